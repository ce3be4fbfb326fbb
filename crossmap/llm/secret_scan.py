"""Secrets in texts: plain patterns, and spans that a conditional random field tags.

Base spans come from three patterns, leftmost and non-overlapping each; a match that is too
short is dropped without another try:

- assign: a key word, = or :, and a value; the value has 8 characters or more.
- access: AKIA and capitals or digits, 16 characters or more.
- hex: 32 or more hexadecimal digits in small letters.

The field (crf.py) tags the tokens of every line as begin of a secret, inside or outside, by
their shape, the words around them and the kind of file. It is trained on windows of tokens of a
bounded sample of documents, in which the values of base spans are tagged; every window with a
secret is also taken without the words before it, and with the last of them only, so that shape and words each count by themselves. Tokens of the sample
in no base span count as outside. What it finds beside
base spans is added as kind `learned`: tagged runs of at least LEAST characters that overlap no base span.

Tokens are runs of letters, digits and + / _ -, and single other characters; lines longer than a slice are
cut at white space. Places are code points, ends exclusive.

Defined cases: a null or empty text has no spans; rows with a null or repeated identifier are scanned like all
others, and one row of a repeated identifier's equal windows is trained on; without any base span in the sample
nothing is added; texts of any length are tagged in blocks of whole lines; equal rows give equal rows; an empty table
gives an empty result; further columns can have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.llm import crf
from crossmap.llm.common import SLICE_BYTES, column, free_name, slices, with_fields
from crossmap.llm.filter_audit import Spans

KINDS, LEARNED = ("assign", "access", "hex"), "learned"
#: The base patterns, and the least length of the group that is named.
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
#: What every base span holds; whole slices are searched for it first.
_HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}"
#: Bounds of the training sample: documents, windows with and without a secret, tokens of a window.
SAMPLE, POSITIVE, NEGATIVE, WINDOW = 8_000, 3_000, 6_000, 24
#: Tokens in front of a secret in its window, and least characters of an added span.
AHEAD, LEAST = 12, 8
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
#: Kinds of bytes: 0 white space, 1 the end of a line, 2 part of a word, 3 a token of its own.
_KIND = np.full(256, 3, np.uint8)
_KIND[:33] = 0
_KIND[[10, 13]] = 1
_KIND[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-")] = 2
_KIND[128:] = 2
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_PLAIN = _LETTERS + bytes(range(33)) + bytes(range(128, 256))


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) by start, then kind."""
    found = []
    for kind, (pattern, group, least) in PATTERNS.items():
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((kind, match.start(), match.end(), match.start(group)))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def file_kind(text: bytes) -> bytes:
    """Size of a text and how much of it is neither letters nor white space, in steps."""
    marks = len(text.translate(None, _PLAIN))
    return b"%d %d" % (min(4, len(text).bit_length() // 4), min(4, marks * 20 // max(1, len(text))))


def apart(runs: list[tuple[int, int]], base: list[tuple[str, int, int, int]]) -> list[tuple[int, int]]:
    """The runs that overlap no base span."""
    if not runs or not base:
        return runs
    starts, reached = np.array([x[1] for x in base]), np.maximum.accumulate([x[2] for x in base])
    before = np.searchsorted(starts, [end for _, end in runs])
    return [run for run, n in zip(runs, before.tolist()) if n == 0 or reached[n - 1] <= run[0]]


class Tokens:
    """The tokens of texts that are joined by line ends: places in bytes, numbers of their lines, and equal ones as kinds."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join([*texts, b""])
        kind = _KIND[np.frombuffer(self.data, np.uint8)]
        word, mark = kind == 2, kind == 3
        edge = np.concatenate(([False], word[:-1]))
        self.starts = np.flatnonzero((word & ~edge) | mark)
        self.ends = np.flatnonzero((word & ~np.concatenate((word[1:], [False]))) | mark) + 1
        self.lines = np.cumsum(kind == 1)[self.starts] if len(kind) else np.zeros(0, np.int64)
        self.text_ends = np.cumsum([len(text) + 1 for text in texts]) - 1
        self.owner = np.searchsorted(self.text_ends, self.starts)

    def kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """The kind of each token, and the first token of each kind; equal hashes are told apart by their bytes."""
        spans = Spans(self.data, self.starts, self.ends - self.starts)
        seed = 0
        while True:
            _, firsts, at = np.unique(spans.hashes(np.full(len(self.starts), seed)), return_index=True, return_inverse=True)
            if spans.equal(firsts[at], np.arange(len(at))).all():
                return at, firsts
            seed += 1

    def points(self, text: int) -> np.ndarray:
        """Code points in front of each byte of a text, and of its end."""
        end = int(self.text_ends[text])
        start = int(self.text_ends[text - 1]) + 1 if text else 0
        own = np.frombuffer(self.data, np.uint8)[start:end]
        return np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))


def blocks(texts: list[bytes], most: int) -> Iterator[list[tuple[int, bytes]]]:
    """Texts (number, bytes) in groups of about `most` bytes; a longer text is cut behind a line, or a blank, or a long word."""
    group, size = [], 0
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > most:
            cut = max(text.rfind(b"\n", start, start + most), text.rfind(b"\r", start, start + most)) + 1
            cut = cut or text.rfind(b" ", start, start + most) + 1 or text.find(b" ", start) + 1 or len(text)
            group.append((i, text[start:cut]))
            yield group
            group, size, start = [], 0, cut
        if size + len(text) - start > most and group:
            yield group
            group, size = [], 0
        group.append((i, text[start:]))
        size += len(text) - start
    if group:
        yield group


def tagged(texts: list[bytes], model: crf.Model, most: int = SLICE_BYTES) -> list[list[tuple[int, int]]]:
    """Tagged runs (start, end) of each text in code points."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    files = [model.files.get(file_kind(text), np.zeros(3, np.float32)) for text in texts]
    passed = dict.fromkeys(range(len(texts)), 0)
    for group in blocks(texts, most):
        tokens = Tokens([text for _, text in group])
        if len(tokens.starts):
            at, firsts = tokens.kinds()
            table = model.table(tokens.data, tokens.starts[firsts], tokens.ends[firsts] - tokens.starts[firsts])
            own = np.array([files[i] for i, _ in group], np.float32)[tokens.owner]
            scores = crf.emissions(table, at, tokens.lines, own)
            tags = crf.decoded(scores, tokens.lines, model.moves)
            firsts, lasts = crf.spans_of(tags, tokens.lines)
            for text in np.unique(tokens.owner[firsts]):
                number, points = group[text][0], tokens.points(text)
                begin = int(tokens.text_ends[text - 1]) + 1 if text else 0
                for first, last in zip(firsts[tokens.owner[firsts] == text], lasts[tokens.owner[firsts] == text]):
                    out[number].append((passed[number] + int(points[tokens.starts[first] - begin]), passed[number] + int(points[tokens.ends[last] - begin])))
        for number, text in group:
            passed[number] += len(text.decode())
    return out


def windows(text: str) -> Iterator[tuple[bool, bytes, bytes, bytes]]:
    """(with a secret, tokens, tags, kind of file): the text in windows of tagged tokens, those with a secret also without most words before it."""
    data = text.encode()
    tokens = Tokens([data])
    if not len(tokens.starts):
        return
    kind, points = file_kind(data), tokens.points(0)
    starts, ends = points[tokens.starts], points[tokens.ends]
    tags = np.zeros(len(starts), np.int8)
    for _, _, end, value in base_spans(text):
        first, last = np.searchsorted(starts, value), np.searchsorted(ends, end, side="right")
        if first < last:
            tags[first:last] = crf.INSIDE
            tags[first] = crf.BEGIN
    names = [data[s:e] for s, e in zip(tokens.starts.tolist(), tokens.ends.tolist())]

    def window(first: int, last: int) -> tuple[bytes, bytes]:
        return b"\0".join(names[first:last]), tags[first:last].tobytes()

    edges = np.concatenate(([0], np.flatnonzero(np.diff(tokens.lines)) + 1, [len(starts)])).tolist()
    for low, high in zip(edges, edges[1:]):
        begins = (low + np.flatnonzero(tags[low:high] == crf.BEGIN)).tolist()
        for at in begins:
            first = max(low, at - AHEAD)
            while tags[first] == crf.INSIDE:
                first += 1
            for start in sorted({first, max(low, at - 1), at}):
                if tags[start] != crf.INSIDE:
                    yield True, *window(start, min(high, start + WINDOW)), kind
        for first in range(low, high, WINDOW):
            last = min(high, first + WINDOW)
            if not tags[first:last].any():
                yield False, *window(first, last), kind


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, positive: int = POSITIVE, negative: int = NEGATIVE) -> crf.Model:
    """The field of the windows of at most `sample` identifiers, trained in one task on at most `positive` and `negative` windows."""
    spark = docs.sparkSession
    ids = docs.select(column(docs, id_col).alias("id")).filter("id is not null").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text")).join(F.broadcast(chosen), "id").select("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "text"):
                for text in part.column("text").to_pylist():
                    found = list(windows(text or ""))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*found), (pa.bool_(), pa.binary(), pa.binary(), pa.binary()))], ["secret", "tokens", "tags", "file"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for tokens, tags, file in zip(*(batch.column(x).to_pylist() for x in ("tokens", "tags", "file"))):
                found.append((tokens.split(b"\0"), list(tags), file))
        model = crf.train(found)
        files = np.array(list(model.files.values()), np.float32)
        yield pa.RecordBatch.from_pydict({"keys": [model.keys.tobytes()], "weights": [model.weights.tobytes()], "names": [list(model.files)], "files": [files.tobytes()],
                                          "moves": [model.moves.tobytes()]}, schema=schema)

    ddl = "keys binary, weights binary, names array<binary>, files binary, moves binary"
    schema = pa.schema([("keys", pa.binary()), ("weights", pa.binary()), ("names", pa.list_(pa.binary())), ("files", pa.binary()), ("moves", pa.binary())])
    cuts = rows.mapInArrow(cut, "secret boolean, tokens binary, tags binary, file binary").distinct()
    order = [F.xxhash64("tokens", "tags", "file"), F.col("tokens"), F.col("tags"), F.col("file")]
    bounded = [cuts.filter(F.col("secret") == secret).orderBy(*order).limit(n) for secret, n in ((True, positive), (False, negative))]
    gathered = bounded[0].unionByName(bounded[1]).repartition(1).sortWithinPartitions("secret", "tokens", "tags", "file")
    found = gathered.mapInArrow(learn, ddl).collect()
    if not found:
        return crf.Model()
    keys, weights, names, files, moves = found[0]
    by_file = np.frombuffer(files, np.float32).reshape(-1, 3)
    return crf.Model(np.frombuffer(keys, np.uint64), np.frombuffer(weights, np.float32).reshape(-1, len(crf.PLACES), 3), {bytes(name): row for name, row in zip(names, by_file)},
                     np.frombuffer(moves, np.float64).reshape(3, 3))


def find_spans(docs: DataFrame, model: crf.Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The documents with arrays of spans `base` and `added`, and those columns' names by their meaning."""
    names: dict[str, str] = {}
    for meaning in ("base", "added"):
        names[meaning] = free_name([*docs.columns, *names.values()], meaning)
    columns, at = docs.columns, docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            for part in slices([batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])], f"c{at}"):
                texts = pc.fill_null(part.column(at).cast(pa.string()), "")
                hinted = pc.match_substring_regex(texts, _HINT).to_pylist()
                base = [base_spans(texts[i].as_py()) if hint else [] for i, hint in enumerate(hinted)]
                runs = [[]] * len(base) if field.empty() else tagged(texts.cast(pa.binary()).to_pylist(), field)
                added = [[(LEARNED, s, e) for s, e in apart(own, plain) if e - s >= LEAST] for own, plain in zip(runs, base)]
                arrays = [pa.array([[{"kind": x[0], "start": x[1], "end": x[2]} for x in row] for row in rows], _TYPE) for rows in (base, added)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*columns, *names.values()])

    return docs.mapInArrow(find, with_fields(docs.schema, ", ".join(f"{name} {SPAN}" for name in names.values()))), names
