"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Words are runs of letters and digits (every character beyond ASCII counts as a
letter) after A-Z are lower-cased. Every `window` consecutive words of an item
are one window; an item with fewer words, but not none, is one window by itself.
Documents are scanned word by word against the hash set of all windows, every
hit is verified word by word, and the words inside hits are marked. Then spans
or whole documents can be removed.

A benchmark whose windows fit into `block_bytes`, as they are held (flat arrays, and the
words by number), goes to the executors as such. The windows of a larger one are a table: a bitmap of
their hashes, of a fixed size, tells which windows of the documents can be among them, these are joined with the table by hash
and verified word by word, and what is found comes back to the documents by the digest of their text. No
broadcast grows with the benchmark, and the documents are read twice whatever its size.

Defined cases: null or empty texts have no words and no hits; items without
words and items with a null text match nothing; a null item_id is left out of
the listed items, though its windows count as hits; repeated items are listed
once per identifier; equal rows give equal results; an empty benchmark leaves
every document clean. Only the identifier and text columns are read, so further
columns can have any names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.llm.common import checkpointed, column, free_name, slices, utf8, with_fields

WINDOW = 10
#: Bytes of windows that are sent to all tasks, as they are held; and bytes for a word of an item, and for a different word beside its own.
BLOCK_BYTES, WORD_BYTES, NUMBER_BYTES = 64 << 20, 28, 140
#: Bits of the bitmap of window hashes, and tasks that fill it.
BITMAP_BITS, BITMAP_TASKS = 27, 8
#: Results that are sent to all tasks; more are joined, a text with very many copies over so many parts.
SENT_RESULTS, SALTS = 100_000, 32
#: Every byte that is no letter, digit or part of a character beyond ASCII becomes a space.
_LETTERS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    """The normalised words of a UTF-8 text."""
    return text.translate(_LETTERS).split()


def _rolling(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of `length` consecutive word numbers from each start."""
    value = np.zeros(len(at), np.uint64)
    for j in range(length):
        value = value * _MULTIPLIER + ids[at + j].astype(np.uint64)
        value ^= value >> np.uint64(29)
    return value


class Windows:
    """The windows of benchmark items, by length: rising hashes, where each begins in the words of all items, and the items that hold it."""

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int):
        self.number: dict[bytes, int] = {}
        self.items: list[object] = []
        ids, sizes = array("i"), []
        for item, text in items:
            own = [self.number.setdefault(w, len(self.number) + 1) for w in words((text or "").encode("utf-8", "replace"))]
            if own:
                ids.extend(own)
                sizes.append(len(own))
                self.items.append(item)
        self.words = np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32)
        self.tables = []
        sizes = np.array(sizes, np.int64)
        begins = np.cumsum(sizes) - sizes
        lengths = np.minimum(sizes, window)
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            each = sizes[own] - length + 1
            starts = (np.repeat(begins[own] - np.cumsum(each) + each, each) + np.arange(each.sum())).astype(np.int32)
            holders = np.repeat(own, each).astype(np.int32)
            hashes = _rolling(self.words, starts, length)
            order = np.argsort(hashes, kind="stable")
            hashes, starts, holders = hashes[order], starts[order], holders[order]
            new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            for j in range(length):
                new[1:] |= self.words[starts[1:] + j] != self.words[starts[:-1] + j]
            firsts = np.flatnonzero(new)
            self.tables.append((length, hashes[firsts], starts[firsts], np.append(firsts, len(new)), holders))

    def owners(self, table: int, number: int) -> set:
        """The items that hold a window; a null identifier is none."""
        _, _, _, edges, holders = self.tables[table]
        return {self.items[i] for i in np.unique(holders[edges[number]:edges[number + 1]]).tolist()} - {None}

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(number of the table, length, starts of verified hits, number of the window of each); 0 in ids matches nothing."""
        known = np.concatenate(([0], np.cumsum(ids != 0)))
        for table, (length, hashes, begins, _, _) in enumerate(self.tables):
            if len(ids) < length:
                continue
            at = np.flatnonzero(known[length:] - known[:-length] == length)
            value = _rolling(ids, at, length)
            place = np.searchsorted(hashes, value)
            inside = np.minimum(place, len(hashes) - 1)
            hit = hashes[inside] == value
            at, inside, value = at[hit], inside[hit], value[hit]
            starts, numbers = [], []
            while len(at):  # windows of equal hash follow each other, and the same window may come again among them
                same = np.ones(len(at), bool)
                for j in range(length):
                    same &= ids[at + j] == self.words[begins[inside] + j]
                starts.append(at[same])
                numbers.append(inside[same])
                more = inside + 1 < len(hashes)
                more[more] &= hashes[inside[more] + 1] == value[more]
                at, inside, value = at[more], inside[more] + 1, value[more]
            if starts:
                yield table, length, np.concatenate(starts), np.concatenate(numbers)


def _scan_slice(part: pa.RecordBatch, text_col: str, windows: Windows) -> tuple[list[int], list[list[int]], list[list]]:
    """Words, hit spans (start and end word, flat) and items of each row."""
    lists = [words(x) for x in utf8(part, text_col)]
    counts = [len(x) for x in lists]
    starts = np.cumsum([0, *(n + 1 for n in counts)])
    ids = np.zeros(int(starts[-1]) + 1, np.int64)
    get, nothing = windows.number.get, 0
    for at, row in zip(starts, lists):
        if row:
            ids[at:at + len(row)] = [get(w, nothing) for w in row]
    spans: list[list[int]] = [[] for _ in lists]
    items: list[set] = [set() for _ in lists]
    change = np.zeros(len(ids) + 1, np.int64)
    any_hit = False
    for table, length, at, numbers in windows.scan(ids):
        any_hit = any_hit or len(at) > 0
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        rows = np.searchsorted(starts, at, side="right") - 1
        for row, number in set(zip(rows.tolist(), numbers.tolist())):
            items[row].update(windows.owners(table, number))
    if any_hit:
        covered = np.concatenate(([0], (np.cumsum(change) > 0).astype(np.int8)))
        edges = np.flatnonzero(np.diff(covered))
        for begin, end in zip(edges[::2], edges[1::2]):
            row = int(np.searchsorted(starts, begin, side="right")) - 1
            spans[row] += [int(begin - starts[row]), int(end - starts[row])]
    return counts, spans, [sorted(x, key=str) for x in items]


def _held(benchmark: DataFrame, block_bytes: int) -> list[tuple] | None:
    """The items, if their windows can be held within the bytes; None if not."""
    sized = benchmark.select(F.size(F.split("text", "[^0-9A-Za-z\\x80-\\x{10FFFF}]+")).alias("n"), F.length("text").alias("chars"))
    n, chars = sized.agg(F.sum(F.greatest("n", F.lit(0))), F.sum("chars")).first()
    if (n or 0) * (WORD_BYTES + NUMBER_BYTES) + 4 * (chars or 0) > block_bytes:
        # Words that repeat are held once; a closer look counts the different ones by their hashes.
        each = benchmark.select(F.explode(F.split(F.lower("text"), "[^0-9a-z\\x80-\\x{10FFFF}]+")).alias("word"))
        different = each.agg(F.approx_count_distinct("word")).first()[0]
        if (n or 0) * WORD_BYTES + 1.2 * different * NUMBER_BYTES > block_bytes:
            return None
    return [tuple(row) for row in benchmark.select("item", "text").collect()]


def find_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
              window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """The documents with three further columns, and those columns' names by their meaning.

    n_words: words of the text; spans: start and end (exclusive) words of what
    was hit, one after the other; items: the items found, as strings.
    """
    names = {}
    for meaning in ("n_words", "spans", "items"):
        names[meaning] = free_name([*docs.columns, *names.values()], meaning)
    items = benchmark.select(column(benchmark, item_col).alias("item"), column(benchmark, item_text).alias("text"))
    held = _held(items, block_bytes)
    if held is None:
        return _with_joined_hits(docs, names, items, text_col, window), names
    return _with_hits(docs, names, held, text_col, window), names


def _with_hits(df: DataFrame, names: dict[str, str], items: list[tuple], text_col: str, window: int) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(Windows(items, window))
    columns, at = df.columns, df.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            own = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in slices([own], f"c{at}"):
                counts, spans, found = _scan_slice(part, f"c{at}", windows)
                found = [[str(x) for x in row] for row in found]
                arrays = [*part.columns, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, *names.values()])

    n_words, spans, found = names.values()
    return df.mapInArrow(scan, with_fields(df.schema, f"{n_words} bigint, {spans} array<bigint>, {found} array<string>"))


def _grams(own: list[bytes], length: int) -> tuple[np.ndarray, Callable[[int], bytes]]:
    """Hashes of all runs of so many words, and the run at a place as bytes."""
    ids = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in own), np.uint64, len(own))
    return _rolling(ids, np.arange(max(0, len(own) - length + 1)), length), lambda i: b" ".join(own[i:i + length])


def _with_joined_hits(df: DataFrame, names: dict[str, str], items: DataFrame, text_col: str, window: int) -> DataFrame:
    """The same by a join of the windows that a bitmap lets through; the result of a text is joined with its copies."""
    columns, at = df.columns, df.columns.index(text_col)
    n_words, spans, found = names.values()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").cast(pa.string()).to_pylist(), utf8(batch, "text")):
                own = words(text)
                length = min(window, len(own))
                if length:
                    hashes, gram = _grams(own, length)
                    n = len(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes.view(np.int64)), pa.array([gram(i) for i in range(n)], pa.binary()), pa.array([length] * n, pa.int32()), pa.array([item] * n, pa.string())],
                        ["hash", "gram", "length", "item"])

    windows = checkpointed(items.mapInArrow(cut, "hash bigint, gram binary, length int, item string").distinct())
    lengths = sorted(row[0] for row in windows.select("length").distinct().collect())

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
        for batch in batches:
            places = batch.column("hash").to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
            np.bitwise_or.at(bits, (places >> np.uint64(3)).astype(np.int64), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], ["bits"])

    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for (bits,) in windows.select("hash").coalesce(BITMAP_TASKS).mapInArrow(mark, "bits binary").collect():
        bitmap |= np.frombuffer(bits, np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for part in slices(batches, "text"):
            for text in utf8(part, "text"):
                own, digest = words(text), hashlib.sha256(text).digest()
                for length in lengths:
                    hashes, gram = _grams(own, length)
                    places = hashes >> np.uint64(64 - BITMAP_BITS)
                    kept = np.flatnonzero((bits[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1)
                    if len(kept):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([digest] * len(kept), pa.binary()), pa.array(kept, pa.int64()), pa.array([length] * len(kept), pa.int32()),
                             pa.array(hashes[kept].view(np.int64)), pa.array([gram(i) for i in kept.tolist()], pa.binary())], ["digest", "start", "length", "hash", "gram"])

    texts = df.select(column(df, text_col).alias("text"))
    asked = texts.mapInArrow(candidates, "digest binary, start bigint, length int, hash bigint, gram binary").distinct()
    hits = asked.join(windows, ["hash", "length", "gram"])
    places = hits.groupBy("digest", "start", "length").agg(F.collect_set("item").alias("items"))
    result = places.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("places"),
                                          F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    result = checkpointed(result)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])], f"c{at}"):
                own = utf8(part, f"c{at}")
                added = [pa.array([len(words(x)) for x in own], pa.int64()), pa.array([hashlib.sha256(x).digest() for x in own], pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*columns, n_words, key])

    key = free_name([*columns, *names.values()], "digest")
    rows = df.mapInArrow(measure, with_fields(df.schema, f"{n_words} bigint, {key} binary"))
    merged = F.aggregate("places", F.array().cast("array<bigint>"), lambda out, x: F.when(
        (F.size(out) > 0) & (x["start"] <= F.element_at(out, -1)), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.greatest(F.element_at(out, -1), x["end"])))
    ).otherwise(F.concat(out, F.array(x["start"], x["end"]))))
    result = result.select(F.col("digest").alias(key), merged.alias(spans), F.col("items").alias(found))
    if result.limit(SENT_RESULTS + 1).count() <= SENT_RESULTS:
        joined = rows.join(F.broadcast(result), key, "left")
    else:
        salt = free_name([*columns, *names.values(), key], "salt")
        dealt = result.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        known = [column(rows, f.name) for f in df.schema.fields if f.name != text_col and f.dataType.typeName() != "map"]
        joined = rows.withColumn(salt, F.pmod(F.xxhash64(*known) if known else F.lit(0), F.lit(SALTS)).cast("int")).join(dealt, [key, salt], "left")
    empty = {spans: F.array().cast("array<bigint>"), found: F.array().cast("array<string>")}
    return joined.select(*(column(joined, c) for c in (*columns, n_words)), *(F.coalesce(column(joined, name), value).alias(name) for name, value in empty.items()))


def hit_words(spans) -> F.Column:
    """Number of words inside flat spans."""
    sign = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(sign, F.lit(0).cast("bigint"), lambda a, x: a + x)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    hits, names = find_hits(docs, benchmark, text_col, **how)
    return hits.filter(F.size(column(hits, names["spans"])) == 0).select(*(column(hits, c) for c in docs.columns))


def without_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents with the words inside hits cut out of their texts; the rest of each text stays as it is."""
    hits, names = find_hits(docs, benchmark, text_col, **how)
    columns, at = docs.columns, docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            texts = own.column(at).to_pylist()
            spans = own.column(len(columns) + 1).to_pylist()
            texts = [_cut(text, flat) if flat else text for text, flat in zip(texts, spans)]
            arrays = [*own.columns[:at], pa.array(texts, own.column(at).type), *own.columns[at + 1:len(columns)]]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return hits.mapInArrow(cut, docs.schema)


def _cut(text: str, flat: list[int]) -> str:
    raw = text.encode("utf-8", "replace")
    plain, places, at = raw.translate(_LETTERS), [], 0
    for word in plain.split():
        at = plain.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    out, kept = b"", 0
    for begin, end in zip(flat[::2], flat[1::2]):
        out += raw[kept:places[begin][0]]
        kept = places[end - 1][1]
    return (out + raw[kept:]).decode("utf-8", "replace")
