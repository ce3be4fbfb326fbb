"""Scores of texts under a language model of word pairs, learnt from part of the texts.

Tokens are the words of a text and one end. P(w | c) = a(c, w) + b(c) * P1(w):
counts of pairs are discounted by DISCOUNT, a = (n(c, w) - DISCOUNT) / n(c); what that
frees, b = DISCOUNT * distinct successors / n(c), goes to the single words, whose
P1 = (n(w) + 1) / (N + V + 1) leaves room for one unknown word. So the
probabilities after any context add up to 1. a and b are quantised in Elias-Fano tries
(elias_fano.py), one for each range of hashed contexts.

Texts are cut into chunks of bounded bytes. A chunk asks the ranges of hashes
for the counts of its distinct words, and the tries for its distinct pairs;
what it asks with holds its own training counts, so one shuffle both
builds a trie and queries it. Answers go back to the chunk. Contexts with more
than one in HOT_SHARE of all training tokens (at most HOT_SHARE words) are spread over
all tries by their successors. Nothing of the vocabulary or the pairs is held as
a whole anywhere.

Chunks are made again in each of the three passes over the texts, so the rows must
come in the same order each time, as they do from files; a chunk that differs
raises an error.

Defined cases: a null or empty text has one token, its end; a null identifier
counts as the empty text when training texts are chosen; without training texts
every token is unknown and its probability 1; repeated rows are learnt from and scored
as often as they occur; an empty table gives an empty result; further columns
can have any names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.llm.common import Words, checkpointed, column, shuffle_partitions, slices, with_fields
from crossmap.llm.elias_fano import PairTrie, quantised, restored

CHUNK_BYTES = 8 << 20
DISCOUNT = 0.75
HOT_SHARE = 1024
#: Training tokens per trie, from which the number of tries follows.
TOKENS_PER_TRIE = 2_000_000
#: Bytes of text per range of hashed words, from which the number of those ranges follows.
BYTES_PER_RANGE = 32 << 20
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\n", b"\r"))
_ANSWER = "chunk string, part int, answer binary"


def held_out(identifier: object, folds: int = 7, fold: int = 2) -> bool:
    return zlib.crc32(("" if identifier is None else str(identifier)).encode()) % folds == fold


class Chunk:
    """Tokens of some texts by number in the chunk's sorted distinct hashes, with the text and training flag of each."""

    def __init__(self, texts: pa.Array, training: np.ndarray):
        words = Words(pc.ascii_lower(texts.cast(pa.string())))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.distinct), np.uint64, len(words.distinct))
        self.vocabulary, numbers = np.unique(np.concatenate((hashes, [END, START])), return_inverse=True)
        self.end, self.start = numbers[-2], numbers[-1]
        n = len(words.counts)
        self.sizes = words.counts + 1
        self.text = np.repeat(np.arange(n), self.sizes)
        last = np.cumsum(self.sizes) - 1
        self.tokens = np.full(len(self.text), self.end, np.int64)
        inside = np.ones(len(self.text), bool)
        inside[last] = False
        self.tokens[inside] = numbers[words.codes]
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[last - self.sizes + 1] = self.start
        self.training = training
        self.key = zlib.crc32(self.tokens.tobytes(), zlib.crc32(self.vocabulary.tobytes()))

    def word_counts(self) -> np.ndarray:
        """Training occurrences of each word; of the start, the number of training texts."""
        learnt = self.training[self.text]
        counts = np.bincount(self.tokens[learnt], minlength=len(self.vocabulary))
        counts[self.start] = self.training.sum()
        return counts

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs (context, word), each token's pair, and the training occurrences of each pair."""
        joint, place = np.unique(self.before * len(self.vocabulary) + self.tokens, return_inverse=True)
        counts = np.bincount(place[self.training[self.text]], minlength=len(joint))
        return joint // len(self.vocabulary), joint % len(self.vocabulary), place, counts


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _range_bits(least: int) -> int:
    """Bits of 2^bits ranges, at least as many as asked for."""
    return max(1, int(least - 1).bit_length())


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value, with their kinds and lengths in front."""
    head = ",".join(f"{a.dtype.str}:{len(a)}" for a in arrays).encode()
    body = b"".join(a.tobytes() for a in arrays)
    raw = len(head).to_bytes(2, "little") + head + body
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(value: bytes) -> list[np.ndarray]:
    raw = pa.decompress(value[8:], decompressed_size=int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    size, arrays = int.from_bytes(raw[:2], "little"), []
    at = 2 + size
    for part in raw[2:2 + size].decode().split(","):
        kind, n = part.rsplit(":", 1)
        arrays.append(np.frombuffer(raw, kind, int(n), at))
        at += int(n) * np.dtype(kind).itemsize
    return arrays


def _small(counts: np.ndarray) -> np.ndarray:
    """Counts in the smallest kind of number that holds them."""
    most = int(counts.max(initial=0))
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch, Chunk]]:
    """Chunks of a partition with names that are the same in every pass."""
    partition = TaskContext.get().partitionId()
    for number, part in enumerate(slices(batches, "text", CHUNK_BYTES)):
        training = np.array([not held_out(x) for x in part.column("id").to_pylist()], bool)
        chunk = Chunk(part.column("text"), training)
        yield f"{partition}.{number}.{chunk.key}", part, chunk


def _row(chunk: str, part: int, value: bytes, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([part], pa.int32()), pa.array([value], pa.binary())], ["chunk", "part", name])


def _edges(sorted_keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2^bits ranges begins in sorted hashes."""
    return np.append(np.searchsorted(sorted_keys >> np.uint64(64 - bits), np.arange(1 << bits, dtype=np.uint64)), len(sorted_keys))


def _word_requests(bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, chunk in _chunks(batches):
            counts, edges = chunk.word_counts(), _edges(chunk.vocabulary, bits)
            for part in np.flatnonzero(np.diff(edges)):
                own = slice(edges[part], edges[part + 1])
                yield _row(name, int(part), _packed(chunk.vocabulary[own], _small(counts[own])), "asked")
    return ask


def _word_answers(table: pa.Table) -> pa.Table:
    """Counts of the words of one range: answers to its chunks, then its totals and frequent words as rows without a chunk."""
    chunks, asked = table.column("chunk").to_pylist(), [_unpacked(x) for x in table.column("asked").to_pylist()]
    part = table.column("part")[0].as_py()
    words, place = np.unique(np.concatenate([x[0] for x in asked]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([x[1] for x in asked]), minlength=len(words)).astype(np.int64)
    ends = np.cumsum([len(x[0]) for x in asked])
    answers = [_packed(_small(counts[place[end - len(x[0]):end]])) for x, end in zip(asked, ends)]
    real = words != START
    top = np.argsort(-counts, kind="stable")[:HOT_SHARE]
    summary = _packed(np.array([counts[real].sum(), (counts[real] > 0).sum()], np.int64), words[top], counts[top])
    return pa.table({"chunk": pa.array([*chunks, None], pa.string()), "part": pa.array([part] * (len(chunks) + 1), pa.int32()), "answer": pa.array([*answers, summary], pa.binary())})


def _spread_keys(contexts: np.ndarray, successors: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Hashes that choose a trie: of the context, or for a frequent context of the pair."""
    return np.where(np.isin(contexts, hot), _mixed(contexts ^ _mixed(successors)), _mixed(contexts))


def _ordered_pairs(chunk: Chunk, hot: np.ndarray, bits: int):
    """A chunk's distinct pairs by trie, context and word: order, hashes, and where each trie begins."""
    context, word, place, counts = chunk.pairs()
    contexts, successors = chunk.vocabulary[context], chunk.vocabulary[word]
    trie = (_spread_keys(contexts, successors, hot) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(trie, kind="stable")  # pairs come sorted by context and word, as the vocabulary is
    edges = np.searchsorted(trie[order], np.arange((1 << bits) + 1))
    return context, word, place, counts, order, contexts[order], successors[order], edges


def _runs(contexts: np.ndarray) -> np.ndarray:
    """Where each run of equal contexts begins, and the end."""
    return np.append(np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))), len(contexts)) if len(contexts) else np.zeros(1, np.int64)


def _pair_requests(hot: np.ndarray, bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.uint64(64 - PairTrie.BITS)
        for name, _, chunk in _chunks(batches):
            _, _, _, counts, order, contexts, successors, edges = _ordered_pairs(chunk, hot, bits)
            counts, short = counts[order], successors >> keep
            for part in np.flatnonzero(np.diff(edges)):
                own = slice(edges[part], edges[part + 1])
                runs = _runs(contexts[own])
                five = short[own].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PairTrie.BITS // 8].reshape(-1)
                yield _row(name, int(part), _packed(contexts[own][runs[:-1]], _small(np.diff(runs)), five, _small(counts[own])), "asked")
    return ask


def _short(five: np.ndarray) -> np.ndarray:
    """The kept bits of successors' hashes as numbers."""
    width = PairTrie.BITS // 8
    out = np.zeros((len(five) // width, 8), np.uint8)
    out[:, :width] = five.reshape(-1, width)
    return out.view("<u8").reshape(-1)


def _pair_answers(hot: np.ndarray, hot_counts: np.ndarray):
    order = np.argsort(hot)
    hot, hot_counts = hot[order], hot_counts[order]

    def answer(table: pa.Table) -> pa.Table:
        """Builds the trie of one range from its chunks' counts and asks it for each distinct context and pair of these once, in rising order."""
        chunks, asked = table.column("chunk").to_pylist(), [_unpacked(x) for x in table.column("asked").to_pylist()]
        part, bits = table.column("part")[0].as_py(), np.uint64(PairTrie.BITS)
        contexts, place = np.unique(np.concatenate([x[0] for x in asked]), return_inverse=True)
        keys = np.repeat(place.astype(np.uint64) << bits, np.concatenate([x[1] for x in asked])) | np.concatenate([_short(x[2]) for x in asked])
        order = np.argsort(keys)
        keys = keys[order]
        new = np.append(True, keys[1:] != keys[:-1])
        pairs = np.empty(len(keys), np.int64)
        pairs[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(np.concatenate([x[3] for x in asked]).astype(np.int64)[order], starts)
        number, successors = (keys[starts] >> bits).astype(np.int64), keys[starts] << np.uint64(64) - bits
        trie, partial = _trie(contexts[number], successors, counts, hot, hot_counts)
        known = trie.context(contexts)
        weights, codes = trie.weights(known), trie.codes(known[number], successors)
        answers, first, start = [], 0, 0
        for one in asked:
            last, stop = first + len(one[0]), start + len(one[3])
            answers.append(_packed(weights[place[first:last]], codes[pairs[start:stop]]))
            first, start = last, stop
        return pa.table({"chunk": pa.array([*chunks, None], pa.string()), "part": pa.array([part] * (len(chunks) + 1), pa.int32()), "answer": pa.array([*answers, _packed(partial)], pa.binary())})
    return answer


def _trie(contexts, successors, counts, hot, hot_counts) -> tuple[PairTrie, np.ndarray]:
    """The trie of those distinct pairs, in rising order, that training texts hold, and the distinct successors here of each frequent context."""
    learnt = counts > 0
    contexts, successors, counts = contexts[learnt], successors[learnt], counts[learnt]
    runs = _runs(contexts)
    own = contexts[runs[:-1]]
    distinct = np.diff(runs)
    totals = np.add.reduceat(counts, runs[:-1]) if len(own) else np.zeros(0, np.int64)
    partial = np.zeros(len(hot), np.int64)
    if len(hot) and len(own):
        place = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
        frequent = hot[place] == own
        totals = np.where(frequent, hot_counts[place], totals)
        partial[place[frequent]] = distinct[frequent]
    else:
        frequent = np.zeros(len(own), bool)
    codes = quantised(np.log10((counts - DISCOUNT) / np.repeat(totals, distinct))) if len(own) else np.zeros(0, np.uint16)
    weights = np.where(frequent, 0, quantised(np.log10(DISCOUNT * distinct / totals))) if len(own) else np.zeros(0)
    return PairTrie(own, runs, successors, codes, weights.astype(np.uint16)), partial


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks themselves: texts, tokens and words, to meet their answers."""
    for name, part, chunk in _chunks(batches):
        identifiers = pa.RecordBatch.from_arrays([part.column("id")], ["id"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, identifiers.schema) as writer:
            writer.write_batch(identifiers)
        tokens = chunk.tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T.reshape(-1)  # bytes of equal weight together, as they compress better
        value = _packed(tokens, chunk.sizes, chunk.training, chunk.vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([value], pa.binary())], ["chunk", "ids", "tokens"])


class _Stored(Chunk):
    """A chunk from its stored tokens."""

    def __init__(self, value: bytes):
        tokens, self.sizes, self.training, self.vocabulary = _unpacked(value)
        self.tokens = np.ascontiguousarray(tokens.reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)
        self.end, self.start = np.searchsorted(self.vocabulary, [END, START])
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[np.cumsum(self.sizes) - self.sizes] = self.start


def _scores(chunk: Chunk, word_answers: list[bytes], pair_answers: dict[int, bytes], hot, hot_weights, bits, total, distinct) -> dict[str, np.ndarray]:
    counts = np.concatenate([_unpacked(x)[0] for x in word_answers]).astype(np.int64)
    if len(counts) != len(chunk.vocabulary):
        raise RuntimeError("rows came in another order than in an earlier pass; write them to a table first")
    single = (counts + 1) / (total + distinct + 1)
    context, word, place, _, order, contexts, _, edges = _ordered_pairs(chunk, hot, bits)
    codes, weights = np.zeros(len(order), np.uint16), np.zeros(len(order), np.uint16)
    for part in np.flatnonzero(np.diff(edges)):
        own = slice(edges[part], edges[part + 1])
        by_context, by_pair = _unpacked(pair_answers[part])
        codes[own] = by_pair
        weights[own] = np.repeat(by_context, np.diff(_runs(contexts[own])))
    lower = restored(weights)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, contexts), len(hot) - 1)
        frequent = hot[at] == contexts
        lower = np.where(frequent, hot_weights[at], lower)
    base = single[word[order]]
    seen = counts[context[order]] > 0
    chance = np.where(seen, restored(codes) + lower * base, base)
    by_pair = np.empty(len(order))
    by_pair[order] = np.log10(chance)
    starts = np.cumsum(chunk.sizes) - chunk.sizes
    return {
        "n_tokens": chunk.sizes, "n_known": np.add.reduceat((counts > 0)[chunk.tokens].astype(np.int64), starts),
        "base_score": np.add.reduceat(np.log10(single)[chunk.tokens], starts), "score": np.add.reduceat(by_pair[place], starts),
    }


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = df.sparkSession
    rows = df.select(column(df, id_col).alias("id"), column(df, text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    word_bits = _range_bits(max(shuffle_partitions(spark), -(-size // BYTES_PER_RANGE)))
    asked = rows.mapInArrow(_word_requests(word_bits), "chunk string, part int, asked binary")
    words = checkpointed(asked.groupBy("part").applyInArrow(_word_answers, _ANSWER))
    total = distinct = 0
    best: list[tuple[int, int]] = []
    for row in words.filter("chunk is null").toLocalIterator():  # at most HOT_SHARE words are held at a time
        sums, own, counts = _unpacked(row["answer"])
        total, distinct = total + int(sums[0]), distinct + int(sums[1])
        best = sorted([*best, *zip(counts.tolist(), own.tolist())], reverse=True)[:HOT_SHARE]
    frequent = sorted((h, n) for n, h in best if n * HOT_SHARE > total or h == int(START))
    hot, hot_counts = np.array([h for h, _ in frequent], np.uint64), np.array([n for _, n in frequent], np.int64)
    bits = _range_bits(max(shuffle_partitions(spark), total // TOKENS_PER_TRIE, -(-size // BYTES_PER_RANGE)))
    asked = rows.mapInArrow(_pair_requests(hot, bits), "chunk string, part int, asked binary")
    pairs = checkpointed(asked.groupBy("part").applyInArrow(_pair_answers(hot, hot_counts), _ANSWER))
    followers = np.zeros(len(hot), np.int64)
    for row in pairs.filter("chunk is null").toLocalIterator():
        followers += _unpacked(row["answer"])[0]
    hot_weights = DISCOUNT * followers / np.maximum(hot_counts, 1)

    answers = words.filter("chunk is not null").withColumn("kind", F.lit(1)).union(pairs.filter("chunk is not null").withColumn("kind", F.lit(2)))
    tokens = rows.mapInArrow(_tokens, "chunk string, ids binary, tokens binary")
    schema = with_fields(rows.select("id").schema, "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")

    def score(key, texts: pa.Table, answered: pa.Table) -> pa.Table:
        if not texts.num_rows or not answered.num_rows:
            raise RuntimeError("rows came in another order than in an earlier pass; write them to a table first")
        identifiers = pa.ipc.open_stream(texts.column("ids")[0].as_py()).read_all()
        chunk = _Stored(texts.column("tokens")[0].as_py())
        found = sorted(zip(*(answered.column(c).to_pylist() for c in ("kind", "part", "answer"))))
        by_pair = {part: x for kind, part, x in found if kind == 2}
        values = _scores(chunk, [x for kind, _, x in found if kind == 1], by_pair, hot, hot_weights, bits, total, distinct)
        n = len(chunk.sizes)
        columns = {"id": identifiers.column("id"), "held_out": pa.array(~chunk.training)} | {k: pa.array(v) for k, v in values.items()}
        columns["train_tokens"] = pa.array(np.full(n, total, np.int64))
        return pa.table({c: columns[c] for c in schema.names})

    scored = tokens.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
    return scored.withColumnRenamed("id", id_col)
