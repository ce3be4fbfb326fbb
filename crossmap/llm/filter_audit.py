"""How text filters overlap, whatever their order, from one pass over the bytes.

A table-driven transducer reads UTF-8: the class of a byte and the state (between
words or inside one) look up the next state and what the byte adds to the counters
of words, capitals, code points and symbols, and whether a word begins or ends. The
next state depends on the byte's class alone, so that the tables are applied to
all bytes of a slice at once. The spans of words go into an open-addressing hash
table by document; a span is taken for one that the table holds only if their bytes
are equal, so that distinct words are counted exactly.

An audit knows of every document which filters it fails. Documents are counted by
part and set of failed filters; those few counts say what every filter removes at
every place of every order, what it removes alone, and its share (Shapley value,
times the number of orders).

Equal texts are known by their SHA-256. No group of copies meets in one task: the
smallest identifier of a text is an aggregate, and it is joined by text and
identifier.

Defined cases: a null text is an empty one; a null part is the empty string; rows
that repeat an identifier count as documents of their own and are not copies of one
another; a null identifier is neither a copy nor an original, and has no labels; a
document labelled twice is good (or toxic) if one label says so; a text of any
length is read in blocks that end between words; an empty table gives an empty
result; further columns can have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmap.llm.common import SLICE_BYTES, checkpointed, column, free_name, slices, utf8, with_fields

SPACES, SYMBOLS = b" \t\n\v\f\r", b"#$%&*|"
#: Classes of bytes; END stands behind every text.
PLAIN, SPACE, CAPITAL, SYMBOL, INNER, END = range(6)
CLASS = np.zeros(256, np.uint8)
CLASS[list(SPACES)] = SPACE
CLASS[0x41:0x5B] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[0x80:0xC0] = INNER
#: State behind a byte of each class: 0 between words, 1 inside one.
NEXT = np.array([1, 0, 1, 1, 1, 0], np.uint8)
#: What a byte of a class adds: code points in the low and capitals in the high 32 bits, symbols alike.
ADDS = np.array([1, 1, 1 + (1 << 32), 1, 0, 0], np.int64)
SYMBOL_ADDS = np.array([0, 0, 0, 1, 0, 0], np.int64)
#: By state times 6 plus class: 1 where a word begins, 2 where one has ended.
EDGE = np.array([1, 0, 1, 1, 1, 0, 0, 2, 0, 0, 0, 2], np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)
MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


class Spans:
    """Spans of a buffer as 64-bit pieces, hashed and compared piece by piece."""

    def __init__(self, data: bytes, starts: np.ndarray, lengths: np.ndarray):
        self.words = np.ndarray((len(data),), "<u8", data + bytes(8), strides=(1,))
        self.starts, self.lengths = starts, lengths

    def piece(self, at: np.ndarray, k: int) -> np.ndarray:
        """The k-th eight bytes of spans that reach so far, without what lies behind them."""
        left = np.minimum(self.lengths[at] - 8 * k, 8).astype(np.uint64)
        return self.words[self.starts[at] + 8 * k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))

    def hashes(self, seeds: np.ndarray) -> np.ndarray:
        value = (seeds.astype(np.uint64) + self.lengths.astype(np.uint64) * np.uint64(0x100000001)) * _MIX
        at, k = np.arange(len(value)), 0
        while len(at):
            mixed = (value[at] ^ self.piece(at, k)) * _MIX
            value[at] = mixed ^ (mixed >> np.uint64(29))
            k += 1
            at = at[self.lengths[at] > 8 * k]
        return value

    def equal(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether spans have the same bytes."""
        same = self.lengths[one] == self.lengths[other]
        at, k = np.flatnonzero(same), 0
        while len(at):
            same[at] = self.piece(one[at], k) == self.piece(other[at], k)
            k += 1
            at = at[same[at] & (self.lengths[one[at]] > 8 * k)]
        return same


def distinct(spans: Spans, owner: np.ndarray) -> np.ndarray:
    """The spans that are the first of their kind in the hash table of their owner."""
    n = len(owner)
    mask = (1 << max(3, (2 * n).bit_length())) - 1
    value = spans.hashes(owner)
    slot = ((value >> np.uint64(20)) & np.uint64(mask)).astype(np.int64)
    held = np.full(mask + 1, -1, np.int32)
    waiting = np.arange(n)
    while len(waiting):
        free = waiting[held[slot[waiting]] < 0]
        held[slot[free]] = free
        there = held[slot[waiting]]
        alike = (value[there] == value[waiting]) & (owner[there] == owner[waiting])
        alike[alike] = spans.equal(there[alike], waiting[alike])
        waiting = waiting[~alike]
        slot[waiting] = (slot[waiting] + 1) & mask
    return held[held >= 0]


def transduced(texts: list[bytes]) -> tuple[np.ndarray, Spans, np.ndarray, np.ndarray]:
    """Counts of each text (words, distinct, capitals, code points, symbols), the spans of
    words, their owners and the distinct ones."""
    data = b" ".join([*texts, b""])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    kind = CLASS[np.frombuffer(data, np.uint8)]
    kind[ends] = END
    before = np.concatenate((NEXT[END:], NEXT[kind[:-1]]))
    edge = EDGE[before * np.uint8(6) + kind]
    starts = np.flatnonzero(edge == 1)
    lengths = np.flatnonzero(edge == 2) - starts
    owner = np.searchsorted(ends, starts)
    spans = Spans(data, starts, lengths)
    firsts = distinct(spans, owner)
    sums = np.add.reduceat(ADDS[kind], begins)
    counts = np.stack([np.bincount(owner, minlength=len(texts)), np.bincount(owner[firsts], minlength=len(texts)),
                       sums >> 32, sums & 0xFFFFFFFF, np.add.reduceat(SYMBOL_ADDS[kind], begins)], axis=1)
    return counts, spans, owner, firsts


def blocks(text: bytes, most: int) -> Iterator[bytes]:
    """A text in blocks of at most `most` bytes that end with white space, or behind a longer word."""
    start = 0
    while start < len(text):
        end = start + most
        if end < len(text):
            last = max(text.rfind(bytes([x]), start, end) for x in SPACES)
            if last < 0:
                found = [x for x in (text.find(bytes([x]), end) for x in SPACES) if x >= 0]
                last = min(found, default=len(text) - 1)
            end = last + 1
        yield text[start:end]
        start = end


def counted(texts: list[bytes], most: int = SLICE_BYTES) -> np.ndarray:
    """Counts of each text; one longer than `most` is read block by block."""
    if not texts:
        return np.zeros((0, len(MEASURES)), np.int64)
    whole = [i for i, text in enumerate(texts) if len(text) <= most]
    out = np.zeros((len(texts), len(MEASURES)), np.int64)
    if whole:
        out[whole] = transduced([texts[i] for i in whole])[0]
    for i, text in enumerate(texts):
        if len(text) > most:
            seen: set[bytes] = set()
            for block in blocks(text, most):
                counts, spans, _, firsts = transduced([block])
                out[i] += counts[0]
                seen.update(block[s:s + n] for s, n in zip(spans.starts[firsts].tolist(), spans.lengths[firsts].tolist()))
            out[i, 1] = len(seen)
    return out


def measured(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The documents with the MEASURES and the digest of their text, and those columns' names by their meaning."""
    names: dict[str, str] = {}
    for meaning in (*MEASURES, "digest"):
        names[meaning] = free_name([*docs.columns, *names.values()], meaning)
    columns, at = docs.columns, docs.columns.index(text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])], f"c{at}"):
                texts = utf8(part, f"c{at}")
                added = [pa.array(x, pa.int64()) for x in counted(texts).T]
                added.append(pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*columns, *names.values()])

    ddl = ", ".join(f"{name} {'binary' if meaning == 'digest' else 'bigint'}" for meaning, name in names.items())
    return docs.mapInArrow(measure, with_fields(docs.schema, ddl)), names


def failures(n_words: Column, n_distinct: Column, n_capitals: Column, n_points: Column, n_symbols: Column, least_words: int = 200,
             distinct_percent: int = 50, capital_percent: int = 2) -> dict[str, Column]:
    """Conditions under which a document fails: too few words (A), too few different ones (B), too many capitals (C), symbols (D)."""
    return {"A": n_words < least_words, "B": 100 * n_distinct < distinct_percent * n_words,
            "C": 100 * n_capitals > capital_percent * n_points, "D": n_symbols > 0}


def failing(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, failed, good, toxic, n): documents by part, bits of the filters ABCDE that they fail, and labels."""
    kept = docs.select(column(docs, id_col).alias("id"), column(docs, part_col).cast("string").alias("part"), column(docs, text_col).alias("text"))
    rows, names = measured(kept)
    conditions = failures(*(F.col(names[x]) for x in MEASURES)).values()
    failed = sum((F.when(condition, 1 << i).otherwise(0) for i, condition in enumerate(conditions)), F.lit(0))
    rows = rows.select("id", F.coalesce("part", F.lit("")).alias("part"), F.col(names["digest"]).alias("digest"), failed.alias("failed"))
    rows = checkpointed(rows.groupBy("id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n")))
    # The copies of a text are counted as such without meeting: only the row with its smallest identifier finds a partner here.
    firsts = rows.filter("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.select(column(labels, id_col).alias("id"), *((column(labels, x) == 1).alias(x) for x in ("quality", "toxic"))).filter("id is not null")
    marks = marks.groupBy("id").agg(*(F.coalesce(F.max(x), F.lit(False)).alias(x) for x in ("quality", "toxic")))
    joined = rows.join(firsts, ["digest", "id"], "left").join(marks, "id", "left")
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    return joined.groupBy("part", (F.col("failed") + copy).alias("failed"), F.coalesce("quality", F.lit(False)).alias("good"),
                          F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(F.sum("n").alias("n"))


def interactions(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """What each filter does at each place of each order, from (part, failed, good, toxic, n): the columns of an audit.

    A part has at most one cell for each set of failed filters, so that its cells are one small row.
    """
    sums = {"n": F.sum("n"), "good": F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)), "toxic": F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0))}
    cells = counts.groupBy("part", "failed").agg(*(value.alias(name) for name, value in sums.items()))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("failed", *sums)).alias("cells"))
    places = []
    for order in permutations(range(len(filters))):
        for step, own in enumerate(order):
            earlier = sum(1 << i for i in order[:step])
            places.append(F.struct(F.lit("".join(filters[i] for i in order)).alias("filter_order"), F.lit(step + 1).alias("step"),
                                   F.lit(earlier).alias("earlier"), F.lit(1 << own).alias("own")))
    rows = parts.select("part", "cells", F.explode(F.array(*places)).alias("at")).select("part", "cells", "at.*")

    def total(where, value=lambda cell: cell["n"]):
        return F.aggregate(F.filter("cells", where), F.lit(0).cast("long"), lambda sum_, cell: sum_ + value(cell))

    def removed(cell):
        return (cell["failed"].bitwiseAND(F.col("earlier")) == 0) & fails(cell)

    def fails(cell):
        return cell["failed"].bitwiseAND(F.col("own")) != 0

    # A filter stands before all others that a document fails in one of as many orders as it fails filters.
    ahead = F.array(*(F.lit(factorial(len(filters)) // k) for k in range(1, len(filters) + 1)))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda c: c["failed"].bitwiseAND(F.col("earlier").bitwiseOR(F.col("own"))) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda c: (c["failed"].bitwiseAND(F.col("earlier")) != 0) & fails(c)).alias("redundant"),
        total(lambda c: c["failed"] == F.col("own")).alias("unique_fails"),
        total(removed, lambda c: c["good"]).alias("good_lost"),
        total(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, lambda c: c["n"] * F.element_at(ahead, F.bit_count(c["failed"]))).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Filters A to E over the documents, for every part, order and step."""
    return interactions(failing(docs, labels, part_col, id_col, text_col))
