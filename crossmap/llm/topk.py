"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become sparse rows of integer weights by dimension (term). Candidates
are held in blocks of bounded size as postings by term; the rows of a block of
queries take one term after the other and scatter weight times posting into
dense arrays of scores. Partition selection keeps the k best of a block, and
what different blocks keep is merged per query.

Queries and candidates meet in blocks: the numbers of blocks are spread over a
grid, every candidate block is sent to each query block once, and a task that
gets several candidate blocks for one query block merges them before it emits
rows. Rows are packed into binary blocks before they move.

Defined cases: vectors that are null or hold null or non-finite components, and
rows with a null identifier, take no part; a component that one vector lacks
counts as 0, so vectors of different lengths and empty ones can meet; equal
scores are ordered by the smaller identifier; of rows that repeat an
identifier, each is a candidate of other identifiers, and the one with the
greatest vector asks; an empty table gives an empty result; further columns
can have any names. A score that 64 bits cannot hold raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from crossmap.llm.common import checkpointed, column, shuffle_partitions

SCALE = 64
K = 20
QUERY_EVERY = 20
#: Rows of a block of candidates and of queries; a block of scores stays in the processor's cache.
CANDIDATES, QUERIES = 4096, 1024
#: Queries that accumulate side by side.
SIDE_BY_SIDE = 32
#: Score of a query with itself, below every real one.
_OWN = np.iinfo(np.int64).min + 1
_BLOCK = "block int, ids binary, lengths binary, weights binary"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of every component, as doubles that hold whole numbers."""
    vector = column(df, vector_col).cast("array<double>")
    good = column(df, id_col).isNotNull() & vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.coalesce(good, F.lit(False))).select(
        column(df, id_col).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x * F.lit(float(scale)))).alias("weights"))


def _blocks(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """Rows packed into numbered blocks of at most `size` rows, each sorted by identifier."""
    spark = rows.sparkSession
    count = rows.count()
    n = max(1, -(-count // size))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            flat = batch.column("weights").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(batch.column("weights").value_lengths().to_numpy(zero_copy_only=False))
            places = batch.column("block").to_numpy(zero_copy_only=False)
            for block in np.unique(places):
                own = held.setdefault(int(block), [])
                for i in np.flatnonzero(places == block):
                    start = ends[i - 1] if i else 0
                    own.append((int(ids[i]), flat[start:ends[i]]))
                    if len(own) == size:
                        yield _packed(int(block), own)
                        own.clear()
        for block, own in held.items():
            if own:
                yield _packed(block, own)

    if not count:
        return spark.createDataFrame([], _BLOCK)
    numbered = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int"))
    return checkpointed(numbered.repartition(min(n, shuffle_partitions(spark)), "block").mapInArrow(pack, _BLOCK))


def _packed(block: int, rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    rows = sorted(rows, key=lambda r: r[0])
    weights = np.concatenate([r[1] for r in rows])
    for kind in (np.int16, np.int32):
        if len(weights) == 0 or np.abs(weights).max() <= np.iinfo(kind).max:
            weights = weights.astype(kind)
            break
    data = [np.array([r[0] for r in rows], np.int64), np.array([len(r[1]) for r in rows], np.int32), weights]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in data)], ["block", "ids", "lengths", "weights"])


def _unpacked(ids: bytes, lengths: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers and a matrix of weights, 0 where a vector has no such component."""
    own, each = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int32)
    matrix = np.zeros((len(own), int(each.max(initial=0))), np.int64)
    if weights:
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(weights) // int(each.sum())]
        matrix[np.arange(matrix.shape[1])[None, :] < each[:, None]] = np.frombuffer(weights, kind)
    return own, matrix


class Postings:
    """A block of candidates by term: the rows that have the term, and their weights."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.most = ids, int(np.abs(matrix).max(initial=0))
        self.terms = []
        for term in range(matrix.shape[1]):
            rows = np.flatnonzero(matrix[:, term])
            full = 2 * len(rows) > len(ids)  # a list that names most rows is kept without their numbers
            weights = matrix[:, term] if full else matrix[rows, term]
            self.terms.append((None if full else rows, weights))

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """Scores of a few queries with every row of the block."""
        bound = queries.shape[1] * self.most * int(np.abs(queries).max(initial=0))
        if bound >= 1 << 62:
            raise OverflowError("a score does not fit 64 bits")
        kind = np.int32 if bound < 1 << 31 else np.int64
        out = np.zeros((len(queries), len(self.ids)), kind)
        for term, (rows, weights) in enumerate(self.terms[:queries.shape[1]]):
            asked = np.flatnonzero(queries[:, term])
            if not len(asked) or not len(weights):
                continue
            amounts = queries[asked, term].astype(kind)
            if rows is None and len(asked) == len(queries):
                out += amounts[:, None] * weights.astype(kind)
            elif rows is None:
                out[asked] += amounts[:, None] * weights.astype(kind)
            else:
                out[np.ix_(asked, rows)] += amounts[:, None] * weights.astype(kind)
        return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row by score, then smaller identifier; columns are sorted by identifier."""
    n, width = scores.shape
    if width > k:
        edge = np.partition(scores, width - k, axis=1)[:, width - k]
        above = scores > edge[:, None]
        ties = scores == edge[:, None]
        room = k - above.sum(axis=1)
        taken = above | (ties & (np.cumsum(ties, axis=1) <= room[:, None]))
        places = np.nonzero(taken)[1].reshape(n, k)
    else:
        places = np.broadcast_to(np.arange(width), (n, width))
    return np.take_along_axis(scores, places, axis=1).astype(np.int64), ids[places]


def _search(ids: np.ndarray, queries: np.ndarray, block: Postings, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of a block for each query; the query's own identifier is pushed below every score."""
    width = len(block.terms)
    queries = queries[:, :width]
    parts = []
    for start in range(0, len(ids), SIDE_BY_SIDE):
        scores = block.scores(queries[start:start + SIDE_BY_SIDE])
        own = ids[start:start + SIDE_BY_SIDE]
        first, last = np.searchsorted(block.ids, own, "left"), np.searchsorted(block.ids, own, "right")
        for row in np.flatnonzero(last > first):
            scores[row, first[row]:last[row]] = np.iinfo(scores.dtype).min
        best, places = _best(scores, block.ids, k)
        best[best == np.iinfo(scores.dtype).min] = _OWN
        parts.append((best, places))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = (np.concatenate(x, axis=1) for x in zip(a, b))
    order = np.lexsort((ids, -scores))[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _emitted(ids: np.ndarray, best: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    scores, places = best
    real = scores != _OWN
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(ids, real.sum(axis=1)), places[real], scores[real])], ["query_id", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query, without its own identifier.

    Both sides as integer_vectors gives them. Of query rows that repeat an
    identifier, the one with the greatest vector asks.
    """
    spark = candidates.sparkSession
    asked = _blocks(queries.groupBy("vec_id").agg(F.max("weights").alias("weights")), QUERIES, 1)
    held = _blocks(candidates, CANDIDATES, 2)
    n_asked, n_held = (1 + (x.agg(F.max("block")).first()[0] or 0) for x in (asked, held))
    parts = max(1, min(n_held, 4 * spark.sparkContext.defaultParallelism // n_asked))
    asked = asked.toDF("q", "q_ids", "q_lengths", "q_weights").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    held = held.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)))).withColumn("part", F.col("block") % parts)
    met = held.hint("merge").join(asked.hint("merge"), ["q", "part"]).select("q", "q_ids", "q_lengths", "q_weights", "ids", "lengths", "weights")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, matrix, best = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = [x[i].as_py() for x in batch.columns]
                if row[:2] != now:
                    if best is not None:
                        yield _emitted(ids, best)
                    now, best = row[:2], None
                    ids, matrix = _unpacked(*row[1:4])
                found = _search(ids, matrix, Postings(*_unpacked(*row[4:])), k)
                best = found if best is None else _merge(best, found, k)
        if best is not None:
            yield _emitted(ids, best)

    kept = met.mapInArrow(score, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return kept.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
