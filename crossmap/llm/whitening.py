"""Whitening of embeddings on the principal components that contour integration finds.

Every entry becomes a whole number, floor(scale * c). The distinct vectors are the fit
list. Their number and their sums are added up exactly, then the products of centred
entries, both as sums of each partition first; only the matrix, of the square of the
vectors' length, reaches the driver. Its eigenpairs come from feast.py: quadrature of
complex shifted solves, Rayleigh-Ritz, and inertia counts that say whether one is missing.
Rows are projected where they lie. The covariance of the whitened fit list is measured by a
last pass over it.

Defined cases: rows whose vector is null or holds null or non-finite entries are left out;
rows with a null or repeated identifier stay; a vector without entries has no components, so no
rows; vectors of different lengths are fitted and whitened apart, each length a space of its own; a
component without variance (fewer distinct vectors than components) has null for whitened and does not
count for identity_error; a deviation beyond 64 bits is null; entries can be as great as doubles are, since
products are made of entries divided by the greatest one; vectors that are equal count once in the fit; an empty table
gives an empty result; further columns can have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.llm.common import checkpointed, column
from crossmap.llm.feast import greatest

SCALE, COMPONENTS = 256, 4
#: A component with a smaller share of the greatest variance has none.
LEAST_SHARE = 1e-12
#: Vectors that a task works on at a time.
_ROWS = 4096
#: Tasks that add up what partitions have summed, before it is added up by dimension.
MERGED_BY = 16
_RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, size, x): the vectors in use, x being the whole numbers floor(scale * c) as bytes of doubles."""
    vector = column(df, vector_col).cast("array<double>")
    good = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.filter(F.coalesce(good, F.lit(False))).select(column(df, id_col).cast("long").alias("vec_id"), F.size(vector).alias("size"), vector.alias("x"))

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * float(scale)) + 0.0
            flat = np.clip(flat, -np.finfo(float).max, np.finfo(float).max)
            ends = np.cumsum(batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)) * 8
            data = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate(([0], ends))), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("size"), data.cast(pa.binary())], ["vec_id", "size", "x"])

    return rows.mapInArrow(floored, "vec_id bigint, size int, x binary")


def _matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            data = b"".join(part.column("x").to_pylist())
            yield part, np.frombuffer(data, np.float64).reshape(-1, size)


def _exact_sums(x: np.ndarray) -> list[int]:
    if np.abs(x).max(initial=0) * len(x) < 2.0**62:
        return [int(s) for s in x.astype(np.int64).sum(axis=0)]
    return [sum(int(v) for v in values) for values in x.T]


def totals(fit: DataFrame, size: int) -> tuple[int, list[int], float]:
    """Number of vectors, exact sum and greatest absolute entry of each dimension."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, most = 0, [0] * size, np.zeros(size)
        for part, x in _matrices(batches, size):
            n += part.num_rows
            sums = [a + b for a, b in zip(sums, _exact_sums(x))]
            most = np.maximum(most, np.abs(x).max(axis=0))
        if n:
            yield pa.RecordBatch.from_pydict({"dim": list(range(size)), "n": [n] * size, "total": [str(s) for s in sums], "most": most.tolist()}, schema=schema)

    def summed(group: pa.Table) -> pa.Table:
        return pa.Table.from_pydict({"dim": [group["dim"][0].as_py()], "n": [sum(group["n"].to_pylist())], "total": [str(sum(map(int, group["total"].to_pylist())))],
                                     "most": [max(group["most"].to_pylist())]}, schema=schema)

    ddl = "dim int, n bigint, total string, most double"
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("total", pa.string()), ("most", pa.float64())])
    rows = sorted(_added(fit.mapInArrow(partial, ddl), summed).collect())
    return (rows[0]["n"], [int(row["total"]) for row in rows], max(row["most"] for row in rows)) if rows else (0, [0] * size, 0.0)


def _added(parts: DataFrame, summed: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """One row for each dim from those of all partitions: first within a few tasks, whatever their dim, then by dim."""
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, pa.Table] = {}
        for batch in batches:
            for i, dim in enumerate(batch.column("dim").to_pylist()):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                held[dim] = summed(pa.concat_tables([held[dim], row])) if dim in held else row
        for table in held.values():
            yield from table.to_batches()

    few = parts.repartition(MERGED_BY).mapInArrow(within, parts.schema)
    return few.groupBy("dim").applyInArrow(lambda key, group: summed(group), parts.schema)


def products(fit: DataFrame, size: int, centred, width: int) -> np.ndarray:
    """Sums of products of the `width` entries that `centred` makes of each vector, as a matrix."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((width, width))
        for _, x in _matrices(batches, size):
            y = centred(x)
            out += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([row.tobytes() for row in out], pa.binary())], ["dim", "line"])

    def summed(group: pa.Table) -> pa.Table:
        line = np.sum([np.frombuffer(x, np.float64) for x in sorted(group["line"].to_pylist())], axis=0)
        return pa.table({"dim": pa.array([group["dim"][0].as_py()], pa.int32()), "line": pa.array([line.tobytes()], pa.binary())})

    rows = _added(fit.mapInArrow(partial, "dim int, line binary"), summed).collect()
    out = np.zeros((width, width))
    for row in rows:
        out[row["dim"]] = np.frombuffer(row["line"], np.float64)
    return (out + out.T) / 2


@dataclass
class Model:
    """What whitening needs: the fit list's number and sums, and its components, the greatest variance first.

    Values are divided by `unit`, the greatest absolute entry as a power of two, before they are centred.
    """

    n: int
    sums: list[int]
    unit: float
    variances: np.ndarray
    vectors: np.ndarray
    share: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x / self.unit - np.array([float(Fraction(s, self.n) / Fraction(self.unit)) for s in self.sums])

    def used(self) -> np.ndarray:
        return self.variances > LEAST_SHARE * self.variances.max(initial=0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over their standard deviation, those of components without variance as nan."""
        spread = np.sqrt(np.where(self.used(), self.variances, np.nan))
        return self.centred(x) @ self.vectors / spread

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of the squares of n * x - S; None beyond 64 bits."""
        most = self.n * np.abs(x).max(initial=0) + max(map(abs, self.sums), default=0)
        if most * most * x.shape[1] < 2.0**62:
            return ((self.n * x.astype(np.int64) - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        exact = (sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x)
        return [value if value < 1 << 63 else None for value in exact]


def fitted(fit: DataFrame, size: int, components: int = COMPONENTS) -> Model:
    """The model of distinct vectors of one length."""
    n, sums, most = totals(fit, size)
    model = Model(n, sums, 2.0 ** np.floor(np.log2(most)) if most else 1.0, np.zeros(0), np.zeros((size, 0)), np.zeros(0))
    covariance = products(fit, size, model.centred, size) / max(1, n)
    model.variances, model.vectors = greatest(covariance, components)
    trace = np.trace(covariance)
    model.share = np.maximum(model.variances, 0) / trace if trace > 0 else np.zeros(len(model.variances))
    return model


def identity_error(fit: DataFrame, size: int, model: Model) -> float:
    """The largest entry by which the covariance of the whitened fit list differs from the identity."""
    used = model.used()
    width = int(used.sum())
    if not width:
        return 0.0

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.column_stack((model.whitened(x)[:, used], np.ones(len(x))))

    sums = products(fit, size, with_one, width + 1) / model.n
    return float(np.abs(sums[:width, :width] - np.outer(sums[width, :width], sums[width, :width]) - np.eye(width)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector in use and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = whole_vectors(df, id_col, vector_col, scale)
    fit = checkpointed(rows.select("size", "x").distinct())
    out = spark.createDataFrame([], _RESULT)
    for (size,) in sorted(tuple(row) for row in fit.select("size").distinct().collect()):
        own = fit.filter(F.col("size") == size)
        model = fitted(own, size, components)
        error = identity_error(own, size, model)

        def project(batches: Iterator[pa.RecordBatch], size: int = size, model: Model = model, error: float = error) -> Iterator[pa.RecordBatch]:
            k = len(model.variances)
            for part, x in _matrices(batches, size):
                ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k)))
                white, each = model.whitened(x).ravel(), len(x) * k
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(each, model.n, np.int64)),
                    pa.array([value for value in model.deviations(x) for _ in range(k)], pa.int64()), pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(model.share, len(x))), pa.array(np.full(each, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

        out = out.unionByName(rows.filter(F.col("size") == size).mapInArrow(project, _RESULT))
    return out
