"""Texts in Arrow batches of bounded size, and lineage cuts in the shared folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a task works on at a time; one longer text is one slice.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: Iterable[str], wanted: str) -> str:
    """A column name that clashes with none of those taken (names differ by more than case)."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted


def column(df: DataFrame, name: str) -> Column:
    """A column by its plain name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def with_fields(schema: StructType, ddl: str) -> StructType:
    """A schema with further fields, as mapInArrow takes it."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, also set for checkpoints.

    Where the session names no folder, a local session takes one of its own; a
    cluster has to name one that all executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows computed once and kept in the shared folder, and how many they are, counted as they are written."""
    seen = Observation()
    kept = checkpointed(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return kept, seen.get["n"]


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    It does so once the driver has collected what refers to them, which a driver with free memory puts off.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], name: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in the same order, cut so that a text or binary column has at most so many bytes a slice, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, end - start)
            before, start = int(ends[end - 1]), end
            pa.default_memory_pool().release_unused()


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a column as bytes, null as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a column, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def joined_sha256(items: Column) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


class Words:
    """The words between ASCII white space of a slice of texts, cut when first asked for.

    codes: the number of each word, text after text; ends: where each text ends;
    distinct: the words by number, as bytes; counts: the words of each text.
    """

    def __init__(self, texts: pa.Array):
        self.texts = texts

    def utf8(self) -> list[bytes]:
        """The texts as bytes, null as empty."""
        return [x or b"" for x in self.texts.cast(pa.binary()).to_pylist()]

    @cached_property
    def _parts(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        lists = pc.ascii_split_whitespace(pc.fill_null(self.texts.cast(pa.string()), ""))
        coded = lists.flatten().dictionary_encode()
        codes, ends = coded.indices.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
        distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if b"" in distinct:  # before and after the outer white space
            real = codes != distinct.index(b"")
            ends = np.concatenate(([0], np.cumsum(real)))[ends]
            codes = codes[real]
        return codes, ends, distinct

    codes = property(lambda self: self._parts[0])
    ends = property(lambda self: self._parts[1])
    distinct = property(lambda self: self._parts[2])
    counts = property(lambda self: np.diff(self.ends, prepend=0))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written as a Parquet table of their own in the shared checkpoint folder, and read from there."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.parquet(folder)
