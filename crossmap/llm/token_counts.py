"""Token counts of whole texts (rank-synchronous merging, see bpe.py).

Defined cases: a null text counts as empty and has no tokens; equal rows give
equal rows; special strings inside a text are one token each; an empty table
gives an empty result; further columns can have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.llm.bpe import load
from crossmap.llm.common import Words, column, slices, with_fields

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row. Workers find the vocabulary through public_tokenizers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(public_tokenizers.path(vocabulary))
        for part in slices(batches, "text"):
            tokens = bpe.counts(Words(part.column("text")))
            n_bytes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), n_bytes, pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = df.select(column(df, id_col).alias("id"), column(df, text_col).alias("text"))
    return rows.mapInArrow(count, with_fields(rows.select("id").schema, "n_bytes bigint, n_tokens bigint")).withColumnRenamed("id", id_col)


def with_limit(counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
