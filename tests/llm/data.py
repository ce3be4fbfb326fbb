"""Small tables for the operators: ordinary, odd and missing values."""

import duckdb

SMALL = "/root/testdata/sf0.001"
LONG = "word " * 20_000 + "x" * 50_000

#: Rows (doc_id, text) with every defined case: null and empty texts, a null id, repeated rows and a very long text.
ODD = [(1, "A small text, with words."), (2, None), (3, ""), (None, "no identifier at all here"), (4, "twice the same row"), (4, "twice the same row"), (5, LONG), (6, " \t\n ")]


def documents(spark, rows=ODD, extra=True):
    """A table of documents; with further columns whose names clash with those of the operators."""
    schema = "doc_id bigint, text string"
    if extra:
        rows = [(*row, i, "z") for i, row in enumerate(rows)]
        schema += ", n_tokens int, `items` string"
    return spark.createDataFrame(rows, schema)


def small(name):
    return duckdb.connect().execute(f"SELECT * FROM '{SMALL}/{name}.parquet'").fetchall()


def columns(name, *wanted):
    return duckdb.connect().execute(f"SELECT {', '.join(wanted)} FROM '{SMALL}/{name}.parquet'").fetchall()


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
