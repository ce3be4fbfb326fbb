"""Lookups of more identifiers than are broadcast."""

from pyspark.sql import functions as F

from crossmap.llm import near_dup
from tests.llm import data
from tests.llm.test_near_dup import brute, found, texts  # noqa: F401


def test_many_identifiers_are_looked_up_by_a_bitmap(spark, texts, monkeypatch):
    """A lookup sends nothing to the driver that grows with the identifiers; with few bits, most documents share one with others."""
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 3)
    monkeypatch.setattr(near_dup, "BITMAP_BITS", 8)
    monkeypatch.setattr(near_dup, "SLOT_BITS", 6)
    sent = []
    monkeypatch.setattr(near_dup.F, "broadcast", lambda df: sent.append(df) or df)
    documents = data.ODD[:4] + [(100 + i, text) for i, text in enumerate(texts)]
    assert found(data.documents(spark, documents), 5, (80, 100)) == brute(documents, 5, (80, 100))
    documents = [(f"{i}", text) for i, text in enumerate(texts)]
    table = spark.createDataFrame(documents, "doc_id string, text string").withColumn("dropped", F.lit("x"))
    stay = sorted({c for _, _, c in brute(documents, 5, (80, 100))})
    kept = near_dup.distinct_documents(table)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == stay
    assert not sent


def test_a_bitmap_holds_all_identifiers_and_has_a_fixed_size(spark):
    ids = spark.range(0, 400_000, 2).select(F.when(F.col("id") > 0, F.col("id")).alias("rep"))
    bits = near_dup.bitmap(ids).value
    places = spark.range(1, 400_000).union(spark.sql("SELECT CAST(NULL AS BIGINT)")).select("id", near_dup._place(F.col("id")).alias("place")).toPandas()
    held = near_dup.marked(places["place"].to_numpy(), bits)
    even = (places["id"].fillna(0) % 2 == 0).to_numpy()
    assert bits.nbytes == 1 << (near_dup.BITMAP_BITS - 3) and held[even].all() and held[~even].mean() < 0.01
