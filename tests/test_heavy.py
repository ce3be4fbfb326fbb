"""Summaries of frequent keys, and joins that split them."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossmap.operators import heavy
from crossmap.operators import verdicts as V
from tests.test_similarity import rows


@pytest.mark.parametrize("seed", range(5))
def test_summary_keeps_every_frequent_key_through_any_merges(seed):
    source = random.Random(seed)
    keys = [source.choice([0, 0, 0, 1, 1, *range(2, 400)]) if source.random() < 0.5 else source.randrange(5000) for _ in range(20_000)]
    most = 16
    summaries = [heavy.lowered(np.array(keys[i:i + 700]), np.ones(len(keys[i:i + 700]), int), most) for i in range(0, len(keys), 700)]
    while len(summaries) > 1:
        a, b = summaries.pop(source.randrange(len(summaries))), summaries.pop(source.randrange(len(summaries)))
        summaries.append(heavy.lowered(np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1])), most))
    found, true = dict(zip(*(x.tolist() for x in summaries[0]))), Counter(keys)
    assert len(found) <= most
    assert {key for key, n in true.items() if n > len(keys) / (most + 1)} <= set(found)
    assert all(n - len(keys) / (most + 1) <= found.get(key, 0) <= n for key, n in true.items())


def skewed(spark, n=20_000):
    """Half of the rows have one key, a quarter another; some keys have no partner, one is null."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 4 == 1, "warm").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    many = spark.range(n).select(F.lit("f").alias("framework"), F.when(F.col("id") != 3, key).alias("id"), F.col("id").alias("row"))
    one = spark.range(990).select(F.lit("f").alias("framework"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"), F.col("id").alias("value"))
    return many, one.union(spark.createDataFrame([("f", "hot", -1), ("f", "warm", -2)], one.schema))


@pytest.fixture
def plain(spark):
    """Without adaptive execution and without broadcasts."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for name, value in zip(before, ("false", "-1", "16")):
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_the_plain_one(plain, how):
    many, one = skewed(plain)
    found = heavy.join_one(many, one, ["framework", "id"], how)
    wanted = many.join(one, ["framework", "id"], how)
    assert rows(found.select(F.coalesce("id", F.lit("")), "row", F.coalesce("value", F.lit(0)))) == rows(wanted.select(F.coalesce("id", F.lit("")), "row", F.coalesce("value", F.lit(0))))
    assert set(found.columns) == set(wanted.columns)


def test_largest_task_is_bounded_without_adaptive_execution(plain):
    many, one = skewed(plain)

    def largest(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    keys = ["framework", "id"]
    assert largest(many.join(one, keys)) >= 10_000
    assert largest(heavy.join_one(many, one, keys)) <= 3 * 20_000 / 16
    assert dict(heavy.heavy_keys(many, keys)).keys() >= {many.filter("id = 'hot'").select(F.xxhash64(*keys)).first()[0]}


def test_lookups_of_texts_split_a_target_that_many_choose(plain):
    spark = plain
    requirements = spark.createDataFrame([("a", str(i), f"A{i}", "", [], i) for i in range(2000)] + [("b", "0", "B0", "", [], 0), ("b", "1", "B1", "", [], 1)],
                                         "framework string, id string, title string, description string, tags array<string>, pos bigint")
    chosen = spark.range(2000).select(F.lit("a").alias("framework_A"), F.col("id").cast("string").alias("id_A"), F.lit("b").alias("framework_B"),
                                      F.when(F.col("id") % 50 == 0, "1").otherwise("0").alias("id_B"))
    found = V._with_texts(chosen, requirements)
    assert found.count() == 2000 and found.filter("title_B = 'B0'").count() == 1960
    assert found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000


def test_empty_and_even_tables(spark):
    many, one = skewed(spark, 50)
    assert heavy.join_one(many.limit(0), one, ["framework", "id"]).count() == 0
    assert heavy.join_one(many, one.limit(0), ["framework", "id"], "left").count() == 50
