import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crossmap.operators import ordering
from crossmap.operators import verdicts as V


def candidates(spark, monkeypatch_span=None):
    rows = spark.range(4000).select(
        F.lit("a").alias("framework_A"),
        F.when(F.col("id") % 10 == 0, "c").otherwise("b").alias("framework_B"),
        F.floor(F.col("id") / 4).alias("pos_A"),
        (F.col("id") % 4 + 1).cast("int").alias("rank"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.round(F.pmod(F.xxhash64("id"), F.lit(500)) / 500, 4)).alias("semantic_score"),
        F.col("id").cast("string").alias("id_A"), F.col("id").cast("string").alias("id_B"),
    )
    return rows


def test_index_equals_row_number_with_many_ties(spark, monkeypatch):
    monkeypatch.setattr(ordering, "POSITION_SPAN", 50)
    rows = candidates(spark)
    plain = Window.partitionBy("framework_A", "framework_B").orderBy(F.desc("semantic_score"), "pos_A", "rank")
    both = ordering.candidate_index(rows).withColumn("plain", F.row_number().over(plain) - 1)
    assert both.count() == 4000
    assert both.filter("index <> plain").count() == 0


def test_no_task_sorts_a_whole_group(spark, monkeypatch):
    """Ties of one score are sorted in spans, so no part grows with the group."""
    monkeypatch.setattr(ordering, "POSITION_SPAN", 50)
    rows = candidates(spark).withColumn("span", ordering.position_step("pos_A"))
    assert rows.groupBy("framework_B", "semantic_score", "span").count().agg(F.max("count")).first()[0] <= 50 * 4


def test_batches_are_full_but_for_the_last(spark):
    found = V.assign_batches(candidates(spark), 10).groupBy("framework_B", "batch_no").agg(
        F.count("*").alias("n"), F.min("idx").alias("low"), F.max("idx").alias("high")
    )
    last = found.groupBy("framework_B").agg(F.max("batch_no").alias("last"))
    assert found.join(last, "framework_B").filter("batch_no < last AND (n <> 10 OR low <> 0 OR high <> 9)").count() == 0
    assert found.agg(F.sum("n")).first()[0] == 4000


def test_position_index(spark, monkeypatch):
    monkeypatch.setattr(ordering, "POSITION_SPAN", 64)
    rows = spark.range(1000).select(F.lit("f").alias("framework"), (F.col("id") * 7).alias("pos"))
    found = ordering.position_index(rows)
    assert found.filter("index <> pos / 7").count() == 0


def test_image_has_the_order_of_doubles(spark):
    values = [float("-inf"), -1e300, -1.5, -1e-310, -0.0, 0.0, 5e-324, 0.1, 0.1 + 2**-55, 1.0, 1e300, float("inf"), float("nan")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    images = [row["_image"] for row in sorted(ordering.with_image(rows, "v").collect())]
    assert images == sorted(images) and len(set(images)) == len(set(map(repr, values))) - 1


POINTS = {"low": 0.0, "q25": 0.25, "median": 0.5, "p90": 0.9, "high": 1.0}


@pytest.mark.parametrize("most", [ordering.SORTED, 4, 1])
def test_quantiles_in_rounds(spark, monkeypatch, most):
    """Values that share all but their last bits, ties, single rows and negative values, with steps of few values."""
    monkeypatch.setattr(ordering, "SORTED", most)
    source = np.random.default_rng(3)
    groups = {"near": 0.5 + np.arange(300) * 2.0**-52, "tied": np.repeat([0.25, 0.5, 0.75], [50, 2, 49]), "one": np.array([0.125]), "wide": source.normal(size=400) * 10.0 ** source.integers(-9, 9, 400)}
    rows = spark.createDataFrame([(name, float(v)) for name, values in groups.items() for v in values] + [("one", None)], "g string, v double").repartition(5)
    found = {row["g"]: row for row in ordering.exact_quantiles(rows, ["g"], "v", POINTS).collect()}
    for name, values in groups.items():
        assert found[name]["n"] == len(values) and np.isclose(found[name]["mean"], values.mean(), rtol=1e-12)
        for point, q in POINTS.items():
            assert np.isclose(found[name][point], np.quantile(values, q), rtol=1e-15, atol=1e-300), (name, point)


def test_a_million_values_inside_a_thousandth(spark, monkeypatch):
    """The largest set of values that one task sorts stays bounded, however crowded a step is."""
    n, largest = 1_000_000, []
    crowded = ordering._crowded
    monkeypatch.setattr(ordering, "_crowded", lambda state: largest.append(state.agg(F.max("_values")).first()[0]) or crowded(state))
    rows = spark.range(n).select(F.lit("a").alias("g"), (0.5 + F.col("id") * (1e-3 / n)).alias("v"))
    row = ordering.exact_quantiles(rows, ["g"], "v", POINTS).first()
    values = 0.5 + np.arange(n) * (1e-3 / n)
    assert largest[0] == n and largest[-1] <= ordering.SORTED
    assert all(np.isclose(row[point], np.quantile(values, q), rtol=1e-15) for point, q in POINTS.items())


@pytest.mark.parametrize("most", [1, 3])
def test_index_in_crowded_steps(spark, monkeypatch, most):
    monkeypatch.setattr(ordering, "SORTED", most)
    monkeypatch.setattr(ordering, "POSITION_SPAN", 50)
    rows = candidates(spark).withColumn("semantic_score", F.when(F.col("pos_A") % 2 == 0, 0.5 + F.col("pos_A") * 2.0**-50).otherwise(F.col("semantic_score")))
    plain = Window.partitionBy("framework_A", "framework_B").orderBy(F.desc("semantic_score"), "pos_A", "rank")
    both = ordering.candidate_index(rows).withColumn("plain", F.row_number().over(plain) - 1)
    assert both.count() == 4000 and both.filter("index <> plain").count() == 0
