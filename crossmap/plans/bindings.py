"""Requirement, vector and verdict tables made from the driver tables."""

from __future__ import annotations

from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.operators import similarity
from crossmap.operators.candidates import candidates
from crossmap.operators.ordering import PAIR
from crossmap.operators.pairs import framework_pairs, in_name_order
from crossmap.operators import verdicts as V
from crossmap.operators.sizes import shared_folder
from crossmap.sources.tables import requirements_from_documents

VECTOR_THRESHOLD = 0.20
TERM_THRESHOLD = 0.15
LETTERS, LETTER_THRESHOLD = "abcdefghijklmnop", 0.97
K = 5
DIGITS = 4
PRUNED_ROWS = 64
SOURCES, TARGETS = ["0", "1", "2"], ["1", "2", "3", "4"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letter_counts(texts: pd.Series) -> np.ndarray:
    """An encoder that needs no model."""
    return np.stack([texts.str.count(letter).to_numpy() for letter in LETTERS], axis=1)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(framework, pos, embedding): the label is the framework."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("label").cast("string").alias("framework"), F.col("vec_id").alias("pos"), "embedding")


def vector_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requirements that stand for the vectors."""
    rows = table(spark, sf_dir, "embeddings")
    number = F.col("vec_id").cast("string")
    return rows.select(
        F.col("label").cast("string").alias("framework"),
        number.alias("id"),
        F.concat(F.lit("Vector "), number).alias("title"),
        F.lit("").alias("description"),
        F.array().cast("array<string>").alias("tags"),
        F.col("vec_id").alias("pos"),
    )


def vector_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(sizes, pairs) of the labels."""
    sizes = similarity.framework_sizes(vectors(spark, sf_dir))
    return sizes, framework_pairs(in_name_order(sizes))


def vector_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(
        vector_requirements(spark, sf_dir), vectors(spark, sf_dir),
        threshold=VECTOR_THRESHOLD, k=K, digits=DIGITS,
    )


def document_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements_from_documents(table(spark, sf_dir, "documents"))


def document_candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(requirements, candidates without titles) of the documents, requirements normalised once and kept as a compressed table."""
    folder = scratch(spark, "requirements")
    document_requirements(spark, sf_dir).write.option("compression", "zstd").parquet(folder)
    rows = spark.read.parquet(folder)
    return rows, candidates(rows, threshold=TERM_THRESHOLD, k=K, digits=DIGITS, titles=False)


def hundredths(a: int, b: int, shift: int = 0) -> Column:
    """Made-up score of a candidate from both positions, in hundredths."""
    return (F.lit(a) * F.col("pos_A") + F.lit(b) * F.col("pos_B") + F.lit(shift)) % 101


def scored(found: DataFrame, shift: int = 0) -> DataFrame:
    """Candidates with the three made-up scores and a justification."""
    return found.withColumns({
        "coverage_A_to_B": hundredths(7, 13, shift) / 100,
        "coverage_B_to_A": hundredths(11, 5, shift) / 100,
        "confidence": hundredths(31, 17, shift) / 100,
        "justification": F.concat(F.lit("<"), F.col("id_A"), F.lit(" & "), F.col("id_B"), F.lit(">")),
    })


def vector_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.classify(scored(vector_candidates(spark, sf_dir)))


def answers(batched: DataFrame, shift: int = 0) -> DataFrame:
    """Responses to the requests of batched candidates, as a judge would write them.

    Every seventh batch of a pair is cut short when it holds several pairs, and
    a candidate whose positions add up to a multiple of 29 gets a coverage
    above one.
    """
    bad = (F.col("pos_A") + F.col("pos_B")) % 29 == 0
    verdict = F.struct(
        F.when(bad, F.lit(1.5)).otherwise(hundredths(7, 13, shift) / 100).alias("coverage_A_to_B"),
        (hundredths(11, 5, shift) / 100).cast("string").alias("coverage_B_to_A"),
        (hundredths(31, 17, shift) / 100).alias("confidence"),
        F.lit("partial").alias("relation_type"),
    )
    rows = batched.groupBy(*PAIR, "batch_no").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("idx", verdict.alias("verdict")))).alias("rows")
    )
    results = F.transform("rows", lambda r: r["verdict"])
    short = (F.col("n") > 1) & (F.col("batch_no") % 7 == 6)
    several = F.to_json(F.struct(F.when(short, F.slice(results, 1, 1)).otherwise(results).alias("results")))
    return rows.select(
        *PAIR, "batch_no", F.when(F.col("n") == 1, F.to_json(F.element_at(results, 1))).otherwise(several).alias("raw")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(framework, region, nation, custkey, name): the market segment is the framework."""
    nations = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_mktsegment").alias("framework"),
        F.col("n_regionkey").alias("region"),
        F.col("n_nationkey").alias("nation"),
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("name"),
    )


def customer_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requirements with three-part identifiers `region.nation.custkey`."""
    rows = customers(spark, sf_dir)
    return rows.select("framework", F.concat_ws(".", "region", "nation", "custkey").alias("id"))


def customer_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration texts, one per segment: expected counts near the real ones.

    Region 4 has one flat count; odd nations of region 3 are left out.
    """
    counted = customers(spark, sf_dir).groupBy("framework", "region", "nation").agg(F.count("*").alias("n"))
    counted = counted.filter("NOT (region = 3 AND nation % 2 = 1)")
    near = F.col("n") + F.col("nation") % 3 - 1
    pick = (
        F.when(F.col("nation") % 3 == 0, F.format_string('"%d.%d.*"', "region", "nation"))
        .when(F.col("nation") % 3 == 1, F.format_string('"%d.%d.2-4"', "region", "nation"))
        .otherwise(F.format_string('"%d.%d.3"', "region", "nation"))
    )
    regions = counted.groupBy("framework", "region").agg(
        F.sum("n").alias("total"),
        F.array_join(F.sort_array(F.collect_list(F.format_string('"%d": %d', F.col("nation"), near))), ", ").alias("subs"),
        F.array_join(F.sort_array(F.collect_list(pick)), ", ").alias("picks"),
    )
    flat = F.col("region") == 4
    group = F.when(flat, F.format_string('"%d": %d', "region", "total")).otherwise(
        F.format_string('"%d": {%s}', "region", "subs")
    )
    picks = F.when(flat, F.lit('"4.*", "4.2-3"')).otherwise(F.col("picks"))
    whole = regions.groupBy("framework").agg(
        F.array_join(F.sort_array(F.collect_list(group)), ", ").alias("groups"),
        F.array_join(F.sort_array(F.collect_list(picks)), ", ").alias("picks"),
    )
    return whole.select(
        F.format_string(
            '{"%s": {"groups": {%s}, "flatGroups": ["1.6", "4"], "overwriteGroupsId": {"2": 7}, '
            '"complianceNA": {"partially": [%s]}}}',
            "framework", "groups", "picks",
        ).alias("value")
    )


DOCUMENT_SPAN = 500


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(framework, path, content): framework documents in YAML, at most 500 customers each.

    Sections are `custkey % 3`, their subsections the nation; some items sit in
    the section itself, some have their own prefix, some only a description.
    """
    rows = customers(spark, sf_dir)
    span = F.floor(F.col("custkey") / DOCUMENT_SPAN)
    kind = F.col("custkey") % 4
    label = F.format_string('%d_label: "%s  of\t%s"', "custkey", "name", "framework")
    desc = F.format_string('%d_desc: "%s."', F.col("custkey"), F.repeat(F.concat("name", F.lit(". ")), 8))
    prefix = F.format_string('%d_prefix: " C.%d. "', "custkey", "custkey")
    item = (
        F.when(kind == 0, desc)
        .when(kind == 1, F.concat_ws(", ", label, desc, prefix))
        .when(kind == 2, label)
        .otherwise(F.concat_ws(", ", label, desc))
    )
    placed = rows.select(
        F.concat(F.lit("part-"), span.cast("string")).alias("framework"),
        (F.col("custkey") % 3).alias("section"), "nation", "custkey",
        F.regexp_replace(item, "\t", r"\\t").alias("item"),
        (F.col("custkey") % 5 == 0).alias("direct"),
    )
    node = placed.groupBy("framework", "section", "direct", F.when(F.col("direct"), -1).otherwise(F.col("nation")).alias("nation")).agg(
        F.array_join(F.collect_list("item"), ", ").alias("items")
    )
    sub = F.concat(
        F.format_string("%d: {title: Nation %d, ", "nation", "nation"),
        F.when(F.col("nation") % 4 == 0, F.format_string('prefix: "N%d", ', "nation")).otherwise(""),
        F.col("items"), F.lit("}"),
    )
    section = node.groupBy("framework", "section").agg(
        F.array_join(F.collect_list(F.when(F.col("direct"), F.col("items")).otherwise(sub)), ", ").alias("body")
    )
    head = F.concat(
        F.when(F.col("section") == 2, "").otherwise(F.format_string('title: " Section %d", ', "section")),
        F.when(F.col("section") == 1, 'prefix: "S-é1", ').otherwise(""),
    )
    text_of = F.concat(F.format_string("%d: {", "section"), head, F.col("body"), F.lit("}"))
    whole = section.groupBy("framework").agg(
        F.array_join(F.reverse(F.sort_array(F.collect_list(text_of))), "\n").alias("content")
    )
    return whole.select("framework", F.concat(F.lit("/in/"), "framework").alias("path"), "content")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def written_documents(spark: SparkSession, sf_dir: str) -> str:
    """The customer documents as files, a folder for each framework."""
    folder = scratch(spark, "documents")
    customer_documents(spark, sf_dir).select("framework", "content").repartition("framework").write.partitionBy("framework").text(folder)
    return folder


def folder_name() -> Column:
    return F.regexp_extract("path", "framework=([^/]+)/", 1)


def title_judge(requests: DataFrame) -> DataFrame:
    """A judge that reads the numbers of both vectors of each pair in the request's text."""
    numbers = F.transform(F.regexp_extract_all("text", F.lit(r"Vector (\d+)"), F.lit(1)), lambda x: x.cast("bigint"))
    rows = requests.withColumn("_n", numbers)

    def part(place, shift):
        return F.get("_n", (2 * place + shift).cast("int"))

    def score(a, b):
        return lambda i: (F.lit(a) * part(i, 0) + F.lit(b) * part(i, 1)) % 101 / 100

    verdicts = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(
        score(7, 13)(i).alias("coverage_A_to_B"), score(11, 5)(i).alias("coverage_B_to_A"), score(31, 17)(i).alias("confidence"), F.lit("partial").alias("relation_type")))
    raw = F.when(F.col("n") == 1, F.to_json(F.get(verdicts, F.lit(0)))).otherwise(F.to_json(F.struct(verdicts.alias("results"))))
    return rows.select(*PAIR, "batch_no", raw.alias("raw"))


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension rows for the even parts: id prefix and one renamed section."""
    span = F.floor(F.col("c_custkey") / DOCUMENT_SPAN)
    parts = table(spark, sf_dir, "customer").select(span.alias("part")).distinct().filter("part % 2 = 0")
    return parts.select(
        F.concat(F.lit("part-"), F.col("part").cast("string")).alias("key"),
        F.lit("K-").alias("section_id_prefix"),
        F.create_map(F.lit("2"), F.lit(12)).alias("overwrite"),
    )
