import pytest
from pyspark.sql import functions as F

from crossmap.functions import text


def value(spark, column, **columns):
    row = spark.createDataFrame([tuple(columns.values())], list(columns))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("stem, name", [
    ("cis-controls-v8-1", "cis_controls_v8"), ("igi1300-2021", "igi1300"), ("iso20022-1-2013", "iso20022_1"),
    ("owaspV4-0-3", "owaspV4_0"), ("soc2-type2", "soc2_type2"), ("nis2", "nis2"), ("a%20b+c", "a%20b+c"), ("50%-policy", "50%_policy"),
])
def test_framework_name(spark, stem, name):
    assert value(spark, text.framework_name(F.col("p")), p=f"file:/x/y.z/{stem}.yaml") == name


@pytest.mark.parametrize("raw, cleaned", [
    ("Critère 1.2", "Critre 1.2"), ("(GV)", "(GV)"), (" 5.1. ", "5.1"), ("..", ""),
])
def test_clean_id(spark, raw, cleaned):
    assert value(spark, text.clean_id(F.col("p")), p=raw) == cleaned


def test_clean_text_handles_unicode_space(spark):
    assert value(spark, text.clean_text(F.col("p")), p="  a  b\x1c\tc\n") == "a b c"


@pytest.mark.parametrize("length, ending", [(120, "x"), (121, "…")])
def test_title_from_description(spark, length, ending):
    title, description = text.title_and_description(F.col("label"), F.col("desc"))
    row = spark.createDataFrame([(" ", "x" * length)], ["label", "desc"]).select(title.alias("t"), description.alias("d")).first()
    assert row["t"] == "x" * 120 + ("…" if ending == "…" else "") and row["d"] == ("x" * length if length > 120 else "")
    row = spark.createDataFrame([(" ", "x" * length)], ["label", "desc"]).select(text.title_and_description(F.col("label"), F.col("desc"), keep=False)[1].alias("d"))
    assert row.first()["d"] == ""


@pytest.mark.parametrize("tags, title, description, content", [
    (["x", "y"], "T", "One. Two", ("y | T: One. Two", "y | T: One")), ([], "T", "", ("T", "T")), (["x"], "T", ". Two", ("x | T: . Two", "x | T")),
    ([], "T", "a" * 300, ("T: " + "a" * 300, "T: " + "a" * 200)),
])
def test_embedding_text(spark, tags, title, description, content):
    row = spark.createDataFrame([(tags, title, description)], "tags ARRAY<STRING>, title STRING, description STRING")
    found = row.select(*(text.embedding_text(F.col("tags"), F.col("title"), F.col("description"), n) for n in (None, text.SENTENCE_LENGTH))).first()
    assert tuple(found) == content


def test_pair_slug_and_sheet(spark):
    row = spark.createDataFrame([("Ab c-é" + "x" * 40, "B")], ["a", "b"])
    found = row.select(text.pair_slug(F.col("a"), F.col("b")).alias("s"), text.sheet_name(F.col("a"), F.col("b")).alias("t")).first()
    assert found["s"] == ("ab_c__" + "x" * 24) + "__b"
    assert found["t"] == "Ab c-éxxxxxx B"


def test_pair_block(spark):
    row = spark.createDataFrame(
        [("fa", ["t1", "t2", "t3", "t4"], "A title", "d" * 301, "fb", [], "B title", "")],
        "framework_A STRING, tags_A ARRAY<STRING>, title_A STRING, description_A STRING, "
        "framework_B STRING, tags_B ARRAY<STRING>, title_B STRING, description_B STRING",
    )
    whole = row.select(text.pair_block(F.lit(2))).first()[0]
    assert whole == "--- Paire 2 ---\nA (fa [t1, t2, t3, t4]): A title\n" + "d" * 301 + "\n\nB (fb): B title\n(sans description)"
    assert row.select(text.pair_block(F.lit(2), tags_shown=text.TAGS_SHOWN, length=text.DESCRIPTION_LENGTH)).first()[0] == (
        "--- Paire 2 ---\nA (fa [t1, t2, t3]): A title\n" + "d" * 300 + "…\n\nB (fb): B title\n(sans description)"
    )


def test_escape_html(spark):
    assert value(spark, text.escape_html(F.col("p")), p="<a href='x'>\"&amp;\"") == "&lt;a href=&#x27;x&#x27;&gt;&quot;&amp;amp;&quot;"


@pytest.mark.parametrize("score", [0.435, 0.125, 0.285, 0.005, 1.0, -0.004])
def test_score_label_rounds_like_the_binary_number(spark, score):
    label = value(spark, text.score_label(F.col("p"), F.col("p"), F.col("p")), p=score)
    assert label == f"{score:.2f} → {score:.2f}/{score:.2f}"
