"""Search through the trigram index against the scan of all titles."""

import random
import re

import pytest
from pyspark.sql import functions as F

from crossmap.operators import search, views
from tests.test_similarity import rows

TITLES = ["Access control policy", "ACCESS to backup tapes", "Backup of logs", "Incident response", "incident RESPONSE plan", "é policy", "", "ab", "Control (access)", "policy.policy", "Logs, logs, logs"]
PATTERNS = ["access", "ACC.SS", "polic(y|ies)", "(backup|incident) ?(of|response)", "^incident.*plan$", "l[o0]gs", "a|b", ".*", "", "(log)+s", "(?:policy)?x?", "control \\(access\\)", "policy\\.policy", "lo{2}gs",
            "(access|ab)", "é pol", "(?x) a c c", "back(?=up)up", "(un", "\\Qaccess\\E", "\\p{L}+ccess", "access|backup|incident", "(access (control|to)|logs, (x|l))", "[ab]ccess control"]


def test_required_runs_are_in_every_match():
    source = random.Random(1)
    pieces = ["access", "log", "ab", "x", "policy", " ", ".", "(a|b)", "(access|logs)", "[abc]", "(log)?", "(lo)+", "x*", "\\.", "c{2}"]
    for _ in range(3000):
        pattern = "".join(source.choices(pieces, k=source.randrange(1, 5)))
        clauses = search.required_grams(pattern)
        for title in TITLES + ["accesslogs", "ccpolicyaccess", "logaccess x", "abab.cc"]:
            if clauses and re.search(pattern, title, re.IGNORECASE):
                assert all(any(grams <= search._grams(title.lower()) for grams in clause) for clause in clauses), (pattern, title)


def test_which_patterns_an_index_can_use():
    assert search.required_grams("access") == [[search._grams("access")]]
    assert search.required_grams("(access|logs)x") == [[search._grams("access"), search._grams("logs")]]
    assert all(search.required_grams(pattern) is None for pattern in ("a|b", ".*", "", "(access)?", "(un", "\\Qaccess\\E", "(access|ab)", "[abc]{5}"))


@pytest.fixture(scope="module")
def tables(spark):
    requirements = spark.createDataFrame([("f" if i % 2 else "g", i, title) for i, title in enumerate(TITLES)], "framework string, pos bigint, title string")
    sides = [requirements.withColumnsRenamed({c: f"{c}_{x}" for c in requirements.columns}) for x in "AB"]
    found = sides[0].crossJoin(sides[1]).withColumn("semantic_score", (F.col("pos_A") + F.col("pos_B")) / 30)
    return found.withColumn("id_A", F.col("pos_A").cast("string")).withColumn("id_B", F.col("pos_B").cast("string")).cache(), search.title_index(requirements).cache()


@pytest.mark.parametrize("pattern", [p for p in PATTERNS if p != "(un"])
def test_index_gives_what_the_scan_gives(tables, pattern):
    found, index = tables
    columns = ["pos_A", "pos_B", "semantic_score"]
    assert rows(search.search_indexed(found, index, 0.2, pattern).select(*columns)) == rows(views.search_candidates(found, 0.2, pattern).select(*columns))
