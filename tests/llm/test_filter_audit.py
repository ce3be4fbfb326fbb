import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from crossmap.llm import filter_audit
from tests.llm import data

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (None, 1, 1), (5, 0, 1), (99, 1, 1)]


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def some_texts(n, seed=3):
    source = random.Random(seed)
    letters = " \t\n\v\f\r aAbZ#$%&*|é  漢\U0001f600x.,"
    return ["".join(source.choices(letters, k=source.choice([0, 1, 2, 8, 9, 16, 17, 200]))) for _ in range(n)]


@pytest.mark.parametrize("most", [7, 1 << 20])
def test_counts_equal_plain_counts(most):
    texts = [*some_texts(400), data.LONG, "a" * 100 + " " + "a" * 99 + "b", ""]
    found = filter_audit.counted([text.encode() for text in texts], most)
    assert found.tolist() == [plain(text) for text in texts]
    assert filter_audit.counted([]).shape == (0, 5)


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit.Spans, "hashes", lambda self, seeds: np.zeros(len(self.starts), np.uint64))
    texts = some_texts(60, seed=4)
    assert filter_audit.counted([text.encode() for text in texts])[:, 1].tolist() == [plain(text)[1] for text in texts]


def brute(rows, labels):
    """The audit of rows (doc_id, part, text), order by order and document by document."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, mark in labels if mark == 1 and i is not None}
    failed = []
    for i, part, text in rows:
        words, distinct, capitals, points, symbols = plain(text or "")
        smaller = any(j is not None and i is not None and j < i and (other or "") == (text or "") for j, _, other in rows)
        marks = [words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * points, symbols > 0, smaller]
        failed.append((i, part or "", {x for x, mark in zip("ABCDE", marks) if mark}))
    out, shares = {}, Counter()
    for part in {part for _, part, _ in failed}:
        for order in permutations("ABCDE"):
            left = [(i, own) for i, at, own in failed if at == part]
            gone = []
            for step, x in enumerate(order, 1):
                removed = [i for i, own in left if x in own]
                redundant = sum(x in own for _, own in gone)
                gone += [(i, own) for i, own in left if x in own]
                left = [(i, own) for i, own in left if x not in own]
                shares[part, x] += len(removed)
                out[part, "".join(order), step] = [len(left), len(removed), redundant, sum(own == {x} for _, at, own in failed if at == part),
                                                   sum(i in good for i in removed), sum(i in toxic for i in removed)]
    return sorted((*key, *value, shares[key[0], key[1][key[2] - 1]]) for key, value in out.items())


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "doc_id bigint, source string, text string, n_words int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return sorted(tuple(row) for row in filter_audit.audit(docs, marks).collect())


def test_audit_equals_documents_one_by_one(spark):
    source = random.Random(5)
    base = ["word " * 150, "Words " * 250, " ".join(map(str, range(300))), " ".join(map(str, range(300))) + " #", "A B C " * 70, "A " * 100 + "#", ""]
    rows = [(i, source.choice(["x", "y", "", None]), source.choice(base)) for i in range(60)]
    rows += [(i, "x", text) for i, text in data.ODD] + [(7, None, None), (7, "y", "word " * 150), (7, "x", "word " * 150)]
    rows += [(i, "hot", "one text in many copies") for i in range(1000, 1300)]
    labels = [*LABELS, *((i, i % 2, i % 3 == 0) for i in range(6, 50)), *((i, 1, 0) for i in range(1000, 1200))]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    found = audited(spark, rows, labels)
    assert found == brute(rows, labels)
    assert len(found) == 600 * 4


def test_empty_tables(spark):
    assert audited(spark, [], LABELS) == []
    assert {row[3:] for row in audited(spark, [(1, "x", "a")], [])} == {row[3:] for row in brute([(1, "x", "a")], [])}


def test_no_task_takes_a_group_of_copies(spark):
    """Rows are joined by text and identifier, never by text alone."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "'x' AS source", "'the same text' AS text")
    labels = spark.range(10).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    counts = {(row["failed"], row["good"]): row["n"] for row in filter_audit.failing(docs, labels).collect()}
    assert counts == {(1, True): 1, (17, True): 9, (17, False): 3990}
