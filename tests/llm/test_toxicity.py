import duckdb
import numpy as np
import pyarrow as pa
import pytest

from crossmap.llm import queries, toxicity
from tests.llm import data

CLEAN, BAD = "a calm sentence about the weather and the sea", "you are a vile rotten fool and a nasty one"


def rows(n=60):
    words = "calm sea weather bread house tree river stone paper light".split()
    out = []
    for i in range(n):
        text = " ".join(words[(i + j) % len(words)] for j in range(6))
        out.append((i, text + (" " + " ".join("vile rotten fool nasty".split()[: 1 + i % 4]) if i % 3 == 0 else "")))
    return out


def labels(spark, documents, more=()):
    return spark.createDataFrame([(i, int(i % 3 == 0), 1) for i, _ in documents if i is not None] + list(more), "doc_id bigint, toxic int, quality int")


def test_toxic_rows_go_and_the_rest_stays(spark):
    documents = rows()
    table = data.documents(spark, documents + [(900, BAD), (901, CLEAN), (None, None), (902, ""), (903, data.LONG), (904, data.LONG + " vile rotten fool nasty")])
    kept = toxicity.without_toxic(table, labels(spark, documents, [(None, 1, 1), (5, None, 1), (7777, 1, 1)]))
    assert kept.columns == table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([*(i for i, _ in documents if i % 3), 901, None, 902, 903], key=repr)


def test_severity_rises_with_the_grades(spark):
    documents = rows(200)
    model = toxicity.fit(data.documents(spark, documents), labels(spark, documents))
    out, names = toxicity.scored(data.documents(spark, documents), model)
    severity = {r.doc_id: r[names["severity"]] for r in out.collect()}
    by_words = [np.mean([severity[i] for i, _ in documents if i % 3 == 0 and i % 4 == k]) for k in range(4)]
    assert by_words == sorted(by_words) and by_words[0] > 0.5 and by_words[3] > 2
    assert model.thresholds == sorted(model.thresholds)


def test_without_labels_nothing_is_toxic(spark):
    table = data.documents(spark)
    for own in (labels(spark, []), spark.createDataFrame([(1, 0, 1), (4, 0, 0)], "doc_id bigint, toxic int, quality int")):
        assert toxicity.without_toxic(table, own).count() == len(data.ODD)
    assert toxicity.without_toxic(table.limit(0), labels(spark, rows())).collect() == []


def test_repeated_documents_and_double_labels(spark):
    documents = rows() + rows()[:5]
    once = toxicity.without_toxic(data.documents(spark, documents), labels(spark, rows(), [(0, 0, 0)]))
    assert once.filter("doc_id = 0").count() == 0 and once.filter("doc_id = 1").count() == 2


def test_copies_of_a_document_are_fitted_once(spark):
    documents = rows()
    copies = documents + [documents[3]] * 400 + [documents[4]] * 100
    once, often = (toxicity.fit(data.documents(spark, x).repartition(5), labels(spark, documents)) for x in (documents, copies))
    assert once.weights and once == often


def test_gradient_is_that_of_the_likelihood():
    source = np.random.default_rng(1)
    n = 400
    x = source.random((n, 6)) < 0.3
    score = x @ np.array([2.0, 1.0, 0.0, -1.0, 0.5, 3.0])
    grade = np.digitize(score + source.logistic(size=n), [1.0, 2.5, 4.0])
    cells, rows_ = np.nonzero(x)[1], np.nonzero(x)[0]
    model = toxicity._descended(cells, rows_, grade, np.arange(6))

    def likelihood(weights, thresholds):
        above = 1 / (1 + np.exp(np.array(thresholds)[None] - (x @ weights)[:, None]))
        full = np.concatenate((np.ones((n, 1)), above, np.zeros((n, 1))), axis=1)
        return np.log(full[np.arange(n), grade] - full[np.arange(n), grade + 1]).mean() - toxicity.DECAY / 2 * (weights**2).sum()

    weights = np.array([model.weights[i] for i in range(6)])
    best = likelihood(weights, model.thresholds)
    for i in range(6):
        for delta in (-0.05, 0.05):
            moved = weights.copy()
            moved[i] += delta
            assert likelihood(moved, model.thresholds) < best + 1e-6
    assert abs(weights - [2, 1, 0, -1, 0.5, 3]).max() < 0.8


def test_features_are_distinct_words_beginnings_and_lengths():
    found, counts = toxicity.features(pa.array(["Idiot, idiot! idiots", "", None, "ab"]))
    assert counts.tolist() == [2 + 1 + 1 + 2, 0, 0, 1 + 1] and len(found) == 8


@pytest.fixture(scope="module")
def halves():
    con = duckdb.connect()
    sf = "/root/testdata/sf0.1"
    documents = con.execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet' JOIN '{sf}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    toxic = dict(con.execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    return documents, toxic


def test_held_out_accuracy(halves):
    """Fitted on the documents with an even place, tested on the others; about one label in eleven has no word that shows it."""
    documents, toxic = halves
    parts = []
    for odd in (0, 1):
        own = documents[odd::2]
        parts.append((*toxicity.features(pa.array([t for _, t in own])), np.array([toxic[i] == 1 for i, _ in own])))
    model = toxicity.fitted(*parts[0])
    found, counts, truth = parts[1]
    rejected = model.at_least(found, counts, model.table())[:, 0] >= toxicity.REJECT
    assert (rejected & truth).sum() / truth.sum() > 0.8
    assert (rejected & ~truth).sum() <= 0.003 * (~truth).sum()


def test_registered(spark):
    result = queries.REGISTERED["op7_toxicity"](spark, data.SMALL)
    assert result.count() == len(data.columns("documents", "doc_id"))
    assert all(0 <= r.severity <= toxicity.GRADES and 0 <= r.p_toxic <= 1 and r.toxic == (r.p_toxic >= 0.5) for r in result.collect())
