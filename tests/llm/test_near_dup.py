import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from crossmap.llm import common, near_dup, queries
from tests.llm import data


def sets(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(documents, width, threshold):
    """(doc_id, set size, smallest identifier reachable) of every row, over all pairs."""
    own = [sets(text, width) for _, text in documents]
    parent = list(range(len(own)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(own)):
        for j in range(i):
            both = len(own[i] & own[j])
            if own[i] and own[j] and threshold[1] * both >= threshold[0] * (len(own[i]) + len(own[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, (identifier, _) in enumerate(documents):
        groups.setdefault(root(i), []).append(identifier)
    names = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, len(s), names[root(k)]) for k, ((i, _), s) in enumerate(zip(documents, own))), key=repr)


def found(df, width, threshold):
    return data.rows(near_dup.near_duplicates(df, shingle=width, threshold=threshold).select("doc_id", "n", "component_id"))


def chain(n, length=40, step=2):
    """Texts of which neighbours overlap by far, and the ends not at all."""
    words = [f"w{i}" for i in range(length + n * step)]
    return [" ".join(words[i * step:i * step + length]) for i in range(n)]


@pytest.fixture(scope="module")
def texts():
    source = random.Random(8)
    pool = [f"word{i}" for i in range(300)]
    out = [" ".join(source.choices(pool, k=source.choice([1, 2, 4, 30, 120]))) for _ in range(60)]
    for base in out[:40]:
        for changes in (0, 1, 2, 3, 6):
            words = base.split()
            for _ in range(changes):
                words[source.randrange(len(words))] = source.choice(pool)
            out.append(" ".join(words))
    return out + chain(9) + ["Same Words Here Now And Then", "same words here now and then", " same  words\there now\nand then "]


@pytest.mark.parametrize("width, threshold", [(3, (85, 100)), (5, (80, 100))])
def test_components(spark, texts, width, threshold):
    documents = data.ODD + [(100 + i, text) for i, text in enumerate(texts)]
    random.Random(1).shuffle(documents)
    assert found(data.documents(spark, documents), width, threshold) == brute(documents, width, threshold)


@pytest.mark.parametrize("cell", [1 << 20, 150])
def test_large_buckets(spark, monkeypatch, cell):
    """A text and many variants of it, of which some overlap enough only with some others."""
    monkeypatch.setattr(near_dup, "SMALL", 4)
    monkeypatch.setattr(near_dup, "CELL", cell)
    source, base = random.Random(9), [f"word{i}" for i in range(80)]
    documents = []
    for i in range(90):
        words = list(base)
        for _ in range(source.randint(0, 5)):
            words[source.randrange(80)] = f"other{source.randrange(20)}"
        documents.append((i, " ".join(words)))
    wanted = brute(documents, 3, (85, 100))
    assert 3 < len({c for *_, c in wanted}) < 60
    assert found(data.documents(spark, documents), 3, (85, 100)) == wanted


def test_empty_table(spark):
    assert near_dup.near_duplicates(data.documents(spark).limit(0)).collect() == []
    assert near_dup.distinct_documents(data.documents(spark).limit(0)).collect() == []


def test_one_of_each_group_stays(spark, texts):
    documents = [(i, text) for i, text in enumerate(texts)]
    table = data.documents(spark, documents)
    kept = near_dup.distinct_documents(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(documents, 5, (80, 100))})


def test_repeated_rows_and_missing_identifiers(spark):
    same = "these are more than five words in a row"
    documents = [(1, same), (1, same), (2, same), (2, "another text that stands for itself alone"), (None, "a text without any identifier at all"), (None, "a text without any identifier at all"),
                 (None, "one more text without any identifier"), (3, None), (3, ""), (4, same)]
    kept = sorted(((r.doc_id, r.text) for r in near_dup.distinct_documents(data.documents(spark, documents)).collect()), key=repr)
    assert kept == sorted([(1, same), documents[3], documents[4], documents[6], (3, None), (3, "")], key=repr)


def registers_of(values):
    return near_dup.sketches(np.concatenate([np.sort(v) for v in values]), np.array([len(v) for v in values]))


def test_registers_merge():
    source = np.random.default_rng(2)
    a, b = (source.integers(0, 2**63, n).astype(np.uint64) for n in (400, 7))
    both = np.unique(np.concatenate((a, b)))
    x, y, z = registers_of([a, b, both])
    assert (near_dup.merged(x, y) == z).all()


@pytest.mark.parametrize("overlap", [0.3, 0.6, 0.85, 1.0])
def test_estimates(overlap):
    source, guesses, agree = np.random.default_rng(3), [], []
    for _ in range(60):
        size = 300
        shared = round(2 * size * overlap / (1 + overlap))
        values = source.integers(0, 2**63, 2 * size).astype(np.uint64)
        x, y = registers_of([values[:size], values[size - shared:2 * size - shared]])
        agree.append((x == y).mean())
        guesses.append(near_dup.estimated_overlap(x[None], y[None], np.array([size]), np.array([size]))[0])
    assert abs(np.mean(guesses) - overlap) < 0.02 and abs(np.mean(agree) - overlap) < 0.02
    assert np.std(guesses) < 0.06


def test_components_of_links(spark):
    source = random.Random(5)
    pairs = [(source.randrange(200), source.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(20)]
    labels = {r.node: r.label for r in near_dup.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    parent = {x: x for pair in pairs for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert labels == {x: root(x) for x in linked}


def test_rounds_of_components_take_few_stages(spark):
    """Each stage leaves files for all of its tasks, so few rows in many partitions take disk by their stages."""
    links = common.checkpointed(spark.createDataFrame([(i, i + 1) for i in range(8)], "a bigint, b bigint"))
    tracker, group = spark.sparkContext.statusTracker(), "rounds of components"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert {r.label for r in near_dup.components(links).collect()} == {0}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    known = {stage for job in tracker.getJobIdsForGroup(group) for stage in tracker.getJobInfo(job).stageIds}
    ran = [stage for stage in known if tracker.getStageInfo(stage).numCompletedTasks]
    assert 0 < len(ran) <= 33


def test_shingles_do_not_cross_texts():
    values, counts = near_dup.shingle_sets(pa.array(["a b c d", "a b", None, "A  B", "b c d a", "c"]), 3)
    ends = np.cumsum(counts)
    parts = [set(values[e - n:e].tolist()) for e, n in zip(ends, counts)]
    assert counts.tolist() == [2, 1, 0, 1, 2, 1]
    assert parts[1] == parts[3] and len(parts[0] & parts[4]) == 1 and not parts[1] & parts[0]


def test_registered(spark):
    documents = data.columns("documents", "doc_id", "text")
    wanted = [(i, n, c, i == c) for i, n, c in brute(documents, 3, (85, 100))]
    assert data.rows(queries.REGISTERED["op3_near_duplicates"](spark, data.SMALL).select("doc_id", "n_shingles", "component_id", "kept")) == sorted(wanted, key=repr)
    assert Fraction(*near_dup.THRESHOLD) == Fraction(4, 5) and near_dup.SHINGLE == 5
