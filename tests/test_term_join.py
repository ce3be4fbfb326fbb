"""The inverted index over word counts against all pairs of rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crossmap.operators import candidates as C
from crossmap.operators import pairs as P
from crossmap.operators import similarity, term_join
from tests.test_similarity import rows


def worded(spark, n=90, seed=4, common=("the", "of", "and"), hot=40):
    """Three frameworks with words of their own, shared ones and a few that nearly all rows have; one framework has most rows, many of them alike."""
    source = random.Random(seed)
    shared = [f"s{i}" for i in range(60)]
    found = []
    for framework, size in (("a", n), ("big", 3 * n), ("c", n)):
        own = [f"{framework}{i}" for i in range(40)]
        for pos in range(size):
            words = source.choices(own, k=source.randrange(8)) + source.choices(shared, k=source.randrange(5)) + source.choices(common, k=source.randrange(4))
            if framework == "big" and pos < hot:
                words = ["the", "the", "s1", "s2"]
            found.append((framework, pos, words))
    found += [("a", n, []), ("c", n, []), ("c", n + 1, ["the"] * 50)]
    return spark.createDataFrame(found, "framework STRING, pos BIGINT, terms ARRAY<STRING>").withColumn("weight", F.lit(1)).repartition(4)


def brute(words, threshold, k, digits=9):
    groups = {}
    for framework, pos, terms, _ in words.collect():
        groups.setdefault(framework, []).append((pos, Counter(terms)))
    out = []
    for a, b in ((a, b) for a in sorted(groups) for b in sorted(groups) if a < b):
        for pos_a, x in groups[a]:
            scored = []
            for pos_b, y in groups[b]:
                length = (sum(v * v for v in x.values()) ** 0.5) * (sum(v * v for v in y.values()) ** 0.5)
                scored.append((-round(sum(v * y[t] for t, v in x.items()) / length, digits) if length else 0.0, pos_b))
            best = [s for s in sorted(scored) if -s[0] >= threshold][:k]
            out += [(a, b, pos_a, pos_b, -score, rank + 1) for rank, (score, pos_b) in enumerate(best)]
    return sorted(out)


def found(words, threshold, k=5, shard=term_join.SHARD_ROWS):
    pairs = P.framework_pairs(P.frameworks_of(words))
    cells = term_join.term_cells(words, pairs, threshold, k, similarity.framework_sizes(words), rows=shard, digits=9)
    return rows(C.select_candidates(cells, threshold, k).select("framework_A", "framework_B", "pos_A", "pos_B", F.round("semantic_score", 9), "rank"))


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.6, 0.999])
@pytest.mark.parametrize("shard, routed", [(1024, 8), (7, 1)])
def test_index_gives_the_whole_result(spark, monkeypatch, threshold, shard, routed):
    monkeypatch.setattr(term_join, "ROUTED_FROM", routed)
    words = worded(spark)
    assert found(words, threshold, shard=shard) == brute(words, threshold, 5)


def test_large_dictionary_and_many_runs(spark, monkeypatch):
    monkeypatch.setattr(term_join, "SENT_WORDS", 3)
    monkeypatch.setattr(term_join, "RUN_ROWS", 50)
    monkeypatch.setattr(term_join, "ROUTED_FROM", 1)
    words = worded(spark)
    assert found(words, 0.4, shard=16) == brute(words, 0.4, 5)


def test_rows_meet_only_where_their_prefixes_meet(spark):
    """With rare words, most pairs of row and shard are left out; a row whose prefix nobody has asks nobody."""
    source = random.Random(2)
    listed = [(f, pos, [f"w{source.randrange(400)}" for _ in range(3)] + ["the"]) for f in ("a", "b") for pos in range(400)]
    listed.append(("a", 1000, ["alone"] * 5 + ["the"]))
    words = spark.createDataFrame(listed, "framework STRING, pos BIGINT, terms ARRAY<STRING>").withColumn("weight", F.lit(1))
    pairs = P.framework_pairs(P.frameworks_of(words))
    sizes = similarity.framework_sizes(words)
    kept = term_join.numbered(words, 0.7)
    blocks = sizes.select("framework", F.ceil(F.col("n") / 8).alias("blocks"))
    routes = term_join.routes(kept, term_join._shards(kept, blocks), pairs, blocks).collect()
    assert len(routes) == len(set(routes)) and 0 < len(routes) < 0.2 * 400 * 50
    assert not [r for r in routes if r["pos"] == 1000]
    assert found(words, 0.7, shard=8) == brute(words, 0.7, 5)


def test_a_frequent_word_goes_to_all_shards_without_a_list(spark):
    listed = [(f, pos, ["the"]) for f in ("a", "b") for pos in range(300)]
    words = spark.createDataFrame(listed, "framework STRING, pos BIGINT, terms ARRAY<STRING>").withColumn("weight", F.lit(1))
    pairs = P.framework_pairs(P.frameworks_of(words))
    sizes = similarity.framework_sizes(words)
    kept = term_join.numbered(words, 0.5)
    blocks = sizes.select("framework", F.ceil(F.col("n") / 10).alias("blocks"))
    routes = term_join.routes(kept, term_join._shards(kept, blocks), pairs, blocks)
    assert routes.count() == 300 * 30
    assert found(words, 0.5, k=2, shard=10) == brute(words, 0.5, 2)


def test_empty_tables_and_thresholds_without_an_index(spark):
    words = worded(spark, n=5)
    assert found(words.limit(0), 0.3) == []
    with pytest.raises(ValueError):
        found(words, 0.0)


def test_packed_rows_hold_the_same_words_in_few_bytes(spark):
    """Rows that travel to every shard: about three bytes a word, which were sixteen."""
    source = random.Random(5)
    listed = [(f, pos, [f"w{source.randrange(3000)}" for _ in range(300)]) for f in ("a", "b") for pos in range(50)] + [("a", 50, ["w1"] * 70_000 + ["w2"] * 300)]
    words = spark.createDataFrame(listed, "framework STRING, pos BIGINT, terms ARRAY<STRING>").withColumn("weight", F.lit(1))
    kept = term_join.numbered(words, 0.1)
    packed = term_join.packed(kept)
    number, size = kept.agg(F.sum(F.size("terms"))).first()[0], packed.agg(F.sum(F.length("words"))).first()[0]
    assert number > 20_000 and size < 3.2 * number
    assert rows(term_join.prefixes(packed).select("framework", "pos", "prefix", F.to_json("terms"))) == rows(kept.select("framework", "pos", "prefix", F.to_json("terms")))
    assert found(words, 0.1, shard=16) == brute(words, 0.1, 5)


def test_sums_beyond_single_precision_are_exact(spark):
    listed = [(f, pos, ["x"] * (9000 + pos) + ["y"] * (7000 + 3 * pos) + ["z"] * pos) for f in ("a", "b") for pos in range(60)]
    words = spark.createDataFrame(listed, "framework STRING, pos BIGINT, terms ARRAY<STRING>").withColumn("weight", F.lit(1))
    assert found(words, 0.5) == brute(words, 0.5, 5)
