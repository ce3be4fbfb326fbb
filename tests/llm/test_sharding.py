import random
import zlib

from crossmap.llm import queries, sharding
from tests.llm import data


def check(result, documents, shards):
    assert len(result) == len(documents)
    expected = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in documents), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in result), key=repr) == expected
    sizes = [0] * shards
    for shard in range(shards):
        own = [r for r in result if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        sizes[shard] = sum(r["size"] for r in own)
    return sizes


def test_odd_rows(spark):
    rows, slot_map = sharding.shard(data.documents(spark), 4)
    check(rows.collect(), data.ODD, 4)
    assert slot_map.count() == sharding.VIRTUAL_SLOTS
    rows, slot_map = sharding.shard(data.documents(spark).limit(0), 4)
    assert rows.collect() == [] and slot_map.groupBy("shard").count().count() == 4


def test_sizes_are_near_equal(spark):
    source = random.Random(1)
    documents = [(i, "x" * int(source.expovariate(1 / 300))) for i in range(5000)]
    sizes = check(sharding.shard(data.documents(spark, documents), 16)[0].collect(), documents, 16)
    assert max(sizes) - min(sizes) <= 0.005 * sum(sizes) / 16


def test_rebalancing_moves_little():
    source = random.Random(2)
    sizes = [source.randint(500, 1500) for _ in range(4096)]
    first = sharding.rebalanced(sharding.first_map(4096, 16), sizes, 16)
    assert sharding.rebalanced(first, sizes, 16) == first
    grown = sharding.rebalanced(first, sizes, 17)
    held = [sum(s for s, o in zip(sizes, grown) if o == shard) for shard in range(17)]
    assert max(held) - min(held) <= 0.01 * sum(sizes) / 17
    moved = sum(s for s, a, b in zip(sizes, first, grown) if a != b)
    assert moved <= 1.1 * sum(sizes) / 17
    shrunk = sharding.rebalanced(first, sizes, 15)
    assert set(shrunk) == set(range(15))
    assert sum(s for s, a, b in zip(sizes, first, shrunk) if a != b) <= 1.2 * sum(sizes) / 16


def test_a_large_slot_is_no_trouble():
    sizes = [10**6] + [10] * 999
    owner = sharding.rebalanced(sharding.first_map(1000, 4), sizes, 4)
    held = [sum(s for s, o in zip(sizes, owner) if o == shard) for shard in range(4)]
    assert sorted(held)[-1] == 10**6 and max(sorted(held)[:3]) - min(held) <= 20


def test_written_shards(spark, tmp_path):
    documents = [(i, f"text {i}") for i in range(200)]
    table = spark.createDataFrame([(*row, 7, 8) for row in documents], "doc_id bigint, text string, shard int, virtual_slot int")
    rows, slot_map = sharding.shard(table, 4)
    sharding.write_shards(table, slot_map, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out/rows"))
    assert sorted((r.doc_id, r.text, r.shard, r.virtual_slot) for r in back.collect()) == [(*row, 7, 8) for row in documents]
    assert {r.doc_id: r["_shard"] for r in back.collect()} == {r.doc_id: r.shard for r in rows.collect()}
    assert spark.read.parquet(str(tmp_path / "out/map")).select("version").distinct().collect()[0][0] == 1


def test_registered(spark):
    documents = data.columns("documents", "doc_id", "text")
    result = queries.REGISTERED["op10_sharding"](spark, data.SMALL).collect()
    sizes = check(result, documents, 16)
    assert {r.law for r in result} == {"bytes"} and all(r.grown_shard is None for r in result)
    assert max(sizes) <= sum(sizes) / 16 + max(r["size"] for r in result)
