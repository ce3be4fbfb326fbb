"""Requests and answers as streams against the batch run."""

import json

import pytest
from pyspark.sql import functions as F

from crossmap.operators import verdicts as V
from crossmap.streaming import judging

REQUEST = "framework_A STRING, framework_B STRING, batch_no BIGINT, n BIGINT, at TIMESTAMP"
RESPONSE = "framework_A STRING, framework_B STRING, batch_no BIGINT, raw STRING, at TIMESTAMP"


def verdict(score=0.5):
    return {"coverage_A_to_B": score, "coverage_B_to_A": str(score), "confidence": score, "relation_type": "partial"}


def answer(*scores):
    return json.dumps(verdict(*scores) if len(scores) == 1 else {"results": [verdict(x) for x in scores]})


def at(minute):
    return f"2026-01-01T00:{minute:02d}:00"


#: Files by arrival: requests (batch, n, minute) and answers (batch, raw, minute).
STEPS = [
    ([(0, 2, 0), (1, 2, 0), (2, 1, 0)], [(5, answer(0.9), 0)]),
    ([(3, 2, 1)], [(0, answer(0.1, 0.2), 1), (0, answer(0.3, 0.4), 1)]),
    ([], [(0, answer(0.7, 0.7), 2), (2, "no json", 2)]),
    ([(5, 1, 3)], [(99, answer(0.5), 3)]),
    ([(98, 1, 20)], []),
    ([], [(1, answer(0.6, 0.6), 21), (3, answer(0.8, 0.8), 21), (98, answer(0.2), 21)]),
    ([], [(2, answer(0.6), 40)]),
    ([(97, 1, 55)], []),
]


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, judging.ROCKSDB)
    yield spark
    spark.conf.set(key, before)


def test_stream_equals_the_batch_run(rocks, tmp_path):
    spark = rocks
    asked, answered, out = (tmp_path / name for name in ("asked", "answered", "out"))
    asked.mkdir(), answered.mkdir()

    def run():
        read = lambda schema, folder: spark.readStream.schema(schema).json(str(folder))
        closed = judging.closed_requests(read(REQUEST, asked), read(RESPONSE, answered))
        writer = closed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        assert writer.start(str(out)).awaitTermination(180)

    for i, (requests, responses) in enumerate(STEPS):
        (asked / f"{i}.json").write_text("\n".join(json.dumps({"framework_A": "a", "framework_B": "b", "batch_no": b, "n": n, "at": at(m)}) for b, n, m in requests))
        (answered / f"{i}.json").write_text("\n".join(json.dumps({"framework_A": "a", "framework_B": "b", "batch_no": b, "raw": raw, "at": at(m)}) for b, raw, m in responses))
        if i in (1, 2, 4, 7):
            run()
    closed = spark.read.parquet(str(out))
    rows = {r["batch_no"]: (r["n"], r["raw"], r["answered"]) for r in closed.collect()}
    assert closed.count() == len(rows)
    # 1 and 3 were never answered in time; 0 counts its first answer; 2 was answered, though not readably; 5 was answered before it was asked.
    assert rows == {0: (2, answer(0.1, 0.2), True), 1: (2, None, False), 2: (1, "no json", True), 3: (2, None, False), 5: (1, answer(0.9), True), 98: (1, answer(0.2), True)}

    in_time = [(0, answer(0.1, 0.2)), (2, "no json"), (5, answer(0.9)), (98, answer(0.2))]
    requests = spark.createDataFrame([("a", "b", b, n) for b, n in ((0, 2), (1, 2), (2, 1), (3, 2), (5, 1), (98, 1))], "framework_A STRING, framework_B STRING, batch_no BIGINT, n BIGINT")
    responses = spark.createDataFrame([("a", "b", b, raw) for b, raw in in_time], "framework_A STRING, framework_B STRING, batch_no BIGINT, raw STRING")
    for ours, batch in zip(judging.parse_closed(closed), V.parse_responses(requests, responses)):
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, batch.collect()))
    failed = judging.parse_closed(closed)[1]
    batched = requests.select("framework_A", "framework_B", "batch_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("idx"))
    again = V.retry_batches(failed, batched).select("retry_of", "retry_idx").collect()
    assert sorted(map(tuple, again)) == [(1, 0), (1, 1), (3, 0), (3, 1)]
