"""The splitting data source against documents that are read whole."""

import pytest
from pyspark.sql import functions as F

from crossmap.sources import sections
from crossmap.sources.documents import decode_documents, read_documents
from tests.test_similarity import rows

PLAIN = """# a comment: with a colon
---
1:
  title: First
  1_label: "one: two"
  2_desc: |
    lines of text

    more: lines
  3:
    title: Inner
    1_label: é漢
s2: {title: Flow, 1_label: flowing}
"quoted key":
  prefix: Q
  1_label: A
empty:
9:
  title: Last
  1_label: z
  2_prefix: only
"""
ODD = {"a-1.yaml": PLAIN, "b.yml": "{1: {title: t, 1_label: x},\n 2: {1_label: y}}\n", "c.yaml": "", "d.yaml": "# only\n", "e.yaml": "1:\n  1_label: no end", "sub/f.yaml": PLAIN.replace("\n", "\r\n"),
       "sub/a-2.yaml": "5:\n  1_label: the last path of a name\n", "_hidden/g.yaml": PLAIN, "h.txt": PLAIN, "i.yaml": "﻿1:\n  1_label: marked\n2:\n  1_label: b\n"}


@pytest.fixture
def folder(tmp_path):
    for name, content in ODD.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(content, newline="")
    return str(tmp_path)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_every_range_gives_its_sections_once(folder, size):
    found = [row for part in sections.ranges(sections.files(folder), size) for row in sections.sections(part)]
    once = [row for part in sections.ranges(sections.files(folder), 1 << 30) for row in sections.sections(part)]
    assert sorted(found) == sorted(once) and len(set(found)) == len(found)


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_nodes_equal_those_of_whole_documents(spark, folder, size):
    columns = ["framework", "section", "node_nums", "node_titles", "node_prefixes", "n", "label", "desc", "prefix", "pos"]
    found = sections.decode_sections(sections.read_sections(spark, folder, size)).select(*columns)
    documents = read_documents(spark, folder, recursive=True, pattern="*.{yaml,yml}").withColumn("content", F.regexp_replace("content", "^﻿", ""))
    assert rows(found) == rows(decode_documents(documents).select(*columns)) and found.count() > 10


def test_a_large_document_uses_many_tasks(spark, tmp_path):
    body = "".join(f"{s}:\n  title: Section {s}\n" + "".join(f'  {i}_label: "Item {i} of {s}"\n' for i in range(1, 200)) for s in range(400))
    (tmp_path / "big.yaml").write_text(body)
    found = sections.read_sections(spark, str(tmp_path), 1 << 18)
    assert found.rdd.getNumPartitions() == -(-len(body) // (1 << 18)) > 5
    assert found.count() == 400
    nodes = sections.decode_sections(found)
    assert [nodes.count(), nodes.select("pos").distinct().count(), nodes.agg({"pos": "max"}).first()[0]] == [400 * 199, 400 * 199, 400 * 199 - 1]
    first = nodes.filter("section = '7' AND n = 3").first()
    assert (first["pos"], first["section_ord"], first["label"]) == (7 * 199 + 2, 7, "Item 3 of 7")


def test_stream_of_arriving_files(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def run():
        writer = sections.arriving_sections(spark, str(inbox), 64).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        assert writer.start(out).awaitTermination(120)
        return sorted(r["path"].rsplit("/", 1)[1] for r in spark.read.parquet(out).collect())

    (inbox / "a.yaml").write_text(PLAIN)
    assert run() == ["a.yaml"] * 5
    (inbox / "b.yaml").write_text("1:\n  1_label: x\n")
    assert run() == ["a.yaml"] * 5 + ["b.yaml"]
