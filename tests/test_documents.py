import pytest
from crossmap.operators import pairs
from crossmap.sources import dimension, documents, registry

NESTED = """
2:
  title: "Second "
  1_label: "Alpha"
  1_desc: "First. More"
  3:
    title: Inner
    10_desc: "Ten"
    2_label: "Two"
  2_desc: "Only desc"
  1_tags: [ignored]
1:
  title: First
  prefix: "Article X"
  1_prefix: " 5.10. "
  1_label: "Own  prefix\\tid"
  2:
    prefix: "GV."
    1_label: "In subsection"
    1a:
      1_label: "String key is not descended"
  x_label: "No number"
  6_2_label: "Second token is not a field"
  6_desc: "Kept"
  4_prefix: "lonely"
  5_label: null
  7_label: 12
note: "not a section"
s9:
  1_label: "Text key"
"""


def write(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")
    return str(path)


def read(spark, paths, **options):
    found = registry.read_frameworks(spark, paths, **options).orderBy("pos").collect()
    return [(r["framework"], r["id"], r["title"], r["description"], r["tags"], r["pos"]) for r in found]


def test_nested_document(spark, tmp_path):
    path = write(tmp_path, "my fw-2024.yaml", NESTED)
    name = "my_fw"
    assert read(spark, [path]) == [
        (name, "2.1", "Alpha", "First. More", ["Second"], 0),
        (name, "2.2", "Only desc", "", ["Second"], 1),
        (name, "2.3.2", "Two", "", ["Second", "Inner"], 2),
        (name, "2.3.10", "Ten", "", ["Second", "Inner"], 3),
        (name, "5.10", "Own prefix id", "", ["First"], 4),
        (name, "Article X.6", "Kept", "", ["First"], 5),
        (name, "Article X.7", "12", "", ["First"], 6),
        (name, "GV..1", "In subsection", "", ["First"], 7),
        (name, "s9.1", "Text key", "", [], 8),
    ]


def test_section_with_registered_prefix_and_renamed_section(spark, tmp_path):
    path = write(tmp_path, "cis-controls-v8-1.yaml", "3:\n  1_label: A\n11:\n  1_label: B\n12:\n  prefix: P\n  1_label: C\n")
    config = dimension.config_from_text(spark.createDataFrame(
        [('{"cis-controls-v8-1": {"groups": {"3": 1}, "overwriteGroupsId": {"11": 5}}}',)], ["value"]
    ))
    assert [row[1] for row in read(spark, [path], config=config)] == ["CIS-3.1", "CIS-5.1", "P.1"]


def test_a_framework_missing_from_the_configuration_has_no_prefix(spark, tmp_path):
    path = write(tmp_path, "cis-controls-v8-1.yaml", "3:\n  1_label: A\n")
    config = dimension.config_from_text(spark.createDataFrame([('{"other": {"groups": {}}}',)], ["value"]))
    assert [row[1] for row in read(spark, [path], config=config)] == ["3.1"]


def test_repeated_identifiers_stay(spark, tmp_path):
    path = write(tmp_path, "f.yaml", "1:\n  1_prefix: a\n  1_label: A\n  2_prefix: a\n  2_label: B\n")
    assert [(row[1], row[2]) for row in read(spark, [path])] == [("a", "A"), ("a", "B")]


def test_empty_document(spark, tmp_path):
    assert read(spark, [write(tmp_path, "f.yaml", ""), write(tmp_path, "g.yaml", "1:\n  title: t\n")]) == []


def test_listing_skips_hidden_folders_and_keeps_the_last_of_a_name(spark, tmp_path):
    for name in ("a-1.yaml", "sub/a-2.yaml", "sub/b.yaml", "__MACOSX/c.yaml", "d.yml", "e.txt"):
        write(tmp_path, name, "1:\n  1_label: A\n")
    found = {r["framework"]: r["path"] for r in documents.list_frameworks(spark, str(tmp_path)).collect()}
    assert set(found) == {"a", "b"} and found["a"].endswith("sub/a-2.yaml")
    flat = documents.list_frameworks(spark, str(tmp_path), recursive=False)
    assert {r["framework"] for r in flat.collect()} == {"a", "d"}
    loaded = pairs.framework_pairs(pairs.in_load_order(documents.list_frameworks(spark, str(tmp_path))))
    assert [tuple(r) for r in loaded.collect()] == [("a", "b")]
    counts = documents.framework_counts(documents.list_frameworks(spark, str(tmp_path))).first()
    assert tuple(counts) == (2, 1)


def test_listing_does_not_read_contents(spark, tmp_path):
    write(tmp_path, "a.yaml", "1:\n  1_label: A\n")
    plan = documents.list_frameworks(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_dimension(spark):
    dim = dimension.framework_dim(spark)
    assert dim.count() == 41
    names = spark.createDataFrame([("iso27001",), ("elsewhere",)], ["framework"])
    found = {r["framework"]: r for r in dimension.enrich(names, dim).collect()}
    assert found["iso27001"]["survey_key"] == "iso27001-2022" and found["iso27001"]["display_name"] == "ISO 27001:2022"
    other = found["elsewhere"]
    assert (other["survey_key"], other["display_name"], other["domain"], other["language"], other["section_id_prefix"]) == (
        None, "elsewhere", "unknown", "en", "",
    )


def test_configuration(spark, tmp_path):
    path = write(tmp_path, "config.json", """{"f": {"groups": {"1": 3, "2": {"1": 4, "a": 5}, "3": {}},
        "flatGroups": ["1", "2.a"], "overwriteGroupsId": {"2": 9}, "complianceNA": {"no": ["1.2"]}}, "g": {"groups": {"7": 1}}}""")
    config = dimension.read_config(spark, path)
    assert sorted(map(tuple, dimension.expected_counts(config).collect())) == [
        ("f", "1", 3), ("f", "2.1", 4), ("f", "2.a", 5), ("g", "7", 1),
    ]
    assert sorted(map(tuple, dimension.expected_totals(config).collect())) == [("f", 12), ("g", 1)]
    assert sorted(map(tuple, dimension.section_totals(config).collect())) == [("f", "1", 3), ("f", "2", 9), ("g", "7", 1)]
    found = sorted(map(tuple, dimension.sections(config).na.fill("").collect()))
    assert found == [("f", "1", "", 3, "1", True), ("f", "2", "1", 4, "9", False), ("f", "2", "a", 5, "9", True), ("g", "7", "", 1, "7", False)]


def test_registry(spark):
    assert registry.loader("generic") is registry.read_frameworks
    with pytest.raises(KeyError):
        registry.loader("unknown")
    path = "/root/testdata/sf0.001/documents.parquet"
    assert registry.loader("documents")(spark, path).count() == spark.read.parquet(path).count()


def test_no_letter_of_a_document_is_lost(spark):
    from crossmap.sources.tables import requirements_from_documents

    texts = ["\n" + "word " * 100 + "end", "A title\n" + "y" * 500 + ". More. And more.", "Only a title " + "x" * 300]
    rows = spark.createDataFrame([(i, t, "s", "en") for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, source STRING, lang STRING")
    for row in requirements_from_documents(rows).collect():
        whole = " ".join(texts[int(row["id"])].split())
        assert whole in (f"{row['title']} {row['description']}".strip(), row["description"], row["title"])


def test_a_long_document_is_decoded_in_batches(spark, tmp_path):
    from crossmap.sources import decode
    import pandas as pd

    content = "1:\n  title: Long\n" + "".join(f"  {i}_label: item {i}\n" for i in range(1, 20_001))
    batches = list(decode.decode_batches([pd.DataFrame([("long", "p", content)], columns=["framework", "path", "content"])]))
    assert max(map(len, batches)) <= decode.ROWS_AT_ONCE and sum(map(len, batches)) == 20_000
    assert [x for batch in batches for x in batch["pos"]] == list(range(20_000))
