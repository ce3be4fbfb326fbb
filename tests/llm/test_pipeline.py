import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from crossmap.llm import decontaminate, near_dup, pii, toxicity
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_near_dup import brute as brute_components
from tests.llm.test_tokens import check_packing

NAMES = ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]
ITEM = "which of the following rivers flows through the old town of the capital city"
BAD = "you vile rotten fool nasty"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents, labels and benchmark; documents of every kind that a stage acts on."""
    source, folder = random.Random(3), str(tmp_path_factory.mktemp("sf"))
    pool = [f"word{i}" for i in range(400)]
    plain = [" ".join(source.choices(pool, k=source.randint(5, 60))) for _ in range(60)]
    texts = [text + (f" {BAD}" if i % 4 == 0 else "") for i, text in enumerate(plain)]
    texts += [plain[1], plain[1].upper(), plain[2] + " more", f"{plain[3]} {ITEM} {plain[5]}", ITEM.title() + "!"]
    texts += [f"write to a.b@c.org or +1 (017) 555-7713, {plain[6]}", f"write to mary [at] example [dot] org, {plain[7]}", None, "", "x " * 9000]
    rows = [(i, text, "en", f"src{i % 3}", len(text or ""), i) for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, `n_words` int")
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, [row[:2] for row in rows]


def kept(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


def test_stages(spark, corpus, tmp_path):
    folder, documents = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    docs, left, columns = spark.read.parquet(f"{folder}/documents.parquet"), documents, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = columns or docs.columns
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        if name == "toxicity":
            left = [(i, t) for i, t in left if i >= 60 or i % 4]
        elif name == "near_duplicates":
            stay = {c for i, n, c in brute_components(left, near_dup.SHINGLE, near_dup.THRESHOLD)}
            assert len(stay) < len(left)
            left = [(i, t) for i, t in left if i in stay]
        elif name == "decontamination":
            clean = {i for i, _, hits, _ in brute_hits(left, [(1, ITEM)], decontaminate.WINDOW) if not hits}
            assert len(clean) == len(left) - 2
            left = [(i, t) for i, t in left if i in clean]
        else:
            left = [(i, t and pii.masked(t)) for i, t in left]
            assert sum("<email>" in (t or "") for _, t in left) == 2 and sum("<phone>" in (t or "") for _, t in left) == 1
            assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text is not None)
        assert kept(docs) == sorted(left), name
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in left]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    check_packing(last, left, ids, 4096)
    assert sorted(r[:5] for r in corpus_pipeline.run(spark, folder).collect()) == sorted(r[:5] for r in last)


def test_stages_of_an_empty_table(spark, corpus):
    folder, _ = corpus
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == [], name


def test_the_model_needs_no_more_than_its_sample(spark, corpus):
    folder, _ = corpus
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    assert toxicity.fit(docs, labels, sample=10).thresholds != toxicity.fit(docs, labels).thresholds
