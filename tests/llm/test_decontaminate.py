import hashlib
import re

import pytest

from crossmap.llm import decontaminate, queries
from tests.llm import data

ITEM = "one two three four five six seven eight nine ten eleven twelve"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(documents, items, window=10):
    windows = {}
    for item, text in items:
        own = words(text)
        for i in range(len(own) - min(window, len(own)) + 1 if own else 0):
            windows.setdefault(tuple(own[i:i + window]), set()).add(item)
    out = []
    for identifier, text in documents:
        own, hit, found = words(text), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(own) - length + 1):
                if tuple(own[i:i + length]) in windows:
                    hit.update(range(i, i + length))
                    found |= windows[tuple(own[i:i + length])]
        found.discard(None)
        out.append((identifier, len(own), len(hit), sorted(map(str, found))))
    return sorted(out, key=repr)


def hits(spark, documents, items, **how):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    df, names = decontaminate.find_hits(data.documents(spark, documents), benchmark, **how)
    n_hit = decontaminate.hit_words(df[names["spans"]])
    return data.rows(df.select("doc_id", df[names["n_words"]], n_hit, df[names["items"]]))


CASES = data.ODD + [
    (10, f"before {ITEM.upper()}, after"), (11, ITEM.replace(" ", "-")), (12, ITEM.replace("six", "sax")), (13, "the short item"), (14, "Üñï short ITEM ünï"),
    (15, f"{ITEM} and {ITEM} " * 3), (16, "one two three four five six seven eight nine ten"), (17, "tail one two three four five six seven eight nine"),
]
ITEMS = [(1, ITEM), (2, "Short item!"), (3, None), (4, "..."), (None, "no identifier"), (2, "short ITEM"), (5, ITEM)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_hits(spark, block_bytes):
    wanted = [(i, n, h, [str(x) for x in own]) for i, n, h, own in brute(CASES, ITEMS)]
    assert hits(spark, CASES, ITEMS, block_bytes=block_bytes) == wanted


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "_rolling", lambda ids, at, length: (at * 0).astype("uint64"))
    windows = decontaminate.Windows([(1, "a b c"), (2, "b c d")], 2)
    import numpy as np
    ids = np.array([windows.number[x] for x in (b"b", b"c", b"d", b"a", b"b")])
    got = {}
    for table, _, at, numbers in windows.scan(ids):
        for a, n in zip(at.tolist(), numbers.tolist()):
            got.setdefault(a, set()).update(windows.owners(table, n))
    assert got == {0: {1, 2}, 1: {2}, 3: {1}}


def test_windows_are_held_in_as_many_bytes_as_counted():
    """A megabyte of items takes less than is counted for it, and a small share of what objects would take."""
    import tracemalloc

    text = " ".join(f"w{i % 50_000}" for i in range(170_000))
    items = [(i, text[i * 1000:(i + 1) * 1000]) for i in range(len(text) // 1000)]
    n = sum(len(words(x)) for _, x in items)
    tracemalloc.start()
    windows = decontaminate.Windows(items, 10)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held <= n * decontaminate.WORD_BYTES + len(windows.number) * decontaminate.NUMBER_BYTES + 200 * len(items)


def test_many_results_and_copies_of_a_hit(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SENT_RESULTS", 1)
    documents = CASES + [(1000 + i, f"before {ITEM.upper()}, after") for i in range(300)]
    wanted = [(i, n, h, [str(x) for x in own]) for i, n, h, own in brute(documents, ITEMS)]
    assert hits(spark, documents, ITEMS, block_bytes=1) == wanted


def test_empty_tables(spark):
    assert hits(spark, [], ITEMS) == []
    assert all(not own for *_, own in hits(spark, CASES, []))


def test_removal(spark):
    docs, benchmark = data.documents(spark, CASES), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    clean = decontaminate.without_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    marked = {i for i, _, h, _ in brute(CASES, ITEMS) if h}
    assert sorted(r.doc_id for r in clean.collect() if r.doc_id) == sorted(i for i, _ in CASES if i and i not in marked)
    cut = {r.doc_id: r.text for r in decontaminate.without_spans(docs, benchmark).collect()}
    assert cut[10] == "before , after" and cut[14] == "Üñï  ünï" and cut[2] is None and cut[12] == ITEM.replace("six", "sax")


def test_registered(spark):
    found = data.rows(queries.REGISTERED["op4_decontamination"](spark, data.SMALL).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
    wanted = brute(data.columns("documents", "doc_id", "text"), data.columns("benchmark", "item_id", "text"))
    assert found == [(i, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for i, n, h, x in wanted]
    assert any(row[-1] for row in found)
