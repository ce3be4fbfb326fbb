import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from crossmap.llm import lm, queries
from crossmap.llm.elias_fano import EliasFano, Levels, PairTrie, quantised, restored
from tests.llm import data


def brute(documents):
    words, pairs, contexts, followers, texts = Counter(), Counter(), Counter(), Counter(), []
    for identifier, text in documents:
        held = zlib.crc32(("" if identifier is None else str(identifier)).encode()) % 7 == 2
        tokens = [*(text or "").encode().lower().split(), "end"]
        texts.append((identifier, held, tokens))
        if not held:
            words.update(tokens)
            pairs.update(zip(["start", *tokens], tokens))
            contexts.update(["start", *tokens][:-1])
    for c, _ in pairs:
        followers[c] += 1
    total, distinct = sum(words.values()), len(words)
    out = []
    for identifier, held, tokens in texts:
        base = score = 0.0
        for c, w in zip(["start", *tokens], tokens):
            single = (words[w] + 1) / (total + distinct + 1)
            base += math.log10(single)
            chance = (max(pairs[c, w] - lm.DISCOUNT, 0) + lm.DISCOUNT * followers[c] * single) / contexts[c] if contexts[c] else single
            score += math.log10(chance)
        out.append((identifier, held, len(tokens), sum(w in words for w in tokens), total, base, score))
    return out


def check(df, documents):
    wanted, found = sorted(brute(documents), key=repr), data.rows(df)
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    for got, row in zip(found, wanted):
        assert got[5] == pytest.approx(row[5], rel=1e-9, abs=1e-9)
        assert got[6] == pytest.approx(row[6], abs=2e-4 * row[2])


def test_scores(spark):
    source = random.Random(2)
    pool = ["the", "The", "of", "sea", "Ünï", "ship", "mast", "a\x1cb", *map(str, range(40))]
    documents = data.ODD + [(100 + i, " ".join(source.choices(pool, k=source.randint(0, 60)))) for i in range(80)]
    names = [c for c in lm.score_texts(data.documents(spark)).columns]
    assert names == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(lm.score_texts(data.documents(spark, documents)), documents)


def test_small_chunks_and_many_tries_give_the_same(spark, monkeypatch):
    documents = [(i, f"w{i % 5} of the w{i % 7} and of the w{i % 3}") for i in range(60)]
    monkeypatch.setattr(lm, "TOKENS_PER_TRIE", 5)
    check(lm.score_texts(data.documents(spark, documents).repartition(3, "doc_id")), documents)


def test_word_ranges_follow_the_input(spark, monkeypatch):
    documents = [(i, f"w{i % 5} of the w{i % 7} and of the w{i % 3}") for i in range(200)]
    bits, requests = [], lm._word_requests
    monkeypatch.setattr(lm, "_word_requests", lambda n: bits.append(n) or requests(n))
    monkeypatch.setattr(lm, "BYTES_PER_RANGE", 5, raising=False)
    check(lm.score_texts(data.documents(spark, documents).repartition(3, "doc_id")), documents)
    assert 5 << bits[0] >= sum(len(t) for _, t in documents)


def test_empty_tables_and_no_training_texts(spark):
    assert lm.score_texts(data.documents(spark).limit(0)).collect() == []
    held = [i for i in range(200) if lm.held_out(i)][:3]
    check(lm.score_texts(data.documents(spark, [(i, "some words") for i in held])), [(i, "some words") for i in held])


def test_probabilities_after_a_context_add_up_to_one():
    learnt = [i for i in range(20) if not lm.held_out(i)]
    documents = list(zip(learnt, ["a b a c", "b a", "c c c"]))
    vocabulary = ["a", "b", "c"]
    words = Counter(w for _, t in documents for w in [*t.split(), "end"])
    total, distinct = sum(words.values()), len(words)
    singles = {w: (words[w] + 1) / (total + distinct + 1) for w in [*vocabulary, "end"]}
    assert sum(singles.values()) + 1 / (total + distinct + 1) == pytest.approx(1)
    pairs = Counter(p for _, t in documents for p in zip(["start", *t.split()], [*t.split(), "end"]))
    for context in ["start", *vocabulary]:
        n, kinds = sum(c for (x, _), c in pairs.items() if x == context), sum(x == context for x, _ in pairs)
        known = sum((max(pairs[context, w] - lm.DISCOUNT, 0) + lm.DISCOUNT * kinds * p) / n for w, p in singles.items())
        assert known + lm.DISCOUNT * kinds / n / (total + distinct + 1) == pytest.approx(1)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 2**63), (50, 60), (1000, 2**64 - 1), (1000, 1200)])
def test_elias_fano(n, top):
    source = random.Random(n)
    values = np.array(sorted(source.randrange(top) for _ in range(n)), np.uint64)
    sequence = EliasFano(Levels(EliasFano.arrays("x", values)), "x")
    assert (sequence.values(np.arange(n)) == values).all()
    wanted = np.array([0, top - 1, *values.tolist()[:40], *(min(v + 1, 2**64 - 1) for v in values.tolist()[:40]), *(source.randrange(top) for _ in range(40))], np.uint64)
    assert (sequence.successor(wanted) == np.searchsorted(values, wanted)).all()


def test_a_long_bucket_is_halved(monkeypatch):
    values = np.sort(np.random.default_rng(5).integers(0, 2**30, 5000).astype(np.uint64))
    far = np.array([2**50 - 1], np.uint64)
    sequence = EliasFano(Levels(EliasFano.arrays("x", np.concatenate((values, far)))), "x")
    steps = []
    monkeypatch.setattr(EliasFano, "_low", lambda self, at, read=EliasFano._low: steps.append(len(at)) or read(self, at))
    assert (sequence.successor(values) == np.searchsorted(values, values)).all()
    assert len(steps) <= 14


def test_the_trie_is_asked_for_a_pair_once(monkeypatch):
    asked, codes = [], PairTrie.codes
    monkeypatch.setattr(PairTrie, "codes", lambda self, contexts, successors: asked.append(len(contexts)) or codes(self, contexts, successors))
    contexts, successors = np.array([3, 9], np.uint64) << np.uint64(50), np.array([5, 6, 7], np.uint64) << np.uint64(40)
    five = (successors >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5].reshape(-1)
    one = lm._packed(contexts, np.array([1, 2], np.uint8), five, np.array([2, 0, 3], np.uint8))
    table = pa.table({"chunk": ["a", "b"], "part": pa.array([0, 0], pa.int32()), "asked": [one, one]})
    found = lm._pair_answers(np.zeros(0, np.uint64), np.zeros(0, np.int64))(table).column("answer").to_pylist()
    assert sum(asked) == 3 and found[0] == found[1]
    weights, got = lm._unpacked(found[0])
    assert restored(got) == pytest.approx([3.25 / 4, 0, 5.25 / 6], rel=1e-3) and restored(weights) == pytest.approx([0.75 / 4, 0.75 / 6], rel=1e-3)


def test_trie_answers():
    source = np.random.default_rng(4)
    contexts = np.unique(source.integers(0, 2**63, 50).astype(np.uint64))
    sizes = source.integers(1, 9, len(contexts))
    pointers = np.concatenate(([0], np.cumsum(sizes)))
    successors = np.concatenate([np.sort(source.integers(0, 2**63, n).astype(np.uint64)) for n in sizes])
    codes = source.integers(1, 2**16, len(successors)).astype(np.uint16)
    trie = PairTrie(contexts, pointers, successors, codes, np.arange(len(contexts), dtype=np.uint16))
    numbers = trie.context(contexts)
    assert (numbers == np.arange(len(contexts))).all() and (trie.context(contexts + np.uint64(1)) == -1).all()
    assert (trie.codes(np.repeat(numbers, sizes), successors) == codes).all()
    assert (trie.codes(np.repeat(numbers, sizes), successors + np.uint64(1 << 40)) == 0).all()
    assert (trie.pointers.values(np.arange(len(pointers))) == pointers.astype(np.uint64)).all()
    assert len(trie.levels.tobytes()) < 8 * (len(contexts) + len(successors)) * 2 + 1000


def test_quantised_probabilities():
    logs = np.array([-11.9, -3.21, -0.5, -1e-3])
    assert np.abs(np.log10(restored(quantised(logs))) - logs).max() <= 1 / 5400
    assert restored(np.zeros(1, np.uint16))[0] == 0


def test_registered(spark):
    documents = data.columns("documents", "doc_id", "text")
    result = queries.REGISTERED["op8_language_model"](spark, data.SMALL)
    check(result, documents)
    held = [r for r in result.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
