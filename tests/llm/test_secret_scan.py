import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest

from crossmap.llm import crf, queries, secret_scan
from tests.llm import data


def plain_spans(text):
    """The base spans as the contract words them."""
    letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
    assert letters in key
    found = [("assign", m.start(), m.end()) for m in re.finditer(rf"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m.group(2)) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


def test_base_spans_equal_plain_patterns():
    source = random.Random(6)
    pieces = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abcdefgh", "0123456789abcdef", "AKIA", "ABCDEFGH0123", "é", "漢", ".", "ſecret", "toKen", "\n", "x"]
    for _ in range(20_000):
        text = "".join(source.choices(pieces, k=source.randrange(14)))
        assert [x[:3] for x in secret_scan.base_spans(text)] == plain_spans(text)
        assert not secret_scan.base_spans(text) or re.search(secret_scan._HINT, text)


def some_model(seed, forbid=True):
    source = np.random.default_rng(seed)
    model = crf.Model(moves=source.normal(0, 1, (3, 3)))
    model.moves[crf.OUTSIDE, crf.OUTSIDE] += 2
    return model, source


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_finds_the_best_of_all_tags(seed):
    model, source = some_model(seed)
    scores = source.normal(0, 2, (20, 6, 3))
    moves = crf._allowed(model.moves)

    def value(line, tags):
        steps = [crf.OUTSIDE, *tags, crf.OUTSIDE]
        return sum(line[t, y] for t, y in enumerate(tags)) + sum(moves[a, b] for a, b in zip(steps, steps[1:]))

    for line, tags in zip(scores, crf.viterbi(scores, model.moves)):
        assert tuple(tags) == max(product(range(3), repeat=6), key=lambda x: value(line, x))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("shift", [0.0, 2.0, 4.0])
def test_tokens_left_out_are_outside(seed, shift):
    """Cutting lines into runs gives the tags of the whole lines."""
    model, source = some_model(seed)
    lines = np.repeat(np.arange(60), source.integers(1, 40, 60))
    scores = source.normal(0, 2, (len(lines), 3)).astype(np.float32)
    scores[:, 0] += shift
    whole = np.concatenate([crf.viterbi(scores[None, lines == i], model.moves)[0] for i in range(60)])
    assert crf.decoded(scores, lines, model.moves).tolist() == whole.tolist()
    assert crf.covered(scores, lines, model.moves).mean() < 1 or shift < 4


def texts(n, seed=8, share=0.3):
    """Prose, a part of it with a secret of one of the base patterns."""
    source = random.Random(seed)
    words = "the of and there is a house tree with or under river people open state question 17 2024 x9 mail.example".split()
    out = []
    for _ in range(n):
        text = source.choices(words, k=source.randrange(5, 60))
        if source.random() < share:
            hexes = "".join(source.choices("0123456789abcdef", k=40))
            access = "AKIA" + "".join(source.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=16))
            text.insert(source.randrange(len(text)), source.choice([f'token = "{hexes}"', access, f"password={hexes[:18]}"]))
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def model():
    return crf.train([(tokens.split(b"\0"), list(tags), kind) for text in texts(600) for _, tokens, tags, kind in secret_scan.windows(text)])


def test_tagger_finds_base_values_in_other_texts(model):
    """Held-out texts: the values of base spans are tagged, and nothing else."""
    held = texts(400, seed=9)
    runs = secret_scan.tagged([text.encode() for text in held], model)
    wanted = [sorted({(value, end) for _, _, end, value in secret_scan.base_spans(text)}) for text in held]
    both = sum(len(set(a) & set(b)) for a, b in zip(runs, wanted))
    assert both >= 0.97 * sum(map(len, wanted)) and both >= 0.97 * sum(map(len, runs)) and both > 100


def test_tagger_finds_what_no_pattern_does(model):
    found = {text: secret_scan.tagged([text.encode()], model)[0] for text in (
        "the pwd=7602ad27cf5550de1c of it", "there is été 24be64439e3e49cf46b2d open", "under credential = \"f33e61083db5dbdf4bd2369d2f80176\" people")}
    assert not any(map(plain_spans, found))
    assert [text[s:e] for text, runs in found.items() for s, e in runs] == ["7602ad27cf5550de1c", "24be64439e3e49cf46b2d", "f33e61083db5dbdf4bd2369d2f80176"]


@pytest.mark.parametrize("most", [40, 200, 1 << 20])
def test_blocks_change_nothing_between_lines(model, most):
    held = ["\n".join(texts(30, seed=s)) for s in range(5)] + ["", "\n\n", "é" * 30 + "\n" + texts(1, share=1)[0]]
    coded = [text.encode() for text in held]
    lines = [[run for run in secret_scan.tagged([line.encode()], model)[0]] for text in held for line in text.split("\n")]
    whole = secret_scan.tagged(coded, model)
    by_line = []
    for text, runs in zip(held, whole):
        starts = [0, *(m.end() for m in re.finditer("\n", text))]
        by_line += [[(s - start, e - start) for s, e in runs if start <= s < stop] for start, stop in zip(starts, [*starts[1:], len(text) + 1])]
    kinds = len({secret_scan.file_kind(x.encode()) for text in held for x in [text, *text.split("\n")]})
    assert kinds == 1 or sum(a != b for a, b in zip(lines, by_line)) <= 0.1 * len(lines)
    if most > 100:
        blocked = secret_scan.tagged(coded, model, most)
        assert blocked == whole


def test_gradient_of_training_raises_the_likelihood():
    """A trained field gives the tagged windows a better likelihood than one of fewer steps."""
    found = [([b"a", b"k", b"zz9zz9zz9"], [0, 0, 1], b"x"), ([b"a", b"b"], [0, 0], b"x"), ([b"k", b"zz8zz8zz8", b"q"], [0, 1, 0], b"y")] * 3
    model = crf.train(found)
    for tokens, tags, _ in found:
        sizes = np.array([len(token) for token in tokens])
        n = len(tokens)
        scores = crf.emissions(model.table(b"".join(tokens), np.cumsum(sizes) - sizes, sizes), np.arange(n), np.zeros(n, int), np.zeros((n, 3), np.float32))
        assert crf.decoded(scores, np.zeros(n, int), model.moves).tolist() == tags
    assert crf.train([([b"a"], [0], b"x")]).empty()


def test_probabilities_of_tags():
    """Forward and backward sums against all tags of short windows."""
    source = np.random.default_rng(3)
    scores, moves = source.normal(0, 1, (3, 4, 3)), crf._allowed(source.normal(0, 1, (3, 3)))
    sizes = np.array([4, 2, 1])
    real = np.arange(4) < sizes[:, None]
    share, joint = crf._marginals(scores, real, sizes - 1, np.exp(moves))
    wanted, pairs = np.zeros((3, 4, 3)), np.zeros((3, 3))
    for i, size in enumerate(sizes):
        ways = {}
        for tags in product(range(3), repeat=int(size)):
            steps = [0, *tags, 0]
            ways[tags] = np.exp(sum(scores[i, t, y] for t, y in enumerate(tags)) + sum(moves[a, b] for a, b in zip(steps, steps[1:])))
        for tags, value in ways.items():
            for t, y in enumerate(tags):
                wanted[i, t, y] += value / sum(ways.values())
            for a, b in zip(tags, tags[1:]):
                pairs[a, b] += value / sum(ways.values())
    assert np.allclose(share, wanted) and np.allclose(joint, pairs)


def test_added_spans_overlap_no_base_span():
    base = [("assign", 5, 30, 10), ("hex", 12, 20, 12), ("access", 50, 70, 50)]
    runs = [(0, 5), (3, 6), (25, 40), (30, 50), (69, 71), (70, 90)]
    assert secret_scan.apart(runs, base) == [(0, 5), (30, 50), (70, 90)]


def test_query_over_odd_rows_and_model(spark):
    rows = [*data.ODD, *((i, text) for i, text in enumerate(texts(600), 1000)), (999, "the pwd=7602ad27cf5550de1c of it"), (998, "password=short token: 12345678")]
    docs = data.documents(spark, rows)
    found, names = secret_scan.find_spans(docs, secret_scan.fit(docs.filter("doc_id != 999")))
    by_row = sorted(((row["doc_id"], row["text"], [tuple(x) for x in row[names["base"]]], [tuple(x) for x in row[names["added"]]]) for row in found.collect()), key=repr)
    assert [(i, text, base) for i, text, base, _ in by_row] == sorted(((i, text, plain_spans(text or "")) for i, text in rows), key=repr)
    assert {i: added for i, _, _, added in by_row if added} == {999: [("learned", 8, 26)]}
    nothing = data.documents(spark, [])
    assert secret_scan.find_spans(nothing, secret_scan.fit(nothing))[0].collect() == []
    clean = data.documents(spark, data.ODD)
    assert secret_scan.fit(clean).empty() and len(secret_scan.find_spans(clean, secret_scan.fit(clean))[0].collect()) == len(data.ODD)


def test_registered_query(spark):
    found = {row["doc_id"]: row for row in queries.REGISTERED["op12_secrets"](spark, data.SMALL).collect()}
    texts_ = dict(data.columns("documents", "doc_id", "text"))
    assert set(found) == set(texts_)
    for i, text in texts_.items():
        spans, row = plain_spans(text or ""), found[i]
        joined = ",".join(f"{kind}:{s}:{e}" for kind, s, e in spans)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in secret_scan.KINDS] == [sum(x[0] == kind for x in spans) for kind in secret_scan.KINDS]
        assert {f"{kind}:{s}:{e}" for kind, s, e in spans} <= set(row["spans"].split(","))
        assert len([x for x in row["spans"].split(",") if x]) == len(spans) + row["n_added"]
