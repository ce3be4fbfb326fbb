import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from crossmap.llm import bpe, packing, queries, token_counts
from crossmap.llm.common import Words
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def wanted(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def found(texts):
    flat, ends = bpe.load(PATH).encode(Words(pa.array(texts, pa.string())))
    return [flat[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]


def test_ids_are_those_of_the_library(library):
    texts = ["", " ", "a", "aaaa" * 500, "don't I'LL they've 's", "x<|endoftext|>y <|startoftext|> <|endoftext|", "ΑΣ Σ İ ß É é", "日本語 テキスト 🎉🎉", "12345 !!! $%&", "a\x1cb c d", "\n\r\t", None]
    source = random.Random(3)
    texts += ["".join(source.choice("ab \n'stlmdrve<|>.,-éñüß0١🎉") for _ in range(80)) for _ in range(300)]
    texts += [text for (text,) in data.columns("documents", "text")]
    assert found(texts) == wanted(library, texts)


def test_one_merge_a_round_gives_the_same(library):
    slow = bpe.Bpe(PATH)
    slow.together = False
    words = ["banana", "mississippi", "aaaaaaa", "abcabcabc", "tion" * 9]
    flat, ends = slow.encode(Words(pa.array(words)))
    assert [flat[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == wanted(library, words)


def test_marks_at_the_edges_of_pretokens(library):
    source = random.Random(7)
    parts = ["a", "b", " ", "\n", "'", "s", "t", "re", "ve", "ll", "d", "M", "'S", "'RE", "<|endoftext|>", "<|", "|>", ".", "!", "é", "e\u0301", "\u0301", "H\u0331", "ß", "0", "\u0662", "²", "½", "Ⅷ", "🎉",
             "\x1c", "\x85", "\u00a0", "\u200b", "İ", "ΑΣ", "日本", "ǅ", "ﬁ", "\u212a", "한", "\u0345", "\0", "_"]
    texts = ["".join(source.choices(parts, k=source.randint(0, 30))) for _ in range(3000)]
    assert found(texts) == wanted(library, texts)
    assert [len(x) for x in wanted(library, texts)] == bpe.load(PATH).counts(Words(pa.array(texts))).tolist()


def test_files_with_another_pattern_cut_words_by_it(library):
    own = bpe.Bpe(PATH)
    own.at_once = False
    texts = ["don't I'LL x<|endoftext|>y", "", "ΑΣ é 12!", None]
    flat, ends = own.encode(Words(pa.array(texts)))
    assert [flat[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == wanted(library, texts)


def test_pretokens_met_in_other_words_are_not_merged_again(monkeypatch):
    own, merged = bpe.Bpe(PATH), []
    monkeypatch.setattr(bpe.Bpe, "merged", lambda self, x, run=bpe.Bpe.merged: merged.append(x) or run(self, x))
    own.encode(Words(pa.array(["Ship schön"])))
    own.encode(Words(pa.array(["ship, SHIP. (schön) Schön,"])))
    assert not {b"ship", "schön".encode()} & set(merged[1])


def test_memory_of_strings_is_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    own = bpe.Bpe(PATH)
    texts = [f"word{i} other{i % 3}" for i in range(40)]
    for text in texts:
        own.encode(Words(pa.array([text])))
        assert len(own.known) <= 12
    assert own.counts(Words(pa.array(texts))).tolist() == [len(x) for x in wanted(library, texts)]


def test_counts_of_odd_rows(spark, library):
    counts = token_counts.with_limit(token_counts.count_tokens(data.documents(spark)))
    assert counts.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(i, len((t or "").encode()), len(ids), len(ids) > 2048) for (i, t), ids in zip(data.ODD, wanted(library, [t for _, t in data.ODD]))]
    assert data.rows(counts) == sorted(expected, key=repr)
    assert token_counts.count_tokens(data.documents(spark).limit(0)).collect() == []


def test_registered_counts(spark, library):
    documents = data.columns("documents", "doc_id", "text")
    expected = [(i, len(t.encode()), len(ids), len(ids) > 2048) for (i, t), ids in zip(documents, wanted(library, [t for _, t in documents]))]
    assert data.rows(queries.REGISTERED["op2_token_counts"](spark, data.SMALL)) == sorted(expected, key=repr)


def check_packing(result, documents, ids, capacity):
    by_row = {}
    for row in result:
        by_row.setdefault(row.doc_id, []).append(row)
    for (identifier, _), own in zip(documents, ids):
        tokens, same = np.array([*own, 1], "<u4"), by_row[identifier]
        pieces = {(p.piece, p.start, p.length, p.ids_crc32) for p in same}
        assert pieces == {(n, s, len(tokens[s:s + capacity]), zlib.crc32(tokens[s:s + capacity])) for n, s in enumerate(range(0, len(tokens), capacity))}
    sequences = {}
    for row in result:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_odd_rows(spark, library):
    result = packing.packed(data.documents(spark)).collect()
    check_packing(result, data.ODD, wanted(library, [t for _, t in data.ODD]), 4096)
    assert sum(r.doc_id == 4 for r in result) == 2
    assert packing.packed(data.documents(spark).limit(0)).collect() == []


def test_sequences_hold_the_ids(spark, library):
    table = data.documents(spark)
    ids = wanted(library, [t for _, t in data.ODD])
    got = packing.sequences(table, capacity=64).collect()
    assert sorted(x for row in got for x in row.ids) == sorted(x for own in ids for x in [*own, 1])
    assert all(len(row.ids) <= 64 for row in got)


def test_registered_packing(spark, library):
    documents = data.columns("documents", "doc_id", "text")
    ids = wanted(library, [t for _, t in documents])
    n = check_packing(queries.REGISTERED["op5_packing"](spark, data.SMALL).collect(), documents, ids, 4096)
    assert n <= 1.02 * sum(len(x) + 1 for x in ids) / 4096 + 1


def test_fullest_is_the_best_sum():
    source = random.Random(5)
    for _ in range(200):
        left = {x: source.randint(1, 3) for x in sorted(source.sample(range(1, 40), 6), reverse=True)}
        room, sums = source.randint(0, 90), {0}
        for length, count in left.items():
            sums = {s + length * k for s in sums for k in range(count + 1)}
        parts = packing.fullest(left, room)
        assert sum(x * n for x, n in parts) == max(s for s in sums if s <= room)
        assert all(n <= left[x] for x, n in parts)


def test_plan_places_every_piece_once():
    source = random.Random(6)
    counts = {}
    for _ in range(3000):
        length = min(200, int(source.expovariate(1 / 40)) + 1)
        counts[length] = counts.get(length, 0) + 1
    places, filled = {}, {}
    for length, first, last, each, sequence, at in packing.plan(counts, 200):
        for number in range(first, last):
            assert (length, number) not in places
            nth = number - first
            places[length, number] = sequence + nth // each
            filled.setdefault(sequence + nth // each, set()).update(range(at + nth % each * length, at + nth % each * length + length))
    assert len(places) == sum(counts.values())
    total = sum(x * n for x, n in counts.items())
    assert sum(map(len, filled.values())) == total and len(filled) <= 1.01 * total / 200 + 1
