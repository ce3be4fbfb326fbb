"""Byte-pair encoding by rank-synchronous merges of ragged numpy arrays.

Pre-tokens are held side by side in flat arrays. Each round finds the lowest
rank of every sequence and applies that pair to the sequence, in all sequences
at the same time, until no pair of any sequence has a rank. That equals merging
one pair after the other if no symbol is made by two merges and every merge
comes after those that make its parts; the vocabulary is checked for it, and
otherwise only the leftmost pair of the lowest rank is applied in a round.

The texts of a slice are cut into pre-tokens as one array of characters, so that
only distinct pre-tokens become Python values; those met before are remembered.
Files with another pattern than SPLIT have it applied to distinct words.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from crossmap.llm.common import Words

#: Distinct strings that a worker remembers, and the longest one that it does.
REMEMBERED, LONGEST = 500_000, 48
_NONE = np.int32(np.iinfo(np.int32).max)
#: The pattern of pre-tokens that `Bpe.pretokens` follows, and its kinds of characters; ones not met yet are UNKNOWN.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_UNKNOWN, _WHITE, _LETTER, _DIGIT, _OTHER, _SPECIAL = range(6)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Bpe:
    """A tokenizer file with byte-level pre-tokens, lower-casing and marked word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.last = np.array([vocab[x + end] for x in letters], np.int32)
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        left, right = (np.array([vocab[x[i]] for x in merges], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.base = 1 + max(vocab.values())
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        rank_of = np.full(self.base, -1, np.int64)
        rank_of[made] = np.arange(len(made))
        parts = np.maximum(rank_of[left], rank_of[right])
        self.together = len(np.unique(made)) == len(made) and bool((parts < np.arange(len(made))).all())
        splits = [x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"] + r"|\n")  # the line break separates strings that are encoded together
        self.special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile(b"(" + b"|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + b")") if self.special else None
        self.known: dict[bytes, bytes] = {}
        self.at_once = splits[0]["pattern"]["Regex"] == SPLIT and not any(self.pattern.fullmatch(_normal(x)) for x in self.special)
        self.kinds = np.zeros(0x110000, np.uint8)
        self.cased = [(regex.compile(x), kind) for x, kind in ((r"\s", _WHITE), (r"\p{L}", _LETTER), (r"\p{N}", _DIGIT), ("(?s).", _OTHER))]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, _NONE for pairs that are not merged."""
        pairs = left.astype(np.int64) * self.base + right
        place = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[place] == pairs, self.ranks[place], _NONE)

    def merged(self, sequences: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all sequences of bytes (none empty) after all merges, one after the other, and where each ends."""
        own = np.arange(len(sequences))
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        symbols = np.frombuffer(b"".join(sequences), np.uint8)
        final = np.zeros(len(symbols), bool)
        final[np.cumsum(sizes) - 1] = True
        symbols = np.where(final, self.last[symbols], self.inner[symbols])
        ranks = np.full(len(symbols), _NONE, np.int32)
        pairs = np.flatnonzero(~final)
        ranks[pairs] = self._rank(symbols[pairs], symbols[pairs + 1])
        finished = []
        while len(own):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, starts)
            over = lowest == _NONE
            if over.any():
                stay = np.repeat(~over, sizes)
                finished.append((own[over], sizes[over], symbols[~stay]))
                symbols, ranks, final = symbols[stay], ranks[stay], final[stay]
                own, sizes, lowest = own[~over], sizes[~over], lowest[~over]
                if not len(own):
                    break
            sequence = np.repeat(np.arange(len(own)), sizes)
            at = np.flatnonzero(ranks == lowest[sequence])
            at = _apart(at) if self.together else at[np.unique(sequence[at], return_index=True)[1]]
            symbols[at] = self.made[ranks[at]]
            final[at] = final[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            sizes = sizes - np.bincount(sequence[at], minlength=len(own))
            new = np.cumsum(keep)[at] - 1  # where the made symbols stand without the dropped ones
            symbols, ranks, final = symbols[keep], ranks[keep], final[keep]
            ranks[new] = _NONE
            before = new[new > 0] - 1
            changed = np.concatenate((new, before))
            changed = changed[~final[changed]]
            ranks[changed] = self._rank(symbols[changed], symbols[changed + 1])
        return _in_order(finished, len(sequences))

    def encode_words(self, chunks: list[bytes]) -> list[bytes]:
        """The token ids (unsigned 32 bits, little-endian) of strings without white space, as part of a longer text."""
        odd = [i for i, x in enumerate(chunks) if b"<" in x and self.cut and self.cut.search(x)]
        if odd:
            out = self.encode_words([b"" if i in set(odd) else x for i, x in enumerate(chunks)])
            for i in odd:
                pieces = self.cut.split(chunks[i])
                plain = iter(self.encode_words([x for x in pieces if x not in self.special]))
                out[i] = b"".join(int(self.special[x]).to_bytes(4, "little") if x in self.special else next(plain) for x in pieces)
            return out
        found = self.pattern.findall(_normal(b"\n".join(chunks)))
        number: dict[str, int] = {}
        places = np.fromiter((number.setdefault(x, len(number)) for x in found), np.int64, len(found))
        mark = number.get("\n", -1)
        words = [x.encode() for x in number]
        symbols, ends = self.merged(words) if words else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        sizes = np.diff(ends, prepend=0)
        if mark >= 0:
            sizes[mark] = 0
        each = sizes[places]
        stops = np.cumsum(each)
        flat = symbols[np.arange(stops[-1] if len(stops) else 0) + np.repeat((ends - np.diff(ends, prepend=0))[places] - stops + each, each)]
        raw = flat.astype("<u4").tobytes()
        edges = (stops[places == mark] * 4).tolist() + [len(raw)]
        return [raw[a:b] for a, b in zip([0, *edges], edges)]

    def _kind(self, characters: np.ndarray) -> np.ndarray:
        kind = self.kinds[characters]
        if (kind == _UNKNOWN).any():
            for c in np.unique(characters[kind == _UNKNOWN]).tolist():
                self.kinds[c] = next(k for pattern, k in self.cased if pattern.match(chr(c)))
            kind = self.kinds[characters]
        return kind

    def pretokens(self, words: Words) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Pre-tokens and special strings of all texts by number, where each text ends, and the distinct ones."""
        texts, parts, special, last = words.utf8(), [], [], []
        for text in texts:
            pieces = self.cut.split(text) if self.cut and any(x in text for x in self.special) else [text]
            special += [n for n, x in enumerate(pieces, len(parts)) if x in self.special]
            parts += [x.decode() if x in self.special else _normal(x) for x in pieces]
            last.append(len(parts) - 1)
        joined = "\n".join([*parts, "\n"])  # white space behind every part, and two more characters behind the last
        raw = np.frombuffer(joined.encode(), np.uint8)
        characters = raw if joined.isascii() else np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = self._kind(characters)
        stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        for n in special:
            kind[stops[n] - len(parts[n]):stops[n]] = _SPECIAL
        inside = kind != _WHITE
        new = np.empty(len(kind), bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        new |= kind == _DIGIT
        new &= inside
        quotes = np.flatnonzero((characters == ord("'")) & new & (kind == _OTHER))
        first, second = characters[quotes + 1], characters[quotes + 2]
        short = np.isin(first, [ord(x) for x in "stmd"])
        long = (second == ord("e")) & ((first == ord("r")) | (first == ord("v"))) | (first == ord("l")) & (second == ord("l"))
        quotes, behind = quotes[short | long], (quotes + np.where(short, 2, 3))[short | long]
        new[quotes + 1] = False
        new[behind[kind[behind] == _LETTER]] = True
        at = np.flatnonzero(new)
        if characters is raw:
            data, offsets = raw[inside], np.flatnonzero(new[inside])
        else:
            width = 1 + (characters >= 0x80) + (characters >= 0x800).view(np.uint8) + (characters >= 0x10000)
            data = raw[np.repeat(inside, width)]
            width *= inside
            offsets = (np.cumsum(width, dtype=np.int64) - width)[at]
        offsets = np.append(offsets, len(data))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        ends = np.searchsorted(at, stops[last]) if last else np.zeros(0, np.int64)
        return coded.indices.to_numpy(zero_copy_only=False), ends, coded.dictionary.to_numpy(zero_copy_only=False).tolist()

    def _distinct(self, words: Words) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The token ids of distinct pre-tokens or words, those of the texts by number, and where each text ends."""
        known = self.known
        codes, ends, chunks = self.pretokens(words) if self.at_once else (words.codes, words.ends, words.distinct)
        out = list(map(known.get, chunks))
        missing = [i for i, x in enumerate(out) if x is None]
        found = self._encoded([chunks[i] for i in missing])
        if len(known) + len(found) > REMEMBERED:
            known.clear()
        for i, ids in zip(missing, found):
            out[i] = ids
            if len(chunks[i]) <= LONGEST:
                known[chunks[i]] = ids
        return out, codes, ends

    def _encoded(self, chunks: list[bytes]) -> list[bytes]:
        if not self.at_once:
            return self.encode_words(chunks)
        plain = [x for x in chunks if x not in self.special]
        symbols, ends = self.merged(plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        raw, ends = symbols.astype("<u4").tobytes(), (ends * 4).tolist()
        found = (raw[a:b] for a, b in zip([0, *ends], ends))
        return [int(self.special[x]).to_bytes(4, "little") if x in self.special else next(found) for x in chunks]

    def counts(self, words: Words) -> np.ndarray:
        """Tokens of each text."""
        ids, codes, ends = self._distinct(words)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        total = np.concatenate(([0], np.cumsum(sizes[codes])))[ends]
        return np.diff(total, prepend=0)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all texts, one after the other, and where each text ends."""
        ids, codes, ends = self._distinct(words)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, firsts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        each = sizes[codes]
        stops = np.cumsum(each)
        out = flat[np.arange(stops[-1] if len(stops) else 0) + np.repeat(firsts[codes] - stops + each, each)]
        return out, np.concatenate(([0], stops))[ends]


def _in_order(finished: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Finished sequences (numbers, sizes, symbols) put in the order of their numbers, and where each ends."""
    own, sizes, symbols = (np.concatenate(x) for x in zip(*finished))
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(own)
    each = sizes[order]
    ends = np.cumsum(each)
    return symbols[np.arange(len(symbols)) + np.repeat(starts[order] - ends + each, each)], ends


def _apart(at: np.ndarray) -> np.ndarray:
    """Starts of pairs without those that overlap the pair before, from the left."""
    first = np.concatenate(([True], np.diff(at) != 1))
    run = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    return at[run % 2 == 0]


def _normal(piece: bytes) -> str:
    """Composed and lower-cased one character at a time, so that a final sigma is an ordinary one."""
    text = unicodedata.normalize("NFC", piece.decode("utf-8", "replace"))
    return text.replace("Σ", "σ").lower()


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The tokenizer of a file, once per worker."""
    return Bpe(path)
