"""Elias-Fano sequences and a trie of word pairs in memory-mapped levels."""

from __future__ import annotations

import mmap

import numpy as np

#: log10 of a probability is kept in steps of 1 / STEPS from -SPAN to 0; code 0 stands for none.
SPAN, STEPS = 12.0, 5400


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((logs + SPAN) * STEPS), 1, SPAN * STEPS).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    """Probabilities of codes, 0 for code 0."""
    return np.where(codes == 0, 0.0, 10.0 ** (codes / STEPS - SPAN))


class Levels:
    """Named arrays one after the other in one memory map."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.places, at = {}, 0
        for name, array in arrays.items():
            self.places[name] = (at, array.dtype, len(array))
            at += -(-array.nbytes // 8) * 8
        self.map = mmap.mmap(-1, max(at, 1))
        for name, array in arrays.items():
            start = self.places[name][0]
            self.map[start:start + array.nbytes] = array.tobytes()

    def __getitem__(self, name: str) -> np.ndarray:
        start, kind, size = self.places[name]
        return np.frombuffer(self.map, kind, size, start)

    def tobytes(self) -> bytes:
        return self.map[:]


class EliasFano:
    """A rising sequence of numbers: low bits packed, high bits as a bitmap of unary gaps."""

    @staticmethod
    def arrays(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        high = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros(n + (top >> width) + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.zeros(n * width // 64 + 2, "<u8")
        if n and width:
            low, bit = values & np.uint64((1 << width) - 1), np.arange(n, dtype=np.uint64) * np.uint64(width)
            word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            words[word[starts]] = np.bitwise_or.reduceat(low << shift, starts)
            over = shift > 64 - width  # the rest of such a value begins the next word
            words[word[over] + 1] |= low[over] >> np.uint64(64) - shift[over]
        return {f"{name}.low": np.concatenate((words.view(np.uint8)[:-(-n * width // 8)], np.zeros(8, np.uint8))), f"{name}.high": np.packbits(bits, bitorder="little"), f"{name}.shape": np.array([n, width, len(bits)], np.int64)}

    def __init__(self, levels: Levels, name: str):
        self.n, self.width, bits = (int(x) for x in levels[f"{name}.shape"])
        low = levels[f"{name}.low"]
        self.low = np.ndarray((max(len(low) - 7, 1),), "<u8", low, strides=(1,))
        high = np.unpackbits(levels[f"{name}.high"], count=bits, bitorder="little")
        self.buckets = bits - self.n
        #: Where the values of each bucket of high bits begin: a bucket ends at its 0.
        self.first = np.concatenate(([0], np.flatnonzero(high == 0) - np.arange(self.buckets)))
        self.high = np.flatnonzero(high) - np.arange(self.n)

    def _low(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.width
        return self.low[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.width) - 1) if self.width else np.zeros(len(at), np.uint64)

    def values(self, at: np.ndarray) -> np.ndarray:
        return self.high[at].astype(np.uint64) << np.uint64(self.width) | self._low(at)

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """Place of the first value that is not below each wanted one (n if there is none)."""
        high = wanted >> np.uint64(self.width)
        beyond = high >= np.uint64(self.buckets)
        bucket = np.where(beyond, np.uint64(max(self.buckets - 1, 0)), high).astype(np.int64)
        place, end = self.first[bucket], self.first[bucket + 1]
        low = wanted & np.uint64((1 << self.width) - 1)
        live = np.flatnonzero(place < end)
        while len(live):  # halves the bucket, which can be long below a context with many successors
            middle = (place[live] + end[live]) >> 1
            smaller = self._low(middle) < low[live]
            place[live[smaller]] = middle[smaller] + 1
            end[live[~smaller]] = middle[~smaller]
            live = live[place[live] < end[live]]
        return np.where(beyond, self.n, place)


class PairTrie:
    """Contexts and, below each, its successors with quantised discounted probabilities.

    Level 1 has the contexts in rising order and monotone pointers to where their
    successors begin. Level 2 has the successors, each added to its context's
    number so that the whole level rises; a successor is searched for relative to
    its context. A context has the quantised weight of the lower order.
    """

    #: Bits of a successor's hash that are kept below its context's number.
    BITS = 40

    def __init__(self, contexts: np.ndarray, pointers: np.ndarray, successors: np.ndarray, codes: np.ndarray, weights: np.ndarray):
        number = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(pointers))
        relative = number << np.uint64(self.BITS) | successors >> np.uint64(64 - self.BITS)
        arrays = EliasFano.arrays("context", contexts) | EliasFano.arrays("pointer", pointers.astype(np.uint64)) | EliasFano.arrays("successor", relative)
        self._open(Levels(arrays | {"codes": codes, "weights": weights}))

    def _open(self, levels: Levels) -> None:
        self.levels = levels
        self.contexts, self.pointers, self.successors = (EliasFano(levels, x) for x in ("context", "pointer", "successor"))

    def context(self, wanted: np.ndarray) -> np.ndarray:
        """Numbers of contexts, -1 for those that are not there."""
        place = self.contexts.successor(wanted)
        there = place < self.contexts.n
        there[there] = self.contexts.values(place[there]) == wanted[there]
        return np.where(there, place, -1)

    def weights(self, contexts: np.ndarray) -> np.ndarray:
        return np.where(contexts >= 0, self.levels["weights"][np.maximum(contexts, 0)] if self.contexts.n else 0, 0).astype(np.uint16)

    def codes(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of successors of contexts (given by number), 0 for pairs that are not there."""
        out = np.zeros(len(contexts), np.uint16)
        known = np.flatnonzero(contexts >= 0)
        wanted = contexts[known].astype(np.uint64) << np.uint64(self.BITS) | successors[known] >> np.uint64(64 - self.BITS)
        place = self.successors.successor(wanted)
        there = place < self.successors.n
        there[there] = self.successors.values(place[there]) == wanted[there]
        out[known[there]] = self.levels["codes"][place[there]]
        return out
