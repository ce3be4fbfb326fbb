"""A linear-chain conditional random field over three tags, with what can be left out without a change of its result.

Tags: outside, begin, inside; inside never follows outside, and a line begins and ends outside.
Scores of tags are sums of weights of features of a token, of the three tokens before it, of the
one behind it and of the file. Tokens are numbered by their kind, so that a table of the kinds
in sight gives all scores by lookups.

The best tags of a line leave most tokens outside. A run of other tags can only be part of
the best ones if the sum of what its tokens gain at most is above 0. Tokens in no such run are outside, and the
Viterbi algorithm works on the runs that are left, many side by side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from crossmap.llm.filter_audit import Spans

TAGS = OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: Places of the tokens whose features count, relative to the tagged one.
PLACES = (0, -1, -2, -3, 1)
FORBIDDEN = -1e4
STEPS, RATE, DECAY = 60, 0.15, 1e-4
#: Features of a token, of which the first ones also count for its neighbours, and the feature of a line's edge.
TRAITS, NEAR, EDGE = 9, 2, 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Characters as bits: digits, capitals, small letters, others; hexadecimal digits in small letters; small forms.
_CHARACTER = np.full(256, 8, np.uint8)
_CHARACTER[48:58], _CHARACTER[65:91], _CHARACTER[97:123] = 1, 2, 4
_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
_SMALL = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def traits(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Keys of the features of tokens (token, feature), 0 for none: its word, kinds of characters and size, beginning, shape, hexadecimal
    digits, kinds alone, changes of kind, variety of characters, and size."""
    n = len(starts)
    if not n:
        return np.zeros((0, TRAITS), np.uint64)
    begins = np.cumsum(lengths) - lengths
    own = np.frombuffer(data, np.uint8)[np.arange(lengths.sum()) + np.repeat(starts - begins, lengths)]
    character = _CHARACTER[own]
    changed = np.concatenate(([0], character[1:] != character[:-1]))
    changed[begins] = 0
    kinds = np.bitwise_or.reduceat(character, begins).astype(np.uint64)
    hexes = np.logical_and.reduceat(_HEX[own], begins).astype(np.uint64)
    changes = np.minimum(np.ceil(np.log2(np.add.reduceat(changed, begins) + 1)), 7).astype(np.uint64)
    variety = np.minimum(np.bitwise_count(np.bitwise_or.reduceat(np.uint64(1) << (own & 63).astype(np.uint64), begins)) // 2, 7).astype(np.uint64)
    size = np.minimum(np.ceil(np.log2(lengths + 1)), 7).astype(np.uint64)
    every = np.arange(n)
    words = Spans(_SMALL[own].tobytes(), begins, lengths).hashes(np.zeros(n, np.int64))
    first = Spans(own.tobytes(), begins, np.minimum(lengths, 4)).piece(every, 0)
    shape = Spans(character.tobytes(), begins, np.minimum(lengths, 6)).piece(every, 0)
    eight = np.uint64(8)
    values = np.stack([words, kinds * eight + size, first, shape, hexes * eight + size, kinds, changes * eight + size, variety, size], axis=1)
    keys = (values + np.arange(2, TRAITS + 2, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * _MIX
    keys ^= keys >> np.uint64(31)
    keys[lengths <= 3, NEAR:] = 0
    return keys


def _allowed(moves: np.ndarray) -> np.ndarray:
    moves = moves.copy()
    moves[OUTSIDE, INSIDE] = FORBIDDEN
    return moves


@dataclass
class Model:
    """Rising keys of features with weights by place and tag, weights of kinds of files, and of moves from tag to tag."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, len(PLACES), 3), np.float32))
    files: dict[bytes, np.ndarray] = field(default_factory=dict)
    moves: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))

    def empty(self) -> bool:
        return not len(self.keys)

    def table(self, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Scores (kind, place, tag) that kinds of tokens give, the last kind being the edge of a line."""
        weights = np.concatenate((self.weights, np.zeros((1, len(PLACES), 3), np.float32)))
        keys = np.concatenate((traits(data, starts, lengths), np.zeros((1, TRAITS), np.uint64)))
        keys[-1, 0] = EDGE
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        at[self.keys[at] != keys] = len(self.keys)
        out = weights[at[:, 0]]
        for i in range(1, NEAR):
            out += weights[at[:, i]]
        for i in range(NEAR, TRAITS):
            out[:, 0] += weights[at[:, i], 0]
        return out


def emissions(table: np.ndarray, kinds: np.ndarray, lines: np.ndarray, files: np.ndarray) -> np.ndarray:
    """Scores of tags of each token; `lines` numbers the line of each token, `files` are scores of its file."""
    n, edge = len(kinds), len(table) - 1
    out = files + table[kinds, 0]
    for i, place in enumerate(PLACES[1:], 1):
        other = np.full(n, edge)
        k = abs(place)
        same = lines[k:] == lines[:-k] if k < n else np.zeros(0, bool)
        if place < 0:
            other[k:][same] = kinds[:n - k][same]
        else:
            other[:n - k][same] = kinds[k:][same]
        out += table[other, i]
    return out


def covered(scores: np.ndarray, lines: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Tokens that may be other than outside in the best tags."""
    moves, outside = _allowed(moves), moves[OUTSIDE, OUTSIDE]
    into = np.array([moves[:, BEGIN].max(), moves[:, INSIDE].max()]) - outside
    gain = (scores[:, 1:] - scores[:, :1] + into).max(axis=1).astype(np.float64)
    leave = max(0.0, moves[BEGIN:, OUTSIDE].max() - outside)
    gain = np.maximum(gain, -100.0)
    if not (gain > -leave).any():
        return np.zeros(len(gain), bool)

    def best_before(gain: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The greatest sum of a run that ends in front of each token, or 0, within its line."""
        apart = 2 * np.add.reduceat(np.abs(gain), np.flatnonzero(firsts)).max() + 1
        sums = np.cumsum(gain) - apart * np.cumsum(firsts)
        ahead = sums - gain
        return ahead - np.minimum.accumulate(ahead)

    firsts = np.concatenate(([True], lines[1:] != lines[:-1]))
    lasts = np.concatenate((lines[1:] != lines[:-1], [True]))
    return best_before(gain, firsts) + gain + best_before(gain[::-1], lasts[::-1])[::-1] + leave > -1e-3


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of lines of one length: scores (line, token, tag) to tags (line, token)."""
    moves = _allowed(moves)
    n, length, _ = scores.shape
    best = scores[:, 0] + moves[OUTSIDE]
    back = np.zeros((n, length, 3), np.int8)
    for t in range(1, length):
        ways = best[:, :, None] + moves[None]
        back[:, t] = ways.argmax(axis=1)
        best = ways.max(axis=1) + scores[:, t]
    tags = np.zeros((n, length), np.int8)
    tags[:, -1] = (best + moves[:, OUTSIDE]).argmax(axis=1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    return tags


def decoded(scores: np.ndarray, lines: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of all tokens."""
    tags = np.zeros(len(scores), np.int8)
    if not len(scores):
        return tags
    inside = covered(scores, lines, moves)
    at = np.flatnonzero(inside)
    if not len(at):
        return tags
    cuts = np.flatnonzero((np.diff(at) > 1) | (np.diff(lines[at]) != 0)) + 1
    starts, ends = at[np.concatenate(([0], cuts))], at[np.concatenate((cuts - 1, [len(at) - 1]))] + 1
    lengths = ends - starts
    for length in np.unique(lengths):
        own = starts[lengths == length]
        places = own[:, None] + np.arange(length)
        tags[places] = viterbi(scores[places], moves)
    return tags


def spans_of(tags: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of every run that begins with BEGIN."""
    firsts = np.flatnonzero(tags == BEGIN)
    goes_on = np.concatenate(((tags[1:] == INSIDE) & (lines[1:] == lines[:-1]), [False]))
    stops = np.flatnonzero(~goes_on)
    return firsts, stops[np.searchsorted(stops, firsts)]


def train(windows: list[tuple[list[bytes], list[int], bytes]], support: int = 2) -> Model:
    """The model of greatest penalised likelihood of tagged windows (tokens, tags, kind of file), by gradient steps with adapted rates.

    A feature is used if tokens have it `support` times.
    """
    if not any(any(tags) for _, tags, _ in windows):
        return Model()
    length = max(len(tokens) for tokens, _, _ in windows)
    kinds: dict[bytes, int] = {}
    for tokens, _, _ in windows:
        for token in tokens:
            kinds.setdefault(token, len(kinds))
    n, edge = len(windows), len(kinds)
    at, tags = np.full((n, length), edge), np.zeros((n, length), np.int64)
    for i, (tokens, own, _) in enumerate(windows):
        at[i, :len(tokens)] = [kinds[token] for token in tokens]
        tags[i, :len(tokens)] = own
    sizes = np.array([len(tokens) for tokens, _, _ in windows])
    real = np.arange(length) < sizes[:, None]
    file_names, file_at = np.unique([name for _, _, name in windows], return_inverse=True)

    lengths = np.fromiter(map(len, kinds), np.int64, edge)
    keys = np.concatenate((traits(b"".join(kinds), np.cumsum(lengths) - lengths, lengths), np.zeros((1, TRAITS), np.uint64)))
    keys[-1, 0] = EDGE
    seen = np.bincount(at[real], minlength=edge + 1)
    seen[edge] = support
    named, number = np.unique(keys, return_inverse=True)
    number = number.reshape(keys.shape)
    used = np.bincount(number.ravel(), weights=np.repeat(seen, TRAITS), minlength=len(named)) >= support
    used &= named != 0

    others = []
    for place in PLACES:
        moved = np.full((n, length), edge)
        if place == 0:
            moved = at
        elif place < 0:
            moved[:, -place:] = at[:, :place]
        else:
            moved[:, :-place] = at[:, place:]
        others.append(moved)
    shapes = [(len(PLACES), len(named), 3), (len(file_names), 3), (3, 3)]
    values = [np.zeros(shape) for shape in shapes]
    moments = [np.zeros((2, *shape)) for shape in shapes]
    rows, lasts = np.arange(n), sizes - 1

    for step in range(1, STEPS + 1):
        weights, files, moves = values
        scores = np.repeat(files[file_at][:, None], length, axis=1)
        for i, moved in enumerate(others):
            scores += weights[i][number[:, :TRAITS if i == 0 else NEAR]].sum(axis=1)[moved]
        share, joint = _marginals(scores, real, lasts, np.exp(_allowed(moves)))
        wanted = np.where(real[:, :, None], np.eye(3)[tags], 0) - share
        change = np.zeros_like(weights)
        for i, moved in enumerate(others):
            most = TRAITS if i == 0 else NEAR
            for y in range(3):
                summed = np.bincount(moved.ravel(), weights=wanted[:, :, y].ravel(), minlength=edge + 1)
                change[i, :, y] = np.bincount(number[:, :most].ravel(), weights=np.repeat(summed, most), minlength=len(named)) * used
        by_file = np.stack([np.bincount(file_at, weights=wanted[:, :, y].sum(axis=1), minlength=len(file_names)) for y in range(3)], axis=1)
        by_move = -joint
        follows = real[:, 1:]
        np.add.at(by_move, (tags[:, :-1][follows], tags[:, 1:][follows]), 1)
        by_move[OUTSIDE] += (np.eye(3)[tags[:, 0]] - share[:, 0]).sum(axis=0)
        by_move[:, OUTSIDE] += (np.eye(3)[tags[rows, lasts]] - share[rows, lasts]).sum(axis=0)
        for value, gradient, moment in zip(values, (change, by_file, by_move), moments):
            gradient = gradient / n - DECAY * value
            moment[0] = 0.9 * moment[0] + 0.1 * gradient
            moment[1] = 0.999 * moment[1] + 0.001 * gradient**2
            value += RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
    weights, files, moves = values
    kept = np.flatnonzero(used & (np.abs(weights).max(axis=(0, 2)) > 1e-3))
    return Model(named[kept], weights[:, kept].transpose(1, 0, 2).astype(np.float32), dict(zip(file_names.tolist(), files.astype(np.float32))), moves)


def _marginals(scores: np.ndarray, real: np.ndarray, lasts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of tags of each token, and sums of those of pairs of tags, by scaled forward and backward sums."""
    n, length, _ = scores.shape
    mass = np.exp(scores - scores.max(axis=2, keepdims=True))
    forward, backward, joint = np.zeros((n, length, 3)), np.zeros((n, length, 3)), np.zeros((3, 3))
    own = moves[OUTSIDE] * mass[:, 0]
    forward[:, 0] = own / own.sum(axis=1, keepdims=True)
    for t in range(1, length):
        own = forward[:, t - 1] @ moves * mass[:, t]
        forward[:, t] = own / own.sum(axis=1, keepdims=True)
    for t in range(length - 1, -1, -1):
        if t + 1 < length:
            behind = mass[:, t + 1] * backward[:, t + 1]
            own = behind @ moves.T
            backward[:, t] = own / np.maximum(own.sum(axis=1, keepdims=True), 1e-300)
        backward[lasts == t, t] = moves[:, OUTSIDE]
        if t + 1 < length:
            # Pairs of tags, each token pair with probabilities that add up to 1.
            both = np.einsum("ni,nj->nij", forward[:, t], behind) * moves
            size = both.sum(axis=(1, 2))
            inside = real[:, t + 1]
            joint += (both[inside] / size[inside, None, None]).sum(axis=0)
    share = forward * backward
    share = np.where(real[:, :, None], share / np.maximum(share.sum(axis=2, keepdims=True), 1e-300), 0)
    return share, joint
