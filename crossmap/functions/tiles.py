"""Scores between two tiles of vectors, computed with numpy inside a task.

A tile is a bounded number of vectors of one framework. Spark pairs the tiles
and moves them; these helpers see one pair of tiles at a time and give back
only what the caller keeps of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROWS_AT_ONCE = 512
#: Cells that a word touches in a pair of tiles, from which it is multiplied as a dense column.
FREQUENT_CELLS = 4096
TERMS_AT_ONCE = 4096
NUMBERS_AT_ONCE = 1 << 20
MANY_TIES = 64
#: Groups of the columns of a tile, of which the greatest scores bound the best of a row.
GROUPS = 64
#: Rows of a shard that are scored at once, and how often a word is in them at least to be kept as a dense column too.
INDEXED_AT_ONCE, DENSE_FROM = 1024, 32
#: Cells that a word touches in such a part and a slice of rows, from which it is multiplied as a dense column.
INDEXED_CELLS = 2048
#: Sums of products of whole numbers below it are exact in single precision.
EXACT_SINGLE = 1 << 24
KINDS = [np.dtype(x) for x in ("<u1", "<u2", "<u4", "<u8")]
#: The rows of strip_job.
STRIP = pa.schema([(name, pa.string()) for name in ("framework_A", "framework_B")] + [(name, pa.int64()) for name in ("first_A", "first_B", "low_A", "high_A", "low_B", "high_B")] + [(name, pa.float64()) for name in ("low", "high")])
#: Cells that a task keeps before it gives them away.
HELD_CELLS = 1 << 21


def dense_tile(cell):
    """Positions, unit vectors and their short form of a tile, in position order."""
    members = cell.values
    pos = members.field("pos").to_numpy(zero_copy_only=False)
    flat = members.field("payload").flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(pos)
    vectors = flat.reshape(len(pos), -1)[order].astype(np.float64)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
    return pos[order], unit, unit.astype(np.float32)


def dense_scores(tile_a, tile_b):
    """Yields (first row, cosine rows) of two dense tiles; the next rows take the place of these."""
    unit_a, unit_b = tile_a[1], tile_b[1]
    room = np.empty((min(ROWS_AT_ONCE, len(unit_a)), len(unit_b)))
    for start in range(0, len(unit_a), ROWS_AT_ONCE):
        part = unit_a[start : start + ROWS_AT_ONCE]
        yield start, np.matmul(part, unit_b.T, out=room[: len(part)])


def first_best(scores, threshold, k):
    """Row, column and score of the k best cells of each row; among equals the first columns."""
    keep = scores >= threshold
    crowded = np.flatnonzero(np.count_nonzero(keep, axis=1) > k)
    if len(crowded):
        part = scores[crowded]
        last = part.shape[1] - k
        level = np.partition(part, last, axis=1)[:, last, None]
        above, equal = part > level, part == level
        room = k - np.count_nonzero(above, axis=1, keepdims=True)
        keep[crowded] = above | (equal & (np.cumsum(equal, axis=1) <= room))
    rows, columns = np.nonzero(keep)
    return rows, columns, scores[rows, columns]


def dense_best(tile_a, tile_b, floors, k, digits):
    """Yields (rows, columns, scores) that hold the k best cells of every row among those from its floor up.

    A first pass in single precision leaves out what cannot be among the best:
    for unit vectors its error is at most (dimension + 4) roundings, to which
    the rounding of the scores adds. What is left is scored in double
    precision. A row with many ties is scored as a whole.
    """
    _, unit_a, short_a = tile_a
    _, unit_b, short_b = tile_b
    slack = 3 * (unit_a.shape[1] + 4) * 2.0**-24 + 10.0**-digits
    floors = np.broadcast_to(np.asarray(floors, np.float64), len(unit_a))
    room = np.empty((min(ROWS_AT_ONCE, len(unit_a)), len(unit_b)), np.float32)
    wanted = np.empty(room.shape, bool)
    for start in range(0, len(unit_a), ROWS_AT_ONCE):
        part = short_a[start : start + ROWS_AT_ONCE]
        rough = np.matmul(part, short_b.T, out=room[: len(part)])
        floor = (floors[start : start + ROWS_AT_ONCE] - slack).astype(np.float32)[:, None]
        width = rough.shape[1] // max(GROUPS, 8 * k)
        if width > 1:  # The k-th of the greatest scores of groups of columns is at most the k-th score.
            tops = np.fmax.reduce(rough[:, : width * max(GROUPS, 8 * k)].reshape(len(rough), width, -1), axis=1)
            tops = np.partition(np.nan_to_num(tops, nan=-np.inf), tops.shape[1] - k, axis=1)[:, tops.shape[1] - k, None]
            floor = np.fmax(floor, tops - np.float32(slack))
        keep = np.greater_equal(rough, floor, out=wanted[: len(part)])
        counts = np.count_nonzero(keep, axis=1)
        crowded = np.flatnonzero(counts > (k + MANY_TIES if width > 1 else k))
        if len(crowded):
            part = rough[crowded]
            last = part.shape[1] - k
            level = np.partition(part, last, axis=1)[:, last] - slack
            keep[crowded] = part >= np.maximum(level[:, None], floor[crowded])
            counts[crowded] = np.count_nonzero(keep[crowded], axis=1)
        tied = np.flatnonzero(counts > k + MANY_TIES)
        if len(tied):
            exact = np.round(unit_a[start + tied] @ unit_b.T, digits)
            rows, columns, kept = first_best(exact, floors[start + tied, None], k)
            yield start + tied[rows], columns, kept
            keep[tied] = False
        rows, columns = np.divmod(np.flatnonzero(keep), max(len(unit_b), 1))
        rows += start
        step = max(NUMBERS_AT_ONCE // max(unit_a.shape[1], 1), 1)
        for low in range(0, len(rows), step):
            r, c = rows[low : low + step], columns[low : low + step]
            kept = np.round(np.einsum("ij,ij->i", unit_a[r], unit_b[c]), digits)
            strong = kept >= floors[r]
            yield r[strong], c[strong], kept[strong]


def dense_all(tile_a, tile_b, digits):
    """Yields (rows, columns, scores) of every cell."""
    for start, scores in dense_scores(tile_a, tile_b):
        rows, columns = np.indices(scores.shape)
        yield start + rows.ravel(), columns.ravel(), np.round(scores, digits).ravel()


def term_tile(cell):
    """Positions, vocabulary, counts per (row, term) and norms of a tile."""
    members = cell.values
    pos = members.field("pos").to_numpy(zero_copy_only=False)
    words = members.field("payload")
    order = np.argsort(pos)
    place = np.empty(len(pos), dtype=np.int64)
    place[order] = np.arange(len(pos))
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    vocabulary, width = coded.dictionary, max(len(coded.dictionary), 1)
    cells = np.repeat(place, lengths) * width + coded.indices.to_numpy(zero_copy_only=False)
    cells, counts = np.unique(cells, return_counts=True)
    rows, terms = np.divmod(cells, width)
    norms = np.sqrt(np.bincount(rows, counts.astype(np.float64) ** 2, minlength=len(pos)))
    return pos[order], vocabulary, (rows, terms, counts.astype(np.float64)), norms


def _by_column(entries, shared):
    """Rows, shared columns and counts of the entries that both tiles know, in column order."""
    rows, terms, counts = entries
    column = shared[terms]
    used = np.flatnonzero(column >= 0)
    used = used[np.argsort(column[used], kind="stable")]
    return rows[used], column[used], counts[used]


def _columns(entries, total, height):
    """Yields dense count matrices over slices of the columns."""
    rows, column, counts = entries
    for start in range(0, total, TERMS_AT_ONCE):
        width = min(TERMS_AT_ONCE, total - start)
        low, high = np.searchsorted(column, (start, start + width))
        dense = np.zeros((height, width))
        dense[rows[low:high], column[low:high] - start] = counts[low:high]
        yield dense


def _rare_products(entries_a, entries_b, each_b, rare, shape):
    """Sums of products over the rare columns: every entry of A meets the entries of B in its column."""
    rows_a, column_a, counts_a = (x[rare[entries_a[1]]] for x in entries_a)
    rows_b, _, counts_b = entries_b
    starts = np.cumsum(each_b) - each_b
    meets = each_b[column_a]
    ends = np.cumsum(meets)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[column_a] - ends + meets, meets)
    cells = np.repeat(rows_a, meets) * shape[1] + rows_b[at]
    return np.bincount(cells, np.repeat(counts_a, meets) * counts_b[at], minlength=shape[0] * shape[1]).astype(np.float64).reshape(shape)


def term_scores(tile_a, tile_b):
    """Cosines of two term-count tiles."""
    pos_a, vocabulary_a, entries_a, norms_a = tile_a
    pos_b, vocabulary_b, entries_b, norms_b = tile_b
    where = pc.index_in(vocabulary_b, value_set=vocabulary_a)
    into_a = where.fill_null(-1).to_numpy(zero_copy_only=False)
    common = np.flatnonzero(into_a >= 0)
    shared_b = np.full(max(len(vocabulary_b), 1), -1)
    shared_b[common] = np.arange(len(common))
    shared_a = np.full(max(len(vocabulary_a), 1), -1)
    shared_a[into_a[common]] = np.arange(len(common))
    entries_a, entries_b = _by_column(entries_a, shared_a), _by_column(entries_b, shared_b)
    each_a, each_b = (np.bincount(x[1], minlength=len(common)) for x in (entries_a, entries_b))
    frequent = each_a * each_b > FREQUENT_CELLS
    dots = _rare_products(entries_a, entries_b, each_b, ~frequent, (len(pos_a), len(pos_b)))
    number, total = np.cumsum(frequent) - 1, int(frequent.sum())
    dense = []
    for rows, column, counts in (entries_a, entries_b):
        kept = frequent[column]
        dense.append((rows[kept], number[column[kept]], counts[kept]))
    for part_a, part_b in zip(_columns(dense[0], total, len(pos_a)), _columns(dense[1], total, len(pos_b))):
        dots += part_a @ part_b.T
    lengths = np.outer(norms_a, norms_b)
    return np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)


def term_best(tile_a, tile_b, floors, k, digits):
    """Yields (rows, columns, scores) of the k best cells of every row among those from its floor up."""
    yield first_best(np.round(term_scores(tile_a, tile_b), digits), floors[:, None], k)


def packed_rows(owner, n, terms, counts):
    """Numbers of words, rising within each row, and their counts as one short binary value a row."""
    sizes = np.bincount(owner, minlength=n)
    ends = np.cumsum(sizes)
    gaps = np.diff(terms, prepend=0)
    first = (ends - sizes)[sizes > 0]
    gaps[first] = terms[first]
    kinds = []
    for values in (gaps, counts):
        most = np.zeros(n, np.uint64)
        if len(first):
            most[sizes > 0] = np.maximum.reduceat(values, first)
        kinds.append(np.searchsorted(np.array([1 << 8, 1 << 16, 1 << 32], np.uint64), most, side="right").tolist())
    out = []
    for start, end, x, y in zip((ends - sizes).tolist(), ends.tolist(), *kinds):
        out.append(bytes((x, y)) + gaps[start:end].astype(KINDS[x]).tobytes() + counts[start:end].astype(KINDS[y]).tobytes())
    return pa.array(out, pa.binary())


def unpacked_rows(column):
    """How many words each row has, and the numbers and counts of all rows."""
    sizes, terms, counts = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for value in column.to_pylist():
        x, y = KINDS[value[0]], KINDS[value[1]]
        n = (len(value) - 2) // (x.itemsize + y.itemsize)
        sizes.append(n)
        terms.append(np.cumsum(np.frombuffer(value, x, n, 2), dtype=np.int64))
        counts.append(np.frombuffer(value, y, n, 2 + n * x.itemsize).astype(np.int64))
    return np.array(sizes, np.int64), np.concatenate(terms), np.concatenate(counts)


def number_tile(part):
    """Positions, norms, and row, place and count of each word of rows, with the numbers of the words by place."""
    sizes, terms, counts = unpacked_rows(part.column("words"))
    vocabulary, place = np.unique(terms, return_inverse=True)
    entries = np.repeat(np.arange(part.num_rows), sizes), place, counts.astype(np.float64)
    return part.column("pos").to_numpy(zero_copy_only=False), part.column("norm").to_numpy(zero_copy_only=False), vocabulary, entries


def index_tile(part):
    """The same of rows of a shard, by word: postings, where those of each word begin, and dense columns of the frequent ones."""
    pos, norms, vocabulary, (rows, place, counts) = number_tile(part)
    order = np.argsort(place, kind="stable")
    rows, place, counts = rows[order], place[order], counts[order]
    each = np.bincount(place, minlength=len(vocabulary))
    heavy = each >= DENSE_FROM
    number = np.where(heavy, np.cumsum(heavy) - 1, -1)
    dense = np.zeros((int(heavy.sum()), len(pos)), np.float32 if counts.max(initial=0) < EXACT_SINGLE else np.float64)
    own = heavy[place]
    dense[number[place[own]], rows[own]] = counts[own]
    return pos, norms, vocabulary, (rows, counts), each, np.cumsum(each) - each, number, dense


def indexed_best(tile, index, threshold, k, digits):
    """Rows, columns and scores of the k best cells of every row of a tile in a part of a shard."""
    _, norms_a, vocabulary_a, (rows_a, place_a, counts_a) = tile
    _, norms_b, vocabulary_b, (rows_b, counts_b), each_b, starts, number, dense_b = index
    shape = len(norms_a), len(norms_b)
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not (len(vocabulary_a) and len(vocabulary_b)):
        return nothing
    at = np.minimum(np.searchsorted(vocabulary_b, vocabulary_a), len(vocabulary_b) - 1)
    known = vocabulary_b[at] == vocabulary_a
    each_a = np.bincount(place_a, minlength=len(vocabulary_a))
    frequent = known & (each_a * each_b[at] > INDEXED_CELLS) & (number[at] >= 0)
    # No part of a sum of products is above the product of both norms.
    kind = np.float32 if norms_a.max() * norms_b.max() < EXACT_SINGLE else np.float64
    column = np.cumsum(frequent) - 1
    dense_a = np.zeros((shape[0], int(frequent.sum())), kind)
    own = frequent[place_a]
    dense_a[rows_a[own], column[place_a[own]]] = counts_a[own]
    dots = dense_a @ dense_b[number[at[frequent]]].astype(kind, copy=False)
    own = (known & ~frequent)[place_a]
    rows, words, counts = rows_a[own], at[place_a[own]], counts_a[own]
    meets = each_b[words]
    ends = np.cumsum(meets)
    if len(ends) and ends[-1]:
        posting = np.arange(ends[-1]) + np.repeat(starts[words] - ends + meets, meets)
        cells = np.repeat(rows, meets) * shape[1] + rows_b[posting]
        dots += np.bincount(cells, np.repeat(counts, meets) * counts_b[posting], minlength=shape[0] * shape[1]).reshape(shape).astype(kind)
    least = (threshold - 10.0**-digits) * (1 - 1e-5)
    rows, columns = np.nonzero(dots >= (least * norms_a).astype(kind)[:, None] * norms_b.astype(kind) * kind(1 - 1e-5))
    lengths = norms_a[rows] * norms_b[columns]
    scores = np.round(np.divide(dots[rows, columns].astype(np.float64), lengths, out=np.zeros(len(rows)), where=lengths > 0), digits)
    strong = scores >= threshold
    return merged_best((rows[strong], columns[strong], scores[strong]), nothing, k)


def segments(batch, names):
    """Yields the slices of a batch in which the named columns do not change."""
    cuts = np.zeros(batch.num_rows, dtype=bool)
    for name in names:
        column = batch.column(name)
        cuts[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    edges = [0, *np.flatnonzero(cuts).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def index_job(threshold, k, digits):
    """Arrow task over shards of an index, side 0, and the rows that pass each of them, side 1: the k best cells of every row."""
    task = ["framework_B", "shard", "run"]

    def run(batches):
        key, held, index = None, [], None
        for batch in batches:
            for part in segments(batch, [*task, "side", "framework_A"]):
                own = tuple(part.column(name)[0].as_py() for name in task)
                if own != key:
                    key, held, index = own, [], None
                if part.column("side")[0].as_py() == 0:
                    held.append(part.select(["pos", "norm", "words"]))
                    continue
                if not held:
                    continue
                if index is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    index = [index_tile(whole.slice(at, INDEXED_AT_ONCE).combine_chunks().to_batches()[0]) for at in range(0, whole.num_rows, INDEXED_AT_ONCE)]
                    held = [None]
                name_a = part.column("framework_A")[0].as_py()
                for start in range(0, part.num_rows, ROWS_AT_ONCE):
                    tile, best = number_tile(part.slice(start, ROWS_AT_ONCE)), None
                    for piece in index:
                        rows, columns, kept = indexed_best(tile, piece, threshold, k, digits)
                        found = rows, piece[0][columns], kept
                        best = found if best is None else merged_best(best, found, k)
                    yield _cells_batch(name_a, key[0], tile[0][best[0]], best[1], best[2])

    return run


def tile_pairs(batches, read):
    """Yields (group, names, read tiles) of every row with both tiles; a group is a tile of A."""
    last_key, last_tile = None, None
    for batch in batches:
        names_a, names_b = batch.column("framework_A"), batch.column("framework_B")
        blocks_a = batch.column("block_A")
        rows_a, rows_b = batch.column("rows_A"), batch.column("rows_B")
        for i in range(batch.num_rows):
            name_a, name_b = names_a[i].as_py(), names_b[i].as_py()
            key = (name_a, blocks_a[i].as_py())
            if key != last_key:
                last_key, last_tile = key, read(rows_a[i])
            yield key, name_a, name_b, last_tile, read(rows_b[i])


def passing_pairs(batches, read):
    """The same of rows that bring tiles of A to hold first, then the tiles of B that meet some of them; a group is what is held."""
    key, held = None, {}
    for batch in batches:
        names_a, groups, runs, sides = (batch.column(name) for name in ("framework_A", "group", "run", "side"))
        names_b, partners, rows = (batch.column(name) for name in ("framework_B", "partners", "rows"))
        for i in range(batch.num_rows):
            name_a = names_a[i].as_py()
            own = (name_a, groups[i].as_py(), runs[i].as_py())
            if own != key:
                key, held = own, {}
            tile = read(rows[i])
            if sides[i].as_py() == 0:
                held[partners[i].as_py()[0]] = tile
            else:
                for block in sorted(partners[i].as_py()):
                    if block in held:  # a hash can leave a tile empty
                        yield key, name_a, names_b[i].as_py(), held[block], tile


def _cells_batch(name_a, name_b, pos_a, pos_b, kept):
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(pa.scalar(name_a, pa.string()), len(kept)),
            pa.repeat(pa.scalar(name_b, pa.string()), len(kept)),
            pa.array(pos_a, pa.int64()),
            pa.array(pos_b, pa.int64()),
            pa.array(kept, pa.float64()),
        ],
        names=["framework_A", "framework_B", "pos_A", "pos_B", "semantic_score"],
    )


def merged_best(first, second, k):
    """The k best cells of every row from two sets of (rows, positions, scores); equal scores by position."""
    rows, pos, kept = (np.concatenate(x) for x in zip(first, second))
    order = np.lexsort((pos, -kept, rows))
    rows, pos, kept = rows[order], pos[order], kept[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return tuple(x[place < k] for x in (rows, pos, kept))


def raised(best, floors, k):
    """The floors of all rows, raised to the k-th score of rows that have k cells; no lower cell can be among the k best."""
    rows, _, kept = best
    last = np.flatnonzero(rows[k - 1 :] == rows[: max(len(rows) - k + 1, 0)]) + k - 1
    out = floors.copy()
    out[rows[last]] = np.maximum(out[rows[last]], kept[last])
    return out


def cell_job(pairs, read, cells, k=None, threshold=0.0):
    """Arrow task that gives the wanted cells of every pair of tiles.

    With k, the k best of each row from the threshold up are kept while the task stays with a group of
    tiles of A, and leave the task once; beyond HELD_CELLS they leave earlier. What a row has kept is
    the floor of its cells in the next tile.
    """

    def run(batches):
        held, group, size = {}, None, 0

        def flush():
            for name_a, name_b, tile_a, (rows, pos, kept), _ in held.values():
                yield _cells_batch(name_a, name_b, tile_a[0][rows], pos, kept)
            held.clear()

        for own, name_a, name_b, tile_a, tile_b in pairs(batches, read):
            if own != group or size > HELD_CELLS:
                yield from flush()
                group, size = own, 0
            if k is None:
                for rows, columns, kept in cells(tile_a, tile_b):
                    yield _cells_batch(name_a, name_b, tile_a[0][rows], tile_b[0][columns], kept)
                continue
            key, before = (id(tile_a), name_b), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            floors = np.full(len(tile_a[0]), float(threshold))
            if key in held:
                before, floors = held[key][3:]
            found = list(cells(tile_a, tile_b, floors))
            rows, columns, kept = (np.concatenate(x) for x in zip(*found)) if found else before
            if len(rows) and found:
                merged = merged_best(before, (rows, tile_b[0][columns], kept), k)
                size += len(merged[0]) - len(before[0])
                held[key] = (name_a, name_b, tile_a, merged, raised(merged, floors, k))
        yield from flush()

    return run


def grid_job(pairs, digits):
    """Arrow task that gives every pair of tiles as one row-major grid."""

    def run(batches):
        for _, name_a, name_b, tile_a, tile_b in pairs(batches, dense_tile):
            for start, scores in dense_scores(tile_a, tile_b):
                grid = np.round(scores, digits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name_a], pa.string()),
                        pa.array([name_b], pa.string()),
                        pa.array([tile_a[0][start : start + len(grid)]], pa.list_(pa.int64())),
                        pa.array([tile_b[0]], pa.list_(pa.int64())),
                        pa.array([grid.ravel()], pa.list_(pa.float64())),
                    ],
                    names=["framework_A", "framework_B", "pos_A", "pos_B", "scores"],
                )

    return run


def strip_job(pairs, digits):
    """Arrow task that goes through the same grids and gives the range of positions and of scores of each."""

    def run(batches):
        for _, name_a, name_b, tile_a, tile_b in pairs(batches, dense_tile):
            for start, scores in dense_scores(tile_a, tile_b):
                pos_a, pos_b = tile_a[0][start : start + len(scores)], tile_b[0]
                # Rounding keeps the order; the least score is that of the cells that are numbers, if there are any.
                high = scores.max()
                low = scores.min() if high == high else np.fmin.reduce(scores, axis=None)
                low, high = np.round(np.array([low, high]), digits).tolist()
                yield pa.RecordBatch.from_pylist([{
                    "framework_A": name_a, "framework_B": name_b, "first_A": pos_a[0], "first_B": pos_b[0],
                    "low_A": pos_a.min(), "high_A": pos_a.max(), "low_B": pos_b.min(), "high_B": pos_b.max(), "low": low, "high": high,
                }], STRIP)

    return run


def summary_job(pairs, digits):
    """Arrow task that gives count, sum and extremes of every pair of tiles."""

    def run(batches):
        for _, name_a, name_b, tile_a, tile_b in pairs(batches, dense_tile):
            for _, scores in dense_scores(tile_a, tile_b):
                if not scores.size:
                    continue
                grid = np.round(scores, digits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name_a], pa.string()),
                        pa.array([name_b], pa.string()),
                        pa.array([grid.size], pa.int64()),
                        pa.array([grid.sum()], pa.float64()),
                        pa.array([grid.min()], pa.float64()),
                        pa.array([grid.max()], pa.float64()),
                    ],
                    names=["framework_A", "framework_B", "cells", "total", "low", "high"],
                )

    return run
