"""Near-duplicates by SetSketch registers, banded, estimated jointly and verified.

A document's set holds the hashes of its word shingles. Register i of its
sketch is the smallest of exponentially distributed values, one per shingle,
kept on an exponential scale of base BASE and truncated: registers of two parts
of a set merge by their maximum, and registers of two sets agree about as often
as the sets overlap. Registers are grouped into bands; sets that agree in a band
are candidates. The overlap of a candidate pair is estimated by maximum
likelihood from the registers and the known set sizes; pairs that cannot reach
the threshold within six standard errors fall away, the rest is verified on the
full sets.

Equal sets are one class from the start. In each band, the members of a bucket
are first compared with its smallest member only. After links are joined to
components, members of the smaller components of a bucket are compared with those of the
others, pair by pair in small buckets and by postings in cells of bounded size in
large ones; members that are already connected are not compared again. No step
holds a bucket, component or list of links in one place.

A link (overlap at the threshold) is missed only if no band agrees, with
probability (1 - t^BAND)^(REGISTERS / BAND) at most: 5e-11 for 0.85, 5e-8 for 0.8.

Defined cases: words are separated by ASCII white space and A-Z is lower-cased;
a text with fewer words than a shingle is one shingle; null, empty and blank
texts have an empty set and are linked with nothing, so each is its own
component; a null identifier can be linked, but names a component only if all of its
members are null; repeated rows are in one component, and all rows with the
smallest identifier count as kept, of which `distinct_documents` leaves one; an
empty table gives an empty result; further columns can have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crossmap.llm.common import Words, checkpointed, column, counted, free_name, release, slices, with_fields

SHINGLE, THRESHOLD = 5, (80, 100)
REGISTERS, BAND = 128, 4
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
ERRORS = 6
#: Identifiers of documents to look up that may be broadcast; beyond it a bitmap of their hashes goes to the tasks.
BROADCAST_IDS = 100_000
#: Bits of that bitmap, and of the slots of it that tasks fill.
BITMAP_BITS, SLOT_BITS = 26, 20
#: Members up to which a bucket is compared pair by pair; larger ones are compared in cells of so many shingles a side.
SMALL, CELL = 32, 1 << 18
#: Pairs with one leader that share a copy of its set.
PER_COPY = 500
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and how many each text has."""
    words = Words(pc.ascii_lower(texts.cast(pa.string())))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.distinct), np.uint64, len(words.distinct))[words.codes]
    counts, n = words.counts, len(words.counts)
    row = np.repeat(np.arange(n), counts)
    nth = np.arange(len(row)) - np.repeat(words.ends - counts, counts)
    starts = np.flatnonzero((nth + width <= counts[row]) | (nth == 0))
    sizes = np.minimum(counts[row[starts]], width)
    value = sizes.astype(np.uint64) * _ODD[7]
    for j in range(width):
        inside = sizes > j
        value[inside] = _mixed(value[inside] * _ODD[j % 7] + hashes[starts[inside] + j])
    owner = row[starts]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=n)


def sketches(values: np.ndarray, counts: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """One row of registers per set.

    An element's values for the registers come in rising order with exponential
    gaps, each for a register of its own, so an element is done once its value
    is above the largest minimum that its set still has.
    """
    least = np.full((len(counts), registers), np.inf)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = _mixed(values + _ODD[0])
    place, step = (at >> np.uint64(20)).astype(np.int64) % registers, ((at >> np.uint64(40)).astype(np.int64) | 1) % registers
    x = np.zeros(len(values))
    flat = least.reshape(-1)
    for nth in range(registers):
        if not len(owner):
            break
        at = at + _ODD[1]
        uniform = ((_mixed(at) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        x = x - np.log(uniform) / (RATE * (registers - nth))
        np.minimum.at(flat, owner * registers + place, x)
        live = x < least.max(axis=1)[owner]
        owner, at, x, step = owner[live], at[live], x[live], step[live]
        place = (place[live] + step) % registers
    scaled = np.zeros(least.shape)
    np.log(least, out=scaled, where=np.isfinite(least))
    return np.where(np.isfinite(least), np.clip(np.floor(1 - scaled / np.log(BASE)), 0, TOP), 0).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def estimated_overlap(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of pairs of sets by maximum likelihood, from their registers and sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def part(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        p, q = part(u - v * j), part(v - u * j)
        tiny = 1e-300
        return more * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(q, tiny)) + same * np.log(np.maximum(1 - p - q, tiny))

    golden = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = high - golden * (high - low), low + golden * (high - low)
        left = likelihood(c) > likelihood(d)
        low, high = np.where(left, low, c), np.where(left, d, high)
    return (low + high) / 2


def _least(threshold: tuple[int, int], registers: int) -> float:
    t = threshold[0] / threshold[1]
    return t - ERRORS * (t * (1 - t) / registers) ** 0.5


def _digests(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that do not depend on order: its fingerprint."""
    ends = np.cumsum(counts)
    out = []
    for salt in (_ODD[2], _ODD[3]):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(values ^ salt), dtype=np.uint64)))
        out.append((sums[ends] - sums[ends - counts]).view(np.int64))
    return out[0], out[1]


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(column(df, id_col).alias("doc_id"), column(df, text_col).alias("text"))


def sketched(df: DataFrame, id_col: str, text_col: str, shingle: int, registers: int = REGISTERS) -> DataFrame:
    """(doc_id, n, d1, d2, registers) of every row: set size, fingerprint and sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values, counts = shingle_sets(part.column("text"), shingle)
            d1, d2 = _digests(values, counts)
            rows = [x.tobytes() for x in sketches(values, counts, registers)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(d1), pa.array(d2), pa.array(rows, pa.binary())], names)

    rows = _rows(df, id_col, text_col)
    schema = with_fields(rows.select("doc_id").schema, "n bigint, d1 bigint, d2 bigint, registers binary")
    names = schema.names
    return rows.mapInArrow(sketch, schema)


def _banded(classes: DataFrame, band: int) -> DataFrame:
    """(key, node, n): one row per class and band."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(batch.num_rows, -1).astype(np.uint64)
            bands = table.shape[1] // band
            table = table[:, :bands * band].reshape(batch.num_rows, bands, band)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _ODD[4], table.shape[:2]).copy()
            for j in range(band):
                key = _mixed(key * _ODD[5] + table[:, :, j])
            repeated = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), bands) for c in ("node", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), *map(pa.array, repeated)], ["key", "node", "n"])

    return classes.select("node", "n", "registers").mapInArrow(spread, "key bigint, node bigint, n bigint")


def _possible(pairs: DataFrame, classes: DataFrame, threshold: tuple[int, int], registers: int) -> DataFrame:
    """Pairs (a, b) whose estimated overlap may reach the threshold, with that estimate."""
    least = _least(threshold, registers)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(part.num_rows, -1) for c in ("registers_a", "registers_b"))
                sizes = [part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b")]
                guess = estimated_overlap(x, y, *sizes)
                chosen = pa.array(guess >= least)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(chosen), part.column("b").filter(chosen), pa.array(guess).filter(chosen)], ["a", "b", "guess"])

    def side(name: str) -> DataFrame:
        return classes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"registers_{name}"))

    num, den = threshold
    near = (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
    return pairs.join(side("b"), "b").join(side("a"), "a").filter(near).mapInArrow(estimate, "a bigint, b bigint, guess double")


def _place(identifier: Column) -> Column:
    """The bit of an identifier, a null one included."""
    return F.shiftrightunsigned(F.xxhash64(identifier), 64 - BITMAP_BITS)


def bitmap(ids: DataFrame) -> Broadcast:
    """Which hashes the identifiers of a column have: of a fixed size, however many they are. Each task fills a slot."""
    (name,) = ids.columns

    def mark(cell: pa.Table) -> pa.Table:
        bits = np.zeros(1 << SLOT_BITS, bool)
        bits[cell.column("place").to_numpy() & ((1 << SLOT_BITS) - 1)] = True
        return pa.table({"slot": cell.column("slot").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    places = ids.select(_place(column(ids, name)).alias("place")).distinct().withColumn("slot", F.shiftright("place", SLOT_BITS))
    bits = np.zeros((1 << (BITMAP_BITS - SLOT_BITS), 1 << (SLOT_BITS - 3)), np.uint8)
    for slot, own in places.groupBy("slot").applyInArrow(mark, "slot bigint, bits binary").collect():
        bits[slot] = np.frombuffer(own, np.uint8)
    return ids.sparkSession.sparkContext.broadcast(bits.reshape(-1))


def marked(places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which places have their bit set: all of the identifiers, and few others."""
    return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)


def _sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, members): the full sets of some classes, each from the texts of its smallest identifier."""
    wanted, number = counted(classes.select("node", "n", "d1", "d2", "rep").join(nodes.toDF("node").distinct(), "node"))
    ids, shared = wanted.select("rep"), None
    if number <= BROADCAST_IDS:
        found = docs.join(F.broadcast(ids), docs["doc_id"].eqNullSafe(ids["rep"]), "left_semi").select("text")
    else:  # A document of another identifier that has the same bit gives a set that is not asked for.
        shared = bitmap(ids)
        found = docs.select(_place(docs["doc_id"]).alias("place"), "text")

    def asked(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch if shared is None else batch.filter(pa.array(marked(batch.column("place").to_numpy(), shared.value)))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(map(asked, batches), "text"):
            values, counts = shingle_sets(part.column("text"), shingle)
            d1, d2 = _digests(values, counts)
            sets = pa.array([x.tobytes() for x in np.split(values, np.cumsum(counts)[:-1])], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), pa.array(d1), pa.array(d2), sets], ["n", "d1", "d2", "members"])

    sets = found.mapInArrow(collect, "n bigint, d1 bigint, d2 bigint, members binary").dropDuplicates(["n", "d1", "d2"])
    return sets.join(wanted.select("node", "n", "d1", "d2"), ["n", "d1", "d2"]).select("node", "members")


def _verified(pairs: DataFrame, number: int, classes: DataFrame, docs: DataFrame, shingle: int, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of classes whose full sets reach the threshold; pairs are kept and so many."""
    num, den = threshold
    if not number:
        return pairs
    sets = checkpointed(_sets(pairs.select("a").union(pairs.select("b")), classes, docs, shingle))
    copies = pairs.groupBy("a").agg((F.floor(F.count("*") / PER_COPY) + 1).alias("copies"))
    left = sets.withColumnRenamed("node", "a").join(copies, "a").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    asked = pairs.join(copies, "a").withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies"))).drop("copies")
    both = asked.join(sets.select(F.col("node").alias("b"), F.col("members").alias("members_b")), "b")
    both = both.join(left.select("a", "copy", F.col("members").alias("members_a")), ["a", "copy"]).select("a", "b", "members_a", "members_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "members_b", 1 << 20):
                good = []
                for x, y in zip(part.column("members_a"), part.column("members_b")):
                    x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(den * shared >= num * (len(x) + len(y) - shared))
                chosen = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(chosen), part.column("b").filter(chosen)], ["a", "b"])

    return checkpointed(both.mapInArrow(verify, "a bigint, b bigint"))


def components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(node, label): the smallest node that each linked node can reach; links as (a, b), may go on from earlier labels.

    Labels pass along links and then jump to the label of their label, until
    nothing changes. Each node is linked with itself, so its own label comes
    with those of its neighbours.
    """
    if before is not None:
        links = links.union(before.select("node", "label").toDF("a", "b"))
    ends = F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x in "ab" for y in "ab"))
    both = checkpointed(links.filter("a <> b").select(F.explode(ends).alias("end")).select("end.*").distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("label")).toDF("node", "label"))
    while True:
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("passed"))).alias("old")
        near = both.join(labels.toDF("b", "passed").hint("merge"), "b").groupBy("a").agg(F.min("passed").alias("near"), own)
        moved = near.join(labels.toDF("near", "label").hint("merge"), "near").select(F.col("a").alias("node"), "label", "old")
        seen = Observation()
        moved = checkpointed(moved.observe(seen, F.count_if(F.col("label") != F.col("old")).alias("changed")))
        labels = moved.select("node", "label")
        if not seen.get["changed"]:
            return labels


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components so far."""
    left, right = labels.toDF("a", "label_a"), labels.toDF("b", "label_b")
    joined = pairs.join(left, "a", "left").join(right, "b", "left")
    return joined.filter(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select(*pairs.columns)


def _majority(rows: DataFrame, group: str) -> DataFrame:
    """Rows of groups with several labels, with the group's most frequent label."""
    shares = rows.groupBy(group, "label").count()
    main = shares.groupBy(group).agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.count("*").alias("labels"))
    return rows.join(main.filter("labels > 1").drop("labels"), group)


def _crossing(state: DataFrame, tested: DataFrame, classes: DataFrame, threshold: tuple[int, int], registers: int) -> DataFrame:
    """Possible pairs across the components in small buckets: each row with SMALL others at most."""
    num, den = threshold
    known = checkpointed(_majority(state, "key"))
    small = known.filter("label <> main").select("key", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("label_a"))
    sized = F.least("n", "n_a") * den >= F.greatest("n", "n_a") * num
    pairs = known.join(small, "key").filter((F.col("label") != F.col("label_a")) & sized)
    pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    tested = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return _possible(pairs.join(tested, ["a", "b"], "left_anti"), classes, threshold, registers)


def _linked_in_clusters(state: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b) across the components in large buckets, without a row per pair.

    Large buckets that share members make a cluster. Members outside the
    cluster's main component meet all members, in cells of bounded size: members
    go to a block by their hash, those outside to each block in parts, and a
    task counts shared shingles by postings. It emits one link at most for a member
    and a component.
    """
    num, den = threshold
    state, number = counted(state)
    if not number:
        return state.select(F.col("node").alias("a"), F.col("node").alias("b"))
    clusters = components(state.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
    rows = state.select("node", "n", F.col("label").alias("component")).distinct().join(clusters.toDF("node", "cluster"), "node")
    rows = _majority(rows.withColumnRenamed("component", "label"), "cluster").withColumn("outside", F.col("label") != F.col("main"))
    sizes = rows.groupBy("cluster").agg((1 + F.floor(F.sum("n") / CELL)).alias("blocks"), (1 + F.floor(F.sum(F.when(F.col("outside"), F.col("n"))) / CELL)).alias("parts"))
    rows, number = counted(rows.join(sizes, "cluster").select("cluster", "node", "label", "outside", "blocks", "parts"))
    if not number:
        return rows.select(F.col("node").alias("a"), F.col("node").alias("b"))
    number = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    held = rows.select("cluster", "node", "label", F.lit(False).alias("asks"), number(1, "blocks").alias("block"), every("parts").alias("part"))
    asking = rows.filter("outside").select("cluster", "node", "label", F.lit(True).alias("asks"), every("blocks").alias("block"), number(2, "parts").alias("part"))
    sets = checkpointed(_sets(rows.select("node"), classes, docs, shingle))
    cells = held.union(asking).join(sets, "node")

    def link(cell: pa.Table) -> pa.Table:
        nodes, labels, asks = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("node", "label", "asks"))
        values = [np.frombuffer(x, np.uint64) for x in cell.column("members").to_pylist()]
        inside, a, b = np.flatnonzero(~asks), [], []
        if len(inside):
            sizes = np.array([len(values[i]) for i in inside])
            terms, codes = np.unique(np.concatenate([values[i] for i in inside]), return_inverse=True)
            order = np.argsort(codes, kind="stable")
            owners, ends = np.repeat(np.arange(len(inside)), sizes)[order], np.cumsum(np.bincount(codes, minlength=len(terms)))
            starts = np.concatenate(([0], ends[:-1]))
            for i in np.flatnonzero(asks):
                place = np.minimum(np.searchsorted(terms, values[i]), len(terms) - 1)
                place = place[terms[place] == values[i]]
                each = ends[place] - starts[place]
                stops = np.cumsum(each)
                found = owners[np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts[place] - stops + each, each)]
                shared = np.bincount(found, minlength=len(inside))
                hits = inside[den * shared >= num * (sizes + len(values[i]) - shared)]
                hits = hits[labels[hits] != labels[i]]
                for j in hits[np.unique(labels[hits], return_index=True)[1]]:
                    a.append(nodes[i])
                    b.append(nodes[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return checkpointed(cells.groupBy("cluster", "block", "part").applyInArrow(link, "a bigint, b bigint"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: tuple[int, int] = THRESHOLD, registers: int = REGISTERS, band: int = BAND) -> DataFrame:
    """(doc_id, n, d1, d2, component, component_id, kept) of every row.

    Documents with an overlap of at least threshold[0] / threshold[1] are linked;
    component_id is the smallest identifier that links can reach; component is
    the component's own number in this run, null for an empty set.
    """
    docs = _rows(df, id_col, text_col)
    rows = checkpointed(sketched(df, id_col, text_col, shingle, registers))
    classes = rows.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("registers").alias("registers"))
    classes = checkpointed(classes.withColumn("node", F.monotonically_increasing_id()))
    bands = _banded(classes, band)
    buckets = bands.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("size")).filter("size > 1")
    members = checkpointed(bands.join(buckets, "key"))
    release(df.sparkSession)

    stars = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    likely = _possible(stars, classes, threshold, registers)
    best, number = counted(likely.groupBy("b").agg(F.max_by("a", "guess").alias("a")).select("a", "b"))
    labels = components(_verified(best, number, classes, docs, shingle, threshold))
    release(df.sparkSession)

    state = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    few, number = counted(_crossing(state.filter(F.col("size") <= SMALL), best, classes, threshold, registers).select("a", "b"))
    few = _verified(few, number, classes, docs, shingle, threshold)
    release(df.sparkSession)
    many = _linked_in_clusters(state.filter(F.col("size") > SMALL), classes, docs, shingle, threshold)
    labels = components(few.union(many), labels)
    release(df.sparkSession)

    named = classes.select("node", "n", "d1", "d2", "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "label").select("n", "d1", "d2", "component_id", F.col("label").alias("component"))
    out = rows.drop("registers").join(named, ["n", "d1", "d2"], "left")
    out = out.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n", "d1", "d2", "component", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def distinct_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows with one document of each group of near-duplicates left, with their own columns.

    Where identifiers are unique, dropped ones are looked up by identifier;
    otherwise by identifier and set, and of rows that repeat both, one stays.
    """
    found = checkpointed(near_duplicates(df, id_col, text_col, shingle, threshold))
    total, unique = found.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if total == unique:
        dropped = found.filter("not kept").select(F.col("doc_id").alias(free_name(df.columns, "dropped")))
        if dropped.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
            return _without(df, id_col, F.broadcast(dropped))
        # Only rows with the bit of a dropped one are shuffled.
        shared = bitmap(dropped)
        among = F.pandas_udf(lambda places: pd.Series(marked(places.to_numpy(), shared.value)), "boolean")(_place(column(df, id_col)))
        return df.filter(~among).union(_without(df.filter(among), id_col, dropped))
    return _distinct_rows(df, found, id_col, text_col, shingle)


def _without(df: DataFrame, id_col: str, dropped: DataFrame) -> DataFrame:
    return df.join(dropped, column(df, id_col) == dropped[dropped.columns[0]], "left_anti")


def _distinct_rows(df: DataFrame, found: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """The same where identifiers repeat: rows are numbered, fingerprinted and the first of each kept set stays."""
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    at = names[df.columns.index(text_col)]
    identifier = names[df.columns.index(id_col)]

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            values, counts = shingle_sets(part.column(at), shingle)
            d1, d2 = _digests(values, counts)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts, pa.int64()), pa.array(d1), pa.array(d2)], [*names, "n", "d1", "d2"])

    marked = checkpointed(plain.mapInArrow(fingerprint, with_fields(plain.schema, "n bigint, d1 bigint, d2 bigint")).withColumn("row", F.monotonically_increasing_id()))
    keys = marked.select("row", "n", "d1", "d2", F.col(identifier).alias("doc_id"))
    state = found.select(F.col("doc_id").alias("id"), "n", "d1", "d2", "component", "kept").distinct()
    same = (keys["doc_id"].eqNullSafe(state["id"])) & (keys["n"] == state["n"]) & (keys["d1"] == state["d1"]) & (keys["d2"] == state["d2"])
    kept = keys.join(state.filter("kept"), same).select("row", keys["n"], "component")
    first = kept.filter("n > 0").groupBy("component").agg(F.min("row").alias("row")).select("row")
    stay = kept.filter("n = 0").select("row").union(first)
    return marked.join(stay, "row", "left_semi").select(*names).toDF(*df.columns)
