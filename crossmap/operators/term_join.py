"""Cosines of word counts through an inverted index.

A word that only one framework knows adds to the length of a row and to no score, so rows are cut down
to the words that several frameworks share. These are numbered by rising frequency. Once the rest of a row's
words are together shorter than the threshold, they cannot make a score that reaches it: two rows that
match share a word of both their prefixes, the rarest words in front of that rest. The index is cut into
shards of rows; a row of the other side goes to the shards in which its prefix meets another prefix. Words
that most shards know are not looked up row by row: rows with such a word in their prefix go to all shards of the
framework. Where prefixes are long, as with a low threshold, nearly every row would be looked up and go everywhere, so all rows
go to all shards at once. For that, shards are large and rows travel as packed bytes: a row is copied once for a shard, and the copies, not the
pairs, are what is written to disk. A task holds the postings of a shard and lets rows pass by, in several runs if there are
many; it adds up products word by word and emits the best of each row. The result is that of all pairs of rows.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.functions import tiles
from crossmap.operators.sizes import TASKS_PER_CORE, busy_partitions, cut
from crossmap.sources.schemas import CELL

cloudpickle.register_pickle_by_value(tiles)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a shard, and of a run that passes it.
SHARD_ROWS, RUN_ROWS = 1 << 14, 1 << 20
#: Shards of the largest framework from which rows are routed by their prefixes; fewer shards take all rows.
ROUTED_FROM = 8
#: Words of a prefix on average up to which they are looked up.
ROUTED_WORDS = 8
#: Bounds of a dictionary that is sent to all tasks; a larger one is joined.
SENT_WORDS, SENT_BYTES = 200_000, 1 << 25
MOST_RUNS = 64
PAIR = ["framework_A", "framework_B"]
_ROW = "framework string, pos bigint, norm double, terms array<bigint>, counts array<bigint>, prefix int"
_PACKED = "framework string, pos bigint, norm double, prefix int, words binary"


def shared_words(words: DataFrame) -> DataFrame:
    """(term, df): words that at least two frameworks know, and in how many rows they are."""
    each = words.select("framework", F.explode(F.array_distinct("terms")).alias("term")).groupBy("framework", "term").agg(F.count("*").alias("df"))
    return each.groupBy("term").agg(F.count("*").alias("_frameworks"), F.sum("df").alias("df")).filter("_frameworks > 1").select("term", "df")


def numbered(words: DataFrame, least: float) -> DataFrame:
    """(framework, pos, norm, terms, counts, prefix): rows that could reach a score of `least`, cut down to shared words by number."""
    words = words.select("framework", "pos", "terms")
    shared = shared_words(words)
    head = shared.limit(SENT_WORDS + 1).toArrow()
    if head.num_rows <= SENT_WORDS and head.nbytes <= SENT_BYTES:
        known = pa.concat_arrays(head.sort_by([("df", "ascending"), ("term", "ascending")]).column("term").chunks) if head.num_rows else pa.array([], pa.string())
        return words.mapInArrow(_by_number(known, least), _ROW)
    # Numbers rise over the partitions of a sort; they are kept, since a second sort could cut it elsewhere.
    number = cut(shared.orderBy("df", "term").select("term", F.monotonically_increasing_id().alias("number")))
    rows = words.mapInArrow(_with_words(), "framework string, pos bigint, norm double, terms array<string>, counts array<bigint>")
    each = rows.select("framework", "pos", "norm", F.explode(F.arrays_zip("terms", "counts")).alias("at")).select("framework", "pos", "norm", "at.*")
    found = each.join(number, each["terms"] == number["term"]).groupBy("framework", "pos", "norm").agg(F.sort_array(F.collect_list(F.struct("number", "counts"))).alias("at"))
    return found.select("framework", "pos", "norm", F.col("at.number").alias("terms"), F.col("at.counts").alias("counts")).mapInArrow(_with_prefixes(least), _ROW)


def _counted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Row, number and count of the different words of a batch, the words by number, and the length of each row."""
    lists = batch.column("terms")
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    width = max(len(coded.dictionary), 1)
    cells = np.repeat(np.arange(len(sizes)), sizes) * width + coded.indices.to_numpy(zero_copy_only=False)
    cells, counts = np.unique(cells, return_counts=True)
    rows, terms = np.divmod(cells, width)
    return rows, terms, counts, coded.dictionary, np.sqrt(np.bincount(rows, counts.astype(np.float64) ** 2, minlength=len(sizes)))


def _lists(owner: np.ndarray, n: int, *values: pa.Array) -> list[pa.Array]:
    """Values of rows, one after the other, as lists."""
    ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, value) for value in values]


def _with_words():
    def run(batches):
        for batch in batches:
            rows, terms, counts, known, norms = _counted(batch)
            lists = _lists(rows, batch.num_rows, known.take(pa.array(terms)), pa.array(counts.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("framework"), batch.column("pos"), pa.array(norms), *lists], ["framework", "pos", "norm", "terms", "counts"])

    return run


def _prefixed(batch: pa.RecordBatch, owner: np.ndarray, terms: np.ndarray, counts: np.ndarray, norms: np.ndarray, least: float) -> pa.RecordBatch:
    """Rows with their words by rising number, and how many of them stand before a rest that is shorter than `least`."""
    n = batch.num_rows
    share = (counts / norms[owner]) ** 2
    sums = np.concatenate(([0.0], np.cumsum(share)))
    ends = np.cumsum(np.bincount(owner, minlength=n))
    rest = sums[ends][owner] - sums[:-1]
    prefix = np.bincount(owner, rest >= (least * (1 - 1e-9)) ** 2 - 1e-12, minlength=n).astype(np.int32)
    lists = _lists(owner, n, pa.array(terms, pa.int64()), pa.array(counts, pa.int64()))
    out = pa.RecordBatch.from_arrays([batch.column("framework"), batch.column("pos"), pa.array(norms), *lists, pa.array(prefix)], ["framework", "pos", "norm", "terms", "counts", "prefix"])
    return out.filter(pa.array(prefix > 0))


def _by_number(known: pa.Array, least: float):
    """Arrow task that counts words and turns them into numbers by a dictionary."""
    def run(batches):
        for batch in batches:
            rows, terms, counts, own, norms = _counted(batch)
            found = pc.index_in(own, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[terms]
            kept = np.flatnonzero(found >= 0)
            kept = kept[np.lexsort((found[kept], rows[kept]))]
            yield _prefixed(batch, rows[kept], found[kept], counts[kept], norms, least)

    return run


def _with_prefixes(least: float):
    def run(batches):
        for batch in batches:
            owner = np.repeat(np.arange(batch.num_rows), batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            terms, counts = (batch.column(name).flatten().to_numpy(zero_copy_only=False) for name in ("terms", "counts"))
            yield _prefixed(batch, owner, terms, counts, batch.column("norm").to_numpy(zero_copy_only=False), least)

    return run


def _to_every_shard(rows: DataFrame, pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows with framework_B and shard: every shard of every framework that theirs is paired with."""
    met = pairs.select(*PAIR).join(blocks.withColumnsRenamed({"framework": "framework_B"}), "framework_B")
    sides = rows.withColumnRenamed("framework", "framework_A").join(met, "framework_A")
    return sides.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))


def routes(rows: DataFrame, index: DataFrame, pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(framework_A, pos, framework_B, shard): the shards in which the prefix of a row meets another prefix."""
    words = F.explode(F.slice("terms", F.lit(1), F.col("prefix"))).alias("term")
    postings = index.select(F.col("framework").alias("framework_B"), "shard", words).distinct()
    postings = postings.groupBy("framework_B", "term").agg(F.collect_list("shard").alias("shards"))
    known = blocks.withColumnsRenamed({"framework": "framework_B"})
    everywhere = 2 * F.size("shards") > F.col("blocks")
    # A frequent word says nothing about the shard: its rows go to all of them, without the list.
    postings = postings.join(known, "framework_B").select("framework_B", "term", "blocks", F.when(~everywhere, F.col("shards")).alias("shards"))
    asked = rows.select(F.col("framework").alias("framework_A"), "pos", words).join(pairs.select(*PAIR), "framework_A")
    met = asked.join(postings, ["framework_B", "term"])
    rare = met.filter("shards IS NOT NULL").select("framework_A", "pos", "framework_B", F.explode("shards").alias("shard"))
    frequent = met.filter("shards IS NULL").select("framework_A", "pos", "framework_B", "blocks").distinct()
    frequent = frequent.select("framework_A", "pos", "framework_B", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("shard"))
    return rare.unionByName(frequent).distinct()


def _shards(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    return rows.join(blocks, "framework").withColumn("shard", F.pmod(F.xxhash64("pos"), "blocks")).drop("blocks")


def packed(rows: DataFrame) -> DataFrame:
    """Numbered rows with words and counts as one binary value."""
    def run(batches):
        for batch in batches:
            owner = np.repeat(np.arange(batch.num_rows), batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            values = (batch.column(name).flatten().to_numpy(zero_copy_only=False) for name in ("terms", "counts"))
            words = tiles.packed_rows(owner, batch.num_rows, *values)
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in ("framework", "pos", "norm", "prefix")), words], ["framework", "pos", "norm", "prefix", "words"])

    return rows.mapInArrow(run, _PACKED)


def prefixes(rows: DataFrame) -> DataFrame:
    """(framework, pos, prefix, terms) of packed rows, with all their words."""
    def run(batches):
        for batch in batches:
            sizes, terms, _ = tiles.unpacked_rows(batch.column("words"))
            lists = _lists(np.repeat(np.arange(batch.num_rows), sizes), batch.num_rows, pa.array(terms, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in ("framework", "pos", "prefix")), *lists], ["framework", "pos", "prefix", "terms"])

    return rows.mapInArrow(run, "framework string, pos bigint, prefix int, terms array<bigint>")


def term_cells(words: DataFrame, pairs: DataFrame, threshold: float, k: int, sizes: DataFrame, rows: int = SHARD_ROWS, digits: int = 12) -> DataFrame:
    """Cells from a threshold above 0 up that hold the k best of each row, for (framework, pos, terms)."""
    least = threshold - 0.5 * 10.0**-digits
    if least <= 0:
        raise ValueError("rows without a common word have a score of 0, which an index does not find")
    kept = cut(packed(numbered(words, least)))
    blocks = sizes.select("framework", F.ceil(F.col("n") / rows).alias("blocks"))
    shards, most, n = sizes.agg(F.sum(F.ceil(F.col("n") / rows)), F.max(F.ceil(F.col("n") / rows)), F.sum("n")).first()
    parts = busy_partitions(words.sparkSession)
    runs = min(MOST_RUNS, max(-(-parts // max(shards or 1, 1)), (n or 0) // RUN_ROWS + 1))
    if (most or 0) >= ROUTED_FROM and (kept.agg(F.avg("prefix")).first()[0] or 0) <= ROUTED_WORDS:
        asked = prefixes(kept)
        route = routes(asked, _shards(asked, blocks), pairs, blocks)
        asking = route.join(kept.withColumnRenamed("framework", "framework_A"), ["framework_A", "pos"])
    else:
        asking = _to_every_shard(kept, pairs, blocks)
    payload = ["norm", "words"]
    asking = asking.withColumn("run", F.pmod(F.xxhash64("framework_A", "pos"), F.lit(runs))).withColumn("side", F.lit(1))
    holding = _shards(kept, blocks).withColumnsRenamed({"framework": "framework_B"}).join(pairs, "framework_B", "left_semi")
    holding = holding.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1)).cast("array<bigint>")))
    holding = holding.select("framework_B", "shard", "run", F.lit(0).alias("side"), F.lit("").alias("framework_A"), "pos", *payload)
    task = ["framework_B", "shard", "run"]
    both = holding.unionByName(asking.select(*holding.columns)).repartition(parts * TASKS_PER_CORE, *task).sortWithinPartitions(*task, "side", "framework_A", "pos")
    return both.mapInArrow(tiles.index_job(threshold, k, digits), CELL)
