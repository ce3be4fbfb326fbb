"""Toxicity as ordered severity grades by cumulative-link regression.

Sparse features of a text are its lower-cased words and the beginnings of its
words, hashed, present or not, and steps of its length: a long text holds any
word more easily. One vector of weights is shared by all
thresholds: P(grade >= k) = sigmoid(w.x - theta_k) with rising theta. The
expected severity is the sum of those probabilities.

Labels say toxic or not. The grades of toxic training texts follow from how
many different features that are typical for toxic texts they hold: the lower
and upper third, by count, are graded 1 and 3, the rest 2; clean texts are graded 0.

The model is fitted on at most `sample` labelled documents, the smallest ones by a
hash of the identifier; every document is scored. How often features occur in the sample is
counted by tasks and a shuffle; only features that tell toxic from clean texts reach the one task that fits.

Defined cases: null and empty texts have no features and get the severity of
the thresholds alone; labels that are null or without a document are not used;
a document labelled twice is toxic if one label says so; of rows with the same
identifier one is fitted, that with the smallest features; without toxic labels
nothing is toxic; equal rows give equal rows; an empty table gives an empty
result; further columns can have any names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmap.llm.common import Words, checkpointed, column, free_name, slices, with_fields

#: Bound of the fitted sample, in documents; each is taken once, as its distinct features.
SAMPLE = 20_000
BITS = 20
#: Steps of length (doublings of the number of words), numbered after the hashed features.
LENGTHS = 24
WIDTH = (1 << BITS) + LENGTHS
#: Lengths in bytes of the beginnings of words that are features too.
BEGINNINGS = (5, 6, 7)
GRADES = 3
#: Least number of sampled documents with a feature, and least statistic (chi-square) of a feature that is used.
SUPPORT, EVIDENCE = 4, 30.0
STEPS, RATE, DECAY = 300, 0.1, 2e-4
#: Probability of any grade from which a document is rejected.
REJECT = 0.5
_EDGES = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))


def _features(word: bytes) -> list[int]:
    """Hashes of a word without punctuation around it, and of its beginnings."""
    word = word.strip(_EDGES)
    if not word:
        return []
    most = (1 << BITS) - 1
    return [xxhash.xxh3_64_intdigest(word + b" ") & most, *(xxhash.xxh3_64_intdigest(word[:n]) & most for n in BEGINNINGS if len(word) >= n)]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, one after the other, and how many each has."""
    words = Words(pc.utf8_lower(texts.cast(pa.string())))
    n = len(words.distinct)
    flat, sizes = array("q"), np.zeros(n, np.int64)
    for i, word in enumerate(words.distinct):
        own = _features(word)
        sizes[i] = len(own)
        flat.extend(own)
    flat, firsts = np.frombuffer(flat, np.int64) if flat else np.zeros(0, np.int64), np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    pairs = np.unique(row * n + words.codes) if len(row) else np.zeros(0, np.int64)
    row, code = (pairs // max(1, n), pairs % max(1, n))
    each = sizes[code]
    ends = np.cumsum(each)
    found = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(firsts[code] - ends + each, each)]
    steps = np.minimum(np.log2(words.counts + 1).astype(np.int64), LENGTHS)
    owner = np.repeat(np.arange(len(steps)), steps)
    doublings = (1 << BITS) + np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps)
    both = np.unique(np.concatenate((np.repeat(row, each) * WIDTH + found, owner * WIDTH + doublings)))
    return both % WIDTH, np.bincount(both // WIDTH, minlength=len(words.counts))


@dataclass
class Model:
    """Shared weights of the features in use, and the rising thresholds of the grades."""

    weights: dict[int, float]
    thresholds: list[float]

    def table(self) -> np.ndarray:
        table = np.zeros(WIDTH)
        table[list(self.weights)] = list(self.weights.values())
        return table

    def at_least(self, found: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """P(grade >= k) of each text, k from 1."""
        sums = np.concatenate(([0.0], np.cumsum(table[found])))
        ends = np.cumsum(counts)
        score = sums[ends] - sums[ends - counts]
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - score[:, None], -60, 60)))


def telling(feature: np.ndarray, total: np.ndarray, inside: np.ndarray, n: int, positive: int) -> tuple[np.ndarray, np.ndarray]:
    """Which features are used, and which of them are typical for toxic texts, by the texts and toxic texts that hold them."""
    share = positive / n
    expected = total * share
    spread = np.maximum(total * share * (1 - share), 1e-9)
    evidence = (inside - expected) ** 2 / spread
    word = feature < 1 << BITS
    return (word & (total >= SUPPORT) & (evidence >= EVIDENCE)) | (~word & (total > 0)), (inside > expected) & word


def fitted(found: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> Model:
    """The model of a bounded sample in memory."""
    n, positive = len(counts), int(toxic.sum())
    if not positive or positive == n:
        return _settled(positive)
    total = np.bincount(found, minlength=WIDTH)
    inside = np.bincount(found[np.repeat(toxic, counts)], minlength=WIDTH)
    used, typical = telling(np.arange(WIDTH), total, inside, n, positive)
    place = np.full(WIDTH, -1, np.int32)
    place[used] = np.arange(used.sum(), dtype=np.int32)
    keep = place[found] >= 0
    return _graded(place[found[keep]], np.repeat(np.arange(n, dtype=np.int32), counts)[keep], toxic, np.flatnonzero(used), typical[used])


def _settled(positive: int) -> Model:
    """The model of a sample in which all texts are toxic, or none is."""
    return Model({}, [60.0 + i if not positive else -60.0 + i for i in range(GRADES)])


def _graded(cells: np.ndarray, rows: np.ndarray, toxic: np.ndarray, used: np.ndarray, typical: np.ndarray) -> Model:
    """The model of texts with their used features (places in `used` and rows), the toxic ones graded by their typical features."""
    marks = np.bincount(rows, weights=typical[cells], minlength=len(toxic))
    low, high = np.quantile(marks[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 2 - (marks <= low).astype(int) + (marks > high).astype(int), 0)
    return _descended(cells, rows, grade, used)


def _descended(cells: np.ndarray, rows: np.ndarray, grade: np.ndarray, used: np.ndarray) -> Model:
    """Weights and thresholds of the penalised likelihood, by gradient steps with adapted rates."""
    n = len(grade)
    weights, gaps = np.zeros(len(used)), np.zeros(GRADES)
    gaps[0] = 2.0
    moments = [np.zeros((2, len(used))), np.zeros((2, GRADES))]

    def softplus(x):
        return np.log1p(np.exp(-np.abs(x))) + np.maximum(x, 0)

    for step in range(1, STEPS + 1):
        thresholds = gaps[0] + np.concatenate(([0.0], np.cumsum(softplus(gaps[1:]))))
        score = np.bincount(rows, weights=weights[cells], minlength=n)
        above = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -60, 60)))
        full = np.concatenate((np.ones((n, 1)), above, np.zeros((n, 1))), axis=1)
        slope = full * (1 - full)
        at = np.arange(n)
        mass = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        by_score = (slope[at, grade] - slope[at, grade + 1]) / mass / n
        by_threshold = np.zeros(GRADES + 2)
        np.add.at(by_threshold, grade, -slope[at, grade] / mass / n)
        np.add.at(by_threshold, grade + 1, slope[at, grade + 1] / mass / n)
        by_threshold = by_threshold[1:-1]
        inner = np.cumsum(by_threshold[::-1])[::-1]
        gradients = [np.bincount(cells, weights=by_score[rows], minlength=len(used)) - DECAY * weights,
                     np.concatenate(([inner[0]], inner[1:] / (1 + np.exp(-gaps[1:]))))]
        for values, gradient, moment in zip((weights, gaps), gradients, moments):
            moment[0] = 0.9 * moment[0] + 0.1 * gradient
            moment[1] = 0.999 * moment[1] + 0.001 * gradient**2
            values += RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
    thresholds = gaps[0] + np.concatenate(([0.0], np.cumsum(softplus(gaps[1:]))))
    return Model(dict(zip(used.tolist(), weights.tolist())), thresholds.tolist())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model of at most `sample` labelled documents, fitted in one task; only features in use reach it and the driver."""
    spark = docs.sparkSession
    marked = labels.select(column(labels, id_col).alias("id"), column(labels, toxic_col).alias("toxic")).filter("id is not null and toxic is not null")
    marked = marked.groupBy("id").agg((F.max("toxic") > 0).alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text"))
    chosen = rows.join(F.broadcast(marked), "id").select("id", "text", "toxic")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found, counts = features(part.column("text"))
            parts = [x.astype(np.int32).tobytes() for x in np.split(found, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("toxic"), pa.array(parts, pa.binary())], ["id", "toxic", "found"])

    found = chosen.mapInArrow(sparse, with_fields(chosen.select("id").schema, "toxic boolean, found binary"))
    once = checkpointed(found.groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("found").alias("found")).select("toxic", "found"))
    n, positive = once.agg(F.count("*"), F.count_if("toxic")).first()
    if not positive or positive == n:
        return _settled(positive)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, inside = np.zeros(WIDTH, np.int32), np.zeros(WIDTH, np.int32)
        for batch in batches:
            for part in slices([batch], "found"):
                for toxic, own in zip(part.column("toxic").to_pylist(), part.column("found")):
                    own = np.frombuffer(own.as_buffer(), np.int32)
                    total[own] += 1
                    inside[own] += toxic
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64()), pa.array(inside[seen], pa.int64())], ["feature", "total", "inside"])

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feature, total, inside = (batch.column(x).to_numpy() for x in ("feature", "total", "inside"))
            used, typical = telling(feature, total, inside, n, positive)
            yield pa.RecordBatch.from_arrays([pa.array(feature[used]), pa.array(typical[used])], ["feature", "typical"])

    counted = once.mapInArrow(tally, "feature int, total bigint, inside bigint").groupBy("feature").agg(F.sum("total").alias("total"), F.sum("inside").alias("inside"))
    pairs = sorted(tuple(row) for row in counted.mapInArrow(select, "feature int, typical boolean").collect())
    used, typical = np.array([x for x, _ in pairs], np.int32), np.array([x for _, x in pairs], bool)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(WIDTH, -1, np.int32)
        place[used] = np.arange(len(used), dtype=np.int32)
        for batch in batches:
            for part in slices([batch], "found"):
                own = [place[np.frombuffer(x.as_buffer(), np.int32)] for x in part.column("found")]
                kept = [x[x >= 0].tobytes() for x in own]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(kept, pa.binary())], ["toxic", "found"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, counts, cells = [], [], array("i")
        for batch in batches:
            toxic += batch.column("toxic").to_pylist()
            for x in batch.column("found"):
                cells.frombytes(x.as_buffer())
                counts.append(len(x.as_buffer()) // 4)
        if toxic:
            model = _graded(np.frombuffer(cells, np.int32), np.repeat(np.arange(len(counts), dtype=np.int32), counts), np.array(toxic, bool), used, typical)
            keys = [*(-1 - i for i in range(GRADES)), *model.weights]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([*model.thresholds, *model.weights.values()], pa.float64())], ["feature", "weight"])

    gathered = once.mapInArrow(reduce, "toxic boolean, found binary").repartition(1).sortWithinPartitions("found", "toxic")
    weights = {row[0]: row[1] for row in gathered.mapInArrow(train, "feature bigint, weight double").collect()}
    return Model({k: v for k, v in weights.items() if k >= 0}, [weights[-1 - i] for i in range(GRADES)])


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The documents with severity, grade and p_toxic, and those columns' names by their meaning.

    severity: expected grade; grade: the most probable one; p_toxic: probability of grade 1 or more.
    """
    names: dict[str, str] = {}
    for meaning in ("severity", "grade", "p_toxic"):
        names[meaning] = free_name([*docs.columns, *names.values()], meaning)
    columns, at = docs.columns, docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shared.value, shared.value.table()
        for batch in batches:
            for part in slices([batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])], f"c{at}"):
                above = own.at_least(*features(part.column(at)), table)
                mass = np.concatenate((np.ones((len(above), 1)), above), axis=1) - np.concatenate((above, np.zeros((len(above), 1))), axis=1)
                arrays = [pa.array(above.sum(axis=1)), pa.array(mass.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0])]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*columns, *names.values()])

    severity, grade, p = names.values()
    return docs.mapInArrow(score, with_fields(docs.schema, f"{severity} double, {grade} int, {p} double")), names


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    out, names = scored(docs, fit(docs, labels, id_col, text_col), text_col)
    return out.filter(column(out, names["p_toxic"]) < reject).select(*(column(out, c) for c in docs.columns))
