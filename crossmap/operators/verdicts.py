"""Scoring requests out, verdicts in, relations from both.

The judge that answers a request is outside. Requests and responses are
tables keyed by framework pair, pass and batch number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.functions import request, text
from crossmap.operators.candidates import lookup_last
from crossmap.operators.heavy import join_lookup
from crossmap.operators.ordering import PAIR, candidate_index
from crossmap.sources.schemas import RELATION_COLUMNS

VERDICT = (
    "STRUCT<coverage_A_to_B: STRING, coverage_B_to_A: STRING, confidence: STRING, "
    "relation_type: STRING, justification: STRING>"
)
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SCORES = ("coverage_A_to_B", "coverage_B_to_A", "confidence")
KEYS = [*PAIR, "id_A", "id_B"]
RETRY_SPAN = 1 << 20


def assign_batches(candidates: DataFrame, size: int = R.BATCH_SIZE) -> DataFrame:
    """Candidates with batch number and place in the batch, best scores first."""
    placed = candidate_index(candidates, "_index")
    return placed.withColumns({
        "batch_no": F.floor(F.col("_index") / size),
        "idx": F.col("_index") % size,
    }).drop("_index")


def _with_texts(candidates: DataFrame, requirements: DataFrame) -> DataFrame:
    """Candidates with the requirement texts that their identifiers stand for."""
    texts = lookup_last(requirements).select("framework", "id", "title", "description", "tags")
    plain = candidates.drop("title_A", "title_B")
    for letter in ("A", "B"):
        side = texts.withColumnsRenamed({name: f"{name}_{letter}" for name in texts.columns})
        plain = join_lookup(plain, side, [f"framework_{letter}", f"id_{letter}"])
    return plain


def _sides(candidates: DataFrame, requirements: DataFrame) -> DataFrame:
    """Both requirements of each candidate, a row each, with the text that its identifier stands for, without those that have none."""
    texts = lookup_last(requirements).select("framework", "id", text.side_text(*map(F.col, ("framework", "tags", "title", "description"))).alias("text"))
    sides = [F.struct(F.lit(x).alias("side"), F.col(f"framework_{x}").alias("framework"), F.col(f"id_{x}").alias("id")) for x in "AB"]
    of = [*PAIR, "batch_no", F.struct("idx", "id_A", "id_B").alias("of")]
    return join_lookup(candidates.select(*of, F.explode(F.array(*sides)).alias("_side")).select(*PAIR, "batch_no", "of", "_side.*"), texts, ["framework", "id"])


def _also_in(own: str, other: str) -> Column:
    """The sides of a batch whose pair has the other side too."""
    known = F.transform(other, lambda x: x["of"])
    return F.filter(own, lambda x: F.array_contains(known, x["of"]))


def build_requests(
    candidates: DataFrame, requirements: DataFrame, size: int = R.BATCH_SIZE, instructions: str | None = None
) -> DataFrame:
    """One request row per batch: (framework_A, framework_B, batch_no, n, text)."""
    if "batch_no" not in candidates.columns:
        candidates = assign_batches(candidates, size)
    head = request.instructions() if instructions is None else instructions
    # One text travels with a row, straight to its batch; a pair counts if both its sides are there.
    lists = [F.sort_array(F.collect_list(F.when(F.col("side") == x, F.struct("of", "text")))).alias(f"_{x}") for x in "AB"]
    found = _sides(candidates, requirements).groupBy(*PAIR, "batch_no").agg(*lists)
    pairs = F.arrays_zip(_also_in("_A", "_B").alias("a"), _also_in("_B", "_A").alias("b"))
    batches = found.select(*PAIR, "batch_no", pairs.alias("_pairs")).withColumn("n", F.size("_pairs").cast("bigint")).filter("n > 0")
    blocks = F.transform("_pairs", lambda x: F.struct(x["a"]["of"]["idx"].alias("idx"), text.pair_of_sides(x["a"]["of"]["idx"] + 1, x["a"]["text"], x["b"]["text"]).alias("block")))
    joined = F.array_join(F.transform(F.sort_array(blocks), lambda b: b["block"]), "\n\n")
    return batches.select(
        *PAIR, "batch_no", "n", request.request_text(joined, F.col("n"), head).alias("text")
    )


def _number(value: Column) -> Column:
    return F.when(value.rlike(NUMBER), value.try_cast("double"))


def _valid(verdict: Column) -> Column:
    ok = verdict["relation_type"].isin(*R.RELATION_TYPES)
    for name in SCORES:
        ok = ok & _number(verdict[name]).between(0.0, 1.0)
    return F.coalesce(ok, F.lit(False))


def parse_responses(requests: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdict rows of valid batches, and the requests whose answer is missing or invalid.

    A batch counts as a whole: one bad element, or a wrong number of elements,
    fails all of it. Of several answers to a batch, as a judge may deliver them,
    the first in text order counts.
    """
    keys = [*PAIR, "batch_no"]
    once = responses.groupBy(*keys).agg(F.min("raw").alias("raw"))
    answered = requests.select(*keys, "n").join(once, keys, "left")
    single = F.array(F.from_json("raw", VERDICT))
    several = F.from_json("raw", f"STRUCT<results: ARRAY<{VERDICT}>>")["results"]
    parsed = answered.withColumn("_verdicts", F.when(F.col("n") == 1, single).otherwise(several))
    good = (F.size("_verdicts") == F.col("n")) & F.forall("_verdicts", _valid)
    checked = parsed.withColumn("_good", F.coalesce(good, F.lit(False)))
    rows = checked.filter("_good").select(*keys, F.posexplode("_verdicts").alias("idx", "_verdict"))
    verdicts = rows.select(
        *keys, F.col("idx").cast("bigint").alias("idx"),
        *(_number(F.col("_verdict")[name]).alias(name) for name in SCORES),
        F.col("_verdict")["relation_type"].alias("relation_type"),
        F.coalesce(F.col("_verdict")["justification"], F.lit("")).alias("justification"),
    )
    return verdicts, checked.filter("NOT _good").select(*keys, "n")


def retry_batches(failed: DataFrame, batched: DataFrame, answered: DataFrame | None = None) -> DataFrame:
    """The candidates of failed batches as batches of one, without those that have a verdict.

    `retry_of` and `retry_idx` keep the place in the failed batch; the new batch
    numbers are negative, so they never meet those of the first round.
    """
    keys = [*PAIR, "batch_no"]
    again = batched.join(failed.filter("n > 1").select(*keys), keys, "left_semi")
    if answered is not None:
        again = again.join(answered.select(*keys, "idx"), [*keys, "idx"], "left_anti")
    number = -(F.col("batch_no") * RETRY_SPAN + F.col("idx") + 1)
    return again.withColumns({
        "retry_of": F.col("batch_no"), "retry_idx": F.col("idx"), "batch_no": number, "idx": F.lit(0).cast("bigint"),
    })


def retry_requests(failed: DataFrame, batched: DataFrame, requirements: DataFrame) -> DataFrame:
    """Request rows for the candidates of failed batches, one by one."""
    return build_requests(retry_batches(failed, batched), requirements)


def match_verdicts(batched: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Candidates with their verdict; a candidate without one is left out."""
    found = verdicts.drop("relation_type")
    return batched.join(found, [*PAIR, "batch_no", "idx"])


def classify(scored: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """The relation type from both coverages; the judge's own type is not used.

    A pair of frameworks without thresholds of its own is classified with the basic ones.
    """
    plain = scored.drop("relation_type")
    cov_a, cov_b = F.col("coverage_A_to_B"), F.col("coverage_B_to_A")
    if thresholds is None:
        return plain.withColumn("relation_type", R.relation_type(cov_a, cov_b))
    known = thresholds.select(*PAIR, "thresh_eq", "thresh_cov")
    eq = F.coalesce("thresh_eq", F.lit(R.THRESHOLD_EQUIVALENCE))
    cov = F.coalesce("thresh_cov", F.lit(R.THRESHOLD_COVERAGE))
    kind = R.relation_type(cov_a, cov_b, eq, cov)
    return plain.join(known, PAIR, "left").withColumn("relation_type", kind).drop("thresh_eq", "thresh_cov")


def needs_confirmation(relations: DataFrame, threshold: float = R.CONFIRM_THRESHOLD) -> DataFrame:
    """Relations that cover strongly in one direction at least."""
    return relations.filter(
        (F.col("coverage_A_to_B") >= threshold) | (F.col("coverage_B_to_A") >= threshold)
    )


def confirmation_batches(relations: DataFrame, size: int = R.BATCH_SIZE) -> DataFrame:
    """Strong relations as candidates again, batched anew for a second pass."""
    first_pass = ("batch_no", "idx", *SCORES, "relation_type", "justification")
    return assign_batches(needs_confirmation(relations).drop(*first_pass), size)


def confirmation_requests(relations: DataFrame, requirements: DataFrame, size: int = R.BATCH_SIZE) -> DataFrame:
    return build_requests(confirmation_batches(relations, size), requirements, size)


def confirm(first: DataFrame, second: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """First-pass relations averaged with the second pass where there is one.

    `second` has the identifiers, the three scores and the justification.
    """
    again = second.select(
        *KEYS, *(F.col(name).alias(f"_{name}") for name in (*SCORES, "justification"))
    )
    both = first.join(again, KEYS, "left").withColumn("_second", F.col("_confidence").isNotNull())
    averaged = {
        name: F.when(F.col("_second"), R.exact_round((F.col(name) + F.col(f"_{name}")) / 2, 4)).otherwise(F.col(name))
        for name in SCORES
    }
    averaged["justification"] = F.when(F.length("_justification") > 0, F.col("_justification")).otherwise(
        F.col("justification")
    )
    merged = both.withColumns(averaged).drop("_second", *(f"_{name}" for name in (*SCORES, "justification")))
    return classify(merged, thresholds)


def relations(
    batched: DataFrame,
    verdicts: DataFrame,
    confirmations: DataFrame | None = None,
    thresholds: DataFrame | None = None,
) -> DataFrame:
    """Relations of batched candidates: verdict, type by thresholds, second pass if given."""
    scored = classify(match_verdicts(batched, verdicts), thresholds)
    return scored if confirmations is None else confirm(scored, confirmations, thresholds)


def output_relations(rows: DataFrame) -> DataFrame:
    """The columns of a written relation, scores rounded."""
    rounded = ("semantic_score", *SCORES)
    return rows.select(
        *(R.exact_round(F.col(name), 4).alias(name) if name in rounded else F.col(name) for name in RELATION_COLUMNS)
    )
