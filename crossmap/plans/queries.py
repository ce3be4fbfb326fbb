"""The registered queries: every operator over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.functions import relations as R
from crossmap.functions import text
from crossmap.operators import candidates as C
from crossmap.operators import cleanup as K
from crossmap.operators import incremental as I
from crossmap.operators import pairs as P
from crossmap.operators import repair, reports, search, similarity, thresholds, validate, views
from crossmap.operators import verdicts as V
from crossmap.operators.flatten import flatten_requirements
from crossmap.operators.ordering import PAIR
from crossmap.operators.sizes import cut
from crossmap.plans import bindings as B
from crossmap.plans import matrices, runs, stored
from crossmap.plans.mapping import mapping_totals
from crossmap.sources import dimension as D
from crossmap.sources import tables
from crossmap.sources.documents import decode_documents, framework_counts, list_frameworks, read_documents
from crossmap.sources.registry import loader

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
CANDIDATE = [*PAIR, "id_A", "id_B", "semantic_score"]


def query(build: Query) -> Query:
    REGISTERED[build.__name__] = build
    return build


@query
def cosine_topk(spark, sf):
    sizes, pairs = B.vector_pairs(spark, sf)
    cells = similarity.cosine_cells(B.vectors(spark, sf), pairs, B.VECTOR_THRESHOLD, B.K, digits=B.DIGITS, sizes=sizes)
    return C.select_candidates(cells, B.VECTOR_THRESHOLD, B.K)


@query
def candidate_pairs(spark, sf):
    return B.vector_candidates(spark, sf).drop("pos_A", "pos_B", "rank")


@query
def sparse_cosine_topk(spark, sf):
    return B.document_candidates(spark, sf)[1].select(*CANDIDATE)


@query
def encoded_cosine_topk(spark, sf):
    """The pluggable encoder on whole texts: how often each of some letters occurs."""
    rows = B.document_requirements(spark, sf)
    vectors = cut(similarity.embed(rows, B.letter_counts))
    sizes = similarity.framework_sizes(vectors)
    cells = similarity.cosine_cells(vectors, P.framework_pairs(P.in_name_order(sizes)), B.LETTER_THRESHOLD, B.K, digits=B.DIGITS, sizes=sizes)
    return C.select_candidates(cells, B.LETTER_THRESHOLD, B.K)


@query
def pruned_tiles(spark, sf):
    """Which share of the pairs of tiles of the letter vectors cannot reach the threshold."""
    vectors = cut(similarity.embed(B.document_requirements(spark, sf), B.letter_counts))
    sizes = similarity.framework_sizes(vectors)
    return similarity.pruned_tiles(vectors, P.framework_pairs(P.in_name_order(sizes)), B.LETTER_THRESHOLD, B.PRUNED_ROWS, digits=B.DIGITS, sizes=sizes)


@query
def framework_pairs_sym(spark, sf):
    return P.framework_pairs(P.frameworks_of(B.vectors(spark, sf)))


@query
def framework_pairs_asym(spark, sf):
    return P.framework_pairs(P.frameworks_of(B.vectors(spark, sf)), B.SOURCES, B.TARGETS)


@query
def display_pairs(spark, sf):
    return P.display_pairs(P.frameworks_of(B.vectors(spark, sf)), B.SOURCES, B.TARGETS)


@query
def role_of_frameworks(spark, sf):
    return P.role_of_frameworks(P.frameworks_of(B.vectors(spark, sf)), B.SOURCES, B.TARGETS)


@query
def asymmetric_candidates(spark, sf):
    found = C.candidates(
        B.vector_requirements(spark, sf), B.vectors(spark, sf), sources=B.SOURCES, targets=B.TARGETS,
        threshold=B.VECTOR_THRESHOLD, k=B.K, digits=B.DIGITS,
    )
    return found.select(*CANDIDATE)


@query
def incremental_pairs(spark, sf):
    pairs = I.with_settings(P.framework_pairs(P.frameworks_of(B.vectors(spark, sf))), B.VECTOR_THRESHOLD, B.K)
    done = pairs.filter("(CAST(framework_A AS INT) + CAST(framework_B AS INT)) % 2 = 0")
    return I.incremental(pairs, done).select(*PAIR)


def _repaired(spark, sf):
    """Lists of the vectors, made before some of them were edited, removed and added, and repaired since."""
    after = B.vectors(spark, sf)
    pos = F.col("pos")
    before = after.filter(pos % 200 != 13).withColumn("embedding", F.when(pos % 100 == 7, F.reverse("embedding")).otherwise(F.col("embedding")))
    before = before.unionByName(after.filter(pos % 200 == 29).withColumn("pos", -pos))
    pairs = P.framework_pairs(P.in_name_order(similarity.framework_sizes(before)))

    def score(vectors, named):
        return similarity.cosine_cells(vectors, named, B.VECTOR_THRESHOLD, B.K, digits=B.DIGITS)

    stored = cut(C.select_candidates(score(before, pairs), B.VECTOR_THRESHOLD, B.K))
    changed = repair.changes(repair.row_marks(before), repair.row_marks(after))
    return repair.repaired(stored, after, changed, pairs, score, B.VECTOR_THRESHOLD, B.K)


@query
def repaired_candidates(spark, sf):
    return _repaired(spark, sf).selected


@query
def repair_counts(spark, sf):
    return _repaired(spark, sf).counts


@query
def similarity_matrix(spark, sf):
    sizes, pairs = B.vector_pairs(spark, sf)
    summary = similarity.matrix_summary(B.vectors(spark, sf), pairs, digits=B.DIGITS, sizes=sizes)
    return summary.withColumn("mean_score", F.round("mean_score", 9))


@query
def matrix_sample(spark, sf):
    sizes, pairs = B.vector_pairs(spark, sf)
    return views.sample_matrix(B.vectors(spark, sf), pairs, sizes=sizes).withColumn("score", F.round("score", 4))


@query
def matrix_floor(spark, sf):
    sizes, pairs = B.vector_pairs(spark, sf)
    floors = views.matrix_floor(views.sample_matrix(B.vectors(spark, sf), pairs, sizes=sizes))
    return floors.withColumn("floor", F.round("floor", 4))


@query
def score_distribution(spark, sf):
    return thresholds.score_distribution(cut(B.vector_candidates(spark, sf)))


@query
def adaptive_thresholds(spark, sf):
    found = thresholds.adaptive_thresholds(cut(B.vector_candidates(spark, sf)))
    return found.select(*PAIR, "n", "median", "delta", "thresh_eq", "thresh_cov")


@query
def score_histogram(spark, sf):
    return views.score_histogram(cut(B.vector_candidates(spark, sf)))


@query
def reduction_ratio(spark, sf):
    _, pairs = B.vector_pairs(spark, sf)
    return C.reduction_ratio(B.vector_candidates(spark, sf), B.vector_requirements(spark, sf), pairs)


@query
def classify_relations(spark, sf):
    return B.vector_relations(spark, sf).select(
        *CANDIDATE, "coverage_A_to_B", "coverage_B_to_A", "confidence", "relation_type"
    )


@query
def adapted_relations(spark, sf):
    found = cut(B.vector_candidates(spark, sf))
    related = V.classify(B.scored(found), thresholds.resolve_thresholds(found))
    return related.select(*PAIR, "id_A", "id_B", "relation_type")


@query
def relation_counts(spark, sf):
    return K.relation_counts(B.vector_relations(spark, sf))


@query
def relation_share(spark, sf):
    return K.relation_share(B.vector_relations(spark, sf))


@query
def cleanup_kept(spark, sf):
    return K.cleanup(B.vector_relations(spark, sf))[0].select(*PAIR, "id_A", "id_B", "confidence", "relation_type")


@query
def cleanup_removed(spark, sf):
    return K.cleanup(B.vector_relations(spark, sf))[1].select(*PAIR, "id_A", "id_B", "confidence", "relation_type")


@query
def needs_confirmation(spark, sf):
    return V.needs_confirmation(B.vector_relations(spark, sf)).select(*PAIR, "id_A", "id_B")


@query
def confirm_average(spark, sf):
    first = cut(B.vector_relations(spark, sf))
    second = B.scored(V.needs_confirmation(first), shift=10).withColumn("justification", F.lit("again"))
    columns = ["coverage_A_to_B", "coverage_B_to_A", "confidence", "relation_type", "justification"]
    return V.confirm(first, second).select(*PAIR, "id_A", "id_B", *columns)


@query
def requirements_from_documents(spark, sf):
    return B.document_requirements(spark, sf).withColumn("tags", F.array_join("tags", ","))


@query
def embedding_text(spark, sf):
    rows = B.document_requirements(spark, sf)
    return rows.select("framework", "id", similarity.encoding_text(text.SENTENCE_LENGTH).alias("content"))


@query
def document_terms(spark, sf):
    words = similarity.term_vectors(B.document_requirements(spark, sf))
    return words.select("framework", "pos", F.array_join("terms", " ").alias("terms"))


@query
def title_fallback(spark, sf):
    head = F.when(F.contains("text", F.lit("\n")), F.split_part("text", F.lit("\n"), F.lit(1))).otherwise("")
    body = F.when(head == "", F.col("text")).otherwise(F.substr("text", F.length(head) + 2))
    title, description = text.title_and_description(head, body, keep=False)
    return B.table(spark, sf, "documents").select("doc_id", title.alias("title"), description.alias("description"))


@query
def clean_text(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("text"))


@query
def clean_id(spark, sf):
    raw = F.concat(F.lit(" ."), F.col("text"), F.lit(". "))
    return B.table(spark, sf, "documents").select("doc_id", text.clean_id(raw).alias("id"))


@query
def framework_names(spark, sf):
    pages = B.table(spark, sf, "pages")
    path = F.concat(F.regexp_replace("url", r"[?#].*$|/$", ""), F.lit("-"), F.col("page_id") % 30, F.lit(".yaml"))
    return pages.select("page_id", text.framework_name(path).alias("framework"))


@query
def pair_slug(spark, sf):
    pairs = P.framework_pairs(P.frameworks_of(B.customers(spark, sf)))
    a, b = F.col("framework_A"), F.col("framework_B")
    return pairs.select(*PAIR, text.pair_slug(a, b).alias("slug"), text.sheet_name(a, b).alias("sheet"))


@query
def truncated_descriptions(spark, sf):
    rows = B.document_requirements(spark, sf)
    return rows.select("framework", "id", text.truncate(F.col("description")).alias("description"))


@query
def escaped_pages(spark, sf):
    return B.table(spark, sf, "pages").select("page_id", text.escape_html(F.col("html")).alias("html"))


@query
def dedupe_first(spark, sf):
    _, found = B.document_candidates(spark, sf)
    folded = found.withColumns({
        "id_A": (F.col("pos_A") % 50).cast("string"), "id_B": (F.col("pos_B") % 50).cast("string"),
    })
    return C.dedupe_first(folded).select(*CANDIDATE, "pos_A", "rank")


@query
def lookup_last(spark, sf):
    rows = B.document_requirements(spark, sf).withColumn("id", (F.col("pos") % 50).cast("string"))
    return C.lookup_last(rows).select("framework", "id", "title", "pos")


@query
def batches(spark, sf):
    return V.assign_batches(cut(B.vector_candidates(spark, sf))).select(*PAIR, "id_A", "id_B", "batch_no", "idx")


@query
def request_texts(spark, sf):
    rows, found = B.document_candidates(spark, sf)
    return V.build_requests(cut(found), rows)


@query
def confirmation_batches(spark, sf):
    related = cut(B.vector_relations(spark, sf))
    return V.confirmation_batches(related).select(*PAIR, "id_A", "id_B", "batch_no", "idx")


def _event_batches(spark, sf):
    """Requests and responses of ten events each; some responses are out of range."""
    events = B.table(spark, sf, "events")
    score = F.get_json_object("props", "$.k").cast("int")
    verdict = F.struct(
        ((score * 10 + F.when(F.col("event_id") % 97 == 0, 50).otherwise(0)) / 1000).alias("coverage_A_to_B"),
        (score / 100).cast("string").alias("coverage_B_to_A"),
        F.lit(0.5).alias("confidence"),
        F.when(F.col("event_id") % 89 == 0, "other").otherwise("partial").alias("relation_type"),
        F.col("event_type").alias("justification"),
    )
    rows = events.select(
        F.lit("events").alias("framework_A"), (F.col("event_id") % 3).cast("string").alias("framework_B"),
        F.floor(F.col("event_id") / 30).alias("batch_no"), "event_id", verdict.alias("verdict"),
    )
    grouped = rows.groupBy(*PAIR, "batch_no").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("event_id", "verdict"))).alias("rows")
    )
    results = F.transform("rows", lambda r: r["verdict"])
    raw = (
        F.when(F.col("batch_no") % 13 == 12, "no json")
        .when(F.col("batch_no") % 11 == 10, F.to_json(F.struct(F.slice(results, 1, 3).alias("results"))))
        .when(F.col("n") == 1, F.to_json(F.element_at(results, 1)))
        .otherwise(F.to_json(F.struct(results.alias("results"))))
    )
    whole = grouped.select(*PAIR, "batch_no", "n", raw.alias("raw"))
    return whole.select(*PAIR, "batch_no", "n"), whole.filter("batch_no % 17 <> 16").select(*PAIR, "batch_no", "raw")


@query
def parse_verdicts(spark, sf):
    return V.parse_responses(*_event_batches(spark, sf))[0]


@query
def failed_batches(spark, sf):
    return V.parse_responses(*_event_batches(spark, sf))[1]


@query
def retried_candidates(spark, sf):
    batched = cut(V.assign_batches(cut(B.vector_candidates(spark, sf))))
    requests = batched.groupBy(*PAIR, "batch_no").agg(F.count("*").alias("n"))
    _, failed = V.parse_responses(requests, B.answers(batched))
    return V.retry_batches(failed, batched).select(*PAIR, "id_A", "id_B", "retry_of", "retry_idx")


@query
def judged_relations(spark, sf):
    """Batches out, answers in, single retries, adapted types, second pass."""
    found = cut(B.vector_candidates(spark, sf))
    limits = cut(thresholds.resolve_thresholds(found))

    def ask(batched, shift):
        requests = batched.groupBy(*PAIR, "batch_no").agg(F.count("*").alias("n"))
        verdicts, failed = V.parse_responses(requests, cut(B.answers(batched, shift)))
        retried = cut(V.retry_batches(failed, batched))
        single = retried.groupBy(*PAIR, "batch_no").agg(F.count("*").alias("n"))
        again, _ = V.parse_responses(single, B.answers(retried, shift))
        rest = V.match_verdicts(retried.drop("retry_of", "retry_idx"), again)
        return V.match_verdicts(batched, verdicts).unionByName(rest)

    first = cut(V.classify(ask(cut(V.assign_batches(found)), 0), limits))
    second = ask(cut(V.confirmation_batches(first)), 10)
    columns = ["coverage_A_to_B", "coverage_B_to_A", "confidence", "relation_type"]
    return V.confirm(first, second, limits).select(*PAIR, "id_A", "id_B", *columns)


def _checked(spark, sf):
    expected = D.expected_counts(D.config_from_text(B.customer_config(spark, sf)))
    return validate.validate_counts(B.customer_requirements(spark, sf), expected)


@query
def expected_counts(spark, sf):
    return D.expected_counts(D.config_from_text(B.customer_config(spark, sf)))


@query
def expected_totals(spark, sf):
    return D.expected_totals(D.config_from_text(B.customer_config(spark, sf)))


@query
def config_sections(spark, sf):
    return D.sections(D.config_from_text(B.customer_config(spark, sf)))


@query
def section_counts(spark, sf):
    return _checked(spark, sf)[0]


@query
def validation_report(spark, sf):
    sections, report = _checked(spark, sf)
    shown = validate.shown_sections(sections, None)
    return report.join(shown, "framework", "left").withColumns({
        name: F.array_join(name, ",") for name in ("missing_sections", "over_sections")
    })


@query
def validated_frameworks(spark, sf):
    """Counts that are configured under the survey's key, for requirements under the framework's own."""
    expected = D.expected_counts(D.config_from_text(B.customer_config(spark, sf)))
    rows = B.customer_requirements(spark, sf).withColumn("framework", F.lower("framework"))
    keys = expected.select(F.lower("framework").alias("key"), F.col("framework").alias("survey_key")).distinct()
    return validate.validate_counts(rows, D.by_key(expected, keys))[1]


@query
def section_totals(spark, sf):
    return D.section_totals(D.config_from_text(B.customer_config(spark, sf)))


@query
def expand_na(spark, sf):
    config = D.config_from_text(B.customer_config(spark, sf))
    return validate.expand_na(validate.config_selectors(config), D.sections(config))


@query
def flattened_documents(spark, sf):
    nodes = decode_documents(B.customer_documents(spark, sf))
    rows = flatten_requirements(nodes, B.customer_dim(spark, sf))
    return rows.withColumn("tags", F.array_join("tags", "/"))


@query
def enriched_frameworks(spark, sf):
    """Market segments, their lower-case spelling registered for two of them."""
    names = B.customers(spark, sf).select("framework").distinct()
    known = names.filter(F.col("framework") < "C").select(
        F.col("framework").alias("key"), F.lower("framework").alias("survey_key"), F.initcap("framework").alias("display_name"),
        F.lit("trade").alias("domain"), F.lit("fr").alias("language"), F.lit("T-").alias("section_id_prefix"),
    )
    return D.enrich(names, known)


@query
def search_candidates(spark, sf):
    return views.search_candidates(B.vector_candidates(spark, sf), 0.25, "vector 1.*7$").select(*CANDIDATE)


@query
def indexed_search(spark, sf):
    index = search.title_index(B.vector_requirements(spark, sf))
    return search.search_indexed(B.vector_candidates(spark, sf), index, 0.25, "vector 1.*7$").select(*CANDIDATE)


@query
def filter_relations(spark, sf):
    related = B.vector_relations(spark, sf)
    found = views.filter_relations(related, ["equivalence", "A_covers_B"], 0.5)
    return found.select(*PAIR, "id_A", "id_B", "relation_type", "confidence")


@query
def display_floors(spark, sf):
    return views.column_floors(B.vector_relations(spark, sf), ["semantic_score", "confidence"])


def _kept(spark, sf):
    return K.cleanup(B.vector_relations(spark, sf))


@query
def review_rows(spark, sf):
    return views.review_rows(cut(_kept(spark, sf)[0]))


@query
def review_progress(spark, sf):
    kept = cut(_kept(spark, sf)[0])
    rows = views.review_rows(kept)
    state = rows.select("row", (F.col("row") % 3 == 0).alias("checked")).filter("row % 2 = 0")
    return views.review_progress(views.review_rows(kept, state))


@query
def report_table(spark, sf):
    names = {name: F.concat(F.lit("Collection of vectors "), name) for name in PAIR}
    related = cut(B.vector_relations(spark, sf).withColumns(names))
    return reports.report_table(*K.cleanup(related))


@query
def mapping_counts(spark, sf):
    _, pairs = B.vector_pairs(spark, sf)
    related = cut(B.vector_relations(spark, sf))
    kept, removed = K.cleanup(related)
    return mapping_totals(B.vector_requirements(spark, sf), pairs, related, kept, removed)


@query
def scanned_documents(spark, sf):
    """The documents written as files, found, read and decoded."""
    documents = read_documents(spark, B.written_documents(spark, sf), B.folder_name(), recursive=True, pattern="*.txt")
    rows = flatten_requirements(decode_documents(documents), B.customer_dim(spark, sf))
    return rows.withColumn("tags", F.array_join("tags", "/"))


@query
def listed_frameworks(spark, sf):
    return framework_counts(list_frameworks(spark, B.written_documents(spark, sf), name=B.folder_name(), pattern="*.txt"))


@query
def loaded_documents(spark, sf):
    """The named loader of document tables."""
    return loader("documents")(spark, f"{sf}/documents.parquet").withColumn("tags", F.array_join("tags", ","))


@query
def stored_requirements(spark, sf):
    folder = B.scratch(spark, "requirements")
    tables.write_requirements(B.document_requirements(spark, sf), folder, "json")
    return tables.read_requirements(spark, folder, "json").select("framework", "id", "title", "description", F.array_join("tags", ",").alias("tags"), "pos")


@query
def stored_candidates(spark, sf):
    """Two runs into one folder, the second one over more frameworks, and a run that died."""
    folder, rows, vectors = B.scratch(spark, "stored"), B.vector_requirements(spark, sf), B.vectors(spark, sf)
    settings = {"threshold": B.VECTOR_THRESHOLD, "k": B.K, "digits": B.DIGITS}
    few = stored.update_candidates(rows.filter("framework < '5'"), folder, vectors.filter("framework < '5'"), **settings)
    died = few.withColumns({"threshold": F.lit(B.VECTOR_THRESHOLD), "k": F.lit(B.K), "run": F.lit("run-9")})
    tables.write_versioned(died, f"{folder}/{stored.CANDIDATES}", keys=["run"])
    return stored.update_candidates(rows, folder, vectors, **settings).select(*CANDIDATE, "title_A", "title_B")


@query
def exported_candidates(spark, sf):
    found, folder = B.vector_candidates(spark, sf).select(*CANDIDATE, "title_A", "title_B"), B.scratch(spark, "candidates")
    reports.write_rows(found, folder, "json")
    return spark.read.schema(found.schema).json(folder)


@query
def exported_relations(spark, sf):
    related, folder = B.vector_relations(spark, sf), B.scratch(spark, "relations")
    reports.export_relations(related, folder)
    return tables.read_versioned(spark, folder, fmt="json").select(*CANDIDATE, "coverage_A_to_B", "coverage_B_to_A", "confidence", "relation_type")


@query
def ordered_relations(spark, sf):
    """Relations by falling confidence."""
    return views.by_score(B.vector_relations(spark, sf).select(*CANDIDATE, "confidence"), "confidence")


@query
def mapping_run(spark, sf):
    """Relations that a whole run over stored requirements keeps, as it has exported them."""
    source, folder = B.scratch(spark, "source"), B.scratch(spark, "run")
    tables.write_requirements(B.vector_requirements(spark, sf), source)
    made = runs.run(spark, source, folder, "requirements", vectors=B.vectors(spark, sf), judge=B.title_judge, threshold=B.VECTOR_THRESHOLD, k=B.K, digits=B.DIGITS)
    return made["kept"].select(*CANDIDATE, "confidence", "relation_type")


@query
def run_totals(spark, sf):
    """What a run has counted while it wrote its tables; the second of two runs finds everything stored."""
    source, folder = B.scratch(spark, "source"), B.scratch(spark, "run")
    tables.write_requirements(B.vector_requirements(spark, sf), source)
    for _ in range(2):
        made = runs.run(spark, source, folder, "requirements", vectors=B.vectors(spark, sf), threshold=B.VECTOR_THRESHOLD, k=B.K, digits=B.DIGITS)
    return made["totals"]


def _with_matrices(spark, sf):
    """A folder with the candidates of the vectors and their matrices, made in two steps."""
    folder, rows, vectors = B.scratch(spark, "matrices"), B.vector_requirements(spark, sf), B.vectors(spark, sf)
    for end in ("5", "a"):
        own = [df.filter(F.col("framework") < end) for df in (rows, vectors)]
        stored.update_candidates(own[0], folder, own[1], threshold=B.VECTOR_THRESHOLD, k=B.K, digits=B.DIGITS)
        matrices.update_matrices(own[1], folder, B.VECTOR_THRESHOLD, B.K)
    return folder


@query
def stored_matrix_sample(spark, sf):
    shown = matrices.stored_sample(spark, _with_matrices(spark, sf), B.VECTOR_THRESHOLD, B.K)
    return shown.withColumn("score", F.round("score", 4))


@query
def stored_matrix_floor(spark, sf):
    floors = views.matrix_floor(matrices.stored_sample(spark, _with_matrices(spark, sf), B.VECTOR_THRESHOLD, B.K))
    return floors.withColumn("floor", F.round("floor", 4))


@query
def stored_matrix_cells(spark, sf):
    """The whole matrix of one framework pair, cell by cell, from the store."""
    grids = matrices.stored_grids(spark, _with_matrices(spark, sf), B.VECTOR_THRESHOLD, B.K, pair=("2", "7"))
    return similarity.matrix_cells(grids).withColumn("score", R.shorter_score(F.col("score"), 6, similarity.DIGITS))
