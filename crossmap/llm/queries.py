"""The registered queries of the operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmap.llm import decontaminate, filter_audit, html_text, lm, near_dup, packing, pii, secret_scan, sharding, token_counts, topk, toxicity, whitening
from crossmap.llm.common import joined_sha256, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    REGISTERED[build.__name__] = build
    return build


@query
def op1_html_text(spark, sf):
    pages = html_text.extract_text(table(spark, sf, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_token_counts(spark, sf):
    return token_counts.with_limit(token_counts.count_tokens(table(spark, sf, "documents")))


@query
def op3_near_duplicates(spark, sf):
    found = near_dup.near_duplicates(table(spark, sf, "documents"), shingle=3, threshold=(85, 100))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


@query
def op4_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    hits, names = decontaminate.find_hits(docs, table(spark, sf, "benchmark"))
    n_hit = decontaminate.hit_words(F.col(names["spans"]))
    return hits.select(
        "doc_id", F.col(names["n_words"]).alias("n_words"), n_hit.alias("n_hit"), F.size(names["items"]).cast("long").alias("n_items"),
        joined_sha256(F.array_sort(names["items"])).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query
def op5_packing(spark, sf):
    return packing.packed(table(spark, sf, "documents"))


@query
def op6_pii(spark, sf):
    found = pii.find_spans(table(spark, sf, "documents"))

    def number(spans, kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    def listed(spans):
        place = F.array(*(F.lit(k) for k in pii.KINDS))
        keyed = F.transform(spans, lambda s: F.struct(F.array_position(place, s["kind"]).alias("n"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    whole = F.concat("base", "added")
    return found.select("doc_id", *(number(F.col("base"), kind) for kind in pii.KINDS), joined_sha256(listed(F.col("base"))).alias("base_sha256"), F.array_join(listed(whole), ",").alias("spans"),
                        F.size("added").cast("long").alias("n_added"))


@query
def op7_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out, names = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    severity, grade, p = (F.col(names[x]) for x in ("severity", "grade", "p_toxic"))
    return out.select("doc_id", severity.alias("severity"), grade.alias("grade"), p.alias("p_toxic"), (p >= toxicity.REJECT).alias("toxic"))


@query
def op8_language_model(spark, sf):
    return lm.score_texts(table(spark, sf, "documents"))


@query
def op9_topk(spark, sf):
    vectors = topk.integer_vectors(table(spark, sf, "embeddings"))
    return topk.top_k(vectors.filter(F.col("vec_id") % topk.QUERY_EVERY == 0), vectors)


@query
def op10_sharding(spark, sf):
    rows, _ = sharding.shard(table(spark, sf, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op11_filter_audit(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents").select("doc_id", "source", "text"), table(spark, sf, "labels"))


@query
def op12_secrets(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found, names = secret_scan.find_spans(docs, secret_scan.fit(docs))
    base, added = F.col(names["base"]), F.col(names["added"])
    order = F.array(*(F.lit(kind) for kind in (*secret_scan.KINDS, secret_scan.LEARNED)))

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    def listed(spans):
        keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("n"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    return found.select("doc_id", *(number(kind) for kind in secret_scan.KINDS), joined_sha256(listed(base)).alias("base_sha256"),
                        F.array_join(listed(F.concat(base, added)), ",").alias("spans"), F.size(added).cast("long").alias("n_added"))


@query
def op13_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


ORACLE["op9_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w::DOUBLE[], c.w::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

ORACLE["op3_near_duplicates"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, w[s:s + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (SELECT a, b FROM ways UNION SELECT r.doc_id, e.b FROM reached r JOIN ways e ON e.a = r.other),
smallest AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(s.other, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(s.other, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN smallest s USING (doc_id)
"""

ORACLE["op4_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
i AS (SELECT item_id, {_LETTERS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, l, w[s:s + l - 1] AS g
            FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT l FROM windows),
places AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d CROSS JOIN lengths WHERE len(w) >= l),
hits AS (SELECT doc_id, p.l, s, item_id FROM places p JOIN windows x ON x.l = p.l AND x.g = p.w[s:s + p.l - 1]),
marked AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + l)) AS at FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op11_filter_audit"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             list_filter([CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                          CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
                          CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN d.doc_id > first_id THEN 'E' END], lambda x: x IS NOT NULL) AS failed
      FROM d JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders(o) AS (SELECT x FROM letters UNION ALL SELECT o || x FROM orders, letters WHERE length(o) < 5 AND NOT contains(o, x)),
places AS (SELECT o AS filter_order, s AS step, substr(o, s, 1) AS own, string_split(substr(o, 1, s - 1), '') AS earlier FROM orders, range(1, 6) r(s) WHERE length(o) = 5),
audit AS (SELECT part, filter_order, CAST(step AS INT) AS step, own,
                 CAST(sum(CASE WHEN NOT list_has_any(failed, list_append(earlier, own)) THEN n ELSE 0 END) AS BIGINT) AS kept,
                 CAST(sum(CASE WHEN NOT list_has_any(failed, earlier) AND list_contains(failed, own) THEN n ELSE 0 END) AS BIGINT) AS removed,
                 CAST(sum(CASE WHEN list_has_any(failed, earlier) AND list_contains(failed, own) THEN n ELSE 0 END) AS BIGINT) AS redundant,
                 CAST(sum(CASE WHEN failed = [own] THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                 CAST(sum(CASE WHEN NOT list_has_any(failed, earlier) AND list_contains(failed, own) THEN good ELSE 0 END) AS BIGINT) AS good_lost,
                 CAST(sum(CASE WHEN NOT list_has_any(failed, earlier) AND list_contains(failed, own) THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
          FROM cells, places GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM audit
"""
