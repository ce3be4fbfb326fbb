"""SQL on the driver tables that gives the same results as the registered queries."""

from __future__ import annotations

SPACE = r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
PAIR = "framework_A, framework_B"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def clean(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{SPACE}]+', ' ', 'g'), ' ')"


def title(label: str, desc: str) -> str:
    cut = f"regexp_replace(left({strip(desc)}, 120), '[{SPACE}]+$', '')"
    mark = f"CASE WHEN length({strip(desc)}) > 120 THEN '…' ELSE '' END"
    return clean(f"CASE WHEN {strip(label)} = '' AND {strip(desc)} <> '' THEN {cut} || {mark} ELSE {strip(label)} END")


def description(label: str, desc: str, keep: bool = True) -> str:
    short = f" AND length({strip(desc)}) <= 120" if keep else ""
    return clean(f"CASE WHEN {strip(label)} = ''{short} THEN '' ELSE {strip(desc)} END")


def exact(value: str, digits: int) -> str:
    return f"CAST(format('{{:.{digits}f}}', {value}) AS DOUBLE)"


def relation(a: str, b: str, eq: str = "0.85", cov: str = "0.75") -> str:
    return (
        f"CASE WHEN {a} >= {eq} AND {b} >= {eq} THEN 'equivalence' "
        f"WHEN {a} >= {cov} AND {b} < {cov} THEN 'A_covers_B' "
        f"WHEN {b} >= {cov} AND {a} < {cov} THEN 'B_covers_A' "
        f"WHEN {a} >= 0.4 OR {b} >= 0.4 THEN 'partial' ELSE 'no_link' END"
    )


def hundredths(a: int, b: int, shift: int = 0, pos_a: str = "pos_A", pos_b: str = "pos_B") -> str:
    return f"(({a} * {pos_a} + {b} * {pos_b} + {shift}) % 101)"


VECTORS = """
v AS (SELECT CAST(label AS VARCHAR) AS framework, vec_id AS pos, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sizes AS (SELECT framework, count(*) AS n FROM v GROUP BY framework),
pairs AS (SELECT a.framework AS framework_A, b.framework AS framework_B, a.n AS n_A, b.n AS n_B
          FROM sizes a JOIN sizes b ON a.framework < b.framework),
cells AS (SELECT a.framework AS framework_A, b.framework AS framework_B, a.pos AS pos_A, b.pos AS pos_B,
                 round(list_cosine_similarity(a.e, b.e), 4) AS semantic_score
          FROM v a JOIN v b ON a.framework < b.framework),
found AS (SELECT *, CAST(pos_A AS VARCHAR) AS id_A, CAST(pos_B AS VARCHAR) AS id_B,
                 'Vector ' || pos_A AS title_A, 'Vector ' || pos_B AS title_B,
                 CAST(row_number() OVER (PARTITION BY framework_A, framework_B, pos_A
                                         ORDER BY semantic_score DESC, pos_B) AS INT) AS rank
          FROM cells WHERE semantic_score >= 0.2 QUALIFY rank <= 5)"""

def quantile(point: str) -> str:
    place = f"(CAST({point} AS DOUBLE) * (n - 1))"
    low, high = f"l[CAST(floor({place}) AS INT) + 1]", f"l[CAST(ceil({place}) AS INT) + 1]"
    if point == "0.5":
        return f"(({low} + {high}) / 2)"
    share = f"({place} - floor({place}))"
    return (
        f"(CASE WHEN {share} >= 0.5 THEN {high} - ({high} - {low}) * (1 - {share}) "
        f"ELSE {low} + ({high} - {low}) * {share} END)"
    )


THRESHOLDS = f"""
lists AS (SELECT framework_A, framework_B, count(*) AS n, avg(semantic_score) AS mean, list_sort(list(semantic_score)) AS l
          FROM found GROUP BY framework_A, framework_B),
spread AS (SELECT framework_A, framework_B, n, mean, {exact(quantile("0.5"), 4)} AS median,
                  {quantile("0.25")} AS q25, {quantile("0.75")} AS q75, {quantile("0.9")} AS p90 FROM lists),
shifts AS (SELECT *, greatest(CAST(-0.1 AS DOUBLE), least(CAST(0.1 AS DOUBLE),
                  (median - CAST(0.6 AS DOUBLE)) * CAST(0.25 AS DOUBLE))) AS delta FROM spread),
limits AS (SELECT *, {exact("greatest(CAST(0.7 AS DOUBLE), least(CAST(0.95 AS DOUBLE), CAST(0.85 AS DOUBLE) + delta))", 3)} AS thresh_eq,
                  {exact("greatest(CAST(0.6 AS DOUBLE), least(CAST(0.9 AS DOUBLE), CAST(0.75 AS DOUBLE) + delta))", 3)} AS thresh_cov FROM shifts)"""


def scored(shift: int = 0) -> str:
    return (
        f"{hundredths(7, 13, shift)} / 100 AS coverage_A_to_B, {hundredths(11, 5, shift)} / 100 AS coverage_B_to_A, "
        f"{hundredths(31, 17, shift)} / 100 AS confidence"
    )


RELATED = f"""
scored AS (SELECT *, {scored()}, '<' || id_A || ' & ' || id_B || '>' AS justification FROM found),
related AS (SELECT *, {relation("coverage_A_to_B", "coverage_B_to_A")} AS relation_type FROM scored),
kept AS (SELECT * FROM related WHERE NOT (relation_type = 'no_link' OR confidence < 0.4)),
removed AS (SELECT * FROM related WHERE relation_type = 'no_link' OR confidence < 0.4)"""

FIRST_LINE = "split_part(text, chr(10), 1)"
REST = f"substring(text, length({FIRST_LINE}) + 2)"
SENTENCE = f"left({strip("split_part(description, '.', 1)")}, 200)"
DOCUMENTS = f"""
r AS (SELECT lang AS framework, CAST(doc_id AS VARCHAR) AS id, {title(FIRST_LINE, REST)} AS title,
             {description(FIRST_LINE, REST)} AS description, source AS tags, doc_id AS pos FROM documents),
texts AS (SELECT *, tags || ' | ' || title || CASE WHEN description <> '' THEN ': ' || description ELSE '' END AS content
          FROM r)"""
WORDS = r"list_filter(regexp_split_to_array(lower(content), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
DOCUMENT_PAIRS = f"""{DOCUMENTS},
words AS (SELECT framework, pos, unnest({WORDS}) AS word FROM texts),
weights AS (SELECT framework, pos, word, count(*) AS w FROM words GROUP BY framework, pos, word),
norms AS (SELECT framework, pos, sqrt(sum(w * w)) AS norm FROM weights GROUP BY framework, pos),
dots AS (SELECT a.framework AS framework_A, a.pos AS pos_A, b.framework AS framework_B, b.pos AS pos_B,
                CAST(sum(a.w * b.w) AS DOUBLE) AS dot
         FROM weights a JOIN weights b ON a.word = b.word AND a.framework < b.framework
         GROUP BY a.framework, a.pos, b.framework, b.pos),
cells AS (SELECT d.framework_A, d.framework_B, d.pos_A, d.pos_B, round(dot / (na.norm * nb.norm), 4) AS semantic_score
          FROM dots d JOIN norms na ON na.framework = d.framework_A AND na.pos = d.pos_A
                      JOIN norms nb ON nb.framework = d.framework_B AND nb.pos = d.pos_B),
found AS (SELECT *, CAST(pos_A AS VARCHAR) AS id_A, CAST(pos_B AS VARCHAR) AS id_B,
                 CAST(row_number() OVER (PARTITION BY framework_A, framework_B, pos_A
                                         ORDER BY semantic_score DESC, pos_B) AS INT) AS rank
          FROM cells WHERE semantic_score >= 0.15 QUALIFY rank <= 5)"""

LETTERS = ", ".join(f"length(content) - length(replace(content, '{letter}', ''))" for letter in "abcdefghijklmnop")
ENCODED = f"""{DOCUMENTS},
v AS (SELECT framework, pos, CAST([{LETTERS}] AS DOUBLE[]) AS e FROM texts),
cells AS (SELECT a.framework AS framework_A, b.framework AS framework_B, a.pos AS pos_A, b.pos AS pos_B,
                 round(list_cosine_similarity(a.e, b.e), 4) AS semantic_score
          FROM v a JOIN v b ON a.framework < b.framework)"""

BATCHED = """
placed AS (SELECT *, row_number() OVER (PARTITION BY framework_A, framework_B
                                        ORDER BY semantic_score DESC, pos_A, rank) - 1 AS place FROM found),
batched AS (SELECT *, place // 10 AS batch_no, place % 10 AS idx,
                   count(*) OVER (PARTITION BY framework_A, framework_B, place // 10) AS n FROM placed)"""

SEGMENTS = """
c AS (SELECT c_mktsegment AS framework, n_regionkey AS region, n_nationkey AS nation, c_custkey AS custkey, c_name AS name
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
counted AS (SELECT framework, region, nation, count(*) AS n FROM c
            WHERE NOT (region = 3 AND nation % 2 = 1) GROUP BY framework, region, nation),
expected AS (
  SELECT framework, CAST(region AS VARCHAR) AS section, CAST(nation AS VARCHAR) AS subsection, CAST(n + nation % 3 - 1 AS INT) AS expected
  FROM counted WHERE region <> 4
  UNION ALL SELECT framework, '4', NULL, CAST(sum(n) AS INT) FROM counted WHERE region = 4 GROUP BY framework),
expected_keys AS (SELECT framework, concat_ws('.', section, subsection) AS section, expected FROM expected),
parsed AS (SELECT framework, CASE WHEN region = 4 THEN '4' ELSE region || '.' || nation END AS section, count(*) AS parsed
           FROM c GROUP BY ALL),
sections AS (SELECT coalesce(e.framework, p.framework) AS framework, coalesce(e.section, p.section) AS section,
                    coalesce(expected, 0) AS expected, coalesce(parsed, 0) AS parsed
             FROM expected_keys e FULL JOIN parsed p ON e.framework = p.framework AND e.section = p.section)"""

STATUS = "CASE WHEN expected > 0 AND parsed < expected THEN 'missing' WHEN parsed > expected THEN 'over' ELSE 'equal' END"

SCORE = "CAST(json_extract(props, '$.k') AS INT)"
EVENTS = f"""
e AS (SELECT event_id, 'events' AS framework_A, CAST(event_id % 3 AS VARCHAR) AS framework_B, event_id // 30 AS batch_no,
             ({SCORE} * 10 + CASE WHEN event_id % 97 = 0 THEN 50 ELSE 0 END) / 1000 AS coverage_A_to_B,
             {SCORE} / 100 AS coverage_B_to_A, CAST(0.5 AS DOUBLE) AS confidence, event_type AS justification,
             event_id % 89 = 0 AS other,
             row_number() OVER (PARTITION BY event_id % 3, event_id // 30 ORDER BY event_id) - 1 AS idx FROM events),
b AS (SELECT framework_A, framework_B, batch_no, count(*) AS n,
             bool_and(coverage_A_to_B <= 1 AND NOT other) AND batch_no % 13 <> 12 AND batch_no % 17 <> 16
             AND (batch_no % 11 <> 10 OR count(*) = 3) AS good
      FROM e GROUP BY framework_A, framework_B, batch_no)"""


def bad_batches(shift: int, source: str = "batched") -> str:
    return (
        f"SELECT framework_A, framework_B, batch_no FROM {source} GROUP BY framework_A, framework_B, batch_no "
        f"HAVING bool_or((pos_A + pos_B) % 29 = 0) OR (count(*) > 1 AND batch_no % 7 = 6)"
    )


def escape(text: str) -> str:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        text = f"replace({text}, '{plain}', '{escaped}')"
    return text


def colour(values: dict[str, str], other: str) -> str:
    cases = " ".join(f"WHEN '{kind}' THEN '{value}'" for kind, value in values.items())
    return f"CASE relation_type {cases} ELSE '{other}' END"


SHEET_COLOURS = {"equivalence": "C6EFCE", "A_covers_B": "FFEB9C", "B_covers_A": "FFEB9C", "partial": "FFDDC1", "no_link": "FFC7CE"}
# The colours of relation types.
REVIEW_COLOURS = {"equivalence": "#27ae60", "A_covers_B": "#3498db", "B_covers_A": "#e67e22", "partial": "#f39c12", "no_link": "#95a5a6"}
LABEL = "format('{:.2f} → {:.2f}/{:.2f}', semantic_score, coverage_A_to_B, coverage_B_to_A)"
REPORT = f"""{colour(SHEET_COLOURS, "FFFFFF")} AS colour, framework_A AS "Framework A", id_A AS "ID A", title_A AS "Title A",
  framework_B AS "Framework B", id_B AS "ID B", title_B AS "Title B", semantic_score AS "Semantic Score",
  coverage_A_to_B AS "Coverage A→B", coverage_B_to_A AS "Coverage B→A", confidence AS "Confidence",
  relation_type AS "Relation Type", justification AS "Justification" """
REVIEW = f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY framework_A, framework_B, semantic_score DESC, pos_A, rank) - 1 AS row FROM kept)"""
VIEWED = f"WITH {VECTORS},{RELATED}"
KEYS = "framework_A, framework_B, id_A, id_B"


def pair_block() -> str:
    def side(letter: str) -> str:
        return (
            f"'{letter.upper()} (' || {letter}.framework || ' [' || {letter}.tags || ']): ' || {letter}.title || chr(10) || "
            f"CASE WHEN {letter}.description = '' THEN '(sans description)' ELSE {letter}.description END"
        )

    return f"'--- Paire ' || (idx + 1) || ' ---' || chr(10) || {side('a')} || chr(10) || chr(10) || {side('b')}"


def lines(*parts: str) -> str:
    """Text of several lines as an SQL expression."""
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in parts)


#: The default wording of a request, written out here so that a mistake in the engine's own shows.
INSTRUCTIONS = lines(
    "Rate how far the requirements of each numbered pair fulfil each other.", "", "relation | condition",
    "equivalence | coverage_A_to_B >= 0.85 and coverage_B_to_A >= 0.85", "A_covers_B | coverage_A_to_B >= 0.75 > coverage_B_to_A",
    "B_covers_A | coverage_B_to_A >= 0.75 > coverage_A_to_B", "partial | otherwise, coverage_A_to_B >= 0.4 or coverage_B_to_A >= 0.4", "no_link | otherwise",
)
FIELDS = lines(
    "coverage_A_to_B (number 0..1): part of requirement B that requirement A fulfils",
    "coverage_B_to_A (number 0..1): part of requirement A that requirement B fulfils", "confidence (number 0..1): certainty of the two numbers",
    "relation_type (string): see the table of relations", "justification (string): short reason",
)
REQUEST = f"""{INSTRUCTIONS} || chr(10) || chr(10) || 'Number of pairs: ' || n || chr(10) || chr(10) || blocks || chr(10) || chr(10) ||
    'Reply with JSON alone.' || chr(10) || CASE WHEN n = 1 THEN 'One object with these fields:' ELSE
    'One object whose field results is an array of ' || n || ' objects, one for each pair in their order, with these fields:' END || chr(10) || {FIELDS}"""

FLATTENED = f"""
WITH c AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer),
items AS (
  SELECT 'part-' || (k // 500) AS framework, (k // 500) % 2 = 0 AS known, k % 3 AS section, nation, k, k % 4 AS kind, k % 5 = 0 AS direct,
         name || '  of' || chr(9) || segment AS label, repeat(name || '. ', 8) || '.' AS body FROM c),
inherited AS (
  SELECT *, CASE WHEN section = 1 THEN 'S-é1' WHEN NOT known THEN CAST(section AS VARCHAR)
                 WHEN section = 2 THEN 'K-12' ELSE 'K-' || section END AS start FROM items),
rows AS (
  SELECT *, CASE WHEN direct THEN start WHEN nation % 4 = 0 THEN 'N' || nation ELSE start || '.' || nation END AS above,
         concat_ws('/', CASE WHEN section <> 2 THEN 'Section ' || section END, CASE WHEN NOT direct THEN 'Nation ' || nation END) AS tags
  FROM inherited)
SELECT framework, replace(CASE WHEN kind = 1 THEN 'C.' || k ELSE above || '.' || k END, 'é', '') AS id,
       CASE WHEN kind = 0 THEN {clean("left(body, 120)")} || '…' ELSE {clean("label")} END AS title,
       CASE WHEN kind IN (0, 1, 3) THEN {clean("body")} ELSE '' END AS description, tags,
       row_number() OVER (PARTITION BY framework ORDER BY section DESC, CASE WHEN direct THEN -1 ELSE nation END, k) - 1 AS pos
FROM rows"""

ORACLE: dict[str, str] = {
    "cosine_topk": f"WITH {VECTORS} SELECT framework_A, framework_B, pos_A, pos_B, semantic_score, rank FROM found",
    "repaired_candidates": f"WITH {VECTORS} SELECT framework_A, framework_B, pos_A, pos_B, semantic_score, rank FROM found",
    "candidate_pairs": f"WITH {VECTORS} SELECT {KEYS}, title_A, title_B, semantic_score FROM found",
    "sparse_cosine_topk": f"WITH {DOCUMENT_PAIRS} SELECT {KEYS}, semantic_score FROM found",
    "encoded_cosine_topk": f"""WITH {ENCODED} SELECT *, CAST(row_number() OVER (PARTITION BY framework_A, framework_B, pos_A
        ORDER BY semantic_score DESC, pos_B) AS INT) AS rank FROM cells WHERE semantic_score >= 0.97 QUALIFY rank <= 5""",
    "framework_pairs_sym": f"WITH {VECTORS} SELECT framework_A, framework_B FROM pairs",
    "framework_pairs_asym": f"""WITH {VECTORS} SELECT DISTINCT least(a.framework, b.framework) AS framework_A,
        greatest(a.framework, b.framework) AS framework_B FROM sizes a JOIN sizes b ON a.framework <> b.framework
        WHERE a.framework IN ('0','1','2') AND b.framework IN ('1','2','3','4')""",
    "display_pairs": f"""WITH {VECTORS} SELECT a.framework AS framework_A, b.framework AS framework_B
        FROM sizes a JOIN sizes b ON a.framework <> b.framework
        WHERE a.framework IN ('0','1','2') AND b.framework IN ('1','2','3','4')""",
    "role_of_frameworks": f"""WITH {VECTORS} SELECT framework, CASE framework WHEN '0' THEN 'new' WHEN '1' THEN 'both'
        WHEN '2' THEN 'both' ELSE 'existing' END AS role FROM sizes WHERE framework IN ('0','1','2','3','4')""",
    "asymmetric_candidates": f"""WITH {VECTORS} SELECT {KEYS}, semantic_score FROM found
        WHERE (framework_A IN ('0','1','2') AND framework_B IN ('1','2','3','4'))
           OR (framework_B IN ('0','1','2') AND framework_A IN ('1','2','3','4'))""",
    "incremental_pairs": f"""WITH {VECTORS} SELECT framework_A, framework_B FROM pairs
        WHERE (CAST(framework_A AS INT) + CAST(framework_B AS INT)) % 2 <> 0""",
    "similarity_matrix": f"""WITH {VECTORS} SELECT framework_A, framework_B, count(*) AS cells,
        round(avg(semantic_score), 9) AS mean_score, min(semantic_score) AS min_score, max(semantic_score) AS max_score
        FROM cells GROUP BY framework_A, framework_B""",
    "matrix_sample": f"""WITH {VECTORS},
        thin AS (SELECT framework, pos FROM (SELECT *, row_number() OVER (PARTITION BY framework ORDER BY pos) - 1 AS place FROM v)
                 JOIN sizes USING (framework) WHERE place % greatest(1, n // 80) = 0)
        SELECT framework_A, framework_B, pos_A, pos_B, semantic_score AS score FROM cells
        JOIN thin a ON a.framework = framework_A AND a.pos = pos_A JOIN thin b ON b.framework = framework_B AND b.pos = pos_B""",
    "matrix_floor": f"""WITH {VECTORS},
        thin AS (SELECT framework, pos FROM (SELECT *, row_number() OVER (PARTITION BY framework ORDER BY pos) - 1 AS place FROM v)
                 JOIN sizes USING (framework) WHERE place % greatest(1, n // 80) = 0)
        SELECT x.framework AS framework_A, y.framework AS framework_B,
               round(quantile_cont(list_cosine_similarity(x.e, y.e), 0.05), 4) AS floor
        FROM v x JOIN v y ON x.framework < y.framework
        JOIN thin a ON a.framework = x.framework AND a.pos = x.pos JOIN thin b ON b.framework = y.framework AND b.pos = y.pos
        GROUP BY x.framework, y.framework""",
    "score_distribution": f"""WITH {VECTORS},{THRESHOLDS} SELECT framework_A, framework_B, n, {exact("mean", 4)} AS mean, median,
        {exact("q25", 4)} AS q25, {exact("q75", 4)} AS q75, {exact("p90", 4)} AS p90 FROM spread""",
    "adaptive_thresholds": f"""WITH {VECTORS},{THRESHOLDS}
        SELECT framework_A, framework_B, n, median, {exact("delta", 4)} AS delta, thresh_eq, thresh_cov FROM limits""",
    "score_histogram": f"""WITH {VECTORS},
        edges AS (SELECT framework_A, framework_B, CASE WHEN min(semantic_score) = max(semantic_score) THEN min(semantic_score) - 0.5 ELSE min(semantic_score) END AS lo,
                         CASE WHEN min(semantic_score) = max(semantic_score) THEN max(semantic_score) + 0.5 ELSE max(semantic_score) END AS hi FROM found GROUP BY ALL),
        counted AS (SELECT framework_A, framework_B, least(CAST(floor((semantic_score - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin, count(*) AS n
                    FROM found JOIN edges USING (framework_A, framework_B) GROUP BY ALL)
        SELECT framework_A, framework_B, bin, round(lo + bin * ((hi - lo) / 30), 6) AS low,
               round(lo + (bin + 1) * ((hi - lo) / 30), 6) AS high, coalesce(n, 0) AS n
        FROM (SELECT *, unnest(range(30)) AS bin FROM edges) LEFT JOIN counted USING (framework_A, framework_B, bin)""",
    "reduction_ratio": f"""WITH {VECTORS} SELECT framework_A, framework_B, count(f.pos_A) AS kept, n_A * n_B AS total,
        round(100.0 * count(f.pos_A) / greatest(n_A * n_B, 1), 4) AS percent
        FROM pairs LEFT JOIN found f USING (framework_A, framework_B) GROUP BY framework_A, framework_B, n_A, n_B""",
    "classify_relations": f"""{VIEWED} SELECT {KEYS}, semantic_score, coverage_A_to_B, coverage_B_to_A, confidence, relation_type FROM related""",
    "adapted_relations": f"""WITH {VECTORS},{RELATED},{THRESHOLDS} SELECT {KEYS},
        {relation("coverage_A_to_B", "coverage_B_to_A", "thresh_eq", "thresh_cov")} AS relation_type
        FROM scored JOIN limits USING (framework_A, framework_B)""",
    "relation_counts": f"""{VIEWED} SELECT t.relation_type, count(r.pos_A) AS n
        FROM (SELECT unnest(['equivalence', 'A_covers_B', 'B_covers_A', 'partial', 'no_link']) AS relation_type) t
        LEFT JOIN related r USING (relation_type) GROUP BY t.relation_type""",
    "relation_share": f"""{VIEWED} SELECT relation_type, count(*) AS n,
        round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM related GROUP BY relation_type""",
    "cleanup_kept": f"{VIEWED} SELECT {KEYS}, confidence, relation_type FROM kept",
    "cleanup_removed": f"{VIEWED} SELECT {KEYS}, confidence, relation_type FROM removed",
    "needs_confirmation": f"{VIEWED} SELECT {KEYS} FROM related WHERE coverage_A_to_B >= 0.75 OR coverage_B_to_A >= 0.75",
    "confirm_average": f"""{VIEWED},
        twice AS (SELECT *, (coverage_A_to_B >= 0.75 OR coverage_B_to_A >= 0.75) AS again, {hundredths(7, 13, 10)} / 100 AS a2,
                  {hundredths(11, 5, 10)} / 100 AS b2, {hundredths(31, 17, 10)} / 100 AS c2 FROM related),
        merged AS (SELECT {KEYS}, CASE WHEN again THEN {exact("(coverage_A_to_B + a2) / 2", 4)} ELSE coverage_A_to_B END AS coverage_A_to_B,
                   CASE WHEN again THEN {exact("(coverage_B_to_A + b2) / 2", 4)} ELSE coverage_B_to_A END AS coverage_B_to_A,
                   CASE WHEN again THEN {exact("(confidence + c2) / 2", 4)} ELSE confidence END AS confidence,
                   CASE WHEN again THEN 'again' ELSE justification END AS justification FROM twice)
        SELECT *, {relation("coverage_A_to_B", "coverage_B_to_A")} AS relation_type FROM merged""",
    "requirements_from_documents": f"WITH {DOCUMENTS} SELECT * FROM r",
    "embedding_text": f"""WITH {DOCUMENTS} SELECT framework, id,
        tags || ' | ' || title || CASE WHEN {SENTENCE} <> '' THEN ': ' || {SENTENCE} ELSE '' END AS content FROM r""",
    "document_terms": f"WITH {DOCUMENTS} SELECT framework, pos, array_to_string({WORDS}, ' ') AS terms FROM texts",
    "title_fallback": f"""WITH d AS (SELECT doc_id, CASE WHEN contains(text, chr(10)) THEN {FIRST_LINE} ELSE '' END AS head, text FROM documents),
        s AS (SELECT doc_id, head, CASE WHEN head = '' THEN text ELSE substring(text, length(head) + 2) END AS body FROM d)
        SELECT doc_id, {title("head", "body")} AS title, {description("head", "body", keep=False)} AS description FROM s""",
    "clean_text": f"SELECT doc_id, {clean('text')} AS text FROM documents",
    "clean_id": f"""SELECT doc_id, trim(regexp_replace(' .' || text || '. ', '[^\\x00-\\x7F]', '', 'g'), '. ') AS id FROM documents""",
    "framework_names": r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$|/$', '') || '-' || (page_id % 30) || '.yaml' AS path FROM pages)
        SELECT page_id, translate(regexp_replace(regexp_replace(regexp_extract(path, '([^/]+)$', 1), '\.yaml$', ''), '[-_][0-9]+$', ''), '- ', '__') AS framework FROM p""",
    "pair_slug": f"""WITH s AS (SELECT DISTINCT c_mktsegment AS f FROM customer)
        SELECT a.f AS framework_A, b.f AS framework_B,
               left(regexp_replace(lower(a.f), '[^a-z0-9]', '_', 'g'), 30) || '__' || left(regexp_replace(lower(b.f), '[^a-z0-9]', '_', 'g'), 30) AS slug,
               left(left(a.f, 12) || ' ' || left(b.f, 12), 31) AS sheet
        FROM s a JOIN s b ON a.f < b.f""",
    "truncated_descriptions": f"""WITH {DOCUMENTS} SELECT framework, id,
        CASE WHEN length(description) > 300 THEN left(description, 300) || '…' ELSE description END AS description FROM r""",
    "escaped_pages": f"SELECT page_id, {escape('html')} AS html FROM pages",
    "dedupe_first": f"""WITH {DOCUMENT_PAIRS}, folded AS (SELECT framework_A, framework_B, CAST(pos_A % 50 AS VARCHAR) AS id_A,
            CAST(pos_B % 50 AS VARCHAR) AS id_B, semantic_score, pos_A, rank FROM found)
        SELECT * FROM folded QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY pos_A, rank) = 1""",
    "lookup_last": f"""WITH {DOCUMENTS} SELECT framework, CAST(pos % 50 AS VARCHAR) AS id, title, pos FROM r
        QUALIFY row_number() OVER (PARTITION BY framework, pos % 50 ORDER BY pos DESC) = 1""",
    "batches": f"WITH {VECTORS},{BATCHED} SELECT {KEYS}, batch_no, idx FROM batched",
    "request_texts": f"""WITH {DOCUMENT_PAIRS},{BATCHED},
        blocks AS (SELECT framework_A, framework_B, batch_no, n, string_agg({pair_block()}, chr(10) || chr(10) ORDER BY idx) AS blocks
                   FROM batched JOIN r a ON a.framework = framework_A AND a.id = id_A JOIN r b ON b.framework = framework_B AND b.id = id_B
                   GROUP BY framework_A, framework_B, batch_no, n)
        SELECT framework_A, framework_B, batch_no, n, {REQUEST} AS text FROM blocks""",
    "confirmation_batches": f"""{VIEWED},
        strong AS (SELECT *, row_number() OVER (PARTITION BY framework_A, framework_B ORDER BY semantic_score DESC, pos_A, rank) - 1 AS place
                   FROM related WHERE coverage_A_to_B >= 0.75 OR coverage_B_to_A >= 0.75)
        SELECT {KEYS}, place // 10 AS batch_no, place % 10 AS idx FROM strong""",
    "parse_verdicts": f"""WITH {EVENTS} SELECT framework_A, framework_B, batch_no, idx, coverage_A_to_B, coverage_B_to_A, confidence,
        'partial' AS relation_type, justification FROM e JOIN b USING (framework_A, framework_B, batch_no) WHERE good""",
    "failed_batches": f"WITH {EVENTS} SELECT framework_A, framework_B, batch_no, n FROM b WHERE NOT good",
    "retried_candidates": f"""WITH {VECTORS},{BATCHED}, bad AS ({bad_batches(0)})
        SELECT {KEYS}, batch_no AS retry_of, idx AS retry_idx FROM batched JOIN bad USING (framework_A, framework_B, batch_no) WHERE n > 1""",
    "judged_relations": f"""WITH {VECTORS},{THRESHOLDS},
        one AS (SELECT *, {scored()} FROM found WHERE (pos_A + pos_B) % 29 <> 0),
        twice AS (SELECT *, (coverage_A_to_B >= 0.75 OR coverage_B_to_A >= 0.75) AS again, {hundredths(7, 13, 10)} / 100 AS a2,
                  {hundredths(11, 5, 10)} / 100 AS b2, {hundredths(31, 17, 10)} / 100 AS c2 FROM one),
        merged AS (SELECT {KEYS}, CASE WHEN again THEN {exact("(coverage_A_to_B + a2) / 2", 4)} ELSE coverage_A_to_B END AS coverage_A_to_B,
                   CASE WHEN again THEN {exact("(coverage_B_to_A + b2) / 2", 4)} ELSE coverage_B_to_A END AS coverage_B_to_A,
                   CASE WHEN again THEN {exact("(confidence + c2) / 2", 4)} ELSE confidence END AS confidence FROM twice)
        SELECT {KEYS}, coverage_A_to_B, coverage_B_to_A, confidence,
               {relation("coverage_A_to_B", "coverage_B_to_A", "thresh_eq", "thresh_cov")} AS relation_type
        FROM merged JOIN limits USING (framework_A, framework_B)""",
    "expected_counts": f"WITH {SEGMENTS} SELECT framework, section, expected FROM expected_keys",
    "expected_totals": f"WITH {SEGMENTS} SELECT framework, CAST(sum(expected) AS BIGINT) AS expected FROM expected_keys GROUP BY framework",
    "config_sections": f"""WITH {SEGMENTS} SELECT framework, section, subsection, expected,
        CASE WHEN section = '2' THEN '7' ELSE section END AS effective_id,
        concat_ws('.', section, subsection) IN ('1.6', '4') AS is_flat FROM expected""",
    "section_totals": f"""WITH {SEGMENTS} SELECT framework, section, CAST(sum(expected) AS BIGINT) AS expected
        FROM expected GROUP BY framework, section""",
    "section_counts": f"WITH {SEGMENTS} SELECT *, {STATUS} AS status FROM sections",
    "validation_report": f"""WITH {SEGMENTS}, marked AS (SELECT *, {STATUS} AS status FROM sections),
        placed AS (SELECT * FROM marked)
        SELECT framework, CAST(sum(expected) AS BIGINT) AS total_expected, CAST(sum(parsed) AS BIGINT) AS total_parsed,
        count(*) FILTER (WHERE status = 'missing') AS missing, count(*) FILTER (WHERE status = 'over') AS over,
        coalesce(string_agg(section, ',' ORDER BY section) FILTER (WHERE status = 'missing'), '') AS missing_sections,
        coalesce(string_agg(section, ',' ORDER BY section) FILTER (WHERE status = 'over'), '') AS over_sections,
        sum(expected) = sum(parsed) AS ok, CAST(sum(parsed) - sum(expected) AS BIGINT) AS difference FROM placed GROUP BY framework""",
    "validated_frameworks": f"""WITH {SEGMENTS}, marked AS (SELECT *, {STATUS} AS status FROM sections)
        SELECT lower(framework) AS framework, CAST(sum(expected) AS BIGINT) AS total_expected, CAST(sum(parsed) AS BIGINT) AS total_parsed,
        count(*) FILTER (WHERE status = 'missing') AS missing, count(*) FILTER (WHERE status = 'over') AS over,
        sum(expected) = sum(parsed) AS ok, CAST(sum(parsed) - sum(expected) AS BIGINT) AS difference FROM marked GROUP BY framework""",
    "expand_na": f"""WITH {SEGMENTS},
        flat AS (SELECT framework, expected FROM expected WHERE section = '4'),
        nested AS (SELECT framework, section, subsection, expected, CAST(subsection AS INT) % 3 AS kind FROM expected WHERE section <> '4')
        SELECT framework, 'partially' AS option, '4.' || unnest(range(1, expected + 1)) AS item FROM flat
        UNION ALL SELECT framework, 'partially', '4.' || unnest(range(2, least(3, expected) + 1)) FROM flat
        UNION ALL SELECT framework, 'partially', section || '.' || subsection || '.' || unnest(range(1, expected + 1)) FROM nested WHERE kind = 0
        UNION ALL SELECT framework, 'partially', section || '.' || subsection || '.' || unnest(range(2, least(4, expected) + 1)) FROM nested WHERE kind = 1
        UNION ALL SELECT framework, 'partially', section || '.' || subsection || '.3' FROM nested WHERE kind = 2""",
    "flattened_documents": FLATTENED,
    "enriched_frameworks": """WITH s AS (SELECT DISTINCT c_mktsegment AS framework FROM customer)
        SELECT framework, CASE WHEN framework < 'C' THEN lower(framework) END AS survey_key,
               CASE WHEN framework < 'C' THEN upper(left(framework, 1)) || lower(substring(framework, 2)) ELSE framework END AS display_name,
               CASE WHEN framework < 'C' THEN 'trade' ELSE 'unknown' END AS domain,
               CASE WHEN framework < 'C' THEN 'fr' ELSE 'en' END AS language,
               CASE WHEN framework < 'C' THEN 'T-' ELSE '' END AS section_id_prefix FROM s""",
    "search_candidates": f"""WITH {VECTORS} SELECT {KEYS}, semantic_score FROM found WHERE semantic_score >= 0.25
        AND (regexp_matches(title_A, 'vector 1.*7$', 'i') OR regexp_matches(title_B, 'vector 1.*7$', 'i'))""",
    "filter_relations": f"""{VIEWED} SELECT {KEYS}, relation_type, confidence FROM related
        WHERE relation_type IN ('equivalence', 'A_covers_B') AND confidence >= 0.5""",
    "display_floors": f"{VIEWED} SELECT min(semantic_score) AS semantic_score, min(confidence) AS confidence FROM related",
    "review_rows": f"""{VIEWED},{REVIEW} SELECT row, id_A, title_A, relation_type, {colour(REVIEW_COLOURS, "#999")} AS colour,
        {LABEL} AS label, id_B, title_B, {escape("justification")} AS justification, false AS checked FROM numbered""",
    "review_progress": f"""{VIEWED},{REVIEW} SELECT count(*) AS total, count(*) FILTER (WHERE row % 6 = 0) AS checked,
        count(*) FILTER (WHERE row % 6 <> 0) AS remaining,
        CAST(round(100.0 * count(*) FILTER (WHERE row % 6 = 0) / count(*), 0) AS INT) AS percent FROM numbered""",
    "report_table": f"""{VIEWED},
        k AS (SELECT * REPLACE ('Collection of vectors ' || framework_A AS framework_A, 'Collection of vectors ' || framework_B AS framework_B) FROM kept),
        d AS (SELECT * REPLACE ('Collection of vectors ' || framework_A AS framework_A, 'Collection of vectors ' || framework_B AS framework_B) FROM removed),
        sheets AS (SELECT framework_A, framework_B, row_number() OVER (ORDER BY framework_A, framework_B) AS nth
                   FROM (SELECT DISTINCT framework_A, framework_B FROM k))
        SELECT 'Collection o Collection o' || CASE WHEN nth > 1 THEN ' ' || nth ELSE '' END AS sheet, {REPORT} FROM k JOIN sheets USING (framework_A, framework_B)
        UNION ALL SELECT 'Global', {REPORT} FROM k UNION ALL SELECT 'Removed', {REPORT} FROM d""",
    "mapping_counts": f"""{VIEWED} SELECT 'frameworks' AS metric, count(*) AS amount FROM sizes
        UNION ALL SELECT 'requirements', CAST(sum(n) AS BIGINT) FROM sizes UNION ALL SELECT 'pairs', count(*) FROM pairs
        UNION ALL SELECT 'matrix_cells', CAST(sum(n_A * n_B) AS BIGINT) FROM pairs UNION ALL SELECT 'candidates', count(*) FROM found
        UNION ALL SELECT 'kept', count(*) FROM kept UNION ALL SELECT 'removed', count(*) FROM removed""",
    "scanned_documents": FLATTENED,
    "listed_frameworks": """WITH n AS (SELECT count(DISTINCT c_custkey // 500) AS n FROM customer)
        SELECT n AS frameworks, CAST(n * (n - 1) // 2 AS BIGINT) AS pairs FROM n""",
    "loaded_documents": f"WITH {DOCUMENTS} SELECT * FROM r",
    "stored_requirements": f"WITH {DOCUMENTS} SELECT * FROM r",
    "stored_candidates": f"WITH {VECTORS} SELECT {KEYS}, title_A, title_B, semantic_score FROM found",
    "exported_candidates": f"WITH {VECTORS} SELECT {KEYS}, title_A, title_B, semantic_score FROM found",
    "exported_relations": f"""{VIEWED} SELECT {KEYS}, semantic_score, coverage_A_to_B, coverage_B_to_A, confidence, relation_type FROM related""",
    "ordered_relations": f"{VIEWED} SELECT {KEYS}, semantic_score, confidence FROM related ORDER BY confidence DESC",
    "mapping_run": f"""WITH {VECTORS},{RELATED},{THRESHOLDS}, judged AS (SELECT {KEYS}, semantic_score, confidence,
        {relation("coverage_A_to_B", "coverage_B_to_A", "thresh_eq", "thresh_cov")} AS relation_type
        FROM scored JOIN limits USING (framework_A, framework_B))
        SELECT * FROM judged WHERE relation_type <> 'no_link' AND confidence >= 0.4""",
    "run_totals": f"""WITH {VECTORS} SELECT 'frameworks' AS metric, count(*) AS amount FROM sizes
        UNION ALL SELECT 'requirements', CAST(sum(n) AS BIGINT) FROM sizes UNION ALL SELECT 'pairs', count(*) FROM pairs
        UNION ALL SELECT 'matrix_cells', CAST(sum(n_A * n_B) AS BIGINT) FROM pairs UNION ALL SELECT 'candidates', count(*) FROM found""",
    "stored_matrix_cells": f"""WITH {VECTORS} SELECT x.framework AS framework_A, y.framework AS framework_B, x.pos AS pos_A, y.pos AS pos_B,
        round(greatest(0.0, least(1.0, list_cosine_similarity(x.e, y.e))), 6) AS score FROM v x JOIN v y ON x.framework = '2' AND y.framework = '7'""",
}
ORACLE["stored_matrix_sample"] = ORACLE["matrix_sample"]
ORACLE["stored_matrix_floor"] = ORACLE["matrix_floor"]
ORACLE["indexed_search"] = ORACLE["search_candidates"]
