"""The registered queries over the project's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import stats, text
from caseloom.operators import assertions, components, matcher, normalize, ontology, quality, records, splits
from caseloom.session import materialize, shared_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Fixed values of the data model.
RELEVANCE = ["strong", "supportive", "weak", "unrelated", "unknown"]
MODALITIES = ["ct", "mri", "xray", "ultrasound", "histology", "photo", "unknown"]
UNKNOWN_LICENCES = ["", "UNKNOWN", "NO-CC CODE"]
STATUS_LIST = ", ".join(f"'{s}'" for s in assertions.STATUSES)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _distinct(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    return table(spark, d, name).select(*columns).distinct()


def _decision(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(x)), "^(accept|reject)ed$", "$1")


def _sql_decision(c: str) -> str:
    return f"regexp_replace(lower(trim({c})), '^(accept|reject)ed$', '\\1')"


# Normalization


@query("""SELECT DISTINCT case_id, coalesce(article_id, split_part(case_id, '_', 1)) AS article_id, sha256(raw_case_text) AS text_sha256,
  sha256(raw_case_text) = raw_text_sha256 AS hash_holds, length(raw_case_text) AS n_chars FROM cases""")
def norm_cases(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "cases")
    sha = F.sha2("raw_case_text", 256)
    return c.select("case_id", F.coalesce("article_id", F.split_part("case_id", F.lit("_"), F.lit(1))).alias("article_id"), sha.alias("text_sha256"), (sha == F.col("raw_text_sha256")).alias("hash_holds"), F.length("raw_case_text").cast("long").alias("n_chars")).distinct()


@query("SELECT DISTINCT article_id, case_id, image_id, caption, width * height AS pixels FROM selected_images")
def norm_nested_images(spark: SparkSession, d: str) -> DataFrame:
    """Articles with nested cases with nested images, flattened in two steps; an article's cases are nested in several records."""
    i = table(spark, d, "selected_images").select("article_id", "case_id", "image_id", "caption", "width", "height").distinct()
    cases = i.groupBy("article_id", "case_id").agg(F.collect_list(F.struct("image_id", "caption", "width", "height")).alias("images"))
    articles = cases.groupBy("article_id", F.pmod(F.xxhash64("case_id"), F.lit(4096))).agg(F.collect_list(F.struct("case_id", "images")).alias("cases"))
    flat = normalize.flatten_records(normalize.flatten_records(articles, "cases", ["article_id"]), "images", ["article_id", "case_id"])
    return flat.select("article_id", "case_id", "image_id", "caption", (F.col("width") * F.col("height")).alias("pixels"))


@query("SELECT case_id, count(*) AS n FROM cases GROUP BY case_id HAVING count(*) > 1 OR case_id IS NULL")
def pk_violations(spark: SparkSession, d: str) -> DataFrame:
    return normalize.duplicate_keys(table(spark, d, "cases"), "case_id")


@query("SELECT DISTINCT case_id, model, reviewed_at FROM reviewer_a r WHERE NOT EXISTS (SELECT 1 FROM cases c WHERE c.case_id = r.case_id)")
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    return normalize.orphans(table(spark, d, "reviewer_a"), table(spark, d, "cases"), "case_id").select("case_id", "model", "reviewed_at").distinct()


@query("""SELECT case_id, image_id, CASE WHEN NOT EXISTS (SELECT 1 FROM text_qc t WHERE t.case_id = i.case_id) THEN 'ORPHAN'
  WHEN NOT EXISTS (SELECT 1 FROM manifest m WHERE m.case_id = i.case_id AND m.selected_image_id = i.image_id) THEN 'UNVERIFIED' ELSE 'ACCEPTED' END AS outcome
  FROM (SELECT DISTINCT case_id, image_id FROM selected_images) i""")
def reject_split(spark: SparkSession, d: str) -> DataFrame:
    rows = _distinct(spark, d, "selected_images", "case_id", "image_id")
    pairs = table(spark, d, "manifest").select("case_id", F.col("selected_image_id").alias("image_id"))
    out = normalize.split_accepted(rows, table(spark, d, "text_qc"), pairs, "case_id", ["case_id", "image_id"])
    return out.select("case_id", "image_id", F.coalesce("reject_reason", F.lit("ACCEPTED")).alias("outcome"))


@query("""WITH p AS (SELECT DISTINCT lower(trim(image_sha256)) AS sha, case_id FROM selected_images WHERE trim(image_sha256) <> '') SELECT sha, case_id, count(*) OVER (PARTITION BY sha) AS n FROM p""")
def image_relations(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "selected_images").where("trim(image_sha256) <> ''").select(F.lower(F.trim("image_sha256")).alias("sha"), "case_id")
    return normalize.relation_pairs(i, "sha", "case_id")


@query("""SELECT image_id, 'images/' || substr(f, 1, 4) || '/' || substr(f, 1, 5) || '/' || f AS stored_path, regexp_extract(f, '\\.[a-z]+$') AS suffix
  FROM (SELECT DISTINCT image_id, regexp_extract(path, '[^/]+$') AS f FROM selected_images)""")
def image_paths(spark: SparkSession, d: str) -> DataFrame:
    f = _distinct(spark, d, "selected_images", "image_id", "path").select("image_id", F.regexp_extract("path", "[^/]+$", 0).alias("f"))
    return f.select("image_id", normalize.image_path(F.col("f")).alias("stored_path"), F.regexp_extract("f", r"\.[a-z]+$", 0).alias("suffix")).distinct()


# Matching and candidates


def _aliases(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").where("trim(disease) <> '' and diagnosis_label is not null")
    return m.select(F.col("disease").alias("alias"), F.upper(F.trim("diagnosis_label")).alias("concept_id")).distinct()


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return matcher.find_aliases(_distinct(spark, d, "cases", "case_id", "raw_case_text"), _aliases(spark, d), "case_id", "raw_case_text")


_PRESENCE = """aliases AS (SELECT DISTINCT lower(disease) AS alias, upper(trim(diagnosis_label)) AS concept_id FROM manifest WHERE trim(disease) <> '' AND diagnosis_label IS NOT NULL
), texts AS (SELECT DISTINCT case_id, lower(raw_case_text) AS t FROM cases
), hits AS (SELECT DISTINCT case_id, concept_id FROM (SELECT case_id, concept_id, replace(t, alias, chr(57345)) AS m FROM texts JOIN aliases ON contains(t, alias))
  WHERE regexp_matches(m, '(^|[^\\p{L}\\p{N}])\\x{E001}($|[^\\p{L}\\p{N}])'))"""


@query(f"WITH {_PRESENCE} SELECT case_id, concept_id FROM hits")
def alias_presence(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d).select("case_id", "concept_id").distinct()


_OFFSETS = """aliases AS (SELECT DISTINCT lower(disease) AS alias, upper(trim(diagnosis_label)) AS concept_id FROM manifest WHERE trim(disease) <> '' AND diagnosis_label IS NOT NULL
), texts AS (SELECT DISTINCT case_id, raw_case_text AS t FROM cases
), cut AS (SELECT case_id, concept_id, alias, t, string_split(lower(t), alias) AS p FROM texts JOIN aliases ON contains(lower(t), alias)
), pieces AS (SELECT *, unnest(range(1, len(p))) AS i FROM cut
), hits AS (SELECT case_id, concept_id, alias, t, list_sum(list_transform(p[1:i], lambda x: length(x)))::BIGINT + (i - 1) * length(alias) AS a FROM pieces
  WHERE NOT regexp_matches(right(p[i], 1), '[\\p{L}\\p{N}]') AND NOT regexp_matches(left(p[i + 1], 1), '[\\p{L}\\p{N}]'))"""


@query(f'WITH {_OFFSETS} SELECT case_id, concept_id, substr(t, a + 1, length(alias)) AS alias, a::INT AS "start", (a + length(alias))::INT AS "end" FROM hits')
def matcher_offsets(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d)


@query(f"WITH {_PRESENCE} SELECT concept_id, count(DISTINCT case_id) AS candidate_cases FROM hits GROUP BY concept_id")
def concept_support(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d).groupBy("concept_id").agg(F.count_distinct("case_id").alias("candidate_cases"))


@query(f"WITH {_PRESENCE} SELECT case_id, string_agg(concept_id, ',' ORDER BY concept_id) AS concepts, count(*) AS n FROM hits GROUP BY case_id")
def candidates_grouped(spark: SparkSession, d: str) -> DataFrame:
    g = _mentions(spark, d).groupBy("case_id").agg(F.array_sort(F.collect_set("concept_id")).alias("c"))
    return g.select("case_id", F.array_join("c", ",").alias("concepts"), F.size("c").cast("long").alias("n"))


@query(f"""WITH {_PRESENCE}, per AS (SELECT t.case_id, count(h.concept_id) AS n FROM texts t LEFT JOIN hits h USING (case_id) GROUP BY t.case_id)
  SELECT CASE WHEN n = 1 THEN 'SINGLE_TARGET' WHEN n > 1 THEN 'MULTI_TARGET' ELSE 'NO_CANDIDATE' END AS scope, count(*) AS n FROM per GROUP BY 1""")
def scope_counts(spark: SparkSession, d: str) -> DataFrame:
    found = _mentions(spark, d).groupBy("case_id").agg(F.count_distinct("concept_id").alias("k"))
    k = F.coalesce("k", F.lit(0))
    every = _distinct(spark, d, "cases", "case_id").join(found, "case_id", "left")
    return every.select(records.ladder((k == 1, "SINGLE_TARGET"), (k > 1, "MULTI_TARGET"), otherwise="NO_CANDIDATE").alias("scope")).groupBy("scope").agg(F.count("*").alias("n"))


# Evidence and text


@query(r"""SELECT case_id, len(list_filter(regexp_extract_all(raw_case_text, '[^.!?\n]+(?:[.!?]+|$)'), lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) <> '')) AS n
  FROM (SELECT DISTINCT case_id, raw_case_text FROM cases)""")
def sentence_counts(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "cases", "case_id", "raw_case_text").select("case_id", text.sentence_count(F.col("raw_case_text")).cast("long").alias("n"))


_QUOTES = """quotes AS (SELECT DISTINCT r.case_id, r.evidence_quote AS q, r.evidence_start AS a, r.evidence_end AS b, c.raw_case_text AS t
  FROM reviewer_a r JOIN (SELECT DISTINCT case_id, raw_case_text FROM cases) c USING (case_id))"""


def _quotes(spark: SparkSession, d: str) -> DataFrame:
    r = _distinct(spark, d, "reviewer_a", "case_id", "evidence_quote", "evidence_start", "evidence_end").withColumnsRenamed({"evidence_quote": "q", "evidence_start": "a", "evidence_end": "b"})
    return r.join(_distinct(spark, d, "cases", "case_id", F.col("raw_case_text").alias("t")), "case_id")


@query(f"""WITH {_QUOTES} SELECT case_id, q, a, coalesce(a >= 0 AND a < b AND b <= length(t) AND trim(q) <> '' AND substr(t, a + 1, b - a) = q, false) AS exact FROM quotes""")
def evidence_exact(spark: SparkSession, d: str) -> DataFrame:
    return _quotes(spark, d).select("case_id", "q", "a", text.exact_evidence(F.col("t"), F.col("q"), F.col("a"), F.col("b")).alias("exact"))


@query(f"""WITH {_QUOTES} SELECT DISTINCT case_id, q, CASE WHEN q <> '' AND (length(t) - length(replace(t, q, ''))) / length(q) = 1 THEN instr(t, q) - 1 END AS start FROM quotes WHERE q IS NOT NULL""")
def unique_quotes(spark: SparkSession, d: str) -> DataFrame:
    q = _quotes(spark, d).where("q is not null")
    return q.select("case_id", "q", text.unique_quote_start(F.col("t"), F.col("q")).cast("long").alias("start")).distinct()


_RUN = r"([\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\\r\\n|\\[nr])+"


@query(f"""WITH q AS (SELECT DISTINCT m.request_sha256, m.evidence_quote AS q, c.raw_case_text AS t FROM medgemma_labels m JOIN (SELECT DISTINCT case_id, raw_case_text FROM cases) c USING (case_id) WHERE m.evidence_quote <> ''
), z AS (SELECT request_sha256, t, regexp_replace(t, '{_RUN}', ' ', 'g') AS s, trim(regexp_replace(q, '{_RUN}', ' ', 'g')) AS n, list_transform(regexp_extract_all(t, '{_RUN}'), lambda x: length(x) - 1) AS lost FROM q
), i AS (SELECT *, CASE WHEN n <> '' AND (length(s) - length(replace(s, n, ''))) // nullif(length(n), 0) = 1 THEN instr(s, n) - 1 END AS i FROM z
), o AS (SELECT request_sha256, t, i + coalesce(list_sum(lost[1:i - length(replace(left(s, i), ' ', ''))]), 0) AS a, i + length(n) + coalesce(list_sum(lost[1:i + length(n) - 1 - length(replace(left(s, i + length(n) - 1), ' ', ''))]), 0) AS b FROM i
), u AS (SELECT *, a IS NOT NULL AND (length(t) - length(replace(t, substr(t, a::BIGINT + 1, (b - a)::BIGINT), ''))) // nullif(b - a, 0) = 1 AS once FROM o)
SELECT request_sha256, CASE WHEN once THEN a END::INT AS aligned_start, CASE WHEN once THEN b END::INT AS aligned_end FROM u""")
def aligned_quotes(spark: SparkSession, d: str) -> DataFrame:
    rows = _distinct(spark, d, "medgemma_labels", "request_sha256", "case_id", "evidence_quote").where("evidence_quote <> ''").join(_distinct(spark, d, "cases", "case_id", "raw_case_text"), "case_id")
    return quality.align_quotes(rows, "raw_case_text", "evidence_quote").select("request_sha256", "aligned_start", "aligned_end")


@query(f"""WITH {_QUOTES} SELECT DISTINCT case_id, a,
  regexp_extract(substr(t, 1, a), '[^.!?\\n]*$') AS before_in_sentence FROM quotes WHERE a IS NOT NULL AND substr(t, a + 1, b - a) = q""")
def sentence_prefixes(spark: SparkSession, d: str) -> DataFrame:
    q = _quotes(spark, d).where("a is not null").where(text.slice_text(F.col("t"), F.col("a"), F.col("b")) == F.col("q"))
    return q.select("case_id", "a", F.regexp_extract(F.substring("t", F.lit(1), F.col("a")), r"[^.!?\n]*\z", 0).alias("before_in_sentence")).distinct()


_CONTEXT = f"""sides AS (SELECT DISTINCT m.case_id, lower(m.disease) AS disease,
    lower(regexp_extract(substr(c.t, 1, instr(lower(c.t), lower(m.disease)) - 1), '[^.!?\\n]*$')) AS b0,
    lower(regexp_extract(substr(c.t, instr(lower(c.t), lower(m.disease)) + length(m.disease)), '^[^.!?\\n]*')) AS a0
  FROM manifest m JOIN (SELECT DISTINCT case_id, regexp_replace(raw_case_text, '[\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]', ' ', 'g') AS t FROM cases) c USING (case_id) WHERE contains(lower(c.t), lower(m.disease)) AND m.disease <> ''
), clauses AS (SELECT case_id, disease, right(regexp_extract(b0, '^(?s:.*(?:{assertions.CLAUSE}))?((?s:.*))$', 1), 100) AS b,
    left(regexp_extract(a0, '^(?s:(.*?))(?:(?:{assertions.CLAUSE})|$)', 1), 100) AS a FROM sides)"""


@query(f"""WITH {_CONTEXT} SELECT case_id, disease, CASE WHEN regexp_matches(b, '{assertions.FAMILY}') OR regexp_matches(b, '{assertions.HISTORY}') THEN 'historical'
  WHEN regexp_matches(b, '{assertions.NEGATED_BEFORE}') OR regexp_matches(a, '{assertions.NEGATED_AFTER}') OR regexp_matches(b, '{assertions.NOT_DIAGNOSED}') THEN 'ruled_out'
  WHEN regexp_matches(b || ' <disease> ' || a, '{assertions.DIFFERENTIAL}') THEN 'differential'
  WHEN regexp_matches(b || ' <disease> ' || a, '{assertions.PROBABLE}') THEN 'probable'
  WHEN regexp_matches(b || ' <disease> ' || a, '{assertions.SUSPECTED}') THEN 'suspected'
  WHEN regexp_matches(b, '{assertions.CONFIRMED_BEFORE}') OR regexp_matches(a, '{assertions.CONFIRMED_AFTER}') THEN 'confirmed' ELSE 'unclear' END AS status FROM clauses""")
def assertion_status(spark: SparkSession, d: str) -> DataFrame:
    """What the sentence of the first mention of a case's disease asserts."""
    m = table(spark, d, "manifest").where("disease <> ''").select("case_id", F.lower("disease").alias("disease")).distinct()
    blanks = F.regexp_replace("raw_case_text", r"[\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]", " ")
    j = m.join(_distinct(spark, d, "cases", "case_id", blanks.alias("t")), "case_id").withColumn("at", F.instr(F.lower("t"), F.col("disease"))).where("at > 0")
    before = F.regexp_extract(F.substring("t", F.lit(1), F.col("at") - 1), r"[^.!?\n]*\z", 0)
    after = F.regexp_extract(F.substring("t", F.col("at") + F.length("disease"), F.length("t")), r"^[^.!?\n]*", 0)
    return j.select("case_id", "disease", assertions.mention_status(before, after).alias("status")).distinct()


_STATUS = f"""CASE WHEN regexp_matches(b, '{assertions.FAMILY}') OR regexp_matches(b, '{assertions.HISTORY}') THEN 'historical'
  WHEN regexp_matches(b, '{assertions.NEGATED_BEFORE}') OR regexp_matches(a, '{assertions.NEGATED_AFTER}') OR regexp_matches(b, '{assertions.NOT_DIAGNOSED}') THEN 'ruled_out'
  WHEN regexp_matches(b || ' <disease> ' || a, '{assertions.DIFFERENTIAL}') THEN 'differential'
  WHEN regexp_matches(b || ' <disease> ' || a, '{assertions.PROBABLE}') THEN 'probable'
  WHEN regexp_matches(b || ' <disease> ' || a, '{assertions.SUSPECTED}') THEN 'suspected'
  WHEN regexp_matches(b, '{assertions.CONFIRMED_BEFORE}') OR regexp_matches(a, '{assertions.CONFIRMED_AFTER}') THEN 'confirmed' ELSE 'unclear' END"""


_DIAGNOSED = f"""{_OFFSETS}, m AS (SELECT DISTINCT case_id, concept_id, t, a, a + length(alias) AS b FROM hits
), sp AS (SELECT *, a - length(regexp_extract(substr(t, 1, a), '[^.!?\\n]*$')) AS s0, regexp_extract(substr(t, b + 1), '^[^.!?\\n]*(?:[.!?]+|$)') AS tail FROM m WHERE regexp_matches(substr(t, b + 1), '^[^.!?\\n]*(?:[.!?]+|$)')
), sides AS (SELECT case_id, concept_id, a, b AS z, s0, b + length(tail) AS e0, substr(t, s0 + 1, b + length(tail) - s0) AS evidence, lower(regexp_replace(substr(t, s0 + 1, a - s0), '[\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]', ' ', 'g')) AS b0,
  lower(regexp_replace(tail, '[\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]', ' ', 'g')) AS a0 FROM sp
), clauses AS (SELECT case_id, concept_id, a AS pos, z, s0, e0, evidence, right(regexp_extract(b0, '^(?s:.*(?:{assertions.CLAUSE}))?((?s:.*))$', 1), 100) AS b, left(regexp_extract(a0, '^(?s:(.*?))(?:(?:{assertions.CLAUSE})|$)', 1), 100) AS a FROM sides
), st AS (SELECT *, {_STATUS} AS status FROM clauses
), best AS (SELECT case_id, concept_id, arg_min({{'status': status, 'e': evidence, 's0': s0, 'e0': e0}}, (list_position([{STATUS_LIST}], status), pos, z)) AS x, bool_or(status = 'ruled_out') AS no FROM st GROUP BY 1, 2), diagnosed AS (SELECT case_id, concept_id, CASE WHEN x.status = 'confirmed' AND no THEN 'unclear' ELSE x.status END AS status, CASE WHEN x.status = 'confirmed' AND no THEN 'CONTRADICTORY_ASSERTIONS' WHEN x.status = 'confirmed' THEN 'EXPLICIT_ASSERTION' ELSE 'NOT_CONFIRMED' END AS reason,
  x.e AS evidence, x.s0::INT AS evidence_start, x.e0::INT AS evidence_end FROM best)"""


@query(f"WITH {_DIAGNOSED} SELECT * FROM diagnosed")
def diagnosed_concepts(spark: SparkSession, d: str) -> DataFrame:
    """The best assertion per case and concept, with its sentence and offsets."""
    texts = _distinct(spark, d, "cases", "case_id", "raw_case_text")
    return assertions.diagnose(texts, _mentions(spark, d), "case_id", "raw_case_text")


@query(f"""WITH s AS (SELECT case_id, diagnosis_status AS st FROM reviewer_a WHERE diagnosis_status IS NOT NULL UNION SELECT case_id, diagnosis_status FROM reviewer_b WHERE diagnosis_status IS NOT NULL)
  SELECT case_id, arg_min(st, coalesce(list_position([{STATUS_LIST}], st), 99)) AS best, bool_or(st = 'confirmed') AND bool_or(st = 'ruled_out') AS contradictory FROM s GROUP BY case_id""")
def status_argmin(spark: SparkSession, d: str) -> DataFrame:
    s = _distinct(spark, d, "reviewer_a", "case_id", "diagnosis_status").unionByName(_distinct(spark, d, "reviewer_b", "case_id", "diagnosis_status")).where("diagnosis_status is not null")
    st = F.col("diagnosis_status")
    return s.groupBy("case_id").agg(F.min_by(st, assertions.status_rank(st)).alias("best"), (F.bool_or(st == "confirmed") & F.bool_or(st == "ruled_out")).alias("contradictory"))


@query(r"""WITH q AS (SELECT DISTINCT t.case_id, t.clinical_text AS x, c.raw_case_text AS r FROM text_qc t JOIN (SELECT DISTINCT case_id, raw_case_text FROM cases) c USING (case_id))
  SELECT case_id, starts_with(r, x) AS is_prefix, len(regexp_extract_all(x, '[^\s\x{a0}\x{85}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')) AS words FROM q""")
def prefix_words(spark: SparkSession, d: str) -> DataFrame:
    q = _distinct(spark, d, "text_qc", "case_id", F.col("clinical_text").alias("x")).join(_distinct(spark, d, "cases", "case_id", F.col("raw_case_text").alias("r")), "case_id")
    return q.select("case_id", F.startswith("r", F.col("x")).alias("is_prefix"), text.word_count(F.col("x")).cast("long").alias("words"))


_WHITE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


@query(f"""WITH {_DIAGNOSED}, one AS (SELECT case_id, arg_min({{'e': evidence, 's': evidence_start}}, (list_position([{STATUS_LIST}], status), concept_id)) AS x FROM diagnosed GROUP BY 1
), src AS (SELECT c.case_id, c.t, x.e AS e, coalesce(x.s, length(c.t)) AS at0 FROM one JOIN texts c ON c.case_id = one.case_id
), cutp AS (SELECT case_id, t, at0, string_split(regexp_replace(t, '([^.!?\\n]+(?:[.!?]+|$))', chr(57344) || '\\1' || chr(57345), 'g'), chr(57345)) AS p FROM src
), pc AS (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM cutp
), spans AS (SELECT case_id, t, at0, coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x) - CASE WHEN contains(x, chr(57344)) THEN 1 ELSE 0 END)), 0)::BIGINT AS o, p[i] AS piece FROM pc WHERE contains(p[i], chr(57344))
), se AS (SELECT case_id, t, at0, o + instr(piece, chr(57344)) - 1 AS s0, o + length(piece) - 1 AS e0 FROM spans
), tells AS (SELECT case_id, min(s0) AS s0 FROM se WHERE s0 < at0 AND (regexp_matches(substr(t, s0 + 1, e0 - s0), '{"(?i)" + quality.AFTER_DIAGNOSIS[5:]}') OR EXISTS (SELECT 1 FROM hits h WHERE h.case_id = se.case_id AND h.a >= s0 AND h.a + length(h.alias) <= e0)) GROUP BY 1
), ends AS (SELECT src.case_id, src.t, src.e, coalesce(tells.s0, src.at0) AS z FROM src LEFT JOIN tells ON tells.case_id = src.case_id
), clin AS (SELECT *, regexp_replace(substr(t, 1, z), '^[{_WHITE}]+|[{_WHITE}]+$', '', 'g') AS x, regexp_replace(e, '^[{_WHITE}]+|[{_WHITE}]+$', '', 'g') AS q FROM ends)
SELECT case_id, sha256(x) AS clinical_text_sha256, z::INT AS clinical_source_end, CASE WHEN EXISTS (SELECT 1 FROM hits h WHERE h.case_id = clin.case_id AND h.a + length(h.alias) <= z) OR coalesce(q <> '' AND contains(x, q), false) THEN 'TEXT_LABEL_LEAKAGE'
  WHEN len(regexp_extract_all(x, '[^{_WHITE}]+')) < 30 THEN 'TEXT_TOO_SHORT' ELSE 'PASS' END AS reason FROM clin""")
def clinical_prefix(spark: SparkSession, d: str) -> DataFrame:
    """The source prefix that does not tell the diagnosis, cut anew from mentions, cues and evidence."""
    found = materialize(_mentions(spark, d), "mentions")
    best = assertions.diagnose(_distinct(spark, d, "cases", "case_id", "raw_case_text"), found, "case_id", "raw_case_text")
    one = records.first_by(best.select("case_id", "evidence", "evidence_start", assertions.status_rank(F.col("status")).alias("k"), "concept_id"), ["case_id"], [F.col("k"), F.col("concept_id")])
    rows = _distinct(spark, d, "cases", "case_id", "raw_case_text").join(one.drop("k", "concept_id"), "case_id").withColumn("title", F.lit(""))
    out = quality.clean_prefix(rows, found, "case_id")
    return out.select("case_id", F.sha2("clinical_text", 256).alias("clinical_text_sha256"), "clinical_source_end", "reason")


@query(r"""WITH i AS (SELECT DISTINCT s.case_id, s.image_id, s.caption, c.t FROM selected_images s JOIN (SELECT DISTINCT case_id, raw_case_text AS t FROM cases) c USING (case_id)
), w AS (SELECT case_id, image_id, regexp_extract_all(lower(caption), '[\p{L}\p{N}\p{M}\p{Pc}]+') AS c, array_to_string(regexp_extract_all(lower(t), '[\p{L}\p{N}\p{M}\p{Pc}]+'), ' ') AS t FROM i)
  SELECT case_id, image_id, coalesce(len(list_filter(range(1, greatest(1, len(c) - 2)), lambda k: contains(t, array_to_string(c[k:k+3], ' ')))) > 0, false) AS leaks FROM w""")
def caption_ngram_leak(spark: SparkSession, d: str) -> DataFrame:
    i = _distinct(spark, d, "selected_images", "case_id", "image_id", "caption").join(_distinct(spark, d, "cases", "case_id", F.col("raw_case_text").alias("t")), "case_id")
    return i.select("case_id", "image_id", text.shares_ngram(F.col("caption"), F.col("t"), 4).alias("leaks"))


@query("""SELECT DISTINCT case_id, ('0x' || substr(sha256(case_id || ':B'), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1 AS sampled FROM cases""")
def sample_fraction(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "cases", "case_id").select("case_id", records.sampled(F.col("case_id"), ":B", 0.1).alias("sampled"))


@query("""SELECT DISTINCT sample_id, sha256('{"case_id":' || to_json(case_id) || ',"label":' || coalesce(to_json(diagnosis_label), 'null') || ',"sample_id":' || to_json(sample_id) || '}') AS record_sha256 FROM manifest""")
def canonical_records(spark: SparkSession, d: str) -> DataFrame:
    j = text.canonical_json(sample_id=F.col("sample_id"), case_id=F.col("case_id"), label=F.col("diagnosis_label"))
    return table(spark, d, "manifest").select("sample_id", F.sha2(j, 256).alias("record_sha256")).distinct()


# Hierarchies


_EDGES = """edges AS (SELECT 's' || s_suppkey AS c, 'n' || s_nationkey AS p FROM supplier UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
  UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation), closure AS (SELECT c, p FROM edges UNION SELECT x.c, e.p FROM closure x JOIN edges e ON e.c = x.p)"""


def _hierarchy(spark: SparkSession, d: str) -> DataFrame:
    e = lambda t, c, p, cl, pl: table(spark, d, t).select(F.concat(F.lit(cl), F.col(c).cast("string")).alias("c"), F.concat(F.lit(pl), F.col(p).cast("string")).alias("p"))
    return ontology.ancestors(components.union_all([e("supplier", "s_suppkey", "s_nationkey", "s", "n"), e("customer", "c_custkey", "c_nationkey", "c", "n"), e("nation", "n_nationkey", "n_regionkey", "n", "r")]), "c", "p")


@query(f"WITH RECURSIVE {_EDGES} SELECT DISTINCT c AS node, p AS ancestor FROM closure")
def ontology_closure(spark: SparkSession, d: str) -> DataFrame:
    return _hierarchy(spark, d)


@query(f"WITH RECURSIVE {_EDGES} SELECT c AS node, bool_or(p IN ('r0', 'r3')) AND c <> 'n5' AS in_scope FROM closure GROUP BY c")
def scope_flags(spark: SparkSession, d: str) -> DataFrame:
    own = _hierarchy(spark, d).groupBy("node").agg(F.collect_set("ancestor").alias("a"))
    return own.select("node", ontology.in_scope(F.col("node"), F.col("a"), ["r0", "r3"], ["n5"]).alias("in_scope"))


@query(f"""WITH RECURSIVE {_EDGES}, m AS (SELECT n_regionkey AS g, 'n' || n_nationkey AS x FROM nation UNION SELECT n_regionkey, 'r' || n_regionkey FROM nation UNION SELECT 9, 'r' || r_regionkey FROM region)
  SELECT g, x FROM m WHERE NOT EXISTS (SELECT 1 FROM m o JOIN closure k ON k.c = o.x WHERE o.g = m.g AND k.p = m.x)""")
def most_specific(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    m = n.select(F.col("n_regionkey").alias("g"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("x"))
    m = m.unionByName(n.select(F.col("n_regionkey").alias("g"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("x")))
    m = m.unionByName(table(spark, d, "region").select(F.lit(9).alias("g"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("x")))
    return ontology.most_specific(m, _hierarchy(spark, d), "g", "x")


# Records


@query("""SELECT case_id, arg_max(record_sha256, (imported_at::TIMESTAMPTZ, record_sha256)) AS record_sha256 FROM human_label_adjudications GROUP BY case_id""")
def review_latest(spark: SparkSession, d: str) -> DataFrame:
    h = _distinct(spark, d, "human_label_adjudications", "case_id", "imported_at", "record_sha256")
    return records.latest_by(h, ["case_id"], [records.instant(F.col("imported_at")), F.col("record_sha256")]).select("case_id", "record_sha256")


@query(f"""SELECT case_id, image_id FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY coalesce(list_position({RELEVANCE}, image_relevance), 99), coalesce(list_position({MODALITIES}, image_modality), 99),
  coalesce(trim(caption) = '', true), -(width::BIGINT * height), image_id) AS r FROM (SELECT DISTINCT case_id, image_id, image_relevance, image_modality, caption, width, height FROM selected_images)) WHERE r = 1""")
def best_image(spark: SparkSession, d: str) -> DataFrame:
    i = _distinct(spark, d, "selected_images", "case_id", "image_id", "image_relevance", "image_modality", "caption", "width", "height")
    return records.best_images(i, RELEVANCE, MODALITIES).select("case_id", "image_id")


@query("SELECT DISTINCT case_id FROM cases WHERE case_id NOT IN (SELECT case_id FROM human_label_adjudications WHERE case_id IS NOT NULL)")
def review_pending(spark: SparkSession, d: str) -> DataFrame:
    return records.pending(_distinct(spark, d, "cases", "case_id"), table(spark, d, "human_label_adjudications"), ["case_id"])


@query("SELECT DISTINCT case_id FROM cases WHERE case_id NOT IN (SELECT case_id FROM reviewer_b WHERE case_id IS NOT NULL) ORDER BY case_id LIMIT 25")
def pending_top(spark: SparkSession, d: str) -> DataFrame:
    return records.first_pending(_distinct(spark, d, "cases", "case_id"), table(spark, d, "reviewer_b"), ["case_id"], 25)


@query(f"""SELECT DISTINCT a.case_id FROM reviewer_a a SEMI JOIN cases c ON c.case_id = a.case_id ANTI JOIN human_label_adjudications h ON h.case_id = a.case_id
  WHERE EXISTS (SELECT 1 FROM reviewer_b b WHERE b.case_id = a.case_id AND {_sql_decision("b.decision")} <> {_sql_decision("a.decision")})""")
def jobs_semi_anti(spark: SparkSession, d: str) -> DataFrame:
    """Cases on which the two reviewers differ and no person has decided."""
    a = table(spark, d, "reviewer_a").select("case_id", _decision(F.col("decision")).alias("x")).where("x is not null").distinct()
    b = table(spark, d, "reviewer_b").select("case_id", _decision(F.col("decision")).alias("y")).where("y is not null").distinct()
    torn = a.join(b, "case_id").where("x <> y").select("case_id").distinct()
    return records.pending(torn.join(_distinct(spark, d, "cases", "case_id"), "case_id", "left_semi"), table(spark, d, "human_label_adjudications"), ["case_id"])


_PAIRS = f"""pairs AS (SELECT a.x, b.y FROM (SELECT DISTINCT case_id, {_sql_decision("decision")} AS x FROM reviewer_a WHERE decision IS NOT NULL) a
  JOIN (SELECT DISTINCT case_id, {_sql_decision("decision")} AS y FROM reviewer_b WHERE decision IS NOT NULL) b USING (case_id))"""


def _decision_pairs(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "reviewer_a").where("decision is not null").select("case_id", _decision(F.col("decision")).alias("x")).distinct()
    b = table(spark, d, "reviewer_b").where("decision is not null").select("case_id", _decision(F.col("decision")).alias("y")).distinct()
    return a.join(b, "case_id")


@query(f"WITH {_PAIRS} SELECT x || ' / ' || y AS pair, count(*) AS n FROM pairs GROUP BY 1")
def decision_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _decision_pairs(spark, d).groupBy(F.concat_ws(" / ", "x", "y").alias("pair")).agg(F.count("*").alias("n"))


@query(f"""WITH {_PAIRS}, s AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (x = y)::DOUBLE AS k FROM pairs)
  SELECT n::BIGINT AS n, round(k / n, 6) AS rate,
  round((k / n + 1.959963984540054^2 / (2 * n)) / (1 + 1.959963984540054^2 / n) - 1.959963984540054 / (1 + 1.959963984540054^2 / n) * sqrt(k / n * (1 - k / n) / n + 1.959963984540054^2 / (4 * n * n)), 6) AS low,
  round((k / n + 1.959963984540054^2 / (2 * n)) / (1 + 1.959963984540054^2 / n) + 1.959963984540054 / (1 + 1.959963984540054^2 / n) * sqrt(k / n * (1 - k / n) / n + 1.959963984540054^2 / (4 * n * n)), 6) AS high FROM s""")
def agreement_wilson(spark: SparkSession, d: str) -> DataFrame:
    s = _decision_pairs(spark, d).agg(F.count("*").alias("n"), F.count_if(F.col("x") == F.col("y")).alias("k"))
    return s.select("n", *stats.wilson(F.col("k"), F.col("n")))


@query(f"""WITH {_PAIRS}, c AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (x = y) / count(*)::DOUBLE AS po FROM pairs), l AS (SELECT x AS v, count(*)::DOUBLE AS k FROM pairs GROUP BY 1), r AS (SELECT y AS v, count(*)::DOUBLE AS k FROM pairs GROUP BY 1),
  e AS (SELECT sum(l.k * r.k) AS s FROM l JOIN r USING (v)) SELECT n::BIGINT AS n, round(po, 6) AS agreement, round((po - s / (n * n)) / (1 - s / (n * n)), 6) AS kappa FROM c, e""")
def kappa(spark: SparkSession, d: str) -> DataFrame:
    return stats.cohen_kappa(_decision_pairs(spark, d), "x", "y")


@query("SELECT model, count(*) FILTER (processing_status = 'valid') AS valid, count(*) FILTER (processing_status <> 'valid') AS failed FROM (SELECT DISTINCT request_sha256, model, processing_status FROM medgemma_labels) GROUP BY model")
def progress_pivot(spark: SparkSession, d: str) -> DataFrame:
    p = _distinct(spark, d, "medgemma_labels", "request_sha256", "model", "processing_status").withColumn("state", F.when(F.col("processing_status") == "valid", "valid").otherwise("failed"))
    return p.groupBy("model").pivot("state", ["valid", "failed"]).count().fillna(0, ["valid", "failed"])


@query("SELECT reason, count(*) AS n FROM (SELECT DISTINCT case_id, reason FROM text_qc) GROUP BY reason")
def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "text_qc", "case_id", "reason").groupBy("reason").agg(F.count("*").alias("n"))


@query("""SELECT DISTINCT m.case_id, array_to_string(list_filter([CASE WHEN t.case_id IS NULL THEN 'NO_TEXT' END, CASE WHEN coalesce(NOT t.u, false) THEN 'TEXT_UNUSABLE' END, CASE WHEN i.case_id IS NULL THEN 'NO_IMAGE' END,
  CASE WHEN coalesce(i.lic, '') IN ('', 'UNKNOWN', 'NO-CC CODE') THEN 'LICENCE_UNKNOWN' END, CASE WHEN coalesce(g.c, false) THEN 'CONFLICT' END], lambda x: x IS NOT NULL), ';') AS reasons
  FROM (SELECT DISTINCT case_id FROM cases) m LEFT JOIN (SELECT case_id, bool_and(text_usable) AS u FROM text_qc GROUP BY 1) t USING (case_id) LEFT JOIN (SELECT case_id, max(license) AS lic FROM selected_images GROUP BY 1) i USING (case_id)
  LEFT JOIN (SELECT case_id, bool_or(duplicate_conflict) AS c FROM groups GROUP BY 1) g USING (case_id)""")
def readiness_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Left joins of a case with its text, image and group, and the ordered list of what is amiss."""
    t = table(spark, d, "text_qc").groupBy("case_id").agg(F.bool_and("text_usable").alias("u"), F.lit(True).alias("ht"))
    i = table(spark, d, "selected_images").groupBy("case_id").agg(F.max("license").alias("lic"), F.lit(True).alias("hi"))
    g = table(spark, d, "groups").groupBy("case_id").agg(F.bool_or("duplicate_conflict").alias("c"))
    j = _distinct(spark, d, "cases", "case_id").join(t, "case_id", "left").join(i, "case_id", "left").join(g, "case_id", "left")
    why = records.reasons((F.col("ht").isNull(), "NO_TEXT"), (~F.col("u"), "TEXT_UNUSABLE"), (F.col("hi").isNull(), "NO_IMAGE"), (F.coalesce("lic", F.lit("")).isin(UNKNOWN_LICENCES), "LICENCE_UNKNOWN"), (F.col("c"), "CONFLICT"))
    return j.select("case_id", F.array_join(why, ";").alias("reasons"))


@query("""SELECT DISTINCT m.sample_id, m.case_id, upper(trim(m.diagnosis_label)) AS label, c.raw_text_sha256, a.fold, g.split_group FROM manifest m JOIN (SELECT DISTINCT case_id, raw_text_sha256 FROM cases) c USING (case_id)
  JOIN (SELECT DISTINCT case_id, fold FROM assignments) a USING (case_id) LEFT JOIN (SELECT DISTINCT case_id, split_group FROM groups) g USING (case_id)""")
def single_targets(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").select("sample_id", "case_id", F.upper(F.trim("diagnosis_label")).alias("label")).distinct()
    return m.join(_distinct(spark, d, "cases", "case_id", "raw_text_sha256"), "case_id").join(_distinct(spark, d, "assignments", "case_id", "fold"), "case_id").join(_distinct(spark, d, "groups", "case_id", "split_group"), "case_id", "left").distinct()


@query("""SELECT coalesce(a.case_id, b.case_id) AS case_id, a.n AS by_a, b.n AS by_b FROM (SELECT case_id, count(DISTINCT model) AS n FROM reviewer_a GROUP BY 1) a
  FULL JOIN (SELECT case_id, count(DISTINCT reviewer_id) AS n FROM human_label_adjudications GROUP BY 1) b ON a.case_id = b.case_id""")
def reviews_full_outer(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "reviewer_a").groupBy("case_id").agg(F.count_distinct("model").alias("by_a"))
    b = table(spark, d, "human_label_adjudications").groupBy("case_id").agg(F.count_distinct("reviewer_id").alias("by_b"))
    return a.join(b, "case_id", "full_outer")


@query("""SELECT c.case_id, c.n_chars, i.images, h.history FROM (SELECT DISTINCT case_id, length(raw_case_text) AS n_chars FROM cases) c
  LEFT JOIN (SELECT case_id, string_agg(DISTINCT image_id, ',' ORDER BY image_id) AS images FROM selected_images GROUP BY 1) i USING (case_id)
  LEFT JOIN (SELECT case_id, string_agg(reviewer_id || '=' || human_decision, ';' ORDER BY record_sha256) AS history FROM (SELECT DISTINCT case_id, reviewer_id, human_decision, record_sha256 FROM human_label_adjudications) GROUP BY 1) h USING (case_id)""")
def wide_export(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "selected_images").groupBy("case_id").agg(F.array_join(F.array_sort(F.collect_set("image_id")), ",").alias("images"))
    h = _distinct(spark, d, "human_label_adjudications", "case_id", "reviewer_id", "human_decision", "record_sha256")
    one = F.concat(F.col("reviewer_id"), F.lit("="), F.col("human_decision"))
    listed = F.array_sort(F.collect_list(F.when(one.isNotNull(), F.struct("record_sha256", one.alias("v")))))
    h = h.groupBy("case_id").agg(listed.alias("l")).select("case_id", F.when(F.size("l") > 0, F.array_join("l.v", ";")).alias("history"))
    return table(spark, d, "cases").select("case_id", F.length("raw_case_text").cast("long").alias("n_chars")).distinct().join(i, "case_id", "left").join(h, "case_id", "left")


@query("""SELECT case_id, max(decision) AS decision FROM (SELECT DISTINCT case_id, decision FROM reviewer_b WHERE decision IS NOT NULL
  UNION SELECT DISTINCT case_id, decision FROM reviewer_a a WHERE decision IS NOT NULL AND NOT EXISTS (SELECT 1 FROM reviewer_b b WHERE b.case_id = a.case_id AND b.decision IS NOT NULL)) GROUP BY case_id""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda t: table(spark, d, t).where("decision is not null").groupBy("case_id").agg(F.max("decision").alias("decision"))
    return records.upsert(pick("reviewer_a"), pick("reviewer_b"), ["case_id"])


@query("SELECT record_sha256, min(case_id) AS case_id FROM human_label_adjudications GROUP BY record_sha256")
def append_if_new(spark: SparkSession, d: str) -> DataFrame:
    """Early imports, then all imports appended; a record that is there already is not added again."""
    h = table(spark, d, "human_label_adjudications").groupBy("record_sha256").agg(F.min("case_id").alias("case_id"), F.min("imported_at").alias("at"))
    return records.append_new(h.where("at < '2026-03'"), h, ["record_sha256"]).select("record_sha256", "case_id")


@query("SELECT DISTINCT case_id FROM text_qc INTERSECT SELECT DISTINCT case_id FROM selected_images EXCEPT SELECT DISTINCT case_id FROM manifest")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    k = lambda t: table(spark, d, t).select("case_id")
    return k("text_qc").intersect(k("selected_images")).subtract(k("manifest"))


@query("""SELECT DISTINCT reason, case_id FROM (SELECT 'NO_TEXT' AS reason, case_id FROM cases WHERE case_id NOT IN (SELECT case_id FROM text_qc) UNION ALL SELECT 'NO_IMAGE', case_id FROM cases WHERE case_id NOT IN (SELECT case_id FROM selected_images)
  UNION ALL SELECT 'CONFLICT', case_id FROM groups WHERE duplicate_conflict)""")
def quarantine_union(spark: SparkSession, d: str) -> DataFrame:
    c = _distinct(spark, d, "cases", "case_id")
    tag = lambda df, r: df.select(F.lit(r).alias("reason"), "case_id")
    return components.union_all([tag(records.pending(c, table(spark, d, "text_qc"), ["case_id"]), "NO_TEXT"), tag(records.pending(c, table(spark, d, "selected_images"), ["case_id"]), "NO_IMAGE"), tag(table(spark, d, "groups").where("duplicate_conflict"), "CONFLICT")]).distinct()


@query("SELECT DISTINCT license, image_modality FROM selected_images")
def licence_ledger(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "selected_images", "license", "image_modality")


# Groups and splits


_DUP = """keys AS (SELECT DISTINCT case_id AS v, 't' || raw_text_sha256 AS k FROM cases UNION SELECT case_id, 'i' || lower(trim(image_sha256)) FROM selected_images WHERE trim(image_sha256) <> ''
), edges AS (SELECT DISTINCT x.v AS a, y.v AS b FROM keys x JOIN keys y ON x.k = y.k AND x.v <> y.v), chain(node, seen) AS (SELECT a, a FROM edges UNION SELECT c.node, e.b FROM chain c JOIN edges e ON e.a = c.seen
), roots AS (SELECT node, min(seen) AS root FROM chain GROUP BY node)"""


def _duplicates(spark: SparkSession, d: str) -> DataFrame:
    t = components.key_edges(table(spark, d, "cases"), "case_id", ["raw_text_sha256"])
    i = table(spark, d, "selected_images").withColumn("sha", F.lower(F.trim("image_sha256")))
    return components.components(t.unionByName(components.key_edges(i, "case_id", ["sha"])))


@query(f"WITH RECURSIVE {_DUP} SELECT node, root FROM roots")
def duplicate_components(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(spark, d)


@query(f"""WITH RECURSIVE {_DUP} SELECT root, count(DISTINCT node) AS size, string_agg(DISTINCT upper(trim(m.diagnosis_label)), ',' ORDER BY upper(trim(m.diagnosis_label))) AS labels, count(DISTINCT upper(trim(m.diagnosis_label))) > 1 AS conflict
  FROM roots LEFT JOIN manifest m ON m.case_id = roots.node GROUP BY root""")
def duplicate_conflicts(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "manifest").select(F.col("case_id").alias("node"), F.upper(F.trim("diagnosis_label")).alias("label")).distinct()
    out = components.group_report(_duplicates(spark, d), labels, "node", "root", "label")
    return out.select("root", "size", F.when(F.size("labels") > 0, F.array_join("labels", ",")).alias("labels"), "conflict")


@query(f"WITH RECURSIVE {_DUP} SELECT root, sha256(string_agg(node, chr(10) ORDER BY node)) AS group_id FROM roots GROUP BY root")
def group_ids(spark: SparkSession, d: str) -> DataFrame:
    return components.group_id(_duplicates(spark, d), "root", "node")


_HASHES = """h AS (SELECT DISTINCT case_id, ('0x' || ph)::UBIGINT AS v FROM (SELECT case_id, lpad(regexp_replace(lower(trim(perceptual_hash)), '^0x', ''), 16, '0') AS ph FROM selected_images WHERE perceptual_hash IS NOT NULL)
  WHERE regexp_matches(ph, '^[0-9a-f]{16}$') AND regexp_matches(ph, '[1-9a-f]')), f AS (SELECT v, min(case_id) AS r FROM h GROUP BY v)"""


def _near_hashes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    h = F.lpad(F.regexp_replace(F.lower(F.trim("perceptual_hash")), "^0x", ""), 16, "0")
    rows = table(spark, d, "selected_images").select("case_id", F.when(h.rlike("^[0-9a-f]{16}$") & h.rlike("[1-9a-f]"), h).alias("h")).where("h is not null")
    bits = F.shiftleft(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), 32).bitwiseOR(F.conv(F.substring("h", 9, 8), 16, 10).cast("long"))
    return components.near_hashes(rows, "case_id", bits, 4)


@query(f"WITH {_HASHES} SELECT DISTINCT least(a.r, b.r) AS a, greatest(a.r, b.r) AS b, bit_count(xor(a.v, b.v))::INT AS distance FROM f a JOIN f b ON a.v < b.v AND bit_count(xor(a.v, b.v)) <= 4")
def near_hash_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of distinct hashes within four bits, each known by its smallest case; hash_members tells the other cases."""
    return _near_hashes(spark, d)[0].distinct()


@query(f"WITH {_HASHES} SELECT case_id, r AS representative FROM h JOIN f USING (v)")
def hash_members(spark: SparkSession, d: str) -> DataFrame:
    return _near_hashes(spark, d)[1]


@query("""SELECT upper(trim(m.diagnosis_label)) AS label, count(DISTINCT m.case_id) AS cases, count(DISTINCT coalesce(g.split_group, m.case_id)) AS groups, count(DISTINCT m.case_id) >= 30 AND count(DISTINCT coalesce(g.split_group, m.case_id)) >= 30 AS enough
  FROM manifest m LEFT JOIN (SELECT DISTINCT case_id, split_group FROM groups) g USING (case_id) WHERE m.diagnosis_label IS NOT NULL GROUP BY 1""")
def class_support(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").where("diagnosis_label is not null").select("case_id", F.upper(F.trim("diagnosis_label")).alias("label"))
    g = m.join(_distinct(spark, d, "groups", "case_id", "split_group"), "case_id", "left").groupBy("label").agg(F.count_distinct("case_id").alias("cases"), F.count_distinct(F.coalesce("split_group", "case_id")).alias("groups"))
    return g.withColumn("enough", (F.col("cases") >= 30) & (F.col("groups") >= 30))


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").where("diagnosis_label is not null").select("case_id", F.upper(F.trim("diagnosis_label")).alias("label")).distinct()
    return m.join(_distinct(spark, d, "groups", "case_id", "split_group"), "case_id", "left").select("case_id", "label", F.coalesce("split_group", "case_id").alias("grp"))


def _large_classes(spark: SparkSession, d: str) -> DataFrame:
    """The grouped cases of labels that have the six groups a test part and five folds need."""
    g = materialize(_grouped(spark, d), "grouped")
    enough = g.groupBy("label").agg(F.count_distinct("grp").alias("n")).where("n >= 6").select("label")
    return g.join(enough, "label", "left_semi")


@query()
def split_greedy(spark: SparkSession, d: str) -> DataFrame:
    return splits.greedy_split(_large_classes(spark, d), "grp", "label")


_GROUPS = """g AS (SELECT DISTINCT coalesce(g.split_group, m.case_id) AS grp, upper(trim(m.diagnosis_label)) AS label FROM manifest m LEFT JOIN (SELECT DISTINCT case_id, split_group FROM groups) g USING (case_id) WHERE m.diagnosis_label IS NOT NULL)"""


@query(f"WITH {_GROUPS} SELECT label, count(*) AS groups, true AS whole, true AS in_all, true AS near_target FROM g GROUP BY label HAVING count(*) >= 6")
def split_greedy_check(spark: SparkSession, d: str) -> DataFrame:
    """Of each label its groups, whether they are whole, in the test part and every fold, and near the test share (a fifth, half a group's slack for small labels)."""
    rows = materialize(_large_classes(spark, d), "classes")
    split = materialize(splits.greedy_split(rows, "grp", "label"), "split")
    torn = split.groupBy("grp").agg(F.count("*").alias("k")).where("k > 1")
    bad = splits.split_problems(split, rows, "grp", "label", 5)
    own = rows.select("grp", "label").distinct().join(split, "grp").join(torn, "grp", "left")
    per = own.groupBy("label").agg(F.count("*").alias("groups"), F.count_if(F.col("partition") == "test").alias("t"), (F.count("k") == 0).alias("whole")).join(bad, "label", "left")
    near = F.abs(F.col("t") - F.col("groups") * 0.2) <= F.greatest(F.lit(2.0), F.col("groups") * 0.05)
    return per.select("label", "groups", "whole", F.col("problem").isNull().alias("in_all"), near.alias("near_target"))


_GROUPED = """g AS (SELECT DISTINCT coalesce(g.split_group, m.case_id) AS grp, upper(trim(m.diagnosis_label)) AS label FROM manifest m LEFT JOIN (SELECT DISTINCT case_id, split_group FROM groups) g USING (case_id) WHERE m.diagnosis_label IS NOT NULL)"""


@query(f"""WITH {_GROUPED} SELECT DISTINCT grp, CASE WHEN ('0x' || substr(sha256('42:' || grp), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.8 THEN 'development' ELSE 'test' END AS partition FROM g""")
def split_hash(spark: SparkSession, d: str) -> DataFrame:
    return splits.hash_split(_grouped(spark, d), "grp", {"development": 0.8, "test": 0.2})


@query(f"WITH {_GROUPED} SELECT grp, label, ((row_number() OVER (PARTITION BY label ORDER BY sha256('42:' || grp), grp) - 1) % 5)::INT AS fold FROM g")
def split_hash_rank(spark: SparkSession, d: str) -> DataFrame:
    return splits.hash_folds(_grouped(spark, d), "grp", "label", 5)


_PART = "replace(lower(trim(partition)), '-', '_')"


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, count(*) AS n FROM (SELECT {f} FROM assignments WHERE {f} IS NOT NULL GROUP BY {f} HAVING count(DISTINCT {_PART}) > 1)" for f in ("case_id", "article_id", "split_group", "raw_text_sha256", "clinical_text_sha256")))
def partition_overlap(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "assignments").withColumn("part", F.translate(F.lower(F.trim("partition")), "-", "_"))
    return splits.overlaps(a, ["case_id", "article_id", "split_group", "raw_text_sha256", "clinical_text_sha256"], "part")


@query("""WITH a AS (SELECT DISTINCT upper(trim(diagnosis_label)) AS label, fold FROM assignments WHERE fold IS NOT NULL AND diagnosis_label IS NOT NULL) SELECT l.label, f.fold FROM (SELECT DISTINCT label FROM a) l CROSS JOIN (SELECT DISTINCT fold FROM a) f
  WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.label = l.label AND a.fold = f.fold)""")
def class_coverage(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "assignments").where("fold is not null and diagnosis_label is not null").select(F.upper(F.trim("diagnosis_label")).alias("label"), "fold").distinct()
    return splits.uncovered(a, "label", "fold")


@query("""WITH m AS (SELECT DISTINCT m.sample_id, m.case_id, m.diagnosis_label, m.image_sha256, c.case_id AS c, t.u, i.sha FROM manifest m LEFT JOIN (SELECT DISTINCT case_id FROM cases) c USING (case_id)
  LEFT JOIN (SELECT case_id, bool_and(text_usable) AS u FROM text_qc GROUP BY 1) t USING (case_id) LEFT JOIN (SELECT case_id, max(lower(trim(image_sha256))) AS sha FROM selected_images GROUP BY 1) i USING (case_id))
  SELECT code, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN c IS NULL THEN 'MISSING_CASE' END, CASE WHEN diagnosis_label IS NULL THEN 'LABEL_MISSING' END, CASE WHEN NOT coalesce(u, false) THEN 'TEXT_NOT_USABLE' END,
  CASE WHEN coalesce(sha, '') <> coalesce(lower(trim(image_sha256)), '') THEN 'IMAGE_HASH_MISMATCH' END], lambda x: x IS NOT NULL)) AS code FROM m) GROUP BY code""")
def gate_error_counts(spark: SparkSession, d: str) -> DataFrame:
    m = _distinct(spark, d, "manifest", "sample_id", "case_id", "diagnosis_label", "image_sha256")
    j = m.join(_distinct(spark, d, "cases", "case_id", F.lit(True).alias("c")), "case_id", "left")
    j = j.join(table(spark, d, "text_qc").groupBy("case_id").agg(F.bool_and("text_usable").alias("u")), "case_id", "left")
    j = j.join(table(spark, d, "selected_images").groupBy("case_id").agg(F.max(F.lower(F.trim("image_sha256"))).alias("sha")), "case_id", "left")
    none = F.lit("")
    codes = records.reasons((F.col("c").isNull(), "MISSING_CASE"), (F.col("diagnosis_label").isNull(), "LABEL_MISSING"), (~F.coalesce("u", F.lit(False)), "TEXT_NOT_USABLE"), (F.coalesce("sha", none) != F.coalesce(F.lower(F.trim("image_sha256")), none), "IMAGE_HASH_MISMATCH"))
    return j.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


# Relational shapes over the star schema


@query("""SELECT o_orderpriority AS priority, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R') GROUP BY 1""")
def orders_semi_join(spark: SparkSession, d: str) -> DataFrame:
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(returned, "o_orderkey", "left_semi").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT CASE WHEN n = 1 THEN 'SINGLE_TARGET' WHEN n > 1 THEN 'MULTI_TARGET' ELSE 'NO_TARGET' END AS route, count(*) AS n FROM (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS n FROM lineitem GROUP BY 1) GROUP BY 1""")
def routing_orders(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "A").alias("k"))
    return k.select(records.ladder((F.col("k") == 1, "SINGLE_TARGET"), (F.col("k") > 1, "MULTI_TARGET"), otherwise="NO_TARGET").alias("route")).groupBy("route").agg(F.count("*").alias("n"))


@query("SELECT user_id, max(event_id) AS event_id FROM (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id) GROUP BY user_id")
def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user, kept by a streaming merge over the events file."""
    import uuid

    from caseloom.streaming.latest import maintain_latest, read_latest

    source = f"{d}/events.parquet"
    schema = spark.read.parquet(source).schema
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    folder, glob = source.rsplit("/", 1)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    maintain_latest(stream.select("user_id", "event_id", "ts"), base + "/table", base + "/state", ["user_id"], ["ts", "event_id"])
    return read_latest(spark, base + "/table").select("user_id", "event_id")


@query("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
