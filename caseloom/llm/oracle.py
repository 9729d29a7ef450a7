"""SQL for the queries that SQL can express, for DuckDB over the same tables."""

from caseloom.llm import consensus
from caseloom.llm.lookalike import CHARACTER_MAP, LIGATURES

_TOKENS = r"""regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+')"""
_STRIP = "regexp_replace(regexp_replace({}, '^\\s+', ''), '\\s+$', '')"

_CHAIN = """, chain(node, seen) AS (
  SELECT node, node FROM (SELECT a AS node FROM edges UNION SELECT b FROM edges)
  UNION
  SELECT c.node, e.b FROM chain c JOIN both_ways e ON e.a = c.seen
), lowest AS (SELECT node, min(seen) AS root FROM chain GROUP BY node)
"""



def _same_form(x: str) -> str:
    """The canonical form of the SQL string expression ``x``: mapping, composition, single blanks."""
    single = {c: r for c, r in CHARACTER_MAP.items() if len(r) == 1 and c}
    gone = "".join(chr(c) for c, r in CHARACTER_MAP.items() if r == "" and c)
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    out = f"translate({x}, {quoted(''.join(map(chr, single)) + gone)}, {quoted(''.join(single.values()))})"
    for a, b in LIGATURES.items():
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim(regexp_replace(nfc_normalize({out}), ' +', ' ', 'g'))"


_VOTES = """
WITH r AS (
  SELECT case_id, 'a:' || model AS annotator, decision, raw_text_sha256, reviewed_at FROM reviewer_a
  UNION ALL SELECT case_id, 'b:' || model, decision, raw_text_sha256, reviewed_at FROM reviewer_b
  UNION ALL SELECT case_id, 'm:' || model, decision, raw_text_sha256, reviewed_at FROM medgemma_labels
  UNION ALL SELECT case_id, 'h:' || lower(trim(reviewer_id)), human_decision, raw_text_sha256, reviewed_at FROM human_label_adjudications
), d AS (
  SELECT r.*, CASE lower(trim(decision)) WHEN 'accept' THEN 0 WHEN 'accepted' THEN 0 WHEN 'reject' THEN 1 WHEN 'rejected' THEN 1 WHEN 'uncertain' THEN 2 END AS vote
  FROM r JOIN (SELECT DISTINCT case_id, raw_text_sha256 FROM cases) USING (case_id, raw_text_sha256) WHERE annotator IS NOT NULL
), v AS (
  SELECT case_id, annotator, arg_max(vote, (coalesce(try_cast(reviewed_at AS TIMESTAMPTZ), '0001-01-01'::TIMESTAMPTZ), vote)) AS vote FROM d WHERE vote IS NOT NULL GROUP BY 1, 2
)"""
#: The vector by a dense matrix of all pairs of annotators, as many rounds as the operator takes.
_SPECTRAL = (
    _VOTES.replace("WITH r AS", "WITH RECURSIVE r AS")
    + f""", tot AS (SELECT annotator, count(*)::DOUBLE AS total, avg((vote = 0)::INT) AS c0, avg((vote = 1)::INT) AS c1, avg((vote = 2)::INT) AS c2 FROM v GROUP BY 1
), pairs AS (SELECT x.annotator AS a, y.annotator AS b, count(*)::DOUBLE AS n, sum((x.vote = y.vote)::INT)::DOUBLE AS same FROM v x JOIN v y ON x.case_id = y.case_id AND x.annotator <> y.annotator GROUP BY 1, 2
), mat AS (SELECT p.a, p.b, p.n, p.same - p.n * (x.c0 * y.c0 + x.c1 * y.c1 + x.c2 * y.c2) AS num FROM pairs p JOIN tot x ON x.annotator = p.a JOIN tot y ON y.annotator = p.b
), power AS (
  SELECT 0 AS i, annotator, 0.7::DOUBLE AS v, 0.49::DOUBLE AS usual, 1.0::DOUBLE AS moved FROM tot
  UNION ALL
  SELECT i + 1, annotator, old * {consensus.KEPT} + step * sqrt(sqrt(avg(old * old) OVER () / avg(step * step) OVER ())) * (1 - {consensus.KEPT}), sqrt(avg(old * old) OVER () * avg(step * step) OVER ()), max(abs(step - old)) OVER ()
  FROM (
    SELECT o.i, o.annotator, o.v AS old, (coalesce(sum(m.num * r.v), 0) / (coalesce(sum(m.n * r.v * r.v), 0) + {consensus.PRIOR_WEIGHT} * o.usual + 1e-9)) AS step
    FROM power o LEFT JOIN mat m ON m.a = o.annotator LEFT JOIN power r ON r.annotator = m.b WHERE o.moved >= {consensus.CLOSE} AND o.i < {consensus.ROUNDS} GROUP BY 1, 2, 3, o.usual
  )
), last AS (SELECT p.annotator, p.v, t.total, t.c0, t.c1, t.c2 FROM power p JOIN tot t USING (annotator) WHERE i = (SELECT max(i) FROM power)
), w AS (SELECT sum(greatest(v, 0) ^ 2 * total) AS w, sum(greatest(v, 0) ^ 2 * total * c0) AS r0, sum(greatest(v, 0) ^ 2 * total * c1) AS r1, sum(greatest(v, 0) ^ 2 * total * c2) AS r2 FROM last
), prior AS (SELECT r0 / w AS r0, r1 / w AS r1, r2 / w AS r2 FROM w
), rel AS (SELECT annotator, least(0.98, greatest(0.02, (1 + 2 * v / sqrt(greatest(1e-6, 1 - r0 * r0 - r1 * r1 - r2 * r2))) / 3)) AS p FROM last, prior
), score AS (SELECT case_id, count(*) AS votes, """
    + ", ".join(f"coalesce(sum(ln(2 * p / (1 - p))) FILTER (vote = {k}), 0) + any_value(ln(greatest(r{k}, 1e-6))) AS s{k}, count(*) FILTER (vote = {k}) AS m{k}" for k in range(3))
    + """ FROM v JOIN rel USING (annotator), prior GROUP BY 1
), decided AS (SELECT case_id, votes, CASE WHEN votes > 1 THEN (m0 * (m0 - 1) + m1 * (m1 - 1) + m2 * (m2 - 1))::DOUBLE / (votes * (votes - 1)) END AS agreement,
  CASE greatest(s0, s1, s2) WHEN s0 THEN 'accept' WHEN s1 THEN 'reject' ELSE 'uncertain' END AS consensus_decision,
  round(1 / (exp(s0 - greatest(s0, s1, s2)) + exp(s1 - greatest(s0, s1, s2)) + exp(s2 - greatest(s0, s1, s2))), 6) AS confidence FROM score)"""
)
_MATCHES = (
    """WITH RECURSIVE img AS (
  SELECT DISTINCT case_id, lower(trim(image_sha256)) AS sha,
    lpad(regexp_replace(lower(trim(perceptual_hash)), '^0x', ''), 16, '0') AS ph
  FROM selected_images
), bits AS (
  SELECT case_id, ('0x' || ph)::UBIGINT AS v FROM img WHERE regexp_matches(ph, '^[0-9a-f]{16}$') AND regexp_matches(ph, '[1-9a-f]')
), edges AS (
  SELECT x.case_id AS a, y.case_id AS b FROM img x JOIN img y ON x.sha = y.sha AND x.case_id < y.case_id WHERE regexp_matches(x.sha, '[^0]')
  UNION
  SELECT x.case_id, y.case_id FROM groups x JOIN groups y ON x.split_group = y.split_group AND x.case_id < y.case_id WHERE regexp_matches(trim(x.split_group), '[^0]')
  UNION
  SELECT least(x.case_id, y.case_id), greatest(x.case_id, y.case_id) FROM bits x JOIN bits y ON x.case_id < y.case_id AND bit_count(xor(x.v, y.v)) <= 4
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges)"""
    + _CHAIN
)
_SHINGLES = f"""t AS (
  SELECT DISTINCT case_id, 'raw' AS field, lower({_same_form('raw_case_text')}) AS x FROM cases WHERE raw_case_text IS NOT NULL
  UNION SELECT DISTINCT case_id, 'clinical', lower({_same_form('clinical_text')}) FROM text_qc WHERE clinical_text IS NOT NULL
), w AS (SELECT case_id, field, regexp_extract_all(x, '[\\p{{L}}\\p{{N}}]+') AS w FROM t
), s AS (SELECT DISTINCT case_id, field, unnest(list_transform(range(1, greatest(1, len(w) - 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS tok FROM w
), n AS (SELECT case_id, field, count(*) AS n FROM s GROUP BY 1, 2
), c AS (SELECT field, a.case_id AS x, b.case_id AS y, count(*) AS c FROM s a JOIN s b USING (field, tok) WHERE a.case_id < b.case_id GROUP BY 1, 2, 3
), alike AS (SELECT c.field, c.x, c.y FROM c JOIN n p ON p.field = c.field AND p.case_id = c.x JOIN n q ON q.field = c.field AND q.case_id = c.y WHERE 5 * c.c >= 3 * (p.n + q.n - c.c))"""

_EQUAL = """equal AS (SELECT DISTINCT case_id, 'raw' AS field, raw_case_text AS text FROM cases WHERE raw_case_text IS NOT NULL UNION SELECT DISTINCT case_id, 'clinical', clinical_text FROM text_qc WHERE clinical_text IS NOT NULL)"""

SQL = {
    "p3_found": f"""
WITH pairs AS (
  SELECT m.request_sha256, m.evidence_quote AS q, c.raw_case_text AS t FROM medgemma_labels m JOIN cases c USING (case_id)
  WHERE m.evidence_quote <> '' AND NOT contains(c.raw_case_text, m.evidence_quote)
), same AS (SELECT request_sha256, {_same_form('q')} AS q, {_same_form('t')} AS t FROM pairs)
SELECT DISTINCT request_sha256 FROM same WHERE q <> '' AND contains(t, q)""",
    "p3_canonical": f"SELECT DISTINCT case_id, {_same_form('raw_case_text')} AS text FROM cases",
    "p4_found": f"WITH {_SHINGLES} SELECT DISTINCT x AS case_id_a, y AS case_id_b FROM alike",
    "p4_classes": f"""WITH {_SHINGLES}, both_ways AS (SELECT field, x, y FROM alike UNION SELECT field, y, x FROM alike), k AS (SELECT field, x, count(*) AS links FROM both_ways GROUP BY 1, 2), {_EQUAL}
SELECT e.case_id, e.field, min(e.case_id) OVER (PARTITION BY e.field, e.text) AS class, coalesce(k.links, 0) AS links FROM equal e LEFT JOIN k ON k.field = e.field AND k.x = e.case_id""",
    "p4_groups": f"""WITH RECURSIVE {_SHINGLES}, {_EQUAL}, same AS (SELECT field, text, min(case_id) AS a FROM equal GROUP BY 1, 2
), links AS (SELECT field, x AS a, y AS b FROM alike UNION SELECT e.field, s.a, e.case_id FROM equal e JOIN same s ON s.field = e.field AND s.text = e.text AND s.a <> e.case_id
), both_ways AS (SELECT field, a, b FROM links UNION SELECT field, b, a FROM links),
chain(field, node, seen) AS (SELECT DISTINCT field, case_id, case_id FROM equal UNION SELECT c.field, c.node, e.b FROM chain c JOIN both_ways e ON e.a = c.seen AND e.field = c.field)
SELECT node AS case_id, field, min(seen) AS "group" FROM chain GROUP BY field, node""",
    "p1_found": _MATCHES + "SELECT root AS group_case_id, node AS case_id FROM lowest WHERE root <> node",
    "p1_groups": _MATCHES
    + """, every AS (SELECT case_id FROM selected_images UNION SELECT case_id FROM groups)
SELECT e.case_id, coalesce(l.root, e.case_id) AS group_case_id FROM every e LEFT JOIN lowest l ON l.node = e.case_id WHERE e.case_id IS NOT NULL""",
    "p2_agreement": f"""
{_VOTES}, k AS (SELECT case_id, vote, count(*) AS m FROM v GROUP BY 1, 2
), s AS (SELECT case_id, sum(m)::BIGINT AS votes, sum(m * (m - 1))::DOUBLE AS alike FROM k GROUP BY 1)
SELECT case_id, votes, CASE WHEN votes > 1 THEN round(alike / (votes * (votes - 1)), 6) END AS agreement,
  votes >= 3 AND alike < votes * (votes - 1) AS contested FROM s""",
    "p2_found": f"{_SPECTRAL} SELECT case_id, consensus_decision FROM decided WHERE votes >= 3 AND agreement < 1",
    "p2_reliability": f"""{_SPECTRAL}, q AS (SELECT case_id, {", ".join(f"exp(s{k} - greatest(s0, s1, s2)) / (exp(s0 - greatest(s0, s1, s2)) + exp(s1 - greatest(s0, s1, s2)) + exp(s2 - greatest(s0, s1, s2))) AS q{k}" for k in range(3))} FROM score)
SELECT annotator, count(*) AS votes, round(any_value(p), 6) AS reliability, {", ".join(f"round((coalesce(sum(q{k}) FILTER (vote = {k}), 0) + {consensus.PRIOR_ROWS} * any_value(p)) / (sum(q{k}) + {consensus.PRIOR_ROWS}), 6) AS right_{d}" for k, d in enumerate(consensus.DECISIONS))}
FROM v JOIN q USING (case_id) JOIN rel USING (annotator) GROUP BY annotator""",
    "p2_consensus": f"{_SPECTRAL} SELECT case_id, votes, round(agreement, 6) AS agreement, consensus_decision, confidence FROM decided",
    "p5_found": """
SELECT DISTINCT t.diagnosis_label, t.fold FROM sample_targets t LEFT JOIN (
  SELECT upper(trim(m.diagnosis_label)) AS label, a.fold, count(DISTINCT m.sample_id) AS n
  FROM manifest m JOIN (SELECT DISTINCT case_id, fold FROM assignments) a ON a.case_id = m.case_id GROUP BY 1, 2
) h ON h.label = upper(trim(t.diagnosis_label)) AND h.fold = t.fold
WHERE coalesce(h.n, 0) < greatest(t.target_rows, t.min_rows)""",
    "p5_shortfalls": """
WITH t AS (SELECT diagnosis_label, fold, upper(trim(diagnosis_label)) AS label FROM sample_targets
), w AS (SELECT upper(trim(diagnosis_label)) AS label, fold, max(greatest(target_rows, min_rows)) AS wanted FROM sample_targets GROUP BY 1, 2
), h AS (
  SELECT upper(trim(m.diagnosis_label)) AS label, a.fold, count(DISTINCT m.sample_id) AS n
  FROM manifest m JOIN (SELECT DISTINCT case_id, fold FROM assignments) a ON a.case_id = m.case_id GROUP BY 1, 2
)
SELECT DISTINCT t.diagnosis_label, t.fold, coalesce(h.n, 0) AS available, w.wanted, greatest(0, w.wanted - coalesce(h.n, 0)) AS shortfall, true AS floor_kept
FROM t JOIN w USING (label, fold) LEFT JOIN h USING (label, fold)""",
    "p6_found": """
WITH RECURSIVE own AS (
  SELECT DISTINCT case_id, article_id, lower(trim(patient_link_id)) AS link FROM cases
), keys AS (
  SELECT case_id, 'a' || article_id AS k FROM own WHERE article_id IS NOT NULL
  UNION SELECT case_id, 'p' || link FROM own WHERE regexp_matches(link, '[a-z0-9]') AND link NOT IN
    ('unknown', 'none', 'n/a', 'na', 'n.a.', 'nil', 'null', 'nan', 'unk', 'missing', 'not available', 'not applicable', 'not known', 'not recorded', 'undefined', 'tbd')
  UNION SELECT case_id, 'g' || split_group FROM groups WHERE split_group IS NOT NULL AND case_id IN (SELECT case_id FROM cases)
), stars AS (SELECT k, min(case_id) AS a FROM keys GROUP BY k
), edges AS (SELECT DISTINCT s.a, keys.case_id AS b FROM stars s JOIN keys USING (k) WHERE s.a <> keys.case_id
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges)"""
    + _CHAIN
    + """, placed AS (
  SELECT DISTINCT p.case_id, l.root, replace(lower(trim(p.partition)), '-', '_') AS part FROM assignments p JOIN lowest l ON l.node = p.case_id
) SELECT DISTINCT case_id FROM placed WHERE root IN (SELECT root FROM placed GROUP BY root HAVING count(DISTINCT part) > 1)""",
    "p6_check": """
SELECT split_name, (SELECT count(DISTINCT case_id) FROM cases) AS cases, (SELECT count(DISTINCT case_id) FROM cases) AS distinct_cases,
  true AS near_target, 0::BIGINT AS torn FROM split_targets""",
    "p7_check": f"""
WITH s AS (SELECT DISTINCT doc_id, len({_TOKENS.format('text')}) AS t FROM documents WHERE doc_id IS NOT NULL)
SELECT count(*) AS documents, sum(coalesce(t, 0))::BIGINT AS tokens, count(*) FILTER (t > (SELECT max(capacity_tokens) FROM pack_limits)) AS in_pieces,
  0::BIGINT AS wrongly_cut, 0::BIGINT AS overfull FROM s""",
    "p7_found": f"SELECT DISTINCT doc_id FROM documents WHERE len({_TOKENS.format('text')}) > (SELECT max(capacity_tokens) FROM pack_limits)",
    "p8_found": f"""
WITH sized AS (SELECT lower(trim(source)) AS s, len({_TOKENS.format('text')}) AS n FROM (SELECT DISTINCT * FROM documents)
), have AS (SELECT s, sum(n) AS n FROM sized GROUP BY s)
SELECT DISTINCT t.source FROM mix_targets t LEFT JOIN have h ON h.s = lower(trim(t.source))
WHERE t.max_repeats * coalesce(h.n, 0) < t.target_share * (SELECT sum(n) FROM sized)""",
    "p8_check": f"""
WITH sized AS (SELECT lower(trim(source)) AS s, len({_TOKENS.format('text')}) AS n FROM (SELECT DISTINCT * FROM documents)
), have AS (SELECT s, sum(n) AS n FROM sized GROUP BY s)
SELECT t.source, coalesce(h.n, 0)::BIGINT AS available_tokens, round(t.target_share * (SELECT sum(n) FROM sized))::BIGINT AS target_tokens,
  t.max_repeats * coalesce(h.n, 0) >= t.target_share * (SELECT sum(n) FROM sized) AS filled, true AS allowed, true AS near_target
FROM (SELECT source, max(target_share) AS target_share, max(max_repeats) AS max_repeats FROM mix_targets GROUP BY source) t LEFT JOIN have h ON h.s = lower(trim(t.source))""",
}
