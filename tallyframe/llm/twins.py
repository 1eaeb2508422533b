"""SQL twins of corpus queries, for DuckDB. Written from the definitions of the results, not from the operators."""

from __future__ import annotations

from tallyframe.llm import quality_rules

_BLANKS = r"[ \t\n\v\f\r]"
_WORDS = r"[^ \t\n\v\f\r]+"


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: one step for each bit, the low one first."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce({bits}, {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages), m AS (SELECT *, strlen(payload) AS n, max(page_id) OVER (PARTITION BY payload) AS best FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest, CASE WHEN n < 1000 OR best IS NULL OR page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n >= 1000 AND best IS NOT NULL AND page_id IS DISTINCT FROM best THEN best END AS refers_to FROM m"""

JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_low("text")}, '{_WORDS}') AS w FROM documents),
cut AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM cut), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 90 * (x.n + y.n - met)),
reach AS (SELECT doc_id, doc_id AS seen FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.seen = l.a)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(seen) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

_RUNS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAMINATION = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_low("text")}, '{_RUNS}') AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_low("text")}, '{_RUNS}') AS w FROM benchmark),
cut AS (SELECT item, w, least(len(w), 13) AS m, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM cut), sizes AS (SELECT DISTINCT m FROM win),
spots AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m),
found AS (SELECT doc_id, i, m, item FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM spots) JOIN win USING (m, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _leaf(*values: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values) + ")"


MERKLE = f"""WITH RECURSIVE told AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
  CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf("doc_id", "source", "lang", "(n_chars + 1)", "text")} END AS changed FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM told),
up AS (SELECT tree, 0 AS level, idx, leaf AS digest, n FROM leaves UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY tree, level, idx // 2, n),
subs AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, idx, subroot AS digest, n FROM subs UNION ALL SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, idx // 2, n),
steps AS (SELECT rid, v.level AS k, (l.idx >> v.level) & 1 AS side, s.digest AS sib FROM leaves l JOIN (SELECT DISTINCT tree, level FROM up WHERE n > 1) v USING (tree)
    LEFT JOIN up s ON s.tree = l.tree AND s.level = v.level AND s.idx = xor(l.idx >> v.level, 1)
  UNION ALL SELECT rid, 1000 + v.level, (b.idx >> v.level) & 1, s.digest FROM leaves l JOIN subs b USING (tree), (SELECT DISTINCT level FROM top WHERE n > 1) v
    LEFT JOIN top s ON s.level = v.level AND s.idx = xor(b.idx >> v.level, 1)),
path AS (SELECT rid, side, sib, row_number() OVER (PARTITION BY rid ORDER BY k) AS p FROM steps),
fold AS (SELECT rid, 0 AS p, coalesce(changed, leaf) AS d FROM leaves UNION ALL
  SELECT f.rid, CAST(path.p AS INT), sha256(CASE WHEN sib IS NULL THEN d WHEN side = 1 THEN sib || d ELSE d || sib END) FROM fold f JOIN path ON path.rid = f.rid AND path.p = f.p + 1),
ends AS (SELECT rid, arg_max(d, p) AS folded_root FROM fold GROUP BY rid), proofs AS (SELECT rid, string_agg(sib, '' ORDER BY p) AS sibs FROM path GROUP BY rid)
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(coalesce(sibs, '')) AS proof_sha256, folded_root, folded_root = r.digest AS verified
FROM leaves JOIN subs USING (tree) JOIN ends USING (rid) LEFT JOIN proofs USING (rid), (SELECT digest FROM top WHERE n = 1) r"""

# states: 0 nothing yet, 1 after the system's turn, 2 after a user's, 3 after an assistant's; ins: inserts before a turn; ops: edits of a turn
REPAIR = rf"""WITH RECURSIVE told AS (SELECT coalesce('=' || conv_id, '') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k FROM conversations),
dam AS (SELECT c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM told, range(2) t(i) WHERE k <> 0 AND (i = 0 OR k = 3)),
ord AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS i FROM dam),
seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again FROM ord),
bad AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ \t\n\v\f\r]') THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?]{_BLANKS}*\z') THEN 'truncated' ELSE '' END AS fault,
  left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS q FROM seen),
facts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (q IS NOT NULL AND q || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM bad GROUP BY c),
ins(st, k, st2) AS (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)),
ops(st2, r, op, price, st3) AS (VALUES (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2), (1, 'u', 'K', 0, 2), (3, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3), (0, '', 'R', 1, 2), (1, '', 'R', 1, 2), (3, '', 'R', 1, 2), (2, '', 'R', 1, 3),
  (0, '', 'D', 2, 0), (1, '', 'D', 2, 1), (2, '', 'D', 2, 2), (3, '', 'D', 2, 3)),
walk AS (SELECT c, 0 AS i, 0 AS st, {{'cost': 0, 'audit': ''}} AS b FROM facts UNION ALL
  SELECT w.c, w.i + 1, o.st3, min({{'cost': w.b.cost + 5 * ins.k + o.price + CASE WHEN bad.fault = 'truncated' AND o.op <> 'D' THEN 5 ELSE 0 END, 'audit': w.b.audit || repeat('I', ins.k) || o.op}})
  FROM walk w JOIN bad ON bad.c = w.c AND bad.i = w.i + 1 JOIN ins ON ins.st = w.st JOIN ops o ON o.st2 = ins.st2 AND (o.r = '' OR o.r = bad.r) AND (o.op = 'D' OR bad.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.c, w.i, o.st3),
plan AS (SELECT c, min({{'cost': b.cost + 5 * e.k, 'audit': b.audit || repeat('I', e.k)}}) AS b FROM walk JOIN facts USING (c) JOIN (VALUES (0, 0), (3, 0), (2, 1), (1, 2)) e(st, k) ON e.st = walk.st WHERE i = n GROUP BY c),
edit AS (SELECT c, p, substr(b.audit, CAST(p AS BIGINT), 1) AS op FROM (SELECT c, b, unnest(range(1, length(b.audit) + 1)) AS p FROM plan)),
stepped AS (SELECT c, p, op, count(*) FILTER (op <> 'I') OVER (PARTITION BY c ORDER BY p) AS i, count(*) FILTER (op <> 'D') OVER (PARTITION BY c ORDER BY p) AS e FROM edit),
left_over AS (SELECT z.c, p, op, e, bad.role, bad.text, max(CASE WHEN op = 'K' AND bad.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY z.c) AS s FROM stepped z LEFT JOIN bad ON bad.c = z.c AND bad.i = z.i WHERE op <> 'D'),
done AS (SELECT c, string_agg(CASE WHEN op = 'K' THEN role WHEN (e - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS repaired FROM left_over GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(b.cost, 0) AS BIGINT) AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS c FROM conversations) LEFT JOIN facts USING (c) LEFT JOIN plan USING (c) LEFT JOIN done USING (c)"""


def _rules() -> str:
    rules, n = quality_rules.RULES, range(len(quality_rules.RULES))
    marks, symbols = (s.replace("'", "''") for s in (quality_rules.MARKS, quality_rules.SYMBOLS))
    share = lambda r: f"({r.measure} / nullif({r.of}, 0))"
    vote = lambda r: f"CASE WHEN {share(r)} {'<=' if r.good < r.bad else '>='} {r.good} THEN 1 WHEN {share(r)} {'>=' if r.good < r.bad else '<='} {r.bad} THEN -1 ELSE 0 END"
    odds = "ln(pi / (1 - pi)) + " + " + ".join(f"CASE v{i} WHEN 1 THEN ln(g{i} / (1 - b{i})) WHEN -1 THEN ln((1 - g{i}) / b{i}) ELSE 0 END" for i in n)
    names = ", ".join(f"v{i}" for i in n)
    part = lambda w, i, v: f"(1 + coalesce(sum(c * {w}) FILTER (v{i} = {v}), 0)) / (2 + coalesce(sum(c * {w}) FILTER (v{i} <> 0), 0))"
    share0, good, bad = quality_rules.START
    return rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{_WORDS}') AS w FROM d), win AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM win) WHERE n > 1), rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM again) GROUP BY rid),
ln AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\v\f\r]')) AS l FROM d),
m AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(text, '{_BLANKS}', '', 'g')) AS word_chars, length(text) - length(translate(text, '{symbols}', '')) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(l) AS _lines, length(text) - length(translate(text, '{marks}', '')) AS _marks,
  length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS _capitals, length(text) - length(replace(text, '!', '')) AS _bangs, len(list_distinct(w)) AS _kinds, length(text) - length(translate(text, '.?', '')) AS _stops, 1 AS _one
  FROM d JOIN w USING (rid) JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
voted AS (SELECT *, {", ".join(f"{vote(r)} AS v{i}" for i, r in enumerate(rules))} FROM m), pats AS (SELECT {names}, count(*) AS c FROM voted GROUP BY ALL),
em AS (SELECT 0 AS step, CAST({share0} AS DOUBLE) AS pi, {", ".join(f"CAST({good} AS DOUBLE) AS g{i}, CAST({bad} AS DOUBLE) AS b{i}" for i in n)} UNION ALL
  SELECT step + 1, (1 + sum(c * p)) / (2 + sum(c)), {", ".join(f"{part('p', i, 1)}, {part('(1 - p)', i, -1)}" for i in n)}
  FROM (SELECT *, 1 / (1 + exp(-({odds}))) AS p FROM em, pats WHERE step < {quality_rules.STEPS}) GROUP BY step),
rated AS (SELECT voted.*, 1 / (1 + exp(-({odds}))) AS p, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM voted, em WHERE step = {quality_rules.STEPS})
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND p >= 0.5 AS kept, round(p, 6) AS p_good FROM rated"""


RULES = _rules()
