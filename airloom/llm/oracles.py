"""DuckDB SQL of the corpus queries. Values are written out here, not imported from the operators."""

_RULES = [
    ("symbols", "n_symbols", "n_words", (1.0, 0.05, 19)),
    ("repeats", "n_repeat_words", "n_words", (0.5, 0.05, 9)),
    ("dup_lines", "n_dup_lines", "n_lines", (0.9, 0.1, 16)),
    ("capitals", "n_capitals", "word_chars", (0.9, 0.1, 16)),
    ("shouts", "n_shouts", "n_words", (2.0, 0.1, 19)),
    ("long_words", "word_chars", "n_words", (20.0, 6.0, 14)),
    ("short_words", "-word_chars", "n_words", (-1.0, -3.5, 10)),
]


def _values() -> str:
    rows = [
        f"('{name}', {i}, {round(high - (high - low) * i / n, 6)}::DOUBLE)"
        for name, _, _, (high, low, n) in _RULES for i in range(n + 1)
    ]
    return ", ".join(rows)


def _measures() -> str:
    return " UNION ALL ".join(
        f"SELECT rid, stratum, label, '{name}' AS rule, CASE WHEN {base} > 0 THEN CAST({top} AS DOUBLE) / {base} END AS v FROM labelled"
        for name, top, base, _ in _RULES
    )


def _rejects() -> str:
    return " OR ".join(
        f"coalesce((SELECT max(c.cutoff) FROM chosen c WHERE c.stratum = m.stratum AND c.rule = '{name}') "
        f"< CASE WHEN {base} > 0 THEN CAST({top} AS DOUBLE) / {base} END, false)"
        for name, top, base, _ in _RULES
    )


QUALITY_RULES_WITH = f"""
d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS stratum, row_number() OVER () AS rid FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> '') AS ls FROM d),
win AS (SELECT rid, i, concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS x
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n FROM rep, (VALUES (0), (1), (2)) o(j) GROUP BY rid),
m AS (SELECT w.rid, doc_id, stratum, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
  len(ls)::BIGINT AS n_lines, (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::BIGINT AS n_capitals,
  (length(t) - length(translate(t, '!?', '')))::BIGINT AS n_shouts
  FROM w LEFT JOIN cov ON cov.rid = w.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
known AS (SELECT doc_id, min(quality) AS label FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1)
  GROUP BY doc_id HAVING min(quality) = max(quality)),
labelled AS (SELECT b.*, label FROM b JOIN known ON known.doc_id = b.doc_id WHERE NOT base_failed),
v AS ({_measures()}),
grid(rule, pos, cutoff) AS (VALUES {_values()}),
tests AS (SELECT stratum, v.rule, pos, cutoff, sum(label) AS n, sum(label) FILTER (v.v > cutoff) AS k0,
  sum(1 - label) FILTER (v.v > cutoff) AS gain0 FROM v JOIN grid ON grid.rule = v.rule GROUP BY ALL),
t2 AS (SELECT *, coalesce(k0, 0)::BIGINT AS k, coalesce(gain0, 0)::BIGINT AS gain FROM tests),
tails AS (SELECT stratum, rule, pos, cutoff, k, gain, CASE WHEN k > n * 0.01 THEN 1.0 ELSE
  (SELECT sum(exp(lgamma(t2.n + 1.0) - lgamma(i + 1.0) - lgamma(t2.n - i + 1.0) + i * ln(0.01) + (t2.n - i) * ln(0.99)))
   FROM range(0, t2.k + 1) r(i)) END AS p FROM t2),
ends AS (SELECT stratum, rule, min(pos) AS stop FROM tails
  WHERE p > 0.05 / ((SELECT count(DISTINCT stratum) FROM labelled) * {len(_RULES)}) GROUP BY ALL),
chosen AS (SELECT tails.stratum, tails.rule, arg_max(cutoff, (gain - k) * 1000 - pos) AS cutoff FROM tails
  LEFT JOIN ends ON ends.stratum = tails.stratum AND ends.rule = tails.rule
  WHERE gain > k AND (stop IS NULL OR pos < stop) GROUP BY ALL),
judged AS (SELECT m.*, NOT base_failed AND NOT ({_rejects()}) AS kept FROM b m)
"""

QUALITY_RULES = f"""WITH {QUALITY_RULES_WITH}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""

NEAR_DUPLICATES = """WITH RECURSIVE
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS x FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id"""

DECONTAMINATION = """WITH
b AS (SELECT min(item_id) AS item, ws, len(ws) AS n FROM (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'),
    lambda x: x <> '') AS ws FROM benchmark) WHERE len(ws) >= 5 AND item_id IS NOT NULL GROUP BY ws),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'),
    lambda x: x <> '') AS ws FROM documents WHERE doc_id IS NOT NULL),
-- Every word of an item, with the part it is in and the part's size.
own AS (SELECT item, n, q, least(q // 32, last) AS part, CASE WHEN q // 32 < last THEN 32 ELSE n - 32 * last END AS size, ws[q + 1] AS w
    FROM (SELECT *, greatest(n // 32, 1) - 1 AS last, unnest(range(0, n)) AS q FROM b)),
dw AS (SELECT rid, doc_id, p, ws[p + 1] AS w FROM (SELECT *, unnest(range(0, len(ws))) AS p FROM d)),
-- Plain alignment: all offsets at which words are equal, whether or not a mask hits there.
counted AS (SELECT rid, doc_id, item, n, part, list(q) AS qs FROM dw JOIN own ON own.w = dw.w
    GROUP BY rid, doc_id, item, n, part, size, p - q HAVING count(*) >= greatest(5, size / 4)),
found AS (SELECT doc_id, item, n, count(DISTINCT q) AS matched FROM (SELECT doc_id, item, n, unnest(qs) AS q FROM counted) GROUP BY ALL)
SELECT doc_id, item AS item_id, n::BIGINT AS item_words, matched, matched / n AS coverage FROM found
WHERE matched >= 5 AND matched / n >= 0.6"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i::INT, 1))::BIGINT)"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: "
            "list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384::BIGINT))))")


# Best (cost, audit) of every state, forward over the rows; states: '' nothing yet, s, u, a.
CONVERSATION_REPAIR = f"""WITH RECURSIVE
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
kinds AS (SELECT *, {_crc32('name')} % 20 AS k FROM base),
damaged AS (SELECT coalesce(conv_id::VARCHAR, '') AS c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen FROM damaged),
r AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN seen THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM placed),
step(q, role, nq) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
ins(q, nq, letters, cost) AS (SELECT q, q, '', 0 FROM (VALUES (''), ('s'), ('u'), ('a')) v(q)
    UNION ALL VALUES ('', 'u', 'I', 5), ('s', 'u', 'I', 5), ('u', 'a', 'I', 5), ('a', 'u', 'I', 5),
    ('', 'a', 'II', 10), ('s', 'a', 'II', 10), ('u', 'u', 'II', 10), ('a', 'a', 'II', 10)),
edits AS (SELECT c, i, q, nq, 'K' AS letter, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS cost FROM r JOIN step ON step.role = initial
      WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT c, i, q, nq, 'R', CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END FROM r JOIN step ON step.role IN ('u', 'a')
      WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT c, i, q, q, 'D', 2 FROM r, (VALUES (''), ('s'), ('u'), ('a')) v(q)),
dp(c, i, q, cost, audit) AS (SELECT DISTINCT c, 0::BIGINT, '', 0, '' FROM r
    UNION ALL SELECT c, i, q, best.cost, best.audit FROM (
      SELECT dp.c, dp.i + 1 AS i, e.nq AS q, min(struct_pack(cost := dp.cost + ins.cost + e.cost, audit := dp.audit || ins.letters || e.letter)) AS best
      FROM dp JOIN ins ON ins.q = dp.q JOIN edits e ON e.c = dp.c AND e.i = dp.i + 1 AND e.q = ins.nq GROUP BY 1, 2, 3)),
n AS (SELECT c, count(*) AS n, sum((fault = 'blank')::INT)::BIGINT AS blank, sum((fault = 'duplicate')::INT)::BIGINT AS duplicate,
    sum((fault = 'truncated')::INT)::BIGINT AS truncated, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps FROM r GROUP BY c),
pairs AS (SELECT c, sum((initial || coalesce(after, '') NOT IN ('su', 'ua', 'au'))::INT)::BIGINT AS illegal
    FROM (SELECT c, initial, lead(initial) OVER (PARTITION BY c ORDER BY i) AS after, lead(i) OVER (PARTITION BY c ORDER BY i) AS j FROM r)
    WHERE j IS NOT NULL GROUP BY c),
best AS (SELECT dp.c, min(struct_pack(cost := dp.cost + ins.cost, audit := dp.audit || ins.letters)) AS b
    FROM dp JOIN n ON n.c = dp.c AND n.n = dp.i JOIN ins ON ins.q = dp.q AND ins.nq IN ('', 'a') GROUP BY dp.c),
letters AS (SELECT c, p, letter, sum((letter <> 'I')::INT) OVER (PARTITION BY c ORDER BY p) AS i, sum((letter <> 'D')::INT) OVER (PARTITION BY c ORDER BY p) AS e
    FROM (SELECT c, p, substr(b.audit, p::INT, 1) AS letter FROM (SELECT c, b, unnest(range(1, length(b.audit) + 1)) AS p FROM best))),
emitted AS (SELECT l.c, l.e, letter, CASE WHEN letter = 'I' THEN '' ELSE r.text END AS text, r.role,
    first_value(letter = 'K' AND r.initial = 's') OVER (PARTITION BY l.c ORDER BY l.e) AS s
    FROM letters l LEFT JOIN r ON r.c = l.c AND r.i = l.i WHERE letter <> 'D'),
said AS (SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (e + s::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY e) AS t
    FROM emitted GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS c FROM conversations) o
LEFT JOIN n ON n.c = o.c LEFT JOIN pairs ON pairs.c = o.c LEFT JOIN best ON best.c = o.c LEFT JOIN said ON said.c = o.c"""


# A node is the joined digests of its turns, so that a subtree is what starts with it.
PREFIX_TRIE = f"""WITH
o AS (SELECT conv_id AS c, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS b,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, {_crc32('c::VARCHAR')} % 9 AS h FROM o),
rows AS (SELECT ids.c, o.i, o.x, o.b FROM ids JOIN o ON o.c = ids.c - ids.c % 5 AND o.i <= h
    UNION ALL SELECT ids.c, 100 + o.i, o.x, o.b FROM ids JOIN o ON o.c = ids.c AND o.i > h),
p AS (SELECT c, count(*) OVER w AS d, string_agg(x, '') OVER w AS k, b FROM rows WINDOW w AS (PARTITION BY c ORDER BY i)
    UNION ALL SELECT c, 0, '', 0 FROM ids),
n AS (SELECT min(c) AS conv_id, d AS depth, k, left(k, greatest(length(k) - 64, 0)::BIGINT) AS pk, count(*) AS n_convs, min(b) AS b FROM p GROUP BY d, k),
last AS (SELECT c, max(d) AS d FROM p GROUP BY c),
ends AS (SELECT p.k, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) AS list FROM p JOIN last ON last.c = p.c AND last.d = p.d GROUP BY p.k),
kids AS (SELECT pk AS k, count(*) AS n FROM n WHERE depth > 0 GROUP BY pk),
below AS (SELECT v.k, sum((u.n_convs - 1) * u.b)::BIGINT AS saved, sum((kids.n IS NULL)::INT)::BIGINT AS leaves
    FROM n v JOIN n u ON starts_with(u.k, v.k) LEFT JOIN kids ON kids.k = u.k GROUP BY v.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
  below.leaves AS n_leaves, below.saved AS saved_tokens, sha256(coalesce(ends.list, '')) AS ends_sha256
FROM n JOIN below ON below.k = n.k LEFT JOIN kids ON kids.k = n.k LEFT JOIN ends ON ends.k = n.k
LEFT JOIN n up ON n.depth > 0 AND up.k = n.pk AND up.depth = n.depth - 1"""
