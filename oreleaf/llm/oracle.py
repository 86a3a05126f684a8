"""Expected results of the queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from oreleaf.llm.common import ALNUM_WORD, SPACE_WORD, UPPER
from oreleaf.llm.thresholds import ALPHA, DELTA, GRID, RULES

LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

OP7 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, '{ALNUM_WORD}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({LOWER}, '{ALNUM_WORD}') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[s:s + least(len(w), 10) - 1], 'string_agg', ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
),
n AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT r, s, n, list_aggregate(w[s:s + n - 1], 'string_agg', ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, n WHERE len(w) >= n)
),
h AS (SELECT DISTINCT r, s, n, item_id FROM dw JOIN iw USING (n, g)),
p AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""

_STEPS = ", ".join(
    f"CASE WHEN {below} > 0 THEN least(({above} * {GRID} + {top} * {below} - 1) // ({top} * {below}), {GRID + 1}) ELSE 0 END AS s_{rule}" for rule, (above, below, top) in RULES.items()
)
_RATE = ALPHA / len(RULES)
OP3 = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{SPACE_WORD}')) AS lines FROM documents
),
g AS (SELECT r, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1) GROUP BY r),
c AS (
  SELECT r, doc_id, lang, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN rep USING (r)
),
s AS (SELECT *, {_STEPS} FROM c),
u AS (UNPIVOT s ON {", ".join(f"s_{rule}" for rule in RULES)} INTO NAME rule VALUE step),
good AS (SELECT lang, rule, step FROM u WHERE n_words > 0 AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
n AS (SELECT lang, rule, count(*)::DOUBLE AS n, count(*) OVER () AS tests FROM good GROUP BY lang, rule),
x AS (SELECT n.lang, n.rule, k, n, tests, (SELECT count(*) FROM good b WHERE b.lang = n.lang AND b.rule = n.rule AND b.step > k)::DOUBLE AS x FROM n, range(1, {GRID + 1}) AS r(k)),
p AS (
  SELECT lang, rule, k, tests, CASE WHEN x >= n * {_RATE!r} THEN 1.0 ELSE
    list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE!r}) + (n - i) * ln(1 - {_RATE!r})) for i in range(0, x::BIGINT + 1)]) END AS p FROM x
),
a AS (SELECT lang, rule, min(k) AS k FROM (SELECT lang, rule, k, max(p * tests) OVER (PARTITION BY lang, rule ORDER BY k DESC) AS worst FROM p) WHERE worst <= {DELTA!r} GROUP BY lang, rule),
over AS (SELECT DISTINCT r FROM u JOIN a USING (lang, rule) WHERE step > k),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND r NOT IN (SELECT r FROM over) AS kept FROM f
"""

OP4 = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list(struct_pack(role, text) ORDER BY turn) AS turns, count(*) AS n_turns FROM t GROUP BY conv_id),
u AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_equal, any_value(n_turns) AS n_turns FROM c GROUP BY turns),
p AS (SELECT DISTINCT turns[1:i] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS i FROM u))
SELECT conv_id, n_turns, n_equal,
  list_aggregate([concat('<|', replace(x.role, '<|', '< |'), '|>', chr(10), replace(x.text, '<|', '< |'), '<|end|>', chr(10)) for x in turns], 'string_agg', '') AS rendered
FROM u WHERE turns NOT IN (SELECT turns FROM p)
"""

_HOST = r"lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
_PART = r"regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1)"
OP8 = rf"""
WITH h AS (SELECT DISTINCT {_HOST} AS h, {_PART} AS part FROM pages WHERE {_HOST} <> ''),
d AS (SELECT *, length(pattern) AS n, coalesce(ascii(substring(pattern, 5, 1)), 0) AS a FROM (SELECT DISTINCT array_to_string(string_split(h, '.')[-3:], '.') AS pattern FROM h)),
e AS (
  SELECT 'block' AS list, pattern, unnest([1, 0, 1]) AS on_, unnest([(31 * n + 17 * a) % 200, (31 * n + 17 * a) % 200 + 10 + a % 50, (31 * n + 17 * a) % 200 + 90 + n]) AS day FROM d
  UNION ALL
  SELECT 'allow', h || '/' || part, unnest([1, 0]), unnest([11 * length(h) % 300, 11 * length(h) % 300 + 40]) FROM h WHERE part IN ('de', 'fr')
),
m AS (SELECT list, pattern, day, max(on_) AS on_ FROM e GROUP BY ALL),
ch AS (SELECT * FROM (SELECT *, lag(on_, 1, 0) OVER (PARTITION BY list, pattern ORDER BY day) AS was FROM m) WHERE on_ <> was),
iv AS (SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM ch) WHERE on_ = 1),
c AS (SELECT row_number() OVER () AS r, page_id, url, page_id * 37 % 365 AS day, {_HOST} AS h, {_PART} AS part FROM pages),
k AS (
  SELECT c.r, c.page_id, c.url, c.day, iv.pattern, iv.list, iv.day AS since,
    row_number() OVER (PARTITION BY c.r ORDER BY length(iv.pattern) DESC NULLS LAST, iv.list, iv.pattern DESC) AS best
  FROM c LEFT JOIN iv ON c.url IS NOT NULL AND (iv.pattern = c.h OR suffix(c.h, '.' || iv.pattern) OR iv.pattern = c.h || '/' || c.part) AND iv.day <= c.day AND (iv.until IS NULL OR c.day < iv.until)
)
SELECT page_id, url, day, pattern, list, coalesce(since, -1) AS since, coalesce(list = 'block', false) AS blocked FROM k WHERE best = 1
"""

# CRC-32 byte by byte over the hexadecimal digits of a string, with a table made by its rule.
OP12 = rf"""
WITH RECURSIVE step AS (
  SELECT i AS b, i AS v, 0 AS k FROM range(256) AS r(i)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM step WHERE k < 8
),
crc AS (SELECT list(v ORDER BY b) AS crc FROM step WHERE k = 8),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, '{ALNUM_WORD}') AS w FROM documents),
i AS (SELECT regexp_extract_all({LOWER}, '{ALNUM_WORD}') AS w FROM benchmark),
n AS (SELECT unnest([1, 2, 3]) AS n),
df AS (SELECT r, list_aggregate(w[s:s + n - 1], 'string_agg', ' ') AS f FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, n WHERE len(w) >= n)),
tf AS (SELECT list_aggregate(w[s:s + n - 1], 'string_agg', ' ') AS f FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS s FROM i, n WHERE len(w) >= n)),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM tf)),
c AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2),
    lambda p: 16 * (strpos('0123456789ABCDEF', x[2 * p + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * p + 2]) - 1)),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS b FROM h, crc
),
db AS (SELECT r, b FROM df JOIN c USING (f)),
s AS (SELECT b, count(*)::DOUBLE AS s FROM db GROUP BY b),
t AS (SELECT b, count(*)::DOUBLE AS t FROM tf JOIN c USING (f) GROUP BY b),
g AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
  FROM s FULL JOIN t USING (b)
),
w AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM db JOIN g USING (b) GROUP BY r),
x AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || substring(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h FROM d LEFT JOIN w USING (r)
),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM x),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * (SELECT count(*) FROM k) // 100 THEN rank END AS rank FROM y LEFT JOIN k USING (r)
"""

OP13 = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS mask
  FROM t LEFT JOIN l USING (doc_id)
),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
x AS (SELECT *, coalesce(list_min(list_transform(string_split(nullif(mask, ''), ''), lambda z: strpos(o, z))), 6) AS stop FROM c, o),
s AS (
  SELECT part, o AS filter_order, step::INT AS step, substring(o, step, 1) AS f, sum(CASE WHEN stop > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN stop = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(mask, substring(o, step, 1)) AND stop < step THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = substring(o, step, 1) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN stop = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN stop = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM x, range(1, 6) AS r(step) GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM s
"""

ORACLE: dict[str, str] = {
    "op3_certified_rules": OP3, "op4_snapshot_collapse": OP4, "op7_winnowing": OP7, "op8_temporal_url_filter": OP8,
    "op12_importance_resampling": OP12, "op13_filter_audit": OP13,
}
