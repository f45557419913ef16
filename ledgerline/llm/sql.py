"""DuckDB SQL for the text queries that SQL can express on whole tables."""

from __future__ import annotations

from ledgerline.llm import mixing, quality, secrets, spelling
from ledgerline.llm.common import LOWER, UPPER, WORD


def _q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


_LOW = f"'{UPPER}', '{LOWER}'"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {_q(pattern)}))"


def _line_fails(x: str) -> str:
    n = _count(x, WORD)
    last = f"right(rtrim({x}, {_WHITE}), 1)"
    return f"""(({n} >= 12 AND (NOT regexp_matches({last}, {_q(quality.ENDS)}) OR contains({_q(quality.NO_ENDS)}, {last}))) OR {_count(x, quality.MARKED)} * 10 > {n} * 3
        OR {_count(x, quality.SEPARATOR)} * 5 > {n} OR ({n} <= 4 AND regexp_matches({x}, {_q(quality.MENU)}))
        OR ({n} <= 40 AND regexp_matches({x}, {_q(quality.BOILERPLATE)})))"""


ORACLES: dict[str, str] = {}

ORACLES["op1_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), {_LOW})) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""

ORACLES["op2_quality_rules"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_q(WORD)}) AS words, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
g AS (SELECT doc_id, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL THEN concat_ws(chr(1), w, lead(w) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) END AS gram
      FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS twice FROM g),
c AS (SELECT doc_id, max(twice::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM t),
r AS (SELECT doc_id, sum(covered)::BIGINT AS n_repeat_words FROM c GROUP BY doc_id),
m AS (
  SELECT doc_id, [x FOR x IN lines IF NOT {_line_fails('x')}] AS good, len(lines) AS n_lines, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars, {_count('text', '[#*$%&|<>]')} AS n_symbols,
    len([x FOR x IN lines IF regexp_matches(x, {_q(WORD)})]) - len(list_distinct([x FOR x IN lines IF regexp_matches(x, {_q(WORD)})])) AS n_dup_lines,
    coalesce(list_sum([{_count('x', WORD)} FOR x IN lines IF {_line_fails('x')}]), 0)::BIGINT AS lost_words
  FROM d),
b AS (SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words, n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed FROM m LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lost_words <= {quality.MAX_LOST} * n_words AS kept, lost_words,
  n_lines - len(good) AS n_bad_lines, sha256(coalesce(array_to_string(good, chr(10)), '')) AS clean_sha256 FROM b"""

ORACLES["op3_line_dedup"] = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, {_WHITE}), {_LOW}) AS key FROM l),
f AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, coalesce(f.owner <> k.doc_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""

_SPOT = f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {mixing.LEVEL_BITS * mixing.LEVELS // 4}))::BIGINT"
ORACLES["op4_source_mix"] = f"""
WITH d AS (SELECT doc_id, source, {_count("coalesce(text, '')", WORD)}::BIGINT AS size, {_SPOT} AS spot FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight, 3 * source_size AS top FROM s),
o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(top) OVER f, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS weights
      FROM n WINDOW f AS (ORDER BY top::DOUBLE / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT *, rest::DOUBLE / weights::DOUBLE AS own FROM o),
g AS (SELECT source, source_size, least(top::DOUBLE, max(own) OVER () * weight) AS target FROM p),
h AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM g),
b AS (SELECT source, spot, sum(size)::BIGINT AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY spot) - sum(size) AS below FROM d GROUP BY source, spot),
x AS (SELECT h.source, max(spot) AS last, max(below) AS below, arg_max(words, spot) AS words FROM h JOIN b ON h.source IS NOT DISTINCT FROM b.source AND below <= target - copies * source_size GROUP BY h.source),
e AS (SELECT h.*, last + CASE WHEN words > 0 AND 2 * (target - copies * source_size - below) >= words AND copies < 3 THEN 1 ELSE 0 END AS edge FROM h JOIN x ON h.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, source_size, target, size * (copies + (spot < edge)::INT) AS taken FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source"""

ORACLES["op7_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_q(WORD)}) AS words FROM documents),
w AS (SELECT doc_id, words, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
v AS (SELECT doc_id, w, i, CASE WHEN i + 49 <= len(words) THEN array_to_string(words[i:i + 49], ' ') END AS win FROM w),
f AS (SELECT doc_id, w, i, win IS NOT NULL AND min(doc_id) OVER (PARTITION BY win) < doc_id AS again FROM v),
c AS (SELECT doc_id, w, i, max(again::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone FROM f),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

ORACLES["op8_url_filter"] = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://(.*)$', 1) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOW}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r"""


def _rule_sql(order: int, kind: str, pattern: str, least: int) -> str:
    """Spans of one rule: matches and the pieces between them, whose lengths add up to the starts."""
    p = _q(pattern)
    return f"""SELECT doc_id, {order} AS rule, {_q(kind)} AS kind, start, start + length(hit) AS stop, {int(kind in secrets.BASE)} AS base FROM (
      SELECT doc_id, hit, value, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) - length(hit) AS start FROM (
        SELECT doc_id, unnest(string_split_regex(text, {p})[:-2]) AS gap, unnest(regexp_extract_all(text, {p})) AS hit, unnest(regexp_extract_all(text, {p}, 1)) AS value,
          generate_subscripts(regexp_extract_all(text, {p}), 1) AS i FROM d WHERE regexp_matches(text, {p}))) WHERE length(value) >= {least}"""


ORACLES["op9_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({' UNION ALL '.join(_rule_sql(i, *rule) for i, rule in enumerate(secrets.RULES))}),
t AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM s),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(span, ',' ORDER BY start, rule) FILTER (base = 1) AS known, string_agg(span, ',' ORDER BY start, rule) AS spans FROM t GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(known, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)"""


def _crc_table() -> list[int]:
    """The 256 remainders of the reflected polynomial of CRC-32."""
    out = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


# Bytes of a word are its code points: those of U+00C0 to U+00FF are two bytes, 195 and the code point less 64.
_BYTES = "flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END FOR c IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])"
ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT {_crc_table()}::BIGINT[] AS crc),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_LOW}), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
g AS MATERIALIZED (SELECT doc_id, run, count(*) AS k FROM r GROUP BY ALL),
h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}::BIGINT[]), lambda x, b: xor(x >> 8, crc[(xor(x, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM g, t),
s AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
w AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM s WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(k) >= {spelling.MIN_COUNT}),
d AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM w, unnest(range(1, length(word) + 1)) AS u(i)),
p AS (SELECT a.word, b.word AS near FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
      UNION SELECT d.word, w.word FROM d JOIN w ON d.less = w.word UNION SELECT w.word, d.word FROM d JOIN w ON d.less = w.word),
q AS (SELECT p.word, count(*) AS n_near, arg_min(near, (-w.n, encode(near))) AS best, max(w.n) AS best_n FROM p JOIN w ON w.word = p.near GROUP BY p.word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM w LEFT JOIN q USING (word)),
c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM f JOIN c USING (word) JOIN f e ON e.word = c.at WHERE e.form IS NULL"""

ORACLES["op12_collocations"] = f"""
WITH s AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, string_split_regex(translate(coalesce(text, ''), {_LOW}), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, doc, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS j FROM s),
v AS (SELECT lang, doc, j, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, ws[i:i + m - 1] AS ws, m FROM v, unnest([1, 2, 3]) AS a(m), unnest(range(1, len(ws) - m + 2)) AS b(i)),
f AS MATERIALIZED (SELECT lang, ws, m, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, ws, m, f AS a FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT c.*, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score FROM c, unnest(range(1, m)) AS u(k)
      JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:k] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[k + 1:]),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
i AS (SELECT lang, unnest([ws[1:2], ws[2:3]]) AS ws, a AS longer FROM c WHERE m = 3),
o AS (SELECT lang, ws, max(longer) AS longer FROM i GROUP BY ALL),
t AS (SELECT b.lang, array_to_string(b.ws, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM b LEFT JOIN o ON o.lang = b.lang AND o.ws = b.ws WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n.n, score FROM t JOIN n ON n.lang = t.lang QUALIFY rank <= 2000"""
