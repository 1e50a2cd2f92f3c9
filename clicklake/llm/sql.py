"""SQL twins of the operators' queries."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

TWINS: dict[str, str] = {}

TWINS["op4_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(body) AS text_sha256
FROM d"""

TWINS["op6_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, {_WORDS} AS w,
    (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) AS VARCHAR)
      || ':' || md5(coalesce(text, '')) || ':mix'), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS size,
    -ln(u) / (CASE WHEN len(w) = 0 THEN 1.0::DOUBLE ELSE greatest(len(list_distinct(w))::DOUBLE / len(w), 0.05::DOUBLE) END) AS key
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS weight
  FROM k GROUP BY source),
c AS (SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / weight AS ratio FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM c),
f AS (SELECT min_by(level, ratio) AS level FROM l WHERE level <= ratio),
t AS (SELECT c.source, c.source_size, least(coalesce(f.level, 0) * weight, cap::DOUBLE) AS target FROM c, f),
p AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
    CAST(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS LAST, k.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS through
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (epochs + CASE WHEN 2 * through - size <= 2 * (target - epochs * source_size) AND target - epochs * source_size > 0 THEN 1 ELSE 0 END) * size AS taken
FROM p"""

TWINS["op9_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
v AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM g),
n AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM v) WHERE c > 1),
x AS (SELECT r, least(coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3), 3) AS gap FROM n),
cov AS (SELECT r, CAST(sum(gap) AS BIGINT) AS n_repeat_words FROM x GROUP BY r),
b AS (
  SELECT d.doc_id, d.text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    list_filter(string_split(d.text, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(cov.n_repeat_words, 0) AS n_repeat_words,
    len(regexp_extract_all(d.text, '\p{{L}}')) AS letters, len(regexp_extract_all(d.text, '\p{{Lu}}')) AS capitals
  FROM d LEFT JOIN cov ON d.r = cov.r),
e AS (
  SELECT *, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines OR word_chars > 40 * n_words
    OR 100 * capitals > 60 * letters OR 100 * letters < 50 * word_chars) AS kept
FROM e"""

_HASH3 = "l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2]"
TWINS["op3_line_dedup"] = rf"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
g AS (SELECT doc_id, text, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3),
v AS (SELECT doc_id, text, i, {_HASH3} AS win FROM g WHERE regexp_matches({_HASH3}, '[^\x20\x09-\x0D]')),
o AS (SELECT doc_id, text, i, row_number() OVER (PARTITION BY win ORDER BY doc_id NULLS FIRST, text, i) AS k FROM v),
gone AS (SELECT DISTINCT doc_id, text, i + j AS spot FROM o, (VALUES (0), (1), (2)) AS s(j) WHERE k > 1),
per AS (SELECT doc_id, text, list(spot) AS ats FROM gone GROUP BY doc_id, text)
SELECT a.doc_id, CAST(len(b.l) AS BIGINT) AS n_lines,
  CAST(coalesce(len(p.ats), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN p.ats IS NULL THEN b.text ELSE coalesce(array_to_string(
    [b.l[q] FOR q IN range(1, len(b.l) + 1) IF NOT list_contains(p.ats, q)], chr(10)), '') END) AS clean_sha256
FROM documents a JOIN d b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND coalesce(a.text, '') = b.text
LEFT JOIN per p ON b.doc_id IS NOT DISTINCT FROM p.doc_id AND b.text = p.text"""

_ESC = r"regexp_replace(coalesce({0}, ''), '([<\[])(\\*)(/?s>|\|>|/?<?/?SYS>>|/?INST\])', '\1\\\2\3', 'g')"
TWINS["op8_chat_format"] = rf"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {_ESC.format("role")} AS er, {_ESC.format("text")} AS et,
    len(regexp_extract_all(coalesce(text, ''), '\p{{L}}+|\p{{N}}+|[^\s\p{{L}}\p{{N}}]')) + 4 AS tokens
  FROM given),
a AS (
  SELECT *, row_number() OVER w AS place,
    coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, er, et ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    length(er) + length(et) + 10 AS chars, first_value(er) OVER w AS role1
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, er, et)),
s AS (SELECT *, CAST(floor(start / 768.0) AS BIGINT) AS span FROM a),
sp AS (SELECT conv_id, span, min(start) AS first FROM s GROUP BY conv_id, span),
nx AS (SELECT conv_id, span, lead(first) OVER (PARTITION BY conv_id ORDER BY span) AS next,
    count(*) OVER (PARTITION BY conv_id) AS n_windows FROM sp),
r AS (
  SELECT s.*, n_windows,
    CASE WHEN place = 1 AND role1 = 'system' THEN chars * (n_windows - 1)
      WHEN next IS NOT NULL AND next - start <= 256 THEN chars ELSE 0 END AS again
  FROM s JOIN nx ON s.conv_id IS NOT DISTINCT FROM nx.conv_id AND s.span = nx.span),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '') AS loss,
    CAST(sum(chars + again) AS BIGINT) AS formatted_chars
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM c"""

TWINS["op11_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages),
b AS (SELECT *, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  strlen(body) >= 100 AND least IS NOT NULL AND page_id IS DISTINCT FROM least AS again FROM p)
SELECT page_id, payload_bytes, sha256(body) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN least END AS refers_to
FROM b"""


def _crc32(codes: str) -> str:
    """Unsigned CRC-32 of a list of bytes: each byte is followed by eight steps of the shift register."""
    steps = f"list_prepend(4294967295, flatten(list_transform({codes}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])))"
    turn = "CASE WHEN s >= 0 THEN xor(r, s) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"
    return f"xor(list_reduce(CAST({steps} AS BIGINT[]), lambda r, s: CAST({turn} AS BIGINT)), 4294967295)"


def _codes(text: str) -> str:
    """Bytes of a text below U+0800 in UTF-8."""
    return (
        f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] "
        "ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))"
    )


TWINS["op12_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
    sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS u
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list(u ORDER BY turn NULLS FIRST, u) AS us, list(chars ORDER BY turn NULLS FIRST, u) AS cs,
    {_crc32(_codes("CAST(conv_id AS VARCHAR)"))} % 6 AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.us[1:c.h], []), c.us[c.h + 1:]) AS us, list_concat(coalesce(b.cs[1:c.h], []), c.cs[c.h + 1:]) AS cs
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
m AS (SELECT conv_id, us, cs, unnest(range(0, len(us) + 1)) AS depth FROM r),
k AS (
  SELECT conv_id, depth, array_to_string(us[1:depth], ',') AS node, CASE WHEN depth > 0 THEN array_to_string(us[1:depth - 1], ',') END AS parent,
    us[1:depth] AS path, CASE WHEN depth > 0 THEN cs[depth] ELSE 0 END AS chars, depth = len(us) AS ends FROM m),
n AS (
  SELECT node, depth, any_value(parent) AS parent, any_value(path) AS path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM k GROUP BY node, depth),
kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (node, depth)),
a AS (SELECT path, unnest(range(0, depth + 1)) AS up, n_children = 0 AS leaf, (n_convs - 1) * chars AS saved FROM x),
s AS (
  SELECT array_to_string(path[1:up], ',') AS node, up AS depth, count(*) FILTER (WHERE leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM a GROUP BY ALL)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves, s.saved_tokens, x.ends_sha256
FROM x JOIN s USING (node, depth) LEFT JOIN x p ON p.node = x.parent AND p.depth = x.depth - 1"""

TWINS["op13_spelling"] = rf"""
WITH RECURSIVE t AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
d AS (SELECT name, run, count(*) AS k FROM t WHERE length(run) >= 5 GROUP BY ALL),
h AS (SELECT *, {_crc32(_codes("name || ':' || run"))} AS h FROM d),
v AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
g AS (SELECT word, n, length(word) AS size, unnest(range(1, length(word) + 1)) AS i FROM w),
x AS (SELECT *, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM g),
p AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM x a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM x a JOIN w b ON a.rest = b.word),
b AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM p GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n,
    CASE WHEN b.top >= 2 * w.n THEN (SELECT min(other) FROM p WHERE p.word = w.word AND p.other_n = b.top) END AS form
  FROM w LEFT JOIN b ON b.word = w.word),
r AS (SELECT word, word AS at FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.at WHERE f.form IS NOT NULL),
z AS (SELECT r.word, r.at AS root FROM r JOIN f ON f.word = r.at WHERE f.form IS NULL)
SELECT f.word, f.form, z.root, f.n, f.n_near, f.form_n FROM f JOIN z ON z.word = f.word"""
