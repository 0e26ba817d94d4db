"""DuckDB SQL for the results of operators 11 to 13, over whole tables.

DuckDB has no CRC-32: it is computed from the bytes of a text, half a byte at
a time, with the polynomial's table of 16 entries.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _nibble_table() -> str:
    out = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(f"{x}::BIGINT")
    return f"[{', '.join(out)}]"


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 bytes of ``text``, an SQL
    expression whose code points lie below U+0800."""
    table = _nibble_table()
    codes = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)"
    data = f"flatten(list_transform({codes}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END))"
    half = f"xor(({{c}}) >> 4, {table}[((({{c}}) & 15) + 1)::INT])"
    step = half.format(c=half.format(c="xor(acc, b)"))
    return f"xor(list_reduce({data}, lambda acc, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


OP11 = f"""
WITH runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) AS r FROM documents),
per_doc AS (SELECT k, translate(r, '{_UPPER}', '{_LOWER}') AS w, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT w, c, {crc32("k || ':' || w")} AS h FROM per_doc),
thinned AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, c FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM thinned WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
holes AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, length(word) + 1) AS t(i)),
near AS MATERIALIZED (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
    UNION ALL SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word)),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, other := other)) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b.less >= 10 * w.n THEN b.other END AS form, CASE WHEN -b.less >= 10 * w.n THEN -b.less END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  WITH RECURSIVE steps(word, here) AS (
    SELECT word, word FROM forms
    UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.here = f.word WHERE f.form IS NOT NULL)
  SELECT s.word, s.here AS root FROM steps s JOIN forms f ON s.here = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n FROM forms f JOIN walk USING (word)
"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP12 = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
  FROM items, range(1, len(ws) - least(len(ws), 10) + 2) AS t(i) WHERE len(ws) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
found AS MATERIALIZED (
  SELECT row_id, i, d.n, item_id FROM (
    SELECT row_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM docs, lengths, range(1, len(ws) - n + 2) AS t(i)) d
  JOIN windows USING (n, w)),
hit AS (SELECT row_id, count(DISTINCT p) AS n_hit FROM found, range(i, i + n) AS t(p) GROUP BY row_id),
named AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row_id) LEFT JOIN named USING (row_id)
"""

OP13 = f"""
WITH turns AS (
  SELECT conv_id, turn, md5(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM turns),
convs AS MATERIALIZED (SELECT c AS conv_id, {crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM turns)),
mixed AS (
  SELECT c.conv_id, 0 AS part, p.pos, p.digest, p.n FROM convs c JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 100 AND p.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, p.pos, p.digest, p.n FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos > c.h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, n, string_agg(digest, '') OVER w AS path, lead(1) OVER w IS NULL AS last
  FROM mixed WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
members AS MATERIALIZED (
  SELECT conv_id, depth, n, path, last FROM paths
  UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM mixed) FROM convs),
nodes AS MATERIALIZED (
  SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(n) AS n,
         sha256(coalesce(string_agg(CASE WHEN last THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256,
         left(path, length(path) - 32) AS up
  FROM members GROUP BY path),
children AS MATERIALIZED (SELECT up AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
sums AS (
  SELECT above.path, sum(CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((below.n_convs - 1) * below.n) AS saved
  FROM nodes below LEFT JOIN children c ON c.path = below.path, range(0, below.depth + 1) AS t(d)
  JOIN nodes above ON above.path = left(below.path, 32 * d) GROUP BY above.path)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, CASE WHEN x.depth > 0 THEN p.conv_id END AS parent_conv_id, x.n_convs,
       coalesce(c.n_children, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM nodes x JOIN sums s ON s.path = x.path LEFT JOIN children c ON c.path = x.path LEFT JOIN nodes p ON p.path = x.up AND x.depth > 0
"""

ORACLE_SQL: dict[str, str] = {"op11_spelling_variants": OP11, "op12_decontamination": OP12, "op13_prefix_trie": OP13}
