"""DuckDB SQL of the queries that SQL can express."""

# label, words, first word of the key phrase, words of the key phrase, base rule
_LICENCES = """
  ('mit', 'under the mit license', 1, 4, true),
  ('apache-2', 'apache license version 2', 1, 4, true),
  ('cc-by-nc', 'cc by nc', 1, 3, true),
  ('mit', 'permission is hereby granted free of charge to any person obtaining a copy', 1, 4, false),
  ('mit', 'spdx license identifier mit', 1, 4, false),
  ('apache-2', 'spdx license identifier apache 2', 1, 5, false),
  ('apache-2', 'you may not use this file except in compliance with the license', 8, 5, false),
  ('gpl-2', 'under the gnu general public license version 2', 4, 5, false),
  ('gpl-3', 'under the gnu general public license version 3', 4, 5, false),
  ('lgpl', 'gnu lesser general public license', 1, 5, false),
  ('agpl', 'gnu affero general public license', 1, 5, false),
  ('bsd', 'redistribution and use in source and binary forms with or without modification', 5, 4, false),
  ('mpl-2', 'mozilla public license version 2', 1, 5, false),
  ('cc-by-sa', 'cc by sa', 1, 3, false),
  ('cc0', 'cc0 1 0 universal', 1, 4, false),
  ('unlicense', 'this is free and unencumbered software released into the public domain', 3, 4, false)
"""

# rest of crc32 of decimal ids: a table from the polynomial, then byte by byte
_CRC = """
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table)"""


def _crc(text: str) -> str:
    characters = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    step = "lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295, {characters}), {step}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _tree(name: str, leaves: str, group: str) -> str:
    """CTEs ``<name>_up`` (all nodes by level) and ``<name>_run`` (their runs) over leaves ``grp``, ``pos``, ``digest``."""
    return f"""
{name}_up AS (
  SELECT {group} AS grp, 0 AS lvl, pos, digest, n FROM {leaves}
  UNION ALL
  SELECT grp, any_value(lvl) + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 15) // 16)
  FROM {name}_up WHERE n > 1 GROUP BY grp, pos // 16),
{name}_steps AS (
  SELECT me.grp, me.lvl, me.pos, coalesce(string_agg(other.digest, '' ORDER BY other.pos) FILTER (other.pos < me.pos), '') AS before,
    coalesce(string_agg(other.digest, '' ORDER BY other.pos) FILTER (other.pos > me.pos), '') AS after
  FROM {name}_up me JOIN {name}_up other
    ON me.grp IS NOT DISTINCT FROM other.grp AND me.lvl = other.lvl AND me.pos // 16 = other.pos // 16
  WHERE me.n > 1 GROUP BY ALL)"""


ORACLE = {
    "op1_decontaminate": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS key
  FROM item_words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(s)
  WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS key
  FROM words, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) t(s)),
hits AS (SELECT doc_id, s, n, item_id FROM places JOIN windows USING (n, key)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + n)) t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op2_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS key
  FROM words, unnest(range(1, greatest(len(w) - 33, 1))) t(s)),
repeated AS (SELECT key FROM windows GROUP BY key HAVING count(*) > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS places FROM windows SEMI JOIN repeated USING (key), unnest(range(s, s + 35)) t(p)
  GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(w[p], ' ' ORDER BY p) AS text
  FROM words LEFT JOIN gone USING (doc_id), unnest(range(1, len(w) + 1)) t(p)
  WHERE places IS NULL OR NOT list_contains(places, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op7_minhash_neardup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS key
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) t(s) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.key = b.key AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM words UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other)
SELECT words.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, words.doc_id = component_id AS kept
FROM words LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
""",
    "op5_license_scan": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
templates AS (
  SELECT label, string_split(words, ' ') AS t, k, kn, base
  FROM (VALUES""" + _LICENCES + r""") v(label, words, k, kn, base)),
places AS (
  SELECT doc_id, label, base, s, len(t) AS n,
    len([1 FOR i IN range(1, len(t) + 1) IF w[s + i] = t[i]]) AS same
  FROM words, templates, unnest(range(0, greatest(len(w) - len(t) + 1, 0))) p(s)
  WHERE w[s + k:s + k + kn - 1] = t[k:k + kn - 1]),
found AS (SELECT *, same / n AS share FROM places WHERE same / n >= 0.8),
rolled AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word,
    max(s) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM words LEFT JOIN rolled USING (doc_id)
""",
    "op11_prefix_trie": f"""
WITH {_CRC},
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place,
    md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, {_crc("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, place, id, chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 WHERE place < h
  UNION ALL
  SELECT conv_id, 1, place, id, chars FROM convs JOIN turns USING (conv_id) WHERE place >= h),
paths AS (
  SELECT conv_id, coalesce(list(id ORDER BY part, place) FILTER (id IS NOT NULL), []) AS ids,
    coalesce(list(chars ORDER BY part, place) FILTER (id IS NOT NULL), []) AS sizes
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
prefixes AS (
  SELECT conv_id, d, array_to_string(ids[1:d], '') AS key, d = len(ids) AS ends, coalesce(sizes[d], 0) AS chars
  FROM paths, unnest(range(0, len(ids) + 1)) t(d)),
nodes AS (
  SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY d, key),
kids AS (SELECT d - 1 AS d, left(key, 32 * (d - 1)) AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT *, coalesce(n_children, 0) AS kids FROM nodes LEFT JOIN kids USING (d, key)),
subtrees AS (
  SELECT a AS d, left(key, 32 * a) AS key, count(*) FILTER (kids = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM full_nodes, unnest(range(0, d + 1)) t(a) GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.kids AS n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN subtrees s ON s.d = n.d AND s.key = n.key
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.key = left(n.key, 32 * (n.d - 1))
""",
    "op12_line_dedup": """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, place, lines[place] AS line,
    translate(trim(lines[place], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split, unnest(range(1, len(lines) + 1)) t(place)),
shared AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first IS NOT NULL AND first <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN shared USING (key) GROUP BY doc_id
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE {_CRC},
hashed AS (
  SELECT doc_id, source, sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
    sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))} || {_field(
      "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS altered,
    {_crc("doc_id::VARCHAR")} % 5 = 0 AS tampered
  FROM documents, crc),
leaves AS (
  SELECT *, leaf AS digest, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
{_tree("doc", "leaves", "source")},
subroots AS (
  SELECT grp, digest, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM doc_up WHERE n = 1),
{_tree("src", "subroots", "0")},
doc_tops AS (SELECT grp, max(lvl) AS top FROM doc_up GROUP BY grp),
steps AS (
  SELECT l.doc_id, l.source, l.pos, s.lvl, s.before, s.after FROM leaves l JOIN doc_steps s
    ON s.grp IS NOT DISTINCT FROM l.source AND s.pos = l.pos // (16 ** s.lvl)::BIGINT
  UNION ALL
  SELECT l.doc_id, l.source, l.pos, t.top + s.lvl, s.before, s.after FROM leaves l
    JOIN doc_tops t ON t.grp IS NOT DISTINCT FROM l.source
    JOIN subroots r ON r.grp IS NOT DISTINCT FROM l.source
    JOIN src_steps s ON s.pos = r.pos // (16 ** s.lvl)::BIGINT),
proofs AS (SELECT source, pos, sha256(string_agg(before || after, '' ORDER BY lvl)) AS proof FROM steps GROUP BY source, pos),
folded AS (
  SELECT source, pos, 0 AS lvl, CASE WHEN tampered THEN altered ELSE leaf END AS cur FROM leaves
  UNION ALL
  SELECT f.source, f.pos, f.lvl + 1, sha256(s.before || f.cur || s.after)
  FROM folded f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.pos = f.pos AND s.lvl = f.lvl),
ends AS (SELECT source, pos, max_by(cur, lvl) AS cur FROM folded GROUP BY source, pos),
top AS (SELECT digest AS root FROM src_up WHERE n = 1)
SELECT l.doc_id, l.leaf, r.digest AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, e.cur AS folded_root, e.cur = root AS verified
FROM leaves l JOIN subroots r ON r.grp IS NOT DISTINCT FROM l.source
JOIN ends e ON e.source IS NOT DISTINCT FROM l.source AND e.pos = l.pos
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos, top
""",
}
