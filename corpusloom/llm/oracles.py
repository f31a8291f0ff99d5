"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from . import line_templates, repetition_rules, template_decontam

#: Windows of words found twice or more in their text, by plain grouping instead of a suffix array.
#: The longest repeat of a text: classes of equal runs of 1, 2, 4 ... words as long as some repeat, then the sum of
#: those powers, from the greatest down, by which repeated runs can be made longer and still repeat.
REPETITION = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, i, n, array_to_string(words[i:i + 2], ' ') AS s3, md5(array_to_string(words[i:i + {repetition_rules.MIN_REPEAT - 1}], ' ')) AS s8, md5(array_to_string(words[i:i + {repetition_rules.MAX_LONGEST}], ' ')) AS s101
  FROM (SELECT doc_id, words, len(words) AS n, unnest(range(1, len(words) + 1)) AS i FROM w)),
r AS (SELECT doc_id, i, i + 2 <= n AND count(*) OVER (PARTITION BY doc_id, s3) > 1 AS r3, i + {repetition_rules.MIN_REPEAT - 1} <= n AND count(*) OVER (PARTITION BY doc_id, s8) > 1 AS r8, i + {repetition_rules.MAX_LONGEST} <= n AND count(*) OVER (PARTITION BY doc_id, s101) > 1 AS r101 FROM p),
c AS (SELECT doc_id, r101, bool_or(r3) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3, bool_or(r8) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {repetition_rules.MIN_REPEAT - 1} PRECEDING AND CURRENT ROW) AS c8 FROM r),
a AS (SELECT doc_id, count(*) FILTER (c3) AS n_repeat_words, count(*) FILTER (c8) AS covered_words, bool_or(r101) AS too_long FROM c GROUP BY doc_id),
up AS (
  SELECT 0 AS lvl, doc_id, i, min(i) OVER one AS cls FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) WINDOW one AS (PARTITION BY doc_id, word) QUALIFY count(*) OVER one > 1
  UNION ALL
  SELECT a.lvl + 1, a.doc_id, a.i, min(a.i) OVER two FROM up a JOIN up b ON b.doc_id = a.doc_id AND b.i = a.i + (1 << a.lvl) WINDOW two AS (PARTITION BY a.doc_id, a.cls, b.cls) QUALIFY count(*) OVER two > 1
),
down AS (
  SELECT lvl, doc_id, i, cls, 1 << lvl AS longest FROM up QUALIFY lvl = max(lvl) OVER (PARTITION BY doc_id)
  UNION ALL
  SELECT lvl - 1, doc_id, i, CASE WHEN grows THEN min(i) OVER (PARTITION BY doc_id, cls, more) ELSE cls END, CASE WHEN grows THEN longest + (1 << (lvl - 1)) ELSE longest END
  FROM (SELECT *, bool_or(ok) OVER (PARTITION BY doc_id) AS grows
        FROM (SELECT d.*, u.cls AS more, u.cls IS NOT NULL AND count(*) OVER (PARTITION BY d.doc_id, d.cls, u.cls) > 1 AS ok FROM down d LEFT JOIN up u ON u.doc_id = d.doc_id AND u.lvl = d.lvl - 1 AND u.i = d.i + d.longest WHERE d.lvl > 0))
  WHERE ok OR NOT grows
),
longest AS (SELECT doc_id, max(longest) AS longest FROM down GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
b AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(covered_words, 0)::BIGINT AS covered_words, coalesce(too_long, false) AS too_long, (CASE WHEN longest >= {repetition_rules.MIN_REPEAT} THEN longest ELSE 0 END)::BIGINT AS longest_repeat
  FROM w LEFT JOIN a ON a.doc_id = w.doc_id LEFT JOIN l ON l.doc_id = w.doc_id LEFT JOIN longest ON longest.doc_id = w.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, longest_repeat, covered_words, covered_words::DOUBLE / greatest(n_words, 1) AS covered_fraction, base_failed, NOT base_failed AND covered_words::DOUBLE / greatest(n_words, 1) <= {repetition_rules.MAX_FRACTION} AND NOT too_long AS kept FROM f
"""

#: The template tree with the lines' own texts as keys, and one recursive step for each round of splits.
LINE_TEMPLATES = f"""
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, pos, line, regexp_replace(array_to_string(list_transform(string_split(line, ' '), lambda x: CASE WHEN regexp_matches(x, '\\p{{N}}') THEN '<*>' ELSE x END), ' '), '^ +| +$', '', 'g') AS key FROM l),
d AS (SELECT DISTINCT doc_id, key, len(string_split(key, ' ')) AS size, array_to_string(string_split(key, ' ')[1:{line_templates.DEPTH}], ' ') AS head FROM k WHERE key <> ''),
c AS (SELECT size || ' ' || head AS leaf, key, count(*) AS docs FROM d GROUP BY ALL),
g AS (
  SELECT leaf AS gid, key, docs, string_split(key, ' ') AS tokens, false AS done FROM c
  UNION ALL
  SELECT CASE WHEN member THEN gid WHEN likely THEN gid || chr(10) || 'other' WHEN frequent IS NULL THEN gid || chr(10) || place || ' other' ELSE gid || chr(10) || place || ' is ' || frequent END, key, docs, tokens, member
  FROM (
    SELECT o.*, j.likely, j.place, f.token AS frequent, j.likely AND 100 * len(list_filter(j.template, lambda x: o.tokens[x.p] = x.token)) >= {line_templates.SIMILARITY} * len(j.template) AS member
    FROM g o
    JOIN (SELECT gid, 100 * count(*) FILTER (fixed) >= {line_templates.SIMILARITY} * count(*) AS likely, arg_min(p, (fixed, -top, p)) FILTER (top >= {line_templates.MIN_DOCS} AND top < total) AS place, list(struct_pack(p := p, token := token)) FILTER (fixed) AS template
          FROM (SELECT *, 100 * top >= {line_templates.SIMILARITY} * total AS fixed FROM (SELECT gid, p, max(n) AS top, arg_max(token, n) AS token, sum(n) AS total FROM (SELECT gid, p, token, sum(docs) AS n FROM (SELECT gid, docs, unnest(range(1, len(tokens) + 1)) AS p, unnest(tokens) AS token FROM g WHERE NOT done) GROUP BY ALL) GROUP BY gid, p))
          GROUP BY gid HAVING max(total) >= {line_templates.MIN_DOCS} AND 100 * count(*) FILTER (100 * top >= {line_templates.SIMILARITY} * {line_templates.MIN_DOCS}) >= {line_templates.SIMILARITY} * count(*)) j ON o.gid = j.gid AND NOT o.done AND (j.likely OR j.place IS NOT NULL)
    LEFT JOIN (SELECT gid, p, token FROM (SELECT gid, docs, unnest(range(1, len(tokens) + 1)) AS p, unnest(tokens) AS token FROM g WHERE NOT done) GROUP BY ALL HAVING sum(docs) >= {line_templates.MIN_DOCS}) f ON f.gid = o.gid AND f.p = j.place AND f.token = o.tokens[j.place])
),
member AS (SELECT key, gid FROM g WHERE done),
placed AS (SELECT d.doc_id, d.key, CASE WHEN m.key IS NULL THEN 'line ' || d.key ELSE 'group ' || m.gid END AS template FROM d LEFT JOIN member m ON m.key = d.key),
found AS (SELECT template, min(doc_id) AS keeper FROM placed GROUP BY template HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCS}),
gone AS (SELECT doc_id, key FROM placed JOIN found ON placed.template = found.template WHERE doc_id <> keeper),
marked AS (SELECT k.*, g.key IS NOT NULL AS dropped FROM k LEFT JOIN gone g ON g.doc_id = k.doc_id AND g.key = k.key)
SELECT doc_id, CASE WHEN bool_or(dropped) AND NOT bool_or(key <> '' AND NOT dropped) THEN '' ELSE coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') END AS text, count(*) FILTER (key <> '') AS n_lines, count(*) FILTER (dropped) AS n_dropped FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""

#: RE2 has no lookbehind: what stands around a name or unit is matched and put back, and names are replaced twice,
#: as a match uses up the blank that the next name needs.
_T = template_decontam
_NAMES = rf"regexp_replace(regexp_replace(text, '([\p{{Ll}}\p{{N}},;:] )\p{{Lu}}\p{{Ll}}+([^\p{{L}}\p{{N}}\p{{M}}]|$)', '\1{_T.NAME}\2', 'g'), '([\p{{Ll}}\p{{N}},;:{_T.NAME}] )\p{{Lu}}\p{{Ll}}+([^\p{{L}}\p{{N}}\p{{M}}]|$)', '\1{_T.NAME}\2', 'g')"
_PLAIN = rf"trim(regexp_replace(lower({{}}), '[^\p{{{{L}}}}\p{{{{N}}}}\p{{{{M}}}}{_T.NAME}]+', ' ', 'g'))"
_TYPED = rf"string_split(regexp_replace(regexp_replace({{}}, '\p{{{{N}}}}+( ?)(?:{'|'.join(_T.UNITS)})( |$)', '{_T.NUMBER}\1{_T.UNIT}\2', 'g'), '\p{{{{N}}}}+', '{_T.NUMBER}', 'g'), ' ')"
_SLOT = f"regexp_matches({{}}, '[{_T.NUMBER}{_T.NAME}]')"

#: Every window of every document against every window of every item, in all forms: no seeds, no hashes.
DECONTAMINATION = rf"""
WITH src AS (SELECT true AS is_doc, doc_id AS id, text AS whole FROM documents WHERE text IS NOT NULL UNION SELECT false, item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
clean AS (SELECT *, translate(whole, '{_T.NAME}', ' ') AS text FROM src),
plain AS (SELECT is_doc, id, whole, {_PLAIN.format("text")} AS plain, {_PLAIN.format(_NAMES)} AS named FROM clean),
tokens AS (SELECT is_doc, id, whole, string_split(plain, ' ') AS raw, {_TYPED.format("plain")} AS typed, {_TYPED.format("named")} AS named FROM plain WHERE plain <> ''),
forms AS (SELECT is_doc, id, whole, raw, 0 AS kind, raw AS form FROM tokens UNION ALL SELECT is_doc, id, whole, raw, 1, typed FROM tokens UNION ALL SELECT is_doc, id, whole, raw, 2, named FROM tokens WHERE named <> typed),
every AS (SELECT *, greatest(len(raw) - {_T.WINDOW - 1}, 1) AS n_windows, unnest(range(0, greatest(len(raw) - {_T.WINDOW - 1}, 1))) AS pos FROM forms),
cuts AS (SELECT is_doc, id, whole, kind, n_windows, pos, raw[pos + 1:pos + {_T.WINDOW}] AS own, form[pos + 1:pos + {_T.WINDOW}] AS form FROM every),
win AS (SELECT *, count(*) OVER (PARTITION BY is_doc, id, whole, kind, form) AS copies FROM cuts WHERE kind = 0 OR form <> own),
item AS (SELECT * FROM win WHERE NOT is_doc AND (kind = 0 OR (copies = 1 AND n_windows > {_T.MIN_TOKENS - _T.WINDOW} AND len(list_filter(form, lambda x: NOT {_SLOT.format("x")})) > 0))),
doc AS (SELECT * FROM win WHERE is_doc),
plainly AS (SELECT DISTINCT d.id AS doc_id, d.whole AS doc, i.id AS item_id, i.whole AS item, i.n_windows, i.pos AS w FROM doc d JOIN item i ON d.form = i.form WHERE d.kind = 0 AND i.kind = 0),
place AS (SELECT d.id AS doc_id, d.whole AS doc, i.id AS item_id, i.whole AS item, i.n_windows, i.pos AS w, d.pos - i.pos AS shift, i.own AS iown, d.own AS down, i.form, unnest(range(1, {_T.WINDOW + 1})) AS p FROM doc d JOIN item i ON d.form = i.form WHERE d.kind > 0 AND i.kind > 0),
slot AS (SELECT DISTINCT doc_id, doc, item_id, item, n_windows, w, shift, iown[p] AS own, down[p] AS other FROM place WHERE {_SLOT.format("form[p]")}),
one AS (SELECT *, min(other) OVER (PARTITION BY doc_id, doc, item_id, item, shift, own) = max(other) OVER (PARTITION BY doc_id, doc, item_id, item, shift, own) AS one FROM slot),
fits AS (SELECT * FROM (SELECT *, bool_and(one) OVER (PARTITION BY doc_id, doc, item_id, item, shift, w) AS fits FROM one) WHERE fits),
filled AS (SELECT doc_id, doc, item_id, item, shift, count(DISTINCT own) AS n_slots FROM fits GROUP BY ALL),
agree AS (SELECT *, 0 AS n_slots FROM plainly UNION ALL SELECT f.doc_id, f.doc, f.item_id, f.item, f.n_windows, f.w, l.n_slots FROM fits f JOIN filled l ON f.doc_id IS NOT DISTINCT FROM l.doc_id AND f.doc = l.doc AND f.item_id = l.item_id AND f.item = l.item AND f.shift = l.shift),
total AS (SELECT doc_id, item_id, count(DISTINCT w) AS n_windows, n_windows::BIGINT AS item_windows, max(n_slots)::BIGINT AS n_slots FROM agree GROUP BY doc_id, doc, item_id, item, agree.n_windows),
enough AS (SELECT *, n_windows::DOUBLE / item_windows AS share FROM total WHERE n_windows >= {_T.MIN_WINDOWS} OR n_windows::DOUBLE / item_windows >= {_T.MIN_SHARE}),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY share DESC, n_windows DESC, item_windows DESC, n_slots DESC) AS r FROM enough)
SELECT doc_id, item_id, n_windows, item_windows, share, n_slots FROM best WHERE r = 1
"""
