"""DuckDB SQL of the queries that SQL can express, by other means than the operators': all pairs, whole windows, plain rules."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Distinct lines with their first stand; units are words of lines of 8 words or more, else characters if there are 8.
OP5 = rf"""
WITH line AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, {_WORDS.format('lines[i]')} AS w
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) AS t(i)),
kept AS (SELECT doc_id, line_no, array_to_string(w, ' ') AS t, w FROM line WHERE len(w) > 0),
least AS (SELECT t, any_value(w) AS w, min((doc_id, line_no)) AS f FROM kept GROUP BY t),
variant AS (
  SELECT t, f, 'w' AS unit, -1 AS place, t AS key FROM least WHERE len(w) >= 8
  UNION ALL SELECT t, f, 'w', p, array_to_string(list_concat(w[1:p - 1], w[p + 1:len(w)]), ' ') FROM least, unnest(range(1, len(w) + 1)) AS u(p) WHERE len(w) >= 8
  UNION ALL SELECT t, f, 'c', -1, t FROM least WHERE len(w) < 8 AND length(t) >= 8
  UNION ALL SELECT t, f, 'c', p, substring(t, 1, p - 1) || substring(t, p + 1) FROM least, unnest(range(1, length(t) + 1)) AS u(p)
    WHERE len(w) < 8 AND length(t) >= 8),
near AS (
  SELECT x.t, min(y.f) AS g FROM variant x JOIN variant y ON x.key = y.key AND x.unit = y.unit AND x.t <> y.t AND y.f < x.f
    AND (x.place = y.place OR x.place = -1 OR y.place = -1) GROUP BY x.t),
found AS (
  SELECT k.doc_id, k.line_no, l.f, n.g, (k.doc_id, k.line_no) = l.f AS own FROM kept k JOIN least l ON k.t = l.t LEFT JOIN near n ON n.t = k.t)
SELECT doc_id, line_no, keep[1] AS keep_doc_id, CAST(keep[2] AS INTEGER) AS keep_line_no, edits FROM (
  SELECT doc_id, line_no, CASE WHEN g IS NULL OR NOT own AND f < g THEN [f[1], f[2]] ELSE [g[1], g[2]] END AS keep,
    CASE WHEN g IS NULL OR NOT own AND f < g THEN 0 ELSE 1 END AS edits
  FROM found WHERE NOT own OR g IS NOT NULL)"""

OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS c FROM d, unnest(range(1, len(w) - 3)) AS u(i)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, unnest(range(0, 5)) AS v(k) WHERE c > 1 GROUP BY doc_id),
s AS (
  SELECT d.doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(regexp_extract_all(t, '\p{{L}}')) AS letters
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id),
x AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * len(lines)
    OR 2 * letters < word_chars OR 2 * len(regexp_extract_all(t, '\p{{Lu}}')) > letters OR (n_words >= 100 AND 20 * len(list_distinct(w)) < n_words)
    OR 10 * len(regexp_extract_all(t, '(?m)(?:\.\.\.|…)$')) > 3 * greatest(len(lines), 1)) AS kept
FROM x"""

#: Every shift at which a document and an item agree in 8 words, and of these the ones with 12 of 14 or a whole short item.
OP7 = rf"""
WITH doc AS (SELECT doc_id, {_WORDS.format("lower(coalesce(text, ''))")} AS w FROM documents),
item AS (SELECT row_number() OVER () AS k, item_id, w, len(w) AS n FROM (
  SELECT item_id, {_WORDS.format("lower(coalesce(text, ''))")} AS w FROM benchmark GROUP BY ALL) WHERE len(w) >= 8),
dw AS (SELECT doc_id, i - 1 AS i, w[i] AS x FROM doc, unnest(range(1, len(w) + 1)) AS u(i)),
iw AS (SELECT k, n, i - 1 AS j, w[i] AS x FROM item, unnest(range(1, n + 1)) AS u(i)),
hit AS (
  SELECT doc_id, k, any_value(n) AS n, i - j AS shift, count(*) AS agreeing, list(j) AS js
  FROM dw JOIN iw ON dw.x = iw.x GROUP BY doc_id, k, i - j HAVING count(*) >= 8),
good AS (
  SELECT * FROM hit WHERE CASE WHEN n < 14 THEN agreeing = n
    ELSE list_max([len(list_filter(js, lambda j: j >= s AND j < s + 14)) FOR s IN range(0, n - 13)]) >= 12 END)
SELECT doc_id, item_id, CAST(arg_max(shift, (agreeing, -shift)) AS INTEGER) AS first_word, CAST(max(agreeing) AS INTEGER) AS agreeing
FROM good JOIN item ON good.k = item.k GROUP BY doc_id, good.k, item_id"""

OP8 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, min(r.b) AS component_id FROM s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.sh)"""

QUERY_SQL = {"op5_line_dedup": OP5, "op6_quality_cascade": OP6, "op7_benchmark_decontamination": OP7, "op8_ngram_jaccard_join": OP8}
