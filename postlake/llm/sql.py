"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

#: Ten best integer inner products of each query vector.
OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

#: Lines whose word sets have a Jaccard similarity of 0.8 with an earlier line go.
OP4 = r"""
WITH l AS (
  SELECT doc_id, CAST(i AS INTEGER) AS line, string_split(text, chr(10))[i] AS content
  FROM (SELECT doc_id, coalesce(text, '') AS text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)
), w AS (
  SELECT doc_id, line, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(content), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS words FROM l
), s AS (
  SELECT words, len(words) AS n, min((doc_id, line)) AS first, row_number() OVER (ORDER BY words) AS id FROM w WHERE len(words) > 0 GROUP BY words
), t AS (
  SELECT id, n, unnest(words) AS word FROM s
), f AS (
  SELECT word, count(*) AS df FROM t GROUP BY word
), p AS (
  SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY df, word) AS place FROM t JOIN f USING (word)
), prefix AS (
  SELECT id, n, word FROM p WHERE place <= n - ((80 * n + 99) // 100) + 1
), pairs AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM prefix a JOIN prefix b ON a.word = b.word AND a.id < b.id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), alike AS (
  SELECT x, y FROM pairs JOIN s a ON a.id = x JOIN s b ON b.id = y
  WHERE 180 * len(list_intersect(a.words, b.words)) >= 80 * (a.n + b.n)
), earliest AS (
  SELECT x AS id, min(s.first) AS near FROM (SELECT x, y FROM alike UNION ALL SELECT y, x FROM alike) JOIN s ON s.id = y GROUP BY x
), keep AS (
  SELECT s.words, CASE WHEN near IS NULL OR first < near THEN first ELSE near END AS keep FROM s LEFT JOIN earliest USING (id)
), kept AS (
  SELECT l.doc_id, string_agg(l.content, chr(10) ORDER BY l.line) AS text
  FROM l JOIN w USING (doc_id, line) LEFT JOIN keep ON keep.words = w.words
  WHERE keep.keep IS NULL OR (l.doc_id, l.line) <= keep.keep
  GROUP BY l.doc_id
)
SELECT d.doc_id, CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
       CAST(strlen(coalesce(d.text, '')) - strlen(coalesce(k.text, '')) AS BIGINT) AS bytes_removed,
       md5(coalesce(k.text, '')) AS kept_md5
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

#: Documents and the benchmark items whose template windows they hold, slots checked.
OP7 = r"""
WITH units AS (
  SELECT list_concat(string_split('km cm mm kg mg ml mph kmh lb lbs oz ft hour hours minute minutes second seconds day days week weeks month months year years mile miles meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters gram grams kilogram kilograms liter liters litre litres gallon gallons inch inches foot feet yard yards ton tons pound pounds dollar dollars euro euros cent cents percent degree degrees', ' '), ['%', '$', '€', '£', '°']) AS u
), raw AS (
  SELECT DISTINCT 'd' AS side, doc_id AS id, text, regexp_extract_all(coalesce(text, ''), '[0-9]+(?:[.,:/][0-9]+)*|\p{L}+|[%$€£°]') AS t FROM documents
  UNION ALL
  SELECT DISTINCT 'b', item_id, NULL, regexp_extract_all(text, '[0-9]+(?:[.,:/][0-9]+)*|\p{L}+|[%$€£°]') FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), shape AS (
  SELECT side, id, text, row_number() OVER () AS r, t, list_transform(t, lambda x: lower(x)) AS l, list_transform(t, lambda x: CASE
      WHEN x[1] BETWEEN '0' AND '9' THEN '<number>'
      WHEN lower(x) <> x AND upper(x[1]) || lower(x[2:]) = x THEN '<name>'
      WHEN list_contains(u, lower(x)) THEN '<unit>' ELSE lower(x) END) AS m
  FROM raw, units
), tpl AS (
  SELECT *, list_transform(range(1, len(t) + 1), lambda i: CASE WHEN m[i] = '<name>' THEN l[i] ELSE m[i] END) AS f FROM shape
), b AS (
  SELECT id AS item_id, r AS item, t, l, m, f, least(8, len(t)) AS w FROM tpl WHERE side = 'b' AND len(t) > 0
), bw AS (
  SELECT *, len(list_filter(m[p:p + w - 1], lambda x: x NOT IN ('<number>', '<name>', '<unit>'))) AS plain
  FROM (SELECT *, unnest(range(1, len(t) - w + 2)) AS p FROM b)
), best AS (
  SELECT item, max(plain) AS most, count(*) FILTER (plain >= 5) AS windows FROM bw GROUP BY item
), wanted AS (
  SELECT item_id, 'window' AS kind, p AS place, windows AS n_of, m[p:p + w - 1] AS m, f[p:p + w - 1] AS f, t[p:p + w - 1] AS t FROM bw JOIN best USING (item) WHERE plain >= 5
  UNION ALL
  SELECT item_id, CASE WHEN len(t) < 3 THEN 'line' WHEN most < 2 THEN 'values' ELSE 'whole' END, 1, 1, m, f, t FROM b JOIN best USING (item) WHERE most < 5
), bench AS (
  SELECT item_id, kind, place, n_of, t, CASE WHEN kind IN ('values', 'line') THEN list_transform(t, lambda x: lower(x)) ELSE m END AS reading FROM wanted
  UNION
  SELECT item_id, kind, place, n_of, t, f FROM wanted WHERE kind IN ('window', 'whole')
), d AS (
  SELECT r, id AS doc_id, p AS spot, t[p:p + w - 1] AS t, l[p:p + w - 1] AS l, m[p:p + w - 1] AS m, f[p:p + w - 1] AS f
  FROM (SELECT *, unnest(range(1, len(t) - w + 2)) AS p FROM tpl, (SELECT DISTINCT len(reading) AS w FROM bench WHERE kind <> 'line') WHERE side = 'd' AND len(t) >= w)
), lines AS (
  SELECT r, id AS doc_id, i AS spot, regexp_extract_all(string_split(text, chr(10))[i], '[0-9]+(?:[.,:/][0-9]+)*|\p{L}+|[%$€£°]') AS t
  FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM tpl, (SELECT 1 FROM bench WHERE kind = 'line' LIMIT 1) WHERE side = 'd')
), said AS (
  SELECT r, doc_id, spot, 'template' AS how, t, m AS reading FROM d
  UNION
  SELECT r, doc_id, spot, 'template', t, f FROM d
  UNION
  SELECT r, doc_id, spot, 'values', t, l FROM d WHERE EXISTS (SELECT 1 FROM bench WHERE kind = 'values')
  UNION
  SELECT r, doc_id, spot, 'line', t, list_transform(t, lambda x: lower(x)) FROM lines
), hits AS (
  SELECT r, doc_id, item_id, bench.kind, place, n_of, spot - place AS off, reading, bench.t AS bt, said.t AS dt
  FROM bench JOIN said USING (reading)
  WHERE how = CASE WHEN bench.kind IN ('window', 'whole') THEN 'template' ELSE bench.kind END
), judged AS (
  SELECT *, list_filter(range(1, len(reading) + 1), lambda i: reading[i] IN ('<number>', '<name>', '<unit>')) AS slots,
         len(list_filter(range(1, len(reading) + 1), lambda i: lower(bt[i]) = lower(dt[i]))) AS same
  FROM hits
), paired AS (
  SELECT * EXCLUDE (slots), list_transform(slots, lambda i: {'b': lower(bt[i]), 'd': lower(dt[i])}) AS slots FROM judged
), win AS (
  SELECT *, len(list_filter(slots, lambda s: s.b <> s.d)) = 0 AS unchanged FROM paired
), aligned AS (
  SELECT r, doc_id, item_id, off, kind = 'line' AS line, count(DISTINCT place) AS n, count(DISTINCT place) FILTER (unchanged) AS verbatim, max(n_of) AS n_of, list_distinct(flatten(list(slots))) AS slots
  FROM win WHERE kind <> 'whole' OR unchanged OR same >= 0.5 * len(reading) GROUP BY ALL
), counted AS (
  SELECT *, CASE WHEN len(slots) = len(list_distinct(list_transform(slots, lambda s: s.b))) AND len(slots) = len(list_distinct(list_transform(slots, lambda s: s.d))) AND n >= 0.5 * n_of THEN n
      WHEN verbatim >= 6 OR verbatim >= 0.5 * n_of THEN verbatim ELSE 0 END AS windows
  FROM aligned
)
SELECT doc_id, item_id, CAST(sum(windows) AS BIGINT) AS n_windows, CAST(sum(verbatim) AS BIGINT) AS n_verbatim
FROM counted WHERE windows > 0 GROUP BY r, doc_id, item_id
"""

#: Ten best documents of each item by integer lexical scores.
OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
), f AS (
  SELECT r, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0
), s AS (
  SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM f
), tf AS (
  SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, doc_id, n, unnest(t) AS term FROM f) GROUP BY ALL
), i AS (
  SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), q AS (
  SELECT item_id, text, term, CAST(count(*) AS BIGINT) AS q FROM i GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
), scored AS (
  SELECT item_id, text, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {"op13_lexical": OP13, "op7_decontamination": OP7, "op4_line_dedup": OP4, "op9_topk": OP9}
