"""DuckDB SQL for the text queries that SQL can state. The others are tested against brute force."""

# As DuckDB reads an escape in E'' strings; the six ASCII space characters.
SPACES = r"[ \t\n\x0B\f\r]+"

OP2 = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
total AS (SELECT sum(sqrt(n)) AS w, sum(n) AS n FROM counts),
rates AS (SELECT source, sqrt(c.n) / t.w * CAST(t.n AS DOUBLE) / c.n AS rate FROM counts c, total t),
parts AS (SELECT source, rate, greatest(ceil(rate / 64.0), 1)::INT AS m FROM rates),
cdf AS (
  SELECT source, m, rate / m AS r, 0 AS k, exp(-rate / m) AS p, exp(-rate / m) AS c,
         (ceil(rate / m + 12 * sqrt(rate / m)) + 30)::INT AS last FROM parts
  UNION ALL
  SELECT source, m, r, k + 1, p * r / (k + 1), c + p * r / (k + 1), last FROM cdf WHERE k < last),
draws AS (
  SELECT d.doc_id, d.source, CAST('0x' || substr(md5('mix-1:' || d.doc_id || ':' || j), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM (SELECT doc_id, source, unnest(range(m)) AS j FROM documents JOIN parts USING (source)) d),
hits AS (SELECT doc_id, count(*) AS n FROM draws JOIN cdf USING (source) WHERE c <= u GROUP BY doc_id),
copies AS (SELECT doc_id, unnest(range(1, n + 1)) AS mix_copy FROM hits)
SELECT d.*, mix_copy, md5('mix-1:order:' || doc_id || ':' || mix_copy) AS mix_key FROM documents d JOIN copies USING (doc_id)
"""

OP3 = f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '{SPACES}'), lambda x: x <> '') AS w FROM documents),
cells AS (SELECT doc_id, unnest(w) AS b, unnest(range(1, len(w) + 1)) AS i, w FROM w),
pos AS (SELECT doc_id, i, b, CASE WHEN i > 1 THEN w[i - 1] END AS a FROM cells),
n AS (SELECT sum(len(w)) AS n FROM w),
u AS (SELECT b, count(*) AS n FROM pos GROUP BY b), ud AS (SELECT doc_id, b, count(*) AS n FROM pos GROUP BY doc_id, b),
p AS (SELECT a, b, count(*) AS n FROM pos WHERE a IS NOT NULL GROUP BY a, b),
pd AS (SELECT doc_id, a, b, count(*) AS n FROM pos WHERE a IS NOT NULL GROUP BY doc_id, a, b),
c AS (
  SELECT s.doc_id, s.i, coalesce(p.n - pd.n, 0) AS pair, ua.n - uda.n AS before, ub.n - udb.n AS single, (SELECT n FROM n) - len(w.w) AS others
  FROM pos s JOIN w USING (doc_id) JOIN u ub ON ub.b = s.b JOIN ud udb ON udb.doc_id = s.doc_id AND udb.b = s.b
  LEFT JOIN u ua ON ua.b = s.a LEFT JOIN ud uda ON uda.doc_id = s.doc_id AND uda.b = s.a
  LEFT JOIN p ON p.a = s.a AND p.b = s.b LEFT JOIN pd ON pd.doc_id = s.doc_id AND pd.a = s.a AND pd.b = s.b),
v AS (
  SELECT doc_id, CASE WHEN pair > 0 THEN pair / before
    ELSE (CASE WHEN i > 1 THEN 0.4::DOUBLE ELSE 1.0::DOUBLE END) * CASE WHEN single > 0 THEN single / others ELSE 1.0::DOUBLE / (others + 1) END END AS s,
    (CASE WHEN i > 1 THEN pair ELSE single END > 0)::INT AS seen FROM c)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, round(coalesce(sum(ln(s)), 0.0), 4)::DOUBLE AS log_score, coalesce(sum(seen), 0)::BIGINT AS n_seen
FROM w LEFT JOIN v ON v.doc_id = w.doc_id GROUP BY w.doc_id, w.w
"""

OP7 = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{SPACES}'), lambda x: x <> '') AS w FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM g),
again AS (SELECT doc_id, unnest(range(i, i + 5)) AS i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
reps AS (SELECT doc_id, count(DISTINCT i) AS n FROM again GROUP BY doc_id),
raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM raw WHERE regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY doc_id),
ls AS (SELECT doc_id, host, text, trim(regexp_replace(lower(x), '[ \\t\\x0B\\f\\r]+', ' ', 'g'), ' ') AS l
       FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS x FROM d)),
held AS (SELECT host, text, l, min(doc_id) AS doc, sum(len(string_split(l, ' '))) AS n FROM ls WHERE l <> '' GROUP BY host, text, l),
texts AS (SELECT host, text, sum(n) AS total FROM held GROUP BY host, text),
hosts AS (SELECT host, count(*) AS n FROM texts GROUP BY host),
freq AS (SELECT host, l, min(doc) AS owner FROM held JOIN hosts USING (host) GROUP BY host, l
         HAVING count(*) > 20 AND count(*) > 0.02 * max(hosts.n)),
owners AS (SELECT f.host, f.l, d.text AS owner FROM freq f JOIN d ON d.doc_id = f.owner),
lost AS (SELECT h.host, h.text, sum(n) AS lost FROM held h JOIN owners o ON h.host = o.host AND h.l = o.l AND h.text <> o.owner GROUP BY h.host, h.text),
gone AS (SELECT host, text FROM lost JOIN texts USING (host, text) WHERE 100 * lost > 70 * total),
m AS (
  SELECT d.doc_id, d.host, d.text, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
    length(regexp_replace(array_to_string(w.w, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(reps.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN reps USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND gone.text IS NULL AS kept
FROM m LEFT JOIN gone ON gone.host = m.host AND gone.text = m.text
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS raw FROM documents),
l AS (SELECT doc_id, unnest(raw) AS line, unnest(range(len(raw))) AS i FROM d),
s AS (SELECT doc_id, i, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS solid FROM l),
k AS (SELECT doc_id, i, solid, len(regexp_split_to_array(solid, '{SPACES}')) AS c, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM s WHERE solid <> ''),
a AS (SELECT doc_id, list(solid ORDER BY k) AS solid, list(c ORDER BY k) AS c, max(n) AS n FROM k GROUP BY doc_id),
u AS (SELECT doc_id, solid, n, c, unnest(range(n)) AS s FROM a),
w AS (SELECT doc_id, solid, n, s, CASE WHEN c[s + 1] >= 50 THEN 1 WHEN c[s + 1] + c[s + 2] >= 50 THEN 2 ELSE 3 END AS m FROM u),
r AS (SELECT doc_id, s, m, row_number() OVER (PARTITION BY solid[s + 1:s + m] ORDER BY doc_id, s) AS o FROM w WHERE s = 0 OR s + m <= n),
gone AS (SELECT DISTINCT k.doc_id, k.i FROM k JOIN r ON r.doc_id = k.doc_id AND r.o > 1 AND k.k BETWEEN r.s AND r.s + m - 1),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM l WHERE NOT EXISTS (
  SELECT 1 FROM gone WHERE gone.doc_id = l.doc_id AND gone.i = l.i) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN cut.n IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text,
  coalesce(a.n, 0)::BIGINT AS n_lines, coalesce(cut.n, 0)::BIGINT AS n_removed
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id) LEFT JOIN a USING (doc_id)
"""

OP11 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
o AS (SELECT lang, source, row, unnest(t) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
s AS (SELECT lang, source, coalesce(any_value(x.n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source) x USING (lang, source) GROUP BY lang, source),
full_p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, k.n AS all_n, v.n AS lang_n, v.v,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (s.n + v.v) AS p
  FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
t AS (SELECT lang, source, term, p, 1 + 1000000000::HUGEINT * (all_n + 1) // (lang_n + v) AS q FROM full_p WHERE n > 0),
tr AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM t WHERE p > q),
trr AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM tr),
pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, b.source AS item, coalesce(pv.value, 0) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source)
SELECT lang, source, 'term' AS part, item, value::BIGINT AS value, rank::INT AS rank FROM trr WHERE rank <= 200
UNION ALL
SELECT lang, source, 'pair', item, value::BIGINT, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT FROM pr
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
s AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
o AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d) GROUP BY row, term),
w AS (SELECT term, floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM o, s GROUP BY term, s.n),
m AS (SELECT row, doc_id, 25 + (75 * len(t) * s.n) // s.l AS m FROM d, s WHERE len(t) > 0),
q AS (SELECT item, term, count(*) AS k FROM (SELECT item, unnest(t) AS term FROM b) GROUP BY item, term),
r AS (SELECT item, m.row, m.doc_id, sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN o USING (term) JOIN m USING (row) GROUP BY item, m.row, m.doc_id),
f AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM f JOIN b USING (item) WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op2_mix_sources": OP2,
    "op3_backoff_scores": OP3,
    "op7_quality": OP7,
    "op9_line_dedup": OP9,
    "op11_source_divergence": OP11,
    "op12_ranked_search": OP12,
}
