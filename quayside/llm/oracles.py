"""SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Table of CRC-32 (reflected polynomial EDB88320) made by its rule, then folded over the bytes.
SHARDING = """
WITH RECURSIVE bits AS (SELECT n, n::BIGINT AS v, 0 AS k FROM range(256) t(n) UNION ALL SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size FROM documents),
crc AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS c
  FROM (SELECT doc_id, hex(encode(text)) AS h FROM d) x, tab),
s AS (SELECT d.doc_id, d.size, coalesce(c.c, 0) AS text_crc32 FROM d LEFT JOIN crc c USING (doc_id)),
r AS (SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id, text_crc32, size) AS n FROM s),
p AS (SELECT *, least(39, CAST((2 * upto - size) * 40 // (2 * greatest(total, 1)) AS INTEGER)) AS shard FROM r)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, n - min(n) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard FROM p
"""

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
gram AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM win),
twice AS (SELECT rid, i FROM gram QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
gaps AS (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS n FROM twice),
rep AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM gaps GROUP BY rid),
ln AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(list_filter(w, lambda x: length(x) >= 2 AND replace(upper(x), 'ẞ', 'SS') = x AND lower(x) <> x)) AS n_upper_words
  FROM d JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
f AS (SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 10 * n_symbols > word_chars THEN 4 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
  + (CASE WHEN n_words >= 10 AND word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN n_words >= 10 AND word_chars > 15 * n_words THEN 32 ELSE 0 END) + (CASE WHEN n_upper_words >= 10 AND 2 * n_upper_words > n_words THEN 64 ELSE 0 END) AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed, n_lines, n_upper_words FROM f
"""


MIXING = rf"""
WITH rw AS (SELECT doc_id, source, len({_WORDS}) AS size, (('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), chr(0)) || ':' || md5(coalesce(text, chr(0)))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rw GROUP BY source),
wt AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM src),
lv AS (SELECT *, CAST((sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0)) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS lvl FROM wt WINDOW w AS (ORDER BY cap / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lm AS (SELECT *, max(CASE WHEN lvl * weight < cap THEN lvl END) OVER () AS level FROM lv),
tg AS (SELECT source, source_size, CASE WHEN level * weight < cap THEN level * weight ELSE CAST(cap AS DOUBLE) END AS target FROM lm),
wh AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS whole FROM tg),
re AS (SELECT *, greatest(0, target - whole * source_size) AS rest FROM wh),
hs AS (SELECT rw.source, re.source_size, re.rest, rw.size, CAST(sum(rw.size) AS HUGEINT) AS words FROM rw JOIN re ON rw.source IS NOT DISTINCT FROM re.source WHERE rw.size > 0 AND re.rest > 0 GROUP BY ALL),
hc AS (SELECT source, rest, size, words, CAST(source_size - coalesce(sum(words) OVER w, 0) AS DOUBLE) AS sure, CAST(coalesce(sum(words * size) OVER w, 0) AS DOUBLE) AS squares FROM hs WINDOW w AS (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ft AS (SELECT source, arg_min(sure, size) AS sure, arg_min(squares, size) AS squares FROM hc WHERE squares / size + sure <= rest GROUP BY source),
al AS (SELECT source, CAST(sum(words * size) AS DOUBLE) AS squares FROM hs GROUP BY source),
gl AS (SELECT re.*, CASE WHEN al.squares IS NOT NULL THEN re.rest - coalesce(ft.sure, 0) END AS chance, coalesce(ft.squares, al.squares) AS squares FROM re LEFT JOIN al ON re.source IS NOT DISTINCT FROM al.source LEFT JOIN ft ON re.source IS NOT DISTINCT FROM ft.source),
gt AS (SELECT *, squares / chance AS level FROM gl),
rk AS (SELECT rw.*, gt.source_size, gt.target, gt.whole, gt.chance, gt.level, CASE WHEN rw.size > 0 AND rw.size < gt.level THEN (rw.u * (gt.level - rw.size)) / (rw.u * (gt.level - rw.size) + (1 - rw.u) * rw.size) END AS q FROM rw JOIN gt ON rw.source IS NOT DISTINCT FROM gt.source),
cu AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q RANGE UNBOUNDED PRECEDING) AS upto, sum(size) OVER (PARTITION BY source, q) AS own FROM rk WHERE q IS NOT NULL),
ct AS (SELECT source, max(q) AS cut FROM cu WHERE upto <= chance OR (upto - own < chance AND upto - chance < chance - (upto - own)) GROUP BY source),
cp AS (SELECT rk.*, CAST(least(3, whole + CASE WHEN size >= level OR q <= cut THEN 1 ELSE 0 END) AS INTEGER) AS copies FROM rk LEFT JOIN ct ON rk.source IS NOT DISTINCT FROM ct.source)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies, coalesce(least(1.0::DOUBLE, size / level), 0) AS inclusion FROM cp
"""

SQL = {"op2_sharding": SHARDING, "op8_quality_rules": QUALITY, "op9_mixing": MIXING}
