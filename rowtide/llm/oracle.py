"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP10 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS s,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    len(regexp_extract_all(coalesce(text, ''), '[#$%&*|!<>=_~^]'))::BIGINT AS symbols,
    (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce('s' || source, 'n')) || ':' || coalesce(md5(text), 'null'))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / ((size + 1)::DOUBLE / (size + symbols + 1)) AS key FROM d),
t AS (SELECT s, source, sum(size)::BIGINT AS source_size FROM k GROUP BY ALL),
w AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS r FROM t),
v AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS wt FROM w),
l AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(wt) OVER () AS weights,
    coalesce(sum(source_size) OVER b, 0) AS full_before, coalesce(sum(wt) OVER b, 0) AS spent
  FROM v WINDOW b AS (ORDER BY source_size / wt, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 2::DOUBLE * source_size * (weights - spent) <= (total - 2::DOUBLE * full_before) * wt AS is_full FROM l),
g AS (SELECT *, sum(CASE WHEN is_full THEN source_size ELSE 0 END) OVER () AS sum_full,
    sum(CASE WHEN is_full THEN 0 ELSE wt END) OVER () AS sum_left FROM f),
p AS (SELECT s, source_size, CASE WHEN is_full THEN 2::DOUBLE * source_size
    ELSE wt * (total - 2::DOUBLE * sum_full) / sum_left END AS target FROM g),
q AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS epochs FROM p),
x AS (SELECT k.doc_id, k.size, q.source_size, q.target, q.epochs, q.target - q.epochs * q.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.s ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN q ON k.s = q.s)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""

# Suffixes of two labels, by country.
TWO_LABELS = [
    f"{name}.{country}"
    for country, names in {
        "ar": "com", "au": "com edu gov net org", "bd": "com", "br": "com gov net org", "cn": "com edu gov net org", "co": "com", "eg": "com",
        "hk": "com", "id": "co", "il": "co", "in": "co gov net org", "jp": "ac co go ne or", "ke": "co", "kr": "co or", "mx": "com", "my": "com",
        "ng": "com", "nz": "ac co govt net org", "pe": "com", "ph": "com", "pk": "com", "pl": "com", "sa": "com", "sg": "com", "th": "co",
        "tr": "com", "tw": "com", "ua": "com", "uk": "ac co gov ltd me nhs org plc sch", "ve": "com", "vn": "com", "za": "ac co",
    }.items()
    for name in names.split()
]

OP6 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
  WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM h),
b AS (SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 0 WHEN rule IS NOT NULL THEN 1 END AS bad FROM r),
hosts AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM b GROUP BY host),
hb AS (SELECT *, rtrim(regexp_extract(host, '([^@]*?)(:[0-9]*)?[.]?$', 1), '') AS bare FROM hosts),
hl AS (SELECT *, string_split(bare, '.') AS ls, regexp_full_match(bare, '[0-9]+([.][0-9]+){3}') OR starts_with(bare, '[') AS ip FROM hb),
hs AS (SELECT *, CASE WHEN list_contains([""" + ", ".join(f"'{x}'" for x in TWO_LABELS) + r"""], array_to_string(ls[-2:], '.')) THEN 2 ELSE 1 END AS w FROM hl),
nm AS (SELECT host, n, k, CASE WHEN ip THEN bare ELSE array_to_string(ls[-(w + 1):], '.') END AS domain,
  CASE WHEN ip THEN bare ELSE array_to_string(ls[-w:], '.') END AS suffix FROM hs),
dm AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM nm GROUP BY ALL),
sf AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM dm GROUP BY ALL),
lv AS (SELECT 'host' AS lv, n, k FROM nm UNION ALL SELECT 'domain', n, k FROM dm UNION ALL SELECT 'suffix', n, k FROM sf),
sm AS (SELECT lv, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, sum(n * n)::DOUBLE AS nn, count(*) AS g, sum(k::DOUBLE * k / n) AS kk
  FROM lv WHERE n > 0 GROUP BY lv),
ro AS (SELECT lv, k / n AS p, n - nn / n - (g - 1) AS room, kk, k, g FROM sm),
st AS (SELECT lv, round(1 / greatest(0.001::DOUBLE, least(0.5::DOUBLE, coalesce(
  CASE WHEN p > 0 AND p < 1 AND room > 0 THEN ((kk - p * k) / (p * (1 - p)) - (g - 1)) / room END, 0.5::DOUBLE))) - 1, 6) AS strength FROM ro),
one AS (SELECT (coalesce(sum(k), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2) AS m,
  coalesce((SELECT strength FROM st WHERE lv = 'suffix'), 1) AS ss, coalesce((SELECT strength FROM st WHERE lv = 'domain'), 1) AS ds,
  coalesce((SELECT strength FROM st WHERE lv = 'host'), 1) AS hs FROM sf),
ms AS (SELECT suffix, (k + ss * m) / (n + ss) AS sm FROM sf, one),
md AS (SELECT suffix, domain, (k + ds * sm) / (n + ds) AS dmn FROM dm JOIN ms USING (suffix), one),
ab AS (SELECT host, k + hs * dmn AS a, n - k + hs * (1 - dmn) AS b FROM nm JOIN md USING (suffix, domain), one),
lo AS (SELECT host, a / (a + b) - sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower_bound FROM ab)
SELECT page_id, host, path, rule,
  CASE bad WHEN 1 THEN 'block' WHEN 0 THEN 'allow' ELSE CASE WHEN lower_bound >= 0.5 THEN 'block' ELSE 'allow' END END AS verdict
FROM b JOIN lo USING (host)
"""

OP1 = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS hex FROM p),
w AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS winner FROM d),
bits AS (SELECT *, list_transform(range(0, 32), lambda i: (('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT
  >> (15 - 5 * (i % 4))) & 31) AS v FROM w)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM bits
"""

OP5 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS valid FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.valid AND b.valid AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(c.c, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(c.c, v.vec_id)) AS kept
FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN c ON v.vec_id = c.a
"""

# The unsigned CRC-32 of a decimal `doc_id`, bit by bit.
CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))))"""

OP11 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, """ + CRC32 + r""" AS h FROM documents),
e AS (SELECT *, len(ws)::BIGINT AS n, h // 10 AS g FROM d),
q AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
w AS (SELECT doc_id, unnest(range(n)) AS i, unnest(ws) AS own, ws, a, 1 + (n - a) // (3 + g % 8) AS p, n FROM q),
t AS (SELECT doc_id, i, n, CASE WHEN a IS NOT NULL AND i >= a THEN ws[(a + (i - a) % p + 1)::BIGINT] ELSE own END AS w FROM w),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS p FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 2),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM m),
s AS (SELECT doc_id, p, min(i) AS start, count(*) AS c FROM g GROUP BY doc_id, p, k HAVING count(*) >= greatest(p, 12 - p)),
r AS (SELECT doc_id, start, c + p AS length, min(p) AS period FROM s GROUP BY ALL),
o AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    min(struct_pack(a := -length, b := start, c := period)) AS top FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT t.doc_id, string_agg(t.w, ' ' ORDER BY t.i) AS kept FROM t LEFT JOIN gone ON t.doc_id = gone.doc_id AND t.i = gone.i
  WHERE gone.i IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.b::BIGINT AS start, (-top.a)::BIGINT AS length, top.c::BIGINT AS period,
  ((-1000 * top.a) // top.c)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN o ON d.doc_id = o.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""

OP12 = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, n_chars::VARCHAR AS c, source AS s, doc_id::VARCHAR AS i, text AS t,
    CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS u
  FROM (SELECT *, """ + CRC32 + r""" AS crc FROM documents)),
p AS (SELECT doc_id, lang, coalesce(strlen(i) || ':' || i, '-') || coalesce(strlen(s) || ':' || s, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(c) || ':' || c, '-') AS head, t, u FROM f),
l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS leaf, sha256(head || coalesce(strlen(u) || ':' || u, '-')) AS claim FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM l),
lv(h, tree, pos, d, n) AS (SELECT 0, tree, pos, leaf, n FROM o
  UNION ALL SELECT h + 1, tree, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (n + 7) // 8 FROM lv WHERE n > 1 GROUP BY h, tree, pos // 8, n),
roots AS (SELECT tree, d AS subroot, h AS height FROM lv WHERE n = 1),
tp(h, pos, d, n) AS (SELECT 0, tree, subroot, (SELECT count(*) FROM roots) FROM roots
  UNION ALL SELECT h + 1, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (n + 7) // 8 FROM tp WHERE n > 1 GROUP BY h, pos // 8, n),
nodes AS (SELECT h, tree, pos, d FROM lv WHERE n > 1
  UNION ALL SELECT height + tp.h, tree, tp.pos, tp.d FROM roots, tp WHERE tp.n > 1),
sib AS (SELECT h, tree, pos, d, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WINDOW w AS (PARTITION BY h, tree, pos // 8 ORDER BY pos)),
walk(doc_id, leaf, tree, h, pos, height, proof, d) AS (
  SELECT doc_id, leaf, o.tree, 0, pos, height, '', claim FROM o JOIN roots ON o.tree = roots.tree
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.h + 1, CASE WHEN w.h = w.height THEN w.tree // 8 ELSE w.pos // 8 END, w.height, w.proof || s.before || s.after, sha256(s.before || w.d || s.after)
  FROM walk w JOIN sib s ON s.h = w.h AND s.tree = w.tree AND s.pos = CASE WHEN w.h = w.height THEN w.tree ELSE w.pos END),
top AS (SELECT d AS root FROM tp WHERE n = 1),
steps AS (SELECT max(h) AS steps FROM tp)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, d AS folded_root, d = root AS verified
FROM walk JOIN roots USING (tree), top, steps WHERE walk.h = walk.height + steps
"""

OP13 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
n AS (SELECT doc_id, x, len(x) // 2 AS n FROM d),
p AS (SELECT doc_id, n, x, unnest(range(n // 100)) AS c FROM n WHERE n >= 100),
s AS (SELECT doc_id, c, substr(x, 200 * c + 1, 400) AS y, unnest(range(least(100, n - 99 - 100 * c))) AS j FROM p),
w AS MATERIALIZED (SELECT doc_id, 100 * c + j AS i, md5_number(substr(y, 2 * j + 1, 200)) AS w FROM s),
f AS (SELECT w, min(struct_pack(doc_id := doc_id, i := i)) AS f FROM w GROUP BY w HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM w JOIN f USING (w) WHERE f <> struct_pack(doc_id := doc_id, i := i)),
g AS (SELECT *, coalesce(i > lag(i) OVER o + 100, TRUE) AS new FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
c AS (SELECT doc_id, k, min(i) AS b, max(i) + 100 AS e FROM k GROUP BY doc_id, k),
t AS (SELECT c.*, lag(e, 1, 0) OVER (PARTITION BY c.doc_id ORDER BY b) AS before FROM c),
u AS (SELECT t.doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS last,
    string_agg(substr(x, 2 * before + 1, 2 * (b - before)), '' ORDER BY b) AS kept
  FROM t JOIN n ON t.doc_id = n.doc_id GROUP BY t.doc_id)
SELECT n.doc_id, n.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(x, 2 * last + 1), x))) AS kept_sha256
FROM n LEFT JOIN u ON n.doc_id = u.doc_id
"""

ORACLE: dict[str, str] = {
    "op1_warc_round_trip": OP1,
    "op4_source_mix": OP4,
    "op5_metric_join": OP5,
    "op6_url_reputation": OP6,
    "op10_exact_dedup": OP10,
    "op11_periodic_runs": OP11,
    "op12_merkle_manifest": OP12,
    "op13_repeated_passages": OP13,
}
