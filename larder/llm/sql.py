"""DuckDB twins of the queries that SQL can express."""

OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS g FROM bi),
lens AS (SELECT DISTINCT n FROM win),
di AS (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n),
occ AS (SELECT DISTINCT di.rid, di.s, di.n, win.item_id FROM di JOIN win ON win.n = di.n AND win.g = array_to_string(di.w[s + 1:s + di.n], ' ')),
pos AS (SELECT rid, unnest(range(s, s + n)) AS p FROM occ),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM pos GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""

# pattern of each kind; the text before a match is the first group, the span the second
_CUES = "|".join(f for c in ("passport", "ssn", "iban", "account", "acct", "password", "konto", "cuenta", "compte") for f in (c, c.capitalize(), c.upper()))
_KINDS = {
    "email": r"(.*?)([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)",
    "ip": r"(.*?)([0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+))",
    "card": r"(.*?)([0-9](?:[\x20-]?[0-9])+)",
    "phone": r"(.*?)(\+[0-9][\x20().0-9-]+[0-9])",
    "url": r"(.*?(?:^|[^A-Za-z]))((?:http://|HTTP://|https://|HTTPS://|ftp://|FTP://)[^ \t\n\r\x0B\x0C<>\x22\x27`{}|\x5C^]*[^ \t\n\r\x0B\x0C<>\x22\x27`{}|\x5C^.,;:!?)])",
    "account": rf"(.*?(?:^|[^A-Za-z])(?:{_CUES})[ :=#\x22\x27]{{0,4}})([0-9A-Za-z-]{{6,}})",
}
_FOUND = " UNION ALL ".join(
    f"SELECT rid, {k} AS k, '{kind}' AS kind, regexp_extract_all(x, '(?s){p}', 1) AS g, regexp_extract_all(x, '(?s){p}', 2) AS v FROM t"
    for k, (kind, p) in enumerate(_KINDS.items()))
OP3 = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x FROM documents),
m AS ({_FOUND}),
e AS (SELECT rid, k, kind, g[i] AS g, v[i] AS v, i FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM m)),
p AS (SELECT rid, k, kind, v, sum(length(g)) OVER q + sum(length(v)) OVER q - length(v) AS s, regexp_replace(v, '[^0-9]', '', 'g') AS digits
      FROM e WINDOW q AS (PARTITION BY rid, k ORDER BY i)),
c AS (SELECT *, CASE kind
   WHEN 'ip' THEN regexp_full_match(v, '0*(?:[0-9]{{1,2}}|1[0-9]{{2}}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{{1,2}}|1[0-9]{{2}}|2[0-4][0-9]|25[0-5])){{3}}')
   WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(digits)),
        lambda i: CASE WHEN i % 2 = 0 THEN CAST(reverse(digits)[i + 1] AS INT)
             ELSE (2 * CAST(reverse(digits)[i + 1] AS INT)) // 10 + (2 * CAST(reverse(digits)[i + 1] AS INT)) % 10 END)) % 10 = 0
   WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
   WHEN 'account' THEN length(v) <= 40 AND length(digits) >= 2 ELSE true END AS ok FROM p),
a AS (SELECT rid, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
        count(*) FILTER (k = 4) AS n_url, count(*) FILTER (k = 5) AS n_account,
        string_agg(kind || ':' || s || ':' || (s + length(v)), ',' ORDER BY k, s) FILTER (k < 4) AS base,
        string_agg(kind || ':' || s || ':' || (s + length(v)), ',' ORDER BY k, s) AS spans
      FROM c WHERE ok GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       coalesce(n_url, 0) AS n_url, coalesce(n_account, 0) AS n_account,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a USING (rid)
"""

OP5 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS place FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
             row_number() OVER (ORDER BY cap / weight, source IS NULL, source) AS rn FROM w),
f AS (SELECT arg_min(level, rn) FILTER (level * weight < cap) AS level FROM l),
g AS (SELECT source, source_size, coalesce(least(f.level * weight, cap), cap) AS target FROM w, f),
o AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM d)
SELECT doc_id, o.source, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE CAST(round(target) AS BIGINT) // source_size * size
    + greatest(0, least(first + size, CAST(round(target) AS BIGINT) % source_size) - first) END AS BIGINT) AS taken
FROM o JOIN g ON o.source IS NOT DISTINCT FROM g.source
"""

OP8 = r"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM e
      WHERE label IS NOT NULL AND v IS NOT NULL AND list_count(v) = len(v) AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.label = b.label AND a.rid <> b.rid AND len(a.v) = len(b.v)
      WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
r(rid, seen) AS (SELECT rid, rid FROM e UNION SELECT r.rid, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT r.rid, min(e.vec_id) AS component_id FROM r JOIN e ON e.rid = r.seen GROUP BY r.rid),
n AS (SELECT a AS rid, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN c USING (rid) LEFT JOIN n USING (rid)
"""

# crc32 of the bytes b with the 256 step values of table t
_STEPS = """SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256)) AS i))"""
_CRC = "xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295)"
_BYTES = "list_transform(range(strlen({0})), lambda i: CAST('0x' || substr(hex({0}), CAST(2 * i + 1 AS INT), 2) AS BIGINT))"

OP11 = rf"""
WITH RECURSIVE steps AS ({_STEPS}),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
        unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS run FROM documents),
u AS (SELECT id, run, count(*) AS n, {_BYTES.format("(id || ':' || run)")} AS b FROM r GROUP BY id, run),
h AS (SELECT id, run, n, {_CRC} AS h FROM u, steps),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM h),
d AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
v AS (SELECT word, k, substr(word, 1, CAST(k AS INT)) || substr(word, CAST(k AS INT) + 2) AS x FROM (SELECT word, unnest(range(length(word))) AS k FROM d)),
p AS (SELECT a.word, b.word AS near FROM v a JOIN v b ON a.k = b.k AND a.x = b.x AND a.word <> b.word
      UNION SELECT v.word, v.x FROM v JOIN d ON d.word = v.x UNION SELECT v.x, v.word FROM v JOIN d ON d.word = v.x),
g AS (SELECT p.word, count(*) AS n_near, arg_min(near, (-d.n, near)) AS best, max(d.n) AS best_n FROM p JOIN d ON d.word = p.near GROUP BY p.word),
f AS (SELECT d.word, d.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * d.n THEN best END AS form, CASE WHEN best_n >= 10 * d.n THEN best_n END AS form_n FROM d LEFT JOIN g USING (word)),
c(word, last) AS (SELECT word, word FROM f UNION SELECT c.word, f.form FROM c JOIN f ON f.word = c.last WHERE f.form IS NOT NULL),
e AS (SELECT c.word, c.last AS root FROM c JOIN f ON f.word = c.last WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN e USING (word)
"""

OP12 = rf"""
WITH steps AS ({_STEPS}),
o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, count(*) AS own, {_BYTES.format("CAST(c AS VARCHAR)")} AS b FROM o GROUP BY c),
p AS (SELECT c, own, {_CRC} % 4 AS h, c - c % 20 AS base FROM s, steps),
l AS (SELECT p.*, least(h, coalesce(s.own, 0)) AS lead FROM p LEFT JOIN s ON s.c = p.base),
r AS (SELECT l.c, o.i AS i, role, text FROM l JOIN o ON o.c = l.base WHERE o.i < lead
      UNION ALL SELECT l.c, o.i - h + lead, role, text FROM l JOIN o ON o.c = l.c WHERE o.i >= h),
a AS (SELECT c, i + 1 AS depth, list({{'r': role, 't': text}}) OVER (PARTITION BY c ORDER BY i) AS path, len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM r
      UNION ALL SELECT c, 0, [], 0 FROM s),
m AS (SELECT c, depth, words, min(c) OVER q AS conv, count(*) OVER q AS n, max(depth) OVER (PARTITION BY c) AS size FROM a WINDOW q AS (PARTITION BY depth, path)),
u AS (SELECT m.*, b.conv AS parent FROM m LEFT JOIN m b ON b.c = m.c AND b.depth = m.depth - 1),
t AS (SELECT conv, depth, any_value(n) AS n, (any_value(n) - 1) * any_value(words) AS saved, any_value(parent) AS parent,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (depth = size), '')) AS ends_sha256 FROM u GROUP BY conv, depth),
k AS (SELECT parent AS conv, depth - 1 AS depth, count(*) AS kids FROM t WHERE depth > 0 GROUP BY parent, depth),
x AS (SELECT m.conv, m.depth, sum(t.saved) AS saved, count(*) FILTER (k.kids IS NULL) AS leaves
      FROM t LEFT JOIN k USING (conv, depth) JOIN m ON m.c = t.conv AND m.depth <= t.depth GROUP BY m.conv, m.depth)
SELECT conv AS conv_id, depth, parent AS parent_conv_id, n AS n_convs, coalesce(kids, 0) AS n_children, leaves AS n_leaves, CAST(x.saved AS BIGINT) AS saved_tokens, ends_sha256
FROM t JOIN x USING (conv, depth) LEFT JOIN k USING (conv, depth)
"""

OP13 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, row_number() OVER () AS rid FROM pages),
g AS (SELECT *, strlen(x) AS size, row_number() OVER (PARTITION BY x ORDER BY page_id DESC NULLS LAST, rid) AS k, max(page_id) OVER (PARTITION BY x) AS last FROM p)
SELECT page_id, size AS payload_bytes, sha1(x) AS payload_digest,
  CASE WHEN k > 1 AND size >= 1000 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN k > 1 AND size >= 1000 THEN last END AS refers_to
FROM g
"""

SQL = {"op11_spelling": OP11, "op12_turns": OP12, "op13_warc": OP13, "op8_embeddings": OP8, "op1_decontaminate": OP1, "op3_personal_data": OP3, "op5_mix": OP5}
