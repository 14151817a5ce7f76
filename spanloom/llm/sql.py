"""SQL (DuckDB) of the numbered queries that SQL can express on whole tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

OP2 = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
 win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
 low AS (SELECT g, min(doc_id) AS first FROM win GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
 gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN low USING (g) WHERE doc_id > first),
 word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
 kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM word LEFT JOIN gone USING (doc_id, p) WHERE gone.doc_id IS NULL GROUP BY 1),
 n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
 SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

OP5 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{ALNUM}') AS w FROM documents),
 b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, regexp_extract_all({_LOWERED}, '{ALNUM}') AS w FROM benchmark) WHERE len(w) > 0),
 win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
 found AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
 hit AS (SELECT doc_id, i, f.n, item_id FROM found f JOIN win USING (g)),
 word AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
 item AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
 SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
 FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)"""


def _similar(words: int, percent: int, columns: str) -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{SPACED}') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {words - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
 link AS (SELECT a, b FROM pair JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * m >= {percent} * (x.n + y.n - m)),
 reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
 comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY 1)
 SELECT d.doc_id, coalesce(n, 0) AS n_shingles, {columns} FROM d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)"""


OP7 = _similar(5, 75, "c AS component_id, c = d.doc_id AS kept")
OP11 = _similar(4, 85, "c AS component_id")

OP3 = """WITH d AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
 w AS MATERIALIZED (SELECT doc_id, i, md5(x[i:i + 399]) AS g FROM (SELECT doc_id, x, unnest(range(1, octet_length(x) - 398)) AS i FROM d)),
 s AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, 0) AS begins FROM w WHERE g IN (SELECT g FROM w GROUP BY 1 HAVING count(*) > 1)),
 r AS (SELECT doc_id, min(i) AS a, max(i) + 399 AS z FROM (SELECT doc_id, i, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s) GROUP BY doc_id, run),
 k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
 t AS (SELECT k.doc_id, sum(z - a + 1) AS n, count(*) AS spans, max(z) AS last, string_agg(hex(x[before + 1:a - 1]), '' ORDER BY a) AS kept FROM k JOIN d ON d.doc_id = k.doc_id GROUP BY 1)
 SELECT d.doc_id, CAST(octet_length(x) AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(CASE WHEN kept IS NULL THEN x ELSE unhex(kept || hex(x[last + 1:octet_length(x)])) END) AS kept_sha256 FROM d LEFT JOIN t ON t.doc_id = d.doc_id"""


def _op12() -> str:
    """Codes of 16 parts from codebooks of 64 entries, moved twice."""
    steps = ["b0 AS (SELECT p, e, q[p * w + 1:(p + 1) * w] AS c FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS e, q, w FROM v QUALIFY row_number() OVER (ORDER BY vec_id) <= 64), (SELECT unnest(range(16)) AS p))"]
    for k in range(3):
        # the entry's index in the last six bits: the least is the nearest entry, and the lowest of equals
        steps.append(f"a{k} AS MATERIALIZED (SELECT vec_id, x.p, any_value(x) AS x, min(64 * list_sum(list_transform(range(1, w + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) + e) AS m FROM x JOIN b{k} b ON x.p = b.p GROUP BY vec_id, x.p)")
        if k < 2:
            steps.append(f"s{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (SELECT p, m % 64 AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM (SELECT p, m, x, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY 1, 2, 3) GROUP BY 1, 2)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(s.c, b.c) AS c FROM b{k} b LEFT JOIN s{k} s ON b.p = s.p AND b.e = s.e)")
    return f"""WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q, len(embedding) // 16 AS w FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 x AS MATERIALIZED (SELECT vec_id, p, w, q[p * w + 1:(p + 1) * w] AS x FROM v, (SELECT unnest(range(16)) AS p)),
 {", ".join(steps)},
 t AS (SELECT vec_id, string_agg(printf('%02x', CAST(m % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY 1)
 SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256 FROM t JOIN v USING (vec_id)"""


OP12 = _op12()

#: The checksum's table is made by its rule; pairs share what is left of them without one letter.
OP13 = rf"""WITH RECURSIVE tab AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
 run AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS word FROM documents) WHERE length(word) >= 6 GROUP BY 1, 2),
 hex AS (SELECT word, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word)) AS x FROM run),
 crc AS (SELECT word, n, xor(list_reduce(list_transform(range(1, length(x), 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT)), lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]), 4294967295), 4294967295) AS h FROM hex, tab),
 v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN word[1:h % length(word)] || word[h % length(word) + 2:] ELSE word END AS word, n FROM crc) WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
 less AS (SELECT word, i, word[1:i - 1] || word[i + 1:] AS g FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
 pair AS (SELECT x.word AS a, y.word AS b FROM less x JOIN less y ON x.i = y.i AND x.g = y.g WHERE x.word <> y.word
  UNION SELECT l.word, v.word FROM less l JOIN v ON l.g = v.word UNION SELECT v.word, l.word FROM less l JOIN v ON l.g = v.word),
 best AS (SELECT a, n AS m, b, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS r, count(*) OVER (PARTITION BY a) AS k FROM pair JOIN v ON b = word),
 form AS (SELECT word, v.n, coalesce(k, 0) AS n_near, CASE WHEN m >= 5 * n THEN b END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM v LEFT JOIN (SELECT * FROM best WHERE r = 1) ON a = word),
 chain AS (SELECT word, word AS tip FROM form UNION SELECT chain.word, form.form FROM chain JOIN form ON chain.tip = form.word WHERE form.form IS NOT NULL),
 ends AS (SELECT chain.word, tip AS root FROM chain JOIN form ON tip = form.word WHERE form.form IS NULL)
 SELECT word, form, root, n, n_near, form_n FROM form JOIN ends USING (word)"""
