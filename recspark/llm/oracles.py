"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLES: dict[str, str] = {}

_BITS = " || ".join(f"lpad(bin(('0x' || substr(h, {i}, 2))::INTEGER), 8, '0')" for i in range(1, 40, 2))
_BASE32 = " || ".join(
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + "
    + " + ".join(f"{16 >> j} * substr(b, {5 * i + j + 1}, 1)::INTEGER" for j in range(5))
    + ", 1)"
    for i in range(32)
)
ORACLES["op1_warc_index"] = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), bits AS (
  SELECT *, {_BITS} AS b FROM p
), named AS (
  SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, max(page_id) OVER (PARTITION BY h) AS newest FROM bits
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM named
"""

ORACLES["op5_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), items AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, least(len(ws), 1)))) AS i FROM b)
), windows AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT r, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM items))
), hits AS (
  SELECT r, n, i, item_id FROM windows JOIN items USING (n, w)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

ORACLES["op6_url_filter"] = rf"""
WITH rest AS (
  SELECT page_id, coalesce(url, '') AS u,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id, u,
         translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT parts.page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host, '(^|\.)(spam|ads|casino|cheap|free)-[a-z]+\.') THEN 'block' ELSE 'allow' END)
         AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""

ORACLES["op9_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
), windows AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
), base AS (
  SELECT d.doc_id, t, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)
), counted AS (
  SELECT *, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND n_symbols * 10 <= n_words
       AND n_dup_lines * 10 <= len(ls) * 5
       AND len(regexp_extract_all(t, '[0-9]')) * 10 <= length(t) * 2
       AND len(regexp_extract_all(t, '[A-Z]')) * 10 <= length(t) * 3 AS kept
FROM counted
"""


def _rounds(steps: int, step) -> str:
    return ", ".join(step(t) for t in range(steps))


#: Books are numbered by round; ``d * 256 + j`` orders entries by distance, then by index.
def _codes_round(t: int) -> str:
    return f"""
  a{t} AS MATERIALIZED (
    SELECT v.r, v.p, min((v.xx + b.cc - 2 * list_inner_product(v.x, b.c))::BIGINT * 256 + b.j) AS best
    FROM cut v JOIN b{t} b USING (p) GROUP BY ALL
  ), m{t} AS (
    SELECT p, best % 256 AS j, i, sum(x[i]::BIGINT) AS s, count(*) AS n
    FROM a{t} JOIN cut USING (r, p), (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM cut))) AS i) GROUP BY ALL
  ), b{t + 1} AS MATERIALIZED (
    SELECT b.p, b.j, coalesce(k.c, b.c) AS c, list_inner_product(coalesce(k.c, b.c), coalesce(k.c, b.c)) AS cc
    FROM b{t} b LEFT JOIN (
      SELECT p, j, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM m{t} GROUP BY ALL
    ) k USING (p, j)
  )"""


ORACLES["op11_vector_codes"] = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT r, p, c AS x, list_inner_product(c, c) AS xx
  FROM (SELECT r, p, x[p * (len(x) // 4) + 1:(p + 1) * (len(x) // 4)] AS c FROM v, (SELECT unnest([0, 1, 2, 3]) AS p))
), b0 AS MATERIALIZED (
  SELECT p, r AS j, x AS c, xx AS cc FROM cut WHERE r < 256
), {_rounds(4, _codes_round)}, last AS (
  SELECT v.r, v.p, min((v.xx + b.cc - 2 * list_inner_product(v.x, b.c))::BIGINT * 256 + b.j) AS best
  FROM cut v JOIN b4 b USING (p) GROUP BY ALL
), coded AS (
  SELECT r, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error FROM last GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, j)) FROM b4) AS codebooks_sha256
FROM coded JOIN v USING (r)
"""


def _cluster_round(t: int) -> str:
    return f"""
  a{t} AS MATERIALIZED (
    SELECT v.r, min((v.xx + b.cc - 2 * list_inner_product(v.x, b.c))::BIGINT * 64 + b.j) AS best FROM v, b{t} b GROUP BY ALL
  ), m{t} AS (
    SELECT best % 64 AS j, i, sum(x[i]::BIGINT) AS s, count(*) AS n
    FROM a{t} JOIN v USING (r), (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY ALL
  ), b{t + 1} AS MATERIALIZED (
    SELECT b.j, coalesce(k.c, b.c) AS c, list_inner_product(coalesce(k.c, b.c), coalesce(k.c, b.c)) AS cc
    FROM b{t} b LEFT JOIN (
      SELECT j, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM m{t} GROUP BY ALL
    ) k USING (j)
  )"""


ORACLES["op12_centroid_clustering"] = f"""
WITH v AS MATERIALIZED (
  SELECT *, list_inner_product(x, x) AS xx, row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS r
  FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  )
), b0 AS MATERIALIZED (
  SELECT r AS j, x AS c, xx AS cc FROM v WHERE r < 40
), {_rounds(5, _cluster_round)}, last AS (
  SELECT v.r, min((v.xx + b.cc - 2 * list_inner_product(v.x, b.c))::BIGINT * 64 + b.j) AS best FROM v, b5 b GROUP BY ALL
), assigned AS (
  SELECT r, (best % 64)::INTEGER AS cluster, best // 64 AS distance FROM last
)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM assigned JOIN v USING (r) JOIN b5 ON j = cluster
"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _named(*words: str, value: str) -> str:
    names = "|".join(map(_any_case, words))
    return f"({names})" + r"""["'']?\x20*[:=]\x20*["'']?""" + f"([{value}]+)"


_ASSIGNED = _named("password", "passwd", "secret", "token", "api_?key", value="A-Za-z0-9+/_.=-")

#: kind, rank, pattern, group of the value, and what must hold of value v and match m
_FINDS = [
    (0, 0, _ASSIGNED, 2, "length(v) >= 12"),
    (1, 0, "AKIA[A-Z0-9]+", 0, "length(v) >= 18"),
    (2, 0, "[0-9a-f]+", 0, "length(v) >= 16"),
    (3, 1, _named("username", "user_?id", "user", "login", "account", "client_?id", "access_?key_?id", value="A-Za-z0-9+/_.@=-"), 2, "length(v) >= 3"),
    (4, 2, _named("passphrase", "passcode", "pass", "pwd", "credential", "private_?key", "auth_?key", "signature", value="A-Za-z0-9+/_.=-"), 2, "length(v) >= 6"),
    (4, 3, _ASSIGNED, 2, "length(v) BETWEEN 6 AND 11"),
    (5, 4, _named("hostname", "host", "server", "endpoint", value="A-Za-z0-9_.:/-"), 2, "length(v) >= 4"),
    (5, 5, r"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"''<>]+""", 0, "true"),
    (3, 6, r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}", 0, "true"),
    (5, 7, r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?", 0, "true"),
    (4, 8, "[0-9A-F]{16,}", 0, "regexp_matches(m, '[A-F]')"),
    (4, 9, "[A-Za-z0-9+/_-]{24,}", 0, "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')"),
]


def _found(pattern: str, group: int) -> str:
    """Rows (r, start, end, v, m) of a pattern's matches, placed by the lengths of what lies before them."""
    return f"""
    SELECT r, "end" - length(m) AS start, "end", v, m FROM (
      SELECT r, m, v, sum(length(m) + length(b)) OVER (PARTITION BY r ORDER BY i)::INTEGER AS "end" FROM (
        SELECT r, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(vs) AS v, unnest(bs[1:len(ms)]) AS b FROM (
          SELECT r, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs, regexp_split_to_array(t, '{pattern}') AS bs FROM d
        )
      )
    )"""


_KINDS = "['assign', 'access', 'hex', 'identifier', 'key', 'endpoint'][kind + 1]"
_SPANS = f"string_agg(concat_ws(':', {_KINDS}, start, \"end\"), ',' ORDER BY start, kind, \"end\")"
ORACLES["op13_secret_scan"] = (
    "WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), parts AS MATERIALIZED ("
    + " UNION ALL ".join(
        f"""
  SELECT r, start, {kind} AS kind, "end", CASE WHEN {kind} = 2 AND NOT regexp_matches(m, '[a-f]') THEN -1 ELSE {rank} END AS rank
  FROM ({_found(pattern, group)}) WHERE {test}"""
        for kind, rank, pattern, group, test in _FINDS
    )
    + rf"""
), breaks AS (
  SELECT r, start AS pos FROM ({_found(r"\n[\x20\x09\x0B-\x0D]*\n", 0)})
), clear AS MATERIALIZED (
  SELECT *, (SELECT count(*) FROM breaks WHERE breaks.r = p.r AND pos < p.start) AS scope FROM parts p
  WHERE rank <= 0 OR NOT EXISTS (
    SELECT 1 FROM parts o WHERE o.r = p.r AND o.rank < p.rank AND o.start < p."end" AND p.start < o."end"
  )
), met AS (
  SELECT p.r, p.start, p.kind, p."end", bool_or(o.kind IN (1, 3)) AS identifier, bool_or(o.kind IN (0, 2, 4)) AS secret, bool_or(o.kind = 5) AS endpoint
  FROM clear p JOIN clear o ON o.r = p.r AND o.scope = p.scope AND p.rank > 0 AND o.rank >= 0
       AND greatest(o.start - p."end", p.start - o."end") BETWEEN 0 AND 160
  GROUP BY ALL
), spans AS (
  SELECT r, start, kind, "end" FROM parts WHERE rank <= 0
  UNION ALL
  SELECT r, start, kind, "end" FROM met
  WHERE CASE WHEN kind IN (1, 3) THEN secret WHEN kind IN (0, 2, 4) THEN identifier OR endpoint ELSE identifier AND secret END
), told AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         {_SPANS} AS spans, {_SPANS} FILTER (kind < 3) AS base
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (r)
"""
)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
