"""DuckDB SQL of operators' results, for tables on which plain joins of all rows are bearable."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase


def similar_groups(shingle: int, percent: int, more: str = "") -> str:
    """Sets of word shingles, all pairs that share one, and the least document that links reach."""
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  s AS MATERIALIZED (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= {shingle} THEN list_transform(range(1, len(w) - {shingle - 2}), lambda i: array_to_string(w[i:i + {shingle - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
  n AS MATERIALIZED (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  l AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
  twoway AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, x.b FROM reach r JOIN twoway x ON r.b = x.a),
  least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id{more} FROM documents d LEFT JOIN n USING (doc_id) JOIN least ON a = d.doc_id"""


def decontamination(window: int = 10) -> str:
    """Every window of the items, and of items of fewer words all of them, joined with all windows of documents as long."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents), i AS (SELECT item_id, {words} AS w FROM benchmark),
  iw AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), {window}) AS k, unnest(CASE WHEN len(w) >= {window} THEN list_transform(range(1, len(w) - {window - 2}), lambda j: array_to_string(w[j:j + {window - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM i),
  ks AS (SELECT DISTINCT k FROM iw),
  dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
  hits AS MATERIALIZED (SELECT DISTINCT doc_id, p, k, item_id FROM dw JOIN iw USING (k, g)),
  words AS (SELECT doc_id, count(DISTINCT q)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def clusters(k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64) -> str:
    """Exact integer clustering: every vector against every centroid."""
    out = [
        f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
  c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q AS m FROM (SELECT sha256('1:' || vec_id) AS h, q FROM kept WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT {k}))"""
    ]
    for i in range(rounds + 1):
        out.append(f"a{i} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY d, c) AS place FROM (SELECT row, vec_id, q, c, list_sum(list_transform(range(1, {width + 1}), lambda i: (q[i] - m[i]) * (q[i] - m[i])))::BIGINT AS d FROM kept, c{i})) WHERE place = 1)")
        if i < rounds:
            out.append(
                f"""s{i} AS (SELECT c, i, sum(q[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{i}, range(1, {width + 1}) r(i) GROUP BY ALL),
  c{i + 1} AS MATERIALIZED (SELECT c, coalesce(f, m) AS m FROM c{i} LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS f FROM s{i} GROUP BY c) USING (c))"""
            )
    return ",\n  ".join(out) + f"\nSELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (c)"


def _plus(state: str, cost: str, step: str) -> str:
    """A state is its cost in nine digits and its audit, so the least text is the cheapest and then the least audit."""
    return f"(lpad((left({state}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || {step})"


def repairs() -> str:
    """The damage by a checksum worked out bit by bit, the cheapest edits row by row, and the repaired text."""
    keep = lambda to: f"CASE WHEN initial = '{to}' THEN 'K' ELSE 'R' END"
    own = lambda to: f"CASE WHEN initial = '{to}' THEN 0 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    stay = lambda to, states: ", ".join(_plus(s, f"{own(to)} + {3 * i}", f"'{'I' * i}' || {keep(to)}") for s, i in states)
    may = "fault IN ('', 'truncated')"
    return f"""WITH RECURSIVE bits(n, k, v) AS (SELECT n, 0, n FROM range(256) t(n) UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
  tab AS MATERIALIZED (SELECT list(v ORDER BY n) AS tab FROM bits WHERE k = 8),
  raw AS (SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::BIGINT) AS codes FROM conversations),
  keyed AS (SELECT conv, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, codes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS k FROM raw, tab),
  hurt AS (SELECT conv, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM keyed WHERE k <> 0),
  placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '' END AS initial, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS tail FROM hurt),
  rows AS MATERIALIZED (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(initial) OVER (PARTITION BY conv ORDER BY i) AS before FROM placed),
  dp AS (SELECT DISTINCT conv, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM rows
    UNION ALL SELECT d.conv, r.i, {_plus('s0', '4', "'D'")}, least({_plus('s1', '4', "'D'")}, CASE WHEN {may} AND initial = 's' THEN {stay('s', [('s0', 0)])} END),
      least({_plus('s2', '4', "'D'")}, CASE WHEN {may} THEN least({stay('u', [('s0', 0), ('s1', 0), ('s2', 1), ('s3', 0)])}) END), least({_plus('s3', '4', "'D'")}, CASE WHEN {may} THEN least({stay('a', [('s0', 1), ('s1', 1), ('s2', 0), ('s3', 1)])}) END)
    FROM dp d JOIN rows r ON r.conv IS NOT DISTINCT FROM d.conv AND r.i = d.i + 1),
  ends AS MATERIALIZED (SELECT conv, least(s0, {_plus('s1', '6', "'II'")}, {_plus('s2', '3', "'I'")}, s3) AS best FROM dp WHERE (conv, i) IN (SELECT (conv, max(i)) FROM rows GROUP BY conv)),
  steps AS (SELECT conv, unnest(string_split(substr(best, 10), '')) AS e, generate_subscripts(string_split(substr(best, 10), ''), 1) AS spot FROM ends WHERE length(best) > 9),
  marked AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv ORDER BY spot) AS i, count(*) FILTER (e <> 'D') OVER (PARTITION BY conv ORDER BY spot) AS o FROM steps),
  kept AS (SELECT m.conv, e, spot, o, r.role, r.text, r.initial FROM marked m LEFT JOIN rows r ON r.conv IS NOT DISTINCT FROM m.conv AND r.i = m.i AND e <> 'I' WHERE e <> 'D'),
  led AS (SELECT *, max(CASE WHEN o = 1 AND e = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv) AS led FROM kept),
  lines AS (SELECT conv, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS body FROM led GROUP BY conv),
  sums AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(best, 9)::BIGINT, 0)::BIGINT AS cost, coalesce(substr(best, 10), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv IS NOT DISTINCT FROM c.conv_id LEFT JOIN lines l ON l.conv IS NOT DISTINCT FROM c.conv_id"""
