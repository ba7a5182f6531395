"""SQL that a second engine runs beside the queries."""

from __future__ import annotations

from tracklight.llm.license_texts import TEMPLATES

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, {LOWER} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM n WINDOW g AS (PARTITION BY body)
"""


def mixing(target: float, limit: float, share: float | None, seed: int = 0, documents: str = "documents", tail: str | None = None) -> str:
    """The mixture; ``tail`` replaces the columns of the registered query."""
    digest = lambda *parts: "('0x' || substr(md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts) + ")), 1, 15))::BIGINT"
    repeats = "pow(list_max(ps) / list_min(ps), 1 - a)" if share is None else f"pow(list_min(ps), a - 1) / list_sum(list_transform(ps, lambda p: pow(p, a))) * {share}"
    budget = "(SELECT max(ceil(tokens / weight)) FROM weighed WHERE weight > 0)" if share is None else f"floor((SELECT sum(tokens) FROM sizes) * {share})"
    tail = tail or "doc_id, source, mix_pass, mix_block, mix_key, mix_tokens, round(weight, 6) AS mix_weight"
    return f"""
WITH RECURSIVE counted AS (
  SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS mix_tokens FROM {documents}
), sizes AS (
  SELECT source AS mix_source, count(*) AS n, CAST(sum(mix_tokens) AS BIGINT) AS tokens FROM counted GROUP BY 1
), shares AS (
  SELECT list(tokens / (SELECT CAST(sum(tokens) AS DOUBLE) FROM sizes) ORDER BY mix_source) AS ps FROM sizes WHERE tokens > 0
), bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS h0, 1.0::DOUBLE AS h1, 0.0::DOUBLE AS r0, 1.0::DOUBLE AS r1, ps FROM shares
  UNION ALL
  SELECT step + 1, if(h_ok, hm, h0), if(h_ok, h1, hm), if(r_over, rm, r0), if(r_over, r1, rm), ps FROM (
    SELECT *, (h0 + h1) / 2 AS hm, (r0 + r1) / 2 AS rm,
      (SELECT ln(list_sum(list_transform(ps, lambda p: pow(p, a)))) - a * list_sum(list_transform(ps, lambda p: pow(p, a) * ln(p))) / list_sum(list_transform(ps, lambda p: pow(p, a)))
       FROM (SELECT (h0 + h1) / 2 AS a)) >= {target} * ln(len(ps)) AS h_ok,
      (SELECT {repeats} FROM (SELECT (r0 + r1) / 2 AS a)) > {limit} AS r_over
    FROM bisect WHERE step < 40)
), exponent AS (
  SELECT if(len(ps) < 2, 1.0, round(greatest(h0, r0), 6)) AS a FROM bisect WHERE step = 40
), raws AS (
  SELECT *, if(tokens > 0, pow(tokens / (SELECT CAST(sum(tokens) AS DOUBLE) FROM sizes), (SELECT a FROM exponent)), 0.0) AS raw FROM sizes
), weighed AS (
  SELECT *, round(raw / (SELECT sum(raw) FROM raws), 9) AS weight FROM raws
), owed AS (
  SELECT *, CAST(floor(weight * {budget}) AS BIGINT) AS quota, CAST(ceil(sqrt(n)) AS BIGINT) AS blocks FROM weighed
), plan AS (
  SELECT *, if(tokens > 0, quota // tokens, 1) AS passes, if(tokens > 0, quota % tokens, 0) AS rest FROM owed
), placed AS (
  SELECT c.*, s.blocks, s.weight, s.passes, s.rest, {digest("c.doc_id", seed)} % s.blocks AS home, {digest("c.doc_id", seed, "'row'")} AS mix_row
  FROM counted c JOIN plan s ON c.source IS NOT DISTINCT FROM s.mix_source
), totals AS (
  SELECT source, home, passes, rest, sum(mix_tokens) AS held, unnest(range(0, passes + 1)) AS mix_pass FROM placed GROUP BY 1, 2, 3, 4
), ordered AS (
  SELECT *, row_number() OVER w AS mix_block, sum(held) OVER (w ROWS UNBOUNDED PRECEDING) AS through
  FROM (SELECT *, {digest("source", "mix_pass", "home", seed)} AS mix_order FROM totals)
  WINDOW w AS (PARTITION BY source, mix_pass ORDER BY mix_order, home)
), kept AS (
  SELECT *, rest - (through - held) AS room FROM ordered WHERE mix_pass < passes OR rest - (through - held) > 0
), chosen AS (
  SELECT p.*, k.mix_pass, k.mix_block, {digest("p.mix_row", "k.mix_pass")} AS mix_key, if(k.mix_pass = k.passes AND k.held > k.room, k.room, NULL) AS room
  FROM placed p JOIN kept k ON p.source IS NOT DISTINCT FROM k.source AND p.home = k.home
), summed AS (
  SELECT *, sum(mix_tokens) OVER (PARTITION BY source, home, mix_pass ORDER BY mix_key, doc_id, mix_tokens ROWS UNBOUNDED PRECEDING) AS used FROM chosen
)
SELECT {tail} FROM summed WHERE room IS NULL OR used <= room
"""


MIXING = mixing(0.995, 4.0, 1.0)

TOOL_CALLS = """
WITH u AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, turn - 1 AS call_turn, turn, coalesce(text, '') AS text FROM conversations WHERE role = 'assistant'),
chains AS (SELECT conv_id, turn, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM u),
depths AS (SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS INT) AS level FROM chains)
SELECT u.conv_id, u.turn, 'call' AS kind, 'c' || u.turn AS call_id, if(r.turn IS NULL, 'unanswered', 'linked') AS status,
  concat_ws('; ', if(length(u.text) BETWEEN 1 AND 300, NULL, 'query is out of range'), if(u.turn >= 2 AND b.turn IS NULL, 'unknown reference $c' || (u.turn - 2), NULL)) AS errors,
  if(u.turn >= 2, 'c' || (u.turn - 2), '') AS depends_on, l.level AS level, coalesce(r.turn, -1) AS result_turn, if(r.turn IS NULL, 0, 1)::BIGINT AS results,
  '{"arguments":{' || if(u.turn >= 2, '"after":"$c' || (u.turn - 2) || '",', '') || '"query":' || to_json(u.text) || ',"turn":' || u.turn || '},"id":"c' || u.turn
    || '","name":"answer","result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' AS json
FROM u LEFT JOIN r ON u.conv_id = r.conv_id AND u.turn = r.call_turn LEFT JOIN u b ON u.conv_id = b.conv_id AND u.turn - 2 = b.turn JOIN depths l ON u.conv_id = l.conv_id AND u.turn = l.turn
UNION ALL
SELECT r.conv_id, r.turn, 'result', 'c' || r.call_turn, 'orphan', '', '', 0, r.turn, 1, '{"content":' || to_json(r.text) || ',"role":"tool"}'
FROM r LEFT JOIN u ON u.conv_id = r.conv_id AND u.turn = r.call_turn WHERE u.turn IS NULL
UNION ALL
SELECT conv_id, turn, 'message', '', '', '', '', 0, -1, 0, '{"content":' || to_json(coalesce(text, '')) || ',"role":' || to_json(coalesce(role, '')) || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""


def licenses(threshold: float = 0.8) -> str:
    """The licence scan; templates are given as values."""
    values = ", ".join("('" + name.replace("'", "''") + "', '" + text.replace("'", "''") + "')" for name, text in sorted(TEMPLATES.items()))
    normal = lambda x: f"lower(regexp_replace({x}, '[^A-Za-z0-9\\n]+', ' ', 'g'))"
    words = lambda x: f"list_filter(regexp_split_to_array({x}, '[ \\n]+'), lambda w: w <> '')"
    ratio = f"({threshold} / (2 - {threshold}))"
    common = lambda a, b: f"CAST(list_sum(list_transform(list_distinct({b}), lambda g: least(len(list_filter({b}, lambda x: x = g)), len(list_filter({a}, lambda x: x = g))))) AS INT)"
    return f"""
WITH RECURSIVE t AS (SELECT name AS template, {words(normal("body"))} AS w FROM (VALUES {values}) v(name, body)),
tb AS (SELECT template, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS bag FROM t WHERE len(w) > 1),
d AS (SELECT doc_id, {normal("coalesce(text, '')")} AS body FROM documents),
parts AS (SELECT doc_id, regexp_split_to_array(body, '\\n *\\n[ \\n]*') AS blocks, string_split(body, chr(10)) AS lines, body FROM d),
units AS (
  SELECT doc_id, 'line' AS unit, unnest(lines) AS part, unnest(range(1, len(lines) + 1)) AS unit_no FROM parts
  UNION ALL SELECT * FROM (SELECT doc_id, 'block' AS unit, unnest(blocks) AS part, unnest(range(1, len(blocks) + 1)) AS unit_no FROM parts) WHERE contains(trim(part), chr(10))
  UNION ALL SELECT doc_id, 'text', body, 1 FROM parts WHERE len(blocks) > 1
),
uw AS (SELECT doc_id, unit, unit_no, {words("part")} AS w FROM units),
ub AS (SELECT doc_id, unit, unit_no, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS bag FROM uw WHERE len(w) BETWEEN 2 AND 400),
pairs AS (
  SELECT doc_id, unit, unit_no, template, ub.bag AS a, tb.bag AS b FROM ub JOIN tb
  ON len(ub.bag) >= len(tb.bag) * {threshold} / (2 - {threshold}) - 1e-9 AND len(ub.bag) <= len(tb.bag) / ({threshold} / (2 - {threshold})) + 1e-9 AND list_has_any(ub.bag, tb.bag)
),
scored AS (SELECT *, {common("a", "b")} AS common FROM pairs),
numbered AS (SELECT row_number() OVER () AS row, doc_id, body, {words("body")} AS w FROM d WHERE contains(body, chr(10))),
fitting AS (
  SELECT row, doc_id, body, template, bag, len(bag) AS size FROM (SELECT *, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS held FROM numbered) JOIN tb
  ON len(list_intersect(held, bag)) + len(bag) - len(list_distinct(bag)) >= len(bag) * {ratio} - 1e-9
),
lined AS (SELECT row, template, {words("part")} AS w, no FROM (
  SELECT row, template, unnest(string_split(body, chr(10))) AS part, unnest(range(1, len(string_split(body, chr(10))) + 1)) AS no FROM fitting)),
placed AS (SELECT *, row_number() OVER g AS pos, sum(len(w)) OVER (g ROWS UNBOUNDED PRECEDING) AS through FROM lined WHERE len(w) > 0 WINDOW g AS (PARTITION BY row, template ORDER BY no)),
spans AS (
  SELECT row, doc_id, template, bag, size, s.pos AS p, e.pos AS q, s.no AS first, e.no AS last, CAST(e.through - s.through + len(s.w) - 1 AS INT) AS n
  FROM fitting JOIN placed s USING (row, template) JOIN placed e USING (row, template)
  WHERE e.pos >= s.pos AND e.through - s.through + len(s.w) - 1 BETWEEN size * {ratio} - 1e-9 AND size / {ratio} + 1e-9
),
spelled AS (
  SELECT row, doc_id, template, any_value(bag) AS b, any_value(size) AS size, first, last, any_value(n) AS n, flatten(list(l.w ORDER BY l.pos)) AS w
  FROM spans JOIN placed l USING (row, template) WHERE l.pos BETWEEN p AND q GROUP BY row, doc_id, template, first, last
),
runs AS (SELECT *, {common("a", "b")} AS common FROM (SELECT *, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS a FROM spelled)),
picks AS (
  SELECT row, doc_id, template, size, list({{'rank': -2 * common / (n + size), 'first': first, 'last': last, 'n': n, 'common': common}}
    ORDER BY -2 * common / (n + size), first, last) AS waiting FROM runs WHERE 2 * common >= {threshold} * (n + size) GROUP BY ALL
  UNION ALL
  SELECT row, doc_id, template, size, list_filter(waiting, lambda r: r.first > waiting[1].last OR r.last < waiting[1].first) FROM picks WHERE len(waiting) > 0
)
SELECT doc_id, unit, CAST(unit_no AS INT) AS unit_no, CAST(unit_no AS INT) AS last_no, template, common, CAST(len(a) AS INT) AS unit_bigrams, CAST(len(b) AS INT) AS template_bigrams,
  round(2 * common / (len(a) + len(b)), 6) AS dice
FROM scored WHERE 2 * common >= {threshold} * (len(a) + len(b))
UNION ALL
SELECT doc_id, 'run', CAST(waiting[1].first AS INT), CAST(waiting[1].last AS INT), template, waiting[1].common, waiting[1].n, CAST(size AS INT), round(-waiting[1].rank, 6)
FROM picks WHERE len(waiting) > 0 AND waiting[1].first < waiting[1].last
"""


#: What reading the written archives must give: payloads by length and digest, the largest page_id of equal payloads of 1,000 bytes or more.
WARC = """
WITH payloads AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), groups AS (
    SELECT payload_digest, max(page_id) AS keep FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM payloads LEFT JOIN groups USING (payload_digest)
"""
