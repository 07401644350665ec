"""One query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lathework.llm import ball_codes, exact_dedup, filter_audit, html_text, merkle, mixing, near_join, packing, pii, rules, suffix_dedup, toxicity, url_lists
from lathework.llm.registry import query
from lathework.plans.registry import table

TOKENIZER = "word_bpe_49k.json"


@query("op1_html_text")
def op1(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


START = 1_672_531_200  # the first day of the example lists and captures, in seconds
OP2_SQL = f"""
WITH cap AS (
  SELECT page_id, url, {START} + (page_id * 7919 % 365) * 86400 AS fetched_at,
         regexp_replace(regexp_extract(lower(coalesce(url, '')), '{url_lists.HOST}', 1), '\\.+$', '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host FROM cap WHERE host <> ''),
keys AS (
  SELECT host, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
                                     lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS domain
  FROM hosts),
dom AS (SELECT domain, ('0x' || substr(md5(domain), 1, 6))::BIGINT AS n FROM (SELECT DISTINCT domain FROM keys)),
ev AS (
  SELECT domain, 'block' AS kind, {START} + (n % 200 + o) * 86400 AS moment, a AS action
  FROM dom, (VALUES (0, 'add'), (60, 'remove'), (120, 'add')) v(o, a) WHERE n % 10 < 3
  UNION ALL SELECT domain, 'allow', {START} + (n % 100) * 86400, 'add' FROM dom WHERE n % 10 = 3
  UNION ALL SELECT domain, 'block', {START} + (n % 300) * 86400, 'add' FROM dom WHERE n % 10 = 4),
iv AS (
  SELECT domain, kind, since, until FROM (
    SELECT domain, kind, moment AS since, action, lead(moment) OVER (PARTITION BY domain, kind ORDER BY moment, action) AS until FROM ev)
  w WHERE action = 'add' AND (until IS NULL OR until > since)),
hit AS (
  SELECT cap.page_id, iv.kind, iv.domain,
         row_number() OVER (PARTITION BY cap.page_id ORDER BY length(iv.domain) DESC, iv.kind) AS place,
         count(*) OVER (PARTITION BY cap.page_id) AS n
  FROM cap JOIN keys USING (host) JOIN iv USING (domain)
  WHERE iv.since <= cap.fetched_at AND (iv.until IS NULL OR iv.until > cap.fetched_at))
SELECT cap.page_id, cap.url, cap.fetched_at, cap.host AS url_host, coalesce(hit.kind = 'block', false) AS url_blocked,
       hit.domain AS url_rule, coalesce(hit.n, 0) AS url_active
FROM cap LEFT JOIN hit ON cap.page_id = hit.page_id AND hit.place = 1
"""


@query("op2_url_lists", OP2_SQL)
def op2(spark, folder):
    captures = url_lists.with_fetch_time(table(spark, folder, "pages"), START)
    hosts = captures.select(url_lists.host_of(F.col("url")).alias("host")).filter("host != ''").distinct()
    return url_lists.judge(captures, url_lists.example_entries(hosts, START))


@query("op3_exact_dedup", """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER w AS place
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
""")
def op3(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@query("op4_packing")
def op4(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", packing.ids_crc32().alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op5_suffix_dedup")
def op5(spark, folder):
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op6_toxicity")
def op6(spark, folder):
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("spans")


OP7_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (
  SELECT doc_id, text, length(text)::BIGINT AS n,
         coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS nxt
  FROM d),
e AS (SELECT *, concat(substr(text, 1, n - n // 2), substr(nxt, 1, n // 2)) AS edited FROM n),
t AS (
  SELECT doc_id, n, edited,
    list_transform([text, edited, nxt], lambda v: list_transform(string_split(v, chr(10) || chr(10)),
      lambda s: list_transform(string_split(s, chr(10)),
        lambda p: array_to_string(list_transform(
          regexp_extract_all(p, '(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){1,4}|[\x20\x09-\x0D]+\\z'),
          lambda x: substr(md5(x), 1, 8)), '')))) AS trees
  FROM e),
b AS (
  SELECT doc_id, n, edited,
    list_transform(trees, lambda t: list_distinct(regexp_extract_all(array_to_string(flatten(t), ''), '.{8}'))) AS sets,
    list_transform(trees, lambda t: list_transform(t, lambda s: {
      'h': substr(md5(array_to_string(list_transform(s, lambda p: substr(md5(p), 1, 8)), '')), 1, 16),
      'p': array_to_string(list_transform(s, lambda p: concat(substr(md5(p), 1, 8), '.', p)), ',')})) AS branches
  FROM t),
f AS (
  SELECT doc_id, n, edited, sets,
    list_transform(branches, lambda b: concat(md5(array_to_string(list_transform(b, lambda s: s.h), '')), ':',
      array_to_string(list_transform(b, lambda s: concat(s.h, '=', s.p)), ';'))) AS prints
  FROM b)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, prints[1] AS fingerprint, prints[2] AS edited_fingerprint,
  CASE WHEN len(sets[1]) + len(sets[2]) = 0 THEN 1.0::DOUBLE
       ELSE 2.0::DOUBLE * len(list_intersect(sets[1], sets[2])) / (len(sets[1]) + len(sets[2])) END AS near_edited,
  CASE WHEN len(sets[1]) + len(sets[3]) = 0 THEN 1.0::DOUBLE
       ELSE 2.0::DOUBLE * len(list_intersect(sets[1], sets[3])) / (len(sets[1]) + len(sets[3])) END AS near_next
FROM f
"""


@query("op7_merkle", OP7_SQL)
def op7(spark, folder):
    found = merkle.edit_likeness(table(spark, folder, "documents"))
    return found.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


@query("op8_near_join")
def op8(spark, folder):
    return near_join.near_duplicates(table(spark, folder, "documents"))


OP9_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
level AS (
  SELECT 0 AS step, 1.5 * sum(source_size)::DOUBLE / sum(w) AS lam FROM s
  UNION ALL
  SELECT step + 1,
         (1.5 * (SELECT sum(source_size) FROM s)::DOUBLE
           - (SELECT coalesce(sum(2.0 * source_size), 0) FROM s WHERE w * lam >= 2.0 * source_size))
         / (SELECT sum(w) FROM s WHERE w * lam < 2.0 * source_size)
  FROM level WHERE step < 100 AND EXISTS (SELECT 1 FROM s WHERE w * lam < 2.0 * source_size)),
t AS (SELECT source, source_size, least(w * (SELECT max(lam) FROM level), 2.0 * source_size)::DOUBLE AS target FROM s),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS due,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS b
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (greatest(0, least(size, due - b)) + greatest(0, least(size, due - b - source_size)))::BIGINT AS taken
FROM r
"""


@query("op9_mixing", OP9_SQL)
def op9(spark, folder):
    # the contract's columns, in training order
    return op9_positions(spark, folder).drop("positions")


@query("op9_positions")
def op9_positions(spark, folder):
    return mixing.mix_summary(table(spark, folder, "documents")).withColumn("target", F.round("target", 6))


@query("op10_rules")
def op10(spark, folder):
    return rules.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
f AS (
  SELECT d.doc_id, part,
         concat(CASE WHEN len(words) < 100 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END,
                CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM d),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
k AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
v AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT concat(a.x, b.x, c.x, e.x, g.x) AS filter_order FROM v a, v b, v c, v e, v g
  WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
s AS (
  SELECT part, filter_order, step::INT AS step, substr(filter_order, step, 1) AS own, n, good, toxic, fails,
         translate(fails, substr(filter_order, 1, step - 1), '') = fails AS alive
  FROM k, o, range(1, 6) r(step)),
t AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (alive AND NOT contains(fails, own)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (alive AND contains(fails, own)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (NOT alive AND contains(fails, own)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (alive AND contains(fails, own)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (alive AND contains(fails, own)), 0)::BIGINT AS toxic_lost
  FROM s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM t
"""


@query("op12_filter_audit", OP12_SQL)
def op12(spark, folder):
    return filter_audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _op11_assign(k):
    return f"""
a{k} AS MATERIALIZED (
  SELECT p.r, p.part, min(64 * list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT + c.e) AS best
  FROM p JOIN c{k} c ON p.part = c.part GROUP BY p.r, p.part)"""


def _op11_round(k):
    return f"""{_op11_assign(k)},
s{k} AS (
  SELECT part, e, pos, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT a.part, a.best % 64 AS e, unnest(p.v) AS x, unnest(range(len(p.v))) AS pos FROM a{k} a JOIN p USING (r, part)) GROUP BY part, e, pos),
m{k} AS (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM s{k} GROUP BY part, e),
c{k + 1} AS MATERIALIZED (SELECT c.part, c.e, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m USING (part, e))"""


OP11_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, label NULLS FIRST, embedding) AS r,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, k AS part, q[k * w + 1:(k + 1) * w] AS v FROM (SELECT r, q, len(q) // 16 AS w FROM kept) z, range(16) t(k)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS e, v FROM p WHERE r <= 64),{_op11_round(0)},{_op11_round(1)},{_op11_assign(2)},
o AS (
  SELECT r, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY r),
b AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN o USING (r), b
"""


@query("op11_ball_codes", OP11_SQL)
def op11(spark, folder):
    return ball_codes.vector_codes(table(spark, folder, "embeddings"))


@query("op13_pii")
def op13(spark, folder):
    return pii.personal_data(table(spark, folder, "documents"))
