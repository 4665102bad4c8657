"""Registered queries of the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickwin.llm.common import table

LLM_QUERIES: dict = {}
LLM_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql:
            LLM_SQL[name] = sql
        return fn
    return deco


# -- 1 token counts ------------------------------------------------------------

@register("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    import public_tokenizers
    from clickwin.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"),
                        public_tokenizers.path("word_bpe_49k.json"))


# -- 3 language ID -------------------------------------------------------------

@register("op3_language_id")
def op3_language_id(spark, sf_dir):
    from clickwin.llm import language_id as li
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return (li.predict(docs.withColumn("held_out", li.held_out("doc_id")), li.fit(docs),
                       ("doc_id", "held_out"))
            .select("doc_id", "held_out", "lang_pred", "score"))


# -- 4 license scans -----------------------------------------------------------

@register("op4_license_scan")
def op4_license_scan(spark, sf_dir):
    from clickwin.llm.license_scan import license_scan
    return license_scan(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 5 sharding ----------------------------------------------------------------

@register("op5_sharding")
def op5_sharding(spark, sf_dir):
    from clickwin.llm.sharding import place
    docs = place(table(spark, sf_dir, "documents", "doc_id", "text"), shards=40)
    return docs.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"))


# -- 6 WARC --------------------------------------------------------------------

OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
d AS (
  SELECT page_id, strlen(payload) AS payload_bytes,
         list_reduce(list_transform(range(32), lambda i:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
             1 + ((('0x' || hex[1 + 5 * (i // 4) : 5 + 5 * (i // 4)])::BIGINT
                   >> (5 * (3 - i % 4))::INT) & 31)]), lambda a, b: a || b) AS payload_digest
  FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""


@register("op6_warc", OP6_SQL)
def op6_warc(spark, sf_dir):
    from clickwin.llm.warc import captures_digest
    return captures_digest(table(spark, sf_dir, "pages", "page_id", "url", "html"))


# -- 7 mixing ------------------------------------------------------------------

OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('7:' || coalesce(doc_id::VARCHAR, '')) AS perm,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
r AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE
            - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
                                                  AND 1 PRECEDING), 0)::DOUBLE AS left_words,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS load,
         row_number() OVER o AS k
  FROM s WINDOW o AS (ORDER BY 3.0 * source_size / w, source NULLS LAST)),
c AS (SELECT min(k) AS k FROM r WHERE 3 * source_size * load > left_words * w),
t AS (
  SELECT r.source, r.source_size,
         CASE WHEN r.k >= c.k THEN (SELECT left_words / load FROM r x WHERE x.k = c.k) * r.w
              ELSE 3.0::DOUBLE * r.source_size END AS target
  FROM r, c),
n AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
g AS (
  SELECT d.doc_id, d.size, n.source_size, n.target, n.whole,
         n.target - n.whole * n.source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.perm, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN 2 * upto - size <= 2 * need THEN 1 ELSE 0 END))::BIGINT AS taken
FROM g
"""


@register("op7_mixing", OP7_SQL)
def op7_mixing(spark, sf_dir):
    from clickwin.llm.mixing import plan_mix
    docs = plan_mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return docs.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.size("places")).alias("taken"))


# -- 9 near-dedup ----------------------------------------------------------------

OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d
        WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d
      UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""


@register("op9_near_dedup", OP9_SQL)
def op9_near_dedup(spark, sf_dir):
    from clickwin.llm.near_dedup import link
    return link(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 10 exact top-k ---------------------------------------------------------------

OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@register("op10_top_k", OP10_SQL)
def op10_top_k(spark, sf_dir):
    from clickwin.llm.topk import top_k
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


# -- 8 LM scoring -----------------------------------------------------------------

@register("op8_lm_scoring")
def op8_lm_scoring(spark, sf_dir):
    from clickwin.llm.suffix_tree import lm_scores
    return lm_scores(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 2 benchmark decontamination -----------------------------------------------------

@register("op2_decontamination")
def op2_decontamination(spark, sf_dir):
    from clickwin.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text"), every_item=True)


# -- 11 SimHash near-dedup -------------------------------------------------------------

@register("op11_simhash")
def op11_simhash(spark, sf_dir):
    from clickwin.llm.simhash import simhash
    return simhash(table(spark, sf_dir, "documents", "doc_id", "text"))


# -- 12 source divergence audit ----------------------------------------------------------

OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text
  FROM documents),
t AS (
  SELECT lang, source, doc, unnest(regexp_extract_all(
      text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term
  HAVING count(DISTINCT doc) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, k.term, count(t.term) AS n
  FROM g JOIN k USING (lang)
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term GROUP BY ALL),
s AS (SELECT lang, source, sum(n)::BIGINT AS n FROM c GROUP BY lang, source),
p AS (
  SELECT c.lang, c.source, c.term, c.n, 1 + 1000000000 * (c.n + 2) // (s.n + 2 * v.v) AS p,
         1 + 1000000000 * (k.n + 2) // (v.n + 2 * v.v) AS q
  FROM c JOIN s USING (lang, source) JOIN v USING (lang) JOIN k USING (lang, term)),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part
                               ORDER BY value DESC, item)::INT AS rank FROM r)
WHERE part = 'pair' OR rank <= 10
"""


@register("op12_divergence", OP12_SQL)
def op12_divergence(spark, sf_dir):
    from clickwin.llm.divergence import divergence
    return divergence(table(spark, sf_dir, "documents", "lang", "source", "text"))


# -- 13 filter interaction audit -----------------------------------------------------------

OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
          100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(first < w.doc_id, false)] AS fails
  FROM w LEFT JOIN l USING (doc_id)),
n AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good,
         count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, fails),
i AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS f FROM i a, i b, i c, i d, i e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (
  SELECT part, o.f, k.i AS step, o.f[k.i] AS own, n.n, n.good, n.toxic, n.fails[o.f[k.i]] AS hit,
         list_bool_or(list_transform(o.f[1 : k.i - 1], lambda x: n.fails[x])) AS earlier,
         len(list_filter(n.fails, lambda x: x)) AS failed
  FROM n, o, i k),
a AS (
  SELECT part, array_to_string(list_transform(f, lambda x: 'ABCDE'[x]), '') AS filter_order,
         step::INT AS step, any_value(own) AS own,
         coalesce(sum(n) FILTER (NOT hit AND NOT coalesce(earlier, false)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (hit AND NOT coalesce(earlier, false)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND earlier), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (hit AND failed = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (hit AND NOT coalesce(earlier, false)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (hit AND NOT coalesce(earlier, false)), 0)::BIGINT AS toxic_lost
  FROM s GROUP BY part, f, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM a
"""


@register("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark, sf_dir):
    from clickwin.llm.filter_audit import filter_audit
    return filter_audit(table(spark, sf_dir, "documents", "doc_id", "lang", "text"),
                        table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
