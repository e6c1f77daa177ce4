"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter.llm import (
    divergence, fingerprint, html_text, line_dedup, mixing, ngram_join, packing, quality, sharding,
    suffix_dedup, toxicity, vector_codes, vector_search,
)
from talkmeter.llm.common import ROW, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_search.nearest(vectors, F.col("vec_id") % 50 == 0)


ORACLES["op3_vector_search"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS query, q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.r <> q.r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id)::INT AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_common_lines(docs).select(
        f"{ROW}.doc_id", "n_lines", "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


LINE_KEYS = """
lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {documents})
  )
), common AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
"""
ORACLES["op5_line_dedup"] = f"""
WITH {LINE_KEYS.format(documents="documents")}
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c USING (key)
GROUP BY doc_id
"""


@query
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed(docs, keep_row=False).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


MIX = """
sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM {documents}
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3.0, 1.0, 2.0][
      1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS full_size
  FROM sizes
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(full_size) OVER (
      ORDER BY full_size / weight, source IS NULL, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (
      ORDER BY full_size / weight, source IS NULL, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level_here
  FROM weighted
), targets AS (
  SELECT source, source_size, least(full_size, coalesce(max(
      CASE WHEN level_here * weight <= full_size THEN level_here END) OVER () * weight, full_size))
      AS target
  FROM levels
), rates AS (
  SELECT *, floor(rate)::BIGINT AS whole, rate - floor(rate) AS fraction
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
), chances AS (
  SELECT doc_id, source, size, k, source_size, target, whole, fraction,
    ('0x' || substr(md5(concat_ws('|', 'mix', k, coalesce(doc_id::VARCHAR, ''),
                                  coalesce(source, ''))), 1, 12))::BIGINT::DOUBLE
      / 281474976710656 AS chance
  FROM (
    SELECT sized.doc_id, sized.source, size, source_size, target, whole, fraction
    FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
  ), range(16) seeds(k)
), seeds AS (
  SELECT source, k FROM (
    SELECT source, k, row_number() OVER (PARTITION BY source ORDER BY
      abs(sum(CASE WHEN chance < fraction THEN size ELSE 0 END)
          - (any_value(target) - any_value(whole) * any_value(source_size))), k) AS place
    FROM chances GROUP BY source, k
  ) WHERE place = 1
), mixed AS (
  SELECT c.*, whole + (chance < fraction)::BIGINT AS copies
  FROM chances c JOIN seeds s ON c.source IS NOT DISTINCT FROM s.source AND c.k = s.k
)
"""
ORACLES["op6_source_mix"] = f"""
WITH {MIX.format(documents="documents")}
SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed
"""


@query
def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    return toxicity.classified(docs, labels, keep_row=False)


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.scored(docs, table(spark, sf_dir, "labels"))


@query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.passages(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("mark")


def suffix_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = suffix_dedup.cut(docs).select("__row.doc_id", "text")
    return rows.withColumn("n_chars", F.length("text"))


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents").select("text", "lang", "source"))


ORACLES["op12_source_divergence"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), counts AS (
  SELECT doc, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term,
    count(*) AS n
  FROM (SELECT doc, lang, source, unnest(w) AS w FROM words) GROUP BY ALL
), vocabulary AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING count(*) >= 30
), langs AS (
  SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS size
  FROM (SELECT DISTINCT lang FROM words) LEFT JOIN vocabulary USING (lang) GROUP BY lang
), occurrences AS (
  SELECT lang, source, term, sum(c.n) AS n
  FROM counts c JOIN vocabulary USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT lang, source, coalesce(sum(n), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM words) LEFT JOIN occurrences USING (lang, source)
  GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, t.term, coalesce(o.n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(o.n, 0) + 5)::HUGEINT // (g.size + 5 * l.v)::HUGEINT)::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (t.n + 5)::HUGEINT // (l.size + 5 * l.v)::HUGEINT)::BIGINT AS q
  FROM groups g JOIN langs l USING (lang) JOIN vocabulary t USING (lang)
  LEFT JOIN occurrences o ON o.lang = g.lang AND o.source = g.source AND o.term = t.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


NEAREST = """
near_{k} AS MATERIALIZED (
  SELECT r, m, any_value(x) AS x, min(struct_pack(away := xx - 2 * list_inner_product(x, c) + cc, e := e)) AS best
  FROM pieces JOIN book_{k} USING (m) GROUP BY r, m
)"""
MOVED = """
book_{n} AS MATERIALIZED (
  SELECT m, e, c, list_inner_product(c, c) AS cc FROM (
    SELECT b.m, b.e, coalesce(moved.c, b.c) AS c FROM book_{k} b LEFT JOIN (
      SELECT m, e, list(c ORDER BY d) AS c FROM (
        SELECT m, best.e AS e, d, floor(sum(x[d]) / count(*)) AS c
        FROM near_{k}, range(1, 1 + (SELECT max(len(v)) FROM vectors) // 16) t(d)
        GROUP BY ALL
      ) GROUP BY m, e
    ) moved USING (m, e)
  )
)"""
ORACLES["op13_vector_codes"] = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS MATERIALIZED (
  SELECT r, m, x, list_inner_product(x, x) AS xx
  FROM (SELECT r, m, v[m * (len(v) // 16) + 1 : (m + 1) * (len(v) // 16)] AS x FROM vectors, range(16) t(m))
), book_0 AS MATERIALIZED (
  SELECT m, r AS e, x AS c, xx AS cc FROM pieces WHERE r < 64
), {NEAREST.format(k=0)}, {MOVED.format(k=0, n=1)}, {NEAREST.format(k=1)}, {MOVED.format(k=1, n=2)},
{NEAREST.format(k=2)}, codes AS (
  SELECT r, string_agg(lower(printf('%02x', best.e)), '' ORDER BY m) AS code,
    sum(best.away)::BIGINT AS error
  FROM near_2 GROUP BY r
), digest AS (
  SELECT sha256(string_agg(c[d]::BIGINT::VARCHAR, ',' ORDER BY m, e, d)) AS codebooks_sha256
  FROM book_2, range(1, 1 + len(c)) t(d)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN vectors USING (r), digest
"""
