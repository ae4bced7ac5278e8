"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    active_lloyd,
    balanced_packing,
    classifier_chain,
    cotraining,
    fair_mixing,
    fingerprint_exchange,
    host_graph,
    language_mixture,
    onebit_codes,
    positional_index,
    signature_tree,
    token_cache,
    zone_negatives,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(plan, sql: str | None = None):
    QUERIES[plan.__name__] = plan
    if sql:
        ORACLES[plan.__name__] = sql
    return plan


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_mixture.identify(table(spark, folder, "documents"))


EXACT_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM texts JOIN groups USING (body)
"""


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_exchange.exact_groups(table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return cotraining.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


NEAR_SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INT AS rank
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0)
WHERE rank <= 20
"""


def op4_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return onebit_codes.nearest(table(spark, folder, "embeddings"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return host_graph.judge(table(spark, folder, "pages"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_cache.count_tokens(table(spark, folder, "documents"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
ranked AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][(place - 1) % 3 + 1]::DOUBLE AS weight, 2 * source_size AS most
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
        FROM sized GROUP BY source)),
ended AS (  -- the sources that end before this one does
  SELECT *, coalesce(sum(most) OVER before, 0) AS sent, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest
  FROM ranked WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (
  SELECT max((1.5 * (SELECT sum(source_size) FROM ranked)::DOUBLE - sent::DOUBLE) / rest) AS level FROM ended),
targets AS (SELECT source, source_size, weight, least(most::DOUBLE, coalesce(level, 0) * weight) AS target FROM ranked, cut),
queue AS (
  SELECT doc_id, source, size,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY turn, md5('mix:' || turn || ':' || coalesce(doc_id::VARCHAR, '')), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized, (VALUES (0), (1)) t(turn)),
packets AS (
  SELECT doc_id, q.source, least(256, size - p * 256) AS words, (start + least(size, (p + 1) * 256))::DOUBLE / weight AS finish
  FROM queue q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source, unnest(range(0, (size + 255) // 256)) AS u(p)),
served AS (
  SELECT doc_id, words, coalesce(sum(words) OVER (ORDER BY finish, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM packets),
mixed AS (
  SELECT doc_id, sum(floor(least(words::DOUBLE, budget - place)))::BIGINT AS taken
  FROM served, (SELECT 1.5 * sum(source_size)::DOUBLE AS budget FROM ranked) WHERE place < budget GROUP BY doc_id),
taken AS (
  SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source LEFT JOIN mixed USING (doc_id))
SELECT * FROM taken
"""


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return fair_mixing.words_taken(table(spark, folder, "documents"))


def op8_jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return signature_tree.link_components(table(spark, folder, "documents"))


def op9_packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return balanced_packing.pack(table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return classifier_chain.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


LEAKS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[s:s + 9] AS gram, len(w[s:s + 9]) AS size
  FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT row, s, size, w[s:s + size - 1] AS gram FROM docs, sizes, unnest(range(1, greatest(len(w) - size + 2, 1))) AS t(s)),
found AS (SELECT row, s, g.size, item_id FROM grams g JOIN windows n ON g.gram = n.gram),
hits AS (SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(range(s, s + size)) AS pos FROM found) GROUP BY row),
listed AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN listed USING (row)
"""


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return positional_index.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


HARD_SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM kept a JOIN kept c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM negatives WHERE rank <= 3
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return zone_negatives.mine(rows.select("vec_id", "embedding", other.alias("label")))


def codes_sql(scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """All rounds written out: each compares every part with every entry."""
    assign = """
a{i} AS MATERIALIZED (
  SELECT row, part, min(struct_pack(d := d, entry := entry)) AS best FROM (
    SELECT x.row, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x)) AS d
    FROM xs x JOIN b{i} b ON x.part = b.part AND x.pos = b.pos GROUP BY ALL) GROUP BY ALL)"""
    move = """
b{j} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT x.part, a.best.entry AS entry, x.pos, ((sum(x.x) - (sum(x.x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM xs x JOIN a{i} a ON x.row = a.row AND x.part = a.part GROUP BY ALL) m
  ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)"""
    steps = [(move.format(i=i - 1, j=i) + "," if i else "") + assign.format(i=i) for i in range(rounds + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
xs AS MATERIALIZED (
  SELECT row, (k - 1) // (size // {parts}) AS part, (k - 1) % (size // {parts}) AS pos, floor({scale} * embedding[k]::DOUBLE)::BIGINT AS x
  FROM (SELECT row, embedding, len(embedding) AS size, unnest(range(1, len(embedding) + 1)) AS k FROM kept)),
b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, pos, x FROM xs WHERE row <= {entries}),{",".join(steps)},
coded AS (
  SELECT row, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY row),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (row), books
"""


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return active_lloyd.codes_and_errors(table(spark, folder, "embeddings"))


query(op1_language_id)
query(op2_exact_dedup, EXACT_SQL)
query(op3_quality)
query(op4_nearest_vectors, NEAR_SQL)
query(op5_url_filter)
query(op6_token_counts)
query(op7_source_mix, MIX_SQL)
query(op8_jaccard_components)
query(op9_packed_sequences)
query(op10_toxicity)
query(op11_decontamination, LEAKS_SQL)
query(op12_hard_negatives, HARD_SQL)
query(op13_vector_codes, codes_sql())
