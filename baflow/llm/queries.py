"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from baflow.llm import decontam, jaccard, langid, lm, mixing, negatives, packing, pii, pivots, resampling, secret_scan, toxicity, url_filter
from baflow.llm.common import fold, read


def op1_subsequence_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), may_learn=fold("doc_id", 3) != 1)
    return toxicity.score(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op2_concat_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op3_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", F.size("leaks").alias("n_items"), (F.size("leaks") > 0).alias("contaminated"),
                        F.col("leaks.item_id").alias("item_ids"), F.col("leaks.distance").alias("distances"))


def op4_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op5_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lm.score(docs, fold("doc_id", 5) != 1).select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_ftrl_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs, may_learn=fold("doc_id", 4) != 2)
    return langid.identify(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op8_count_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_filter.judge(pages, listed_hosts=url_filter.hosts_with_words(pages))


def op10_pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_shared_list_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decisions(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_bit_sliced_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_subsequence_svm": op1_subsequence_svm,
    "op2_concat_packing": op2_concat_packing,
    "op3_cgk_decontamination": op3_cgk_decontamination,
    "op4_forest_secrets": op4_forest_secrets,
    "op5_deleted_interpolation": op5_deleted_interpolation,
    "op6_ftrl_langid": op6_ftrl_langid,
    "op7_boosted_pii": op7_boosted_pii,
    "op8_count_vector_join": op8_count_vector_join,
    "op9_bloom_cascade": op9_bloom_cascade,
    "op10_pivot_permutations": op10_pivot_permutations,
    "op11_shared_list_negatives": op11_shared_list_negatives,
    "op12_hash_threshold_mix": op12_hash_threshold_mix,
    "op13_bit_sliced_resampling": op13_bit_sliced_resampling,
}

OP9_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
           THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN list_has_any(regexp_split_to_array(host, '[.-]'), ['adult', 'bets', 'casino', 'pills', 'spam']) THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled"""

OP11_SQL = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 10"""

# sources by code point are compared as bytes; a source is capped if the level at which it and all fuller ones
# share what the emptier ones leave is at or above its cap
OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) - 1) % 3 + 1] AS weight FROM docs GROUP BY source),
levels AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW w AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)),
capped AS (SELECT *, weight * level >= 2 * source_size AS stops FROM levels),
told AS (
  SELECT source, source_size, weight,
         least((2 * source_size)::DOUBLE, weight * ((1.5 * sum(source_size) OVER () - coalesce(sum(CASE WHEN stops THEN 2 * source_size END) OVER (), 0))::DOUBLE
               / sum(CASE WHEN NOT stops THEN weight END) OVER ())) AS target FROM capped),
goals AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS copies,
         floor(target + 0.5)::BIGINT AS goal FROM told),
ties AS (
  SELECT source, h, sum(size)::BIGINT AS held, (sum(sum(size)) OVER (PARTITION BY source ORDER BY h))::BIGINT AS upto
  FROM docs GROUP BY source, h)
SELECT d.doc_id, d.size, g.source_size, g.target,
       (d.size * g.copies + CASE WHEN t.upto <= g.goal - g.copies * g.source_size THEN d.size
          WHEN t.upto - t.held < g.goal - g.copies * g.source_size
            THEN floor(d.size * ((g.goal - g.copies * g.source_size - t.upto + t.held)::DOUBLE / t.held)) ELSE 0 END)::BIGINT AS taken
FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
JOIN ties t ON d.source IS NOT DISTINCT FROM t.source AND d.h = t.h"""

# crc32 of each different word from the table of its polynomial
OP13_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
goal AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
tokens AS (SELECT r, unnest(w) AS word FROM docs),
s_words AS (SELECT word, count(*) AS n FROM tokens GROUP BY word),
t_words AS (SELECT word, count(*) AS n FROM goal GROUP BY word),
hexed AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM s_words UNION SELECT word FROM t_words)),
bucketed AS (SELECT word, xor(list_reduce(list_transform(range(1, len(x) + 1, 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM hexed, crc),
s AS (SELECT bucket, sum(n) AS n FROM s_words JOIN bucketed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM t_words JOIN bucketed USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
sums AS (SELECT r, sum(gain) AS g FROM tokens JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY r),
weighed AS (SELECT doc_id, len(w) AS n_features, CASE WHEN len(w) = 0 THEN 0 ELSE floor(g::DOUBLE / len(w)) END::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM docs LEFT JOIN sums USING (r)),
scored AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM weighed),
ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place,
    count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END::BIGINT AS rank FROM ranked"""

ORACLES: dict[str, str] = {"op9_bloom_cascade": OP9_SQL, "op11_shared_list_negatives": OP11_SQL, "op12_hash_threshold_mix": OP12_SQL,
                           "op13_bit_sliced_resampling": OP13_SQL}
