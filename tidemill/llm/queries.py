"""The operators over the given tables, with production parameters, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from tidemill.llm import (
    bpe, decontaminate, minhash, mixing, negatives, quality, secrets, spellings, subspaces,
    substrings, suffixtree, toxicity, urls)

Query = Callable[[SparkSession, str], DataFrame]

#: Largest number of passes over a source that the mixture may need.
MAX_REPEATS = 1.25
#: Rules for hosts and paths: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_subspaces(spark: SparkSession, folder: str) -> DataFrame:
    return subspaces.near_vectors(_table(spark, folder, "embeddings"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return quality.quality_scores(docs, quality.quality_machine(docs, labels))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return toxicity.toxicity_scores(docs, toxicity.toxicity_lexicon(docs, labels))


def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(_table(spark, folder, "documents")).drop("kept_text")


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(_table(spark, folder, "documents"))


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds a passage."""
    return decontaminate.pairs_of_ids(decontaminate.contaminated(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' sources, flattened as far as no source needs more than 1.25 passes."""
    return mixing.mixing_plan(_table(spark, folder, "documents"), max_repeats=MAX_REPEATS)


OP8_SQL = mixing.mixing_sql(MAX_REPEATS)


def op9_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return suffixtree.scored(_table(spark, folder, "documents"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts by the rules, else by a list.

    No list is given, so it is taken from the table: canonical URLs under which more than one
    page was fetched.
    """
    pages = _table(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    listed = (pages.select(urls.host_of("url").alias("host"), urls.path_of("url").alias("path"))
              .select(urls.canonical().alias("url")).where("url IS NOT NULL")
              .groupBy("url").count().where("count > 1").select("url"))
    return urls.url_verdicts(pages, rules, listed)


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END
    AS rest FROM pages),
u AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
v AS (SELECT *, CASE WHEN host <> '' THEN host || regexp_replace(path, '(\.html|/)$', '') END
  AS canonical FROM u),
l AS (SELECT canonical FROM v WHERE canonical IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
r(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
h AS (SELECT u.host, u.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
    max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) u JOIN r
    ON (u.host = r.host OR suffix(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.host, u.path)
SELECT v.page_id, v.host, v.path, h.rule,
  coalesce(h.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  l.canonical IS NOT NULL AS listed
FROM v LEFT JOIN h ON v.host = h.host AND v.path = h.path LEFT JOIN l ON v.canonical = l.canonical
"""


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every text under a public vocabulary, and what they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encoded(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return bpe.decoded(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelled.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Three rows of other labels for each of five positives of every 50th vector."""
    vectors = _table(spark, folder, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label").cast("long") + 1) % 10)
    return negatives.hard_negatives(vectors.withColumn(
        "label", F.coalesce(moved, F.col("label").cast("long"))))


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS other,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id
    ORDER BY score DESC, other)::INT AS rank, other AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def op13_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Words of 7 letters or more, one letter of every 31st left out, with the words they vary."""
    return spellings.spelling_groups(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_subspaces": op1_subspaces, "op2_quality": op2_quality, "op3_toxicity": op3_toxicity,
    "op4_substrings": op4_substrings, "op5_secrets": op5_secrets, "op6_minhash": op6_minhash,
    "op7_decontaminate": op7_decontaminate,
    "op8_mixing": op8_mixing, "op9_suffix_tree": op9_suffix_tree,
    "op10_url_filter": op10_url_filter, "op11_byte_bpe": op11_byte_bpe,
    "op12_hard_negatives": op12_hard_negatives, "op13_spellings": op13_spellings}
ORACLE: dict[str, str] = {"op8_mixing": OP8_SQL, "op10_url_filter": OP10_SQL,
                          "op12_hard_negatives": OP12_SQL}
