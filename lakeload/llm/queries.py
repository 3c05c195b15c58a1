"""Queries of this package over the test tables, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakeload.llm import (bpe, conversations, cotraining, embeddings, hard_negatives, mixing, phrase_dedup, quality_rules, secrets,
                          simhash, suffix_dedup, token_counts, toxicity)
from lakeload.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier in the corpus."""
    return phrase_dedup.deduplicate(table(spark, sf_dir, "documents"), digest=True)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that also start elsewhere."""
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), digest=True)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the production unigram vocabulary, and the score of its best segmentation."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.vocabulary())


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest id that links of at most three bits reach from it."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents at the production temperature: each copy with the document's columns, its copy
    number and its shuffle key."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base rules and the spans that the Markov models add."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and host-corrected verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes that they decode to."""
    path, pattern = bpe.vocabulary()
    return bpe.encode_docs(table(spark, sf_dir, "documents"), path, pattern, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of both views, their combination and the verdict for every document."""
    return cotraining.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten negatives in the score window of each of five positives of every hundredth vector."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and verdict of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage, with the digest of what it reads then."""
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")), outputs=("repaired_sha256",))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline one after another over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"pipeline": pipeline, "op1_substring_dedup": op1_substring_dedup, "op2_suffix_dedup": op2_suffix_dedup,
           "op3_token_counts": op3_token_counts, "op4_simhash": op4_simhash, "op5_mixing": op5_mixing, "op6_secret_scan": op6_secret_scan,
           "op7_quality_rules": op7_quality_rules, "op8_embedding_dedup": op8_embedding_dedup,
           "op9_byte_bpe": op9_byte_bpe, "op10_quality_classifier": op10_quality_classifier,
           "op11_hard_negatives": op11_hard_negatives, "op12_toxicity": op12_toxicity, "op13_conversation_repair": op13_conversation_repair}

OP5_SQL = f"""
WITH sizes AS (
  SELECT source, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS size FROM documents GROUP BY source),
weights AS (SELECT source, size, pow(CAST(size AS DOUBLE), {mixing.TEMPERATURE}) AS weight FROM sizes),
rates AS (
  SELECT source, coalesce(CASE WHEN size > 0 THEN weight / (SELECT sum(weight) FROM weights)
           * (SELECT CAST(sum(size) AS DOUBLE) FROM sizes) / size END, 1.0) AS rate FROM weights),
parts AS (SELECT source, greatest(1, CAST(ceil(rate / {mixing.STEP}) AS INT)) AS m, rate FROM rates),
terms AS (
  SELECT source, m, k, exp(-(rate / m)) * pow(rate / m, k) / gamma(k + 1.0) AS p
  FROM parts, (SELECT unnest(range(0, {mixing.TERMS + 1})) AS k)),
cdf AS (SELECT source, m, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
tables AS (SELECT source, m, list(c ORDER BY k) AS cs FROM cdf GROUP BY source, m),
drawn AS (
  SELECT d.*, CAST(list_sum(list_transform(range(1, m + 1), lambda j: len(list_filter(cs, lambda c: c <=
      CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':n:' || j), 1, 13) AS BIGINT) AS DOUBLE)
      / 4503599627370496.0)))) AS INT) AS n
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT * EXCLUDE (n), CAST(unnest(range(1, n + 1)) AS INT) AS copy FROM drawn WHERE n > 0)
SELECT *, CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':at:' || copy), 1, 13) AS BIGINT)
  AS shuffle_key FROM copies
"""

OP7_SQL = f"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM starts),
dup AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT doc_id, sum(n) AS n FROM (
    SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM dup) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
b AS (SELECT *, (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS x FROM b WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT sum(n) AS n, sum(x) / CAST(sum(n) AS DOUBLE) AS mean, count(*) AS k FROM h),
v AS (
  SELECT any_value(m.mean) AS mean, any_value(m.mean * (1 - m.mean)) AS noise,
    greatest(sum(h.n * pow(h.x / CAST(h.n AS DOUBLE) - m.mean, 2)) - any_value(m.mean * (1 - m.mean) * m.k), 0) / any_value(m.n) AS between_
  FROM h, m),
p AS (
  SELECT mean, CASE WHEN between_ > 0 THEN least(greatest(noise / between_ - 1, {quality_rules.PRIOR_WEIGHT[0]}), {quality_rules.PRIOR_WEIGHT[1]})
    ELSE {quality_rules.PRIOR_WEIGHT[1]} END AS weight FROM v),
verdict AS (SELECT source, (x + mean * weight) / (n + weight) > {quality_rules.MAX_HOST_RATE} AS bad FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(bad, FALSE) AS kept
FROM b LEFT JOIN verdict ON b.source = verdict.source
"""

OP11_SQL = f"""
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)),
near AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id, br) AS place FROM scored WHERE same
  QUALIFY place <= {hard_negatives.POSITIVES}),
far AS (
  SELECT n.anchor_id, n.other_id AS positive_id, f.other_id AS negative_id, n.score AS positive_score, f.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY n.r, n.place ORDER BY f.score DESC, f.other_id, f.br) AS INT) AS rank
  FROM near n JOIN scored f ON n.r = f.r AND NOT f.same
    AND {hard_negatives.LEAST} * n.score <= 100 * f.score AND 100 * f.score <= {hard_negatives.MOST} * n.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM far WHERE rank <= {hard_negatives.NEGATIVES}
"""

SQL = {**({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}), "op5_mixing": OP5_SQL, "op7_quality_rules": OP7_SQL, "op11_hard_negatives": OP11_SQL}
