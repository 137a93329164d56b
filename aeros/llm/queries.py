"""The corpus operators applied to their whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, ctw, flac, neardup, negatives, packing, pii, suffixes, topk, toxicity, warc, whitening
from .common import stored, table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.digests(stored(flac.encode_column(table(spark, sf_dir, "documents")), "streams", codec="zstd"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


#: Names the surrogates; a deployment passes its own secret.
PII_KEY = b"surrogate-key-of-the-registered-query"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.size("pii_kinds").alias("n_entities"), "pii_kinds")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(table(spark, sf_dir, "documents"), size=2)


def fold(parts: int) -> Column:
    """The part of its table that a document is in."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold(4) != 2)
    return toxicity.learn(labels, table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repaired(table(spark, sf_dir, "conversations"))


def op10_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scores(table(spark, sf_dir, "documents"), fold(10) != 0)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_flac, op3_topk, op4_warc, op5_pii, op6_packing, op7_neardup, op8_chat, op9_toxicity, op10_ctw, op11_decontamination, op12_whitening, op13_hard_negatives)}

ORACLES = {
    "op3_topk": """
        WITH v AS (
            SELECT vec_id, min(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE))) AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
            GROUP BY vec_id
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10
    """,
    "op4_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id > first_id THEN first_id END AS refers_to, TRUE AS digest_ok
        FROM f
    """,
    "op11_decontamination": r"""
        WITH b AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
        ), d AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
        ), places AS (
            SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT k FROM windows) WHERE i + k - 1 <= len(w)
        ), met AS (
            SELECT doc_id, i, k, item FROM places JOIN windows USING (k, s)
        ), hits AS (
            SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM met) GROUP BY 1
        ), items AS (
            SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY 1
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
}
