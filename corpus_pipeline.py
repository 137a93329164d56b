"""Corpus pipeline: reject toxic documents, keep one of each group of near copies, replace personal data, pack.

Each stage takes (spark, docs, sf_dir); docs is what the stage before kept. All but the last give the columns of
`documents`; the last gives the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeros.llm import neardup, packing, pii, toxicity
from aeros.llm.common import stored, table

#: Least calibrated probability of label 1 at which a document is rejected, as in op9_toxicity.
REJECT = toxicity.TOXIC
#: Names the surrogates; a deployment passes its own secret.
PII_KEY = b"surrogate-key-of-the-corpus-pipeline"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.learn(table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out), docs)
    return toxicity.scored(docs, model, docs.columns).filter(F.col("score") < REJECT).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs, size=5, percent=80)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = pii.surrogates(docs, PII_KEY, kinds=None)
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("pii", replace_personal_data), ("packing", pack)]

#: Learned scores, keyed surrogates and packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
