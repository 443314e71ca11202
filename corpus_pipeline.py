"""Documents to token files in five stages, each stored before the next begins.

Language identification drops what has no language, one document of each group of similar ones
stays, documents with benchmark items go, the sources are mixed to their target weights, and
what is left is encoded and written in ORC files, of which a digest is returned.

Every stage but the last returns the columns of ``documents``. Null ids and texts, empty tables
and repeated rows are what the operators define for them; each stage names its own case.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontamination, jaccard_join, language_id, mixing, token_output
from tillroll.llm.common import store, table

TOKENIZER = "byte_bpe_50k.json"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a text or a letter go. A null lang is filled."""
    found = language_id.identify(docs, language_id.train(docs), ("_pred", "_score"))
    kept = found.where(F.col("_pred") != language_id.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "_pred")).select(docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the first by id and hash of its text, null last.

    Rows are told apart by id and text, so near copies go that share the id of what is kept; of
    rows equal in both one stays. Documents without words are similar to nothing."""
    placed, smallest = jaccard_join.similar_rows(docs)
    first = smallest.select("first.doc_id", "first.body")
    alone = placed.where("part IS NULL").select("doc_id", "body")
    kept = store(
        first.unionByName(alone).select(
            F.col("doc_id").alias("_kept"), F.col("body").alias("_body")
        ),
        "kept",
    )
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.xxhash64("text") == F.col("_body"))
    left = docs.join(kept.distinct(), same, "left_semi").select(docs.columns)
    # Only where rows are repeated is there a reason to compare texts.
    repeated = placed.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("_rows"))
    if repeated.where("_rows > 1").isEmpty():
        return left
    return left.dropDuplicates(["doc_id", "text"])


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; rows with one id or none are told apart by text."""
    return decontamination.decontaminate_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digest of the token files: doc_id, start, n_tokens, ids_crc32."""
    return token_output.write_and_digest(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", keep_known_languages),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", drop_leaked),
    ("mixing sources", mix_sources),
    ("token output", write_tokens),
]

#: Neither the network nor the tokenizer can be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
