"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``, but for the last, which returns the
encoded documents. Null texts, empty tables and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard_bayes, line_dedup, mixing, quality_mcd, sp_nbest
from tessera.llm.common import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_mcd.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; n_chars is the new length. A document that loses all its
    lines stays with an empty text."""
    out = line_dedup.dedup_lines(docs)
    value = {"text": F.col("kept.text"), "n_chars": F.length("kept.text").cast("long")}
    return out.select(*[value.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id."""
    return jaccard_bayes.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row for each document and epoch."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces, ids, score and the score of the second-best segmentation, and whether the ids
    decode to the text."""
    out = sp_nbest.segmentations(docs, n=2)
    ids = F.get("best.ids", F.lit(0))
    return out.select("doc.doc_id", "doc.lang", "doc.source", F.size(ids).cast("long").alias("n_pieces"), ids.alias("ids"),
                      F.round(F.col("best.scores")[0], 6).alias("score"), F.round(F.get("best.scores", F.lit(1)), 6).alias("second_score"),
                      (F.col("best.decoded") == F.coalesce("doc.text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]
#: Robust estimates, MinHash candidates and best segmentations are beyond SQL; tests/llm holds each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
