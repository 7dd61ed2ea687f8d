"""The corpus pipeline: documents in, clean and tokenised documents out.

Five stages in order; each takes (spark, docs, sf_dir), works on every row its
predecessor kept, and is written as Parquet before the next one reads it. All
but the last return the columns of ``documents``. The rows that stay:

- ``language_id`` drops documents without a determined language, or with one whose score
  is below 0.5 (two languages that fit about alike, as in mixed or very short texts);
- ``near_dedup`` keeps one document, the smallest doc_id, of each group of
  near copies (five-word shingles, similarity 0.8 or more, linked by chains);
- ``decontaminate`` drops documents that hold a benchmark window;
- ``secret_scan`` masks secrets and keeps every document;
- ``sentencepiece`` adds the ids of each document's text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.llm import decontaminate, langid, near_dedup, secrets, sentencepiece_bpe
from harvestline.llm.common import ship, table, written
from harvestline.llm.queries import PIECE_BPE, folded

SHINGLE_WORDS = 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = langid.train(folded(docs).where("not held_out"))
    return langid.keep_identified(spark, docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dedup.deduplicated(spark, docs, SHINGLE_WORDS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secrets.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each document."""
    ship(spark)
    return sentencepiece_bpe.encode(docs, public_tokenizers.path(PIECE_BPE)).select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids"
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

# Merge-dropout, language scores and entropy spans are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
