"""A training corpus from raw documents: quality rules, near duplicates, benchmark windows, personal data, pieces.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept. All but
the last return the columns of ``documents``; ``run`` writes each stage's result as Parquet to the
shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.llm import decontam, ngram_join, pii_anchor, risk_thresholds, sp_nbest
from roadrisk.llm.common import read_table, ship, stored
from roadrisk.llm.queries import PIECE_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the certified cutoffs leave; all labels take part in the cutoffs."""
    return risk_thresholds.keep_good(docs, read_table(ship(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts: that of the smallest doc_id."""
    ship(spark)
    return ngram_join.keep_one(docs)


def benchmark_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontam.drop_contaminated(docs, read_table(ship(spark), sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    ship(spark)
    return docs.withColumn("text", pii_anchor.redacted(F.col("text"))).withColumn("n_chars", F.length("text").cast("long"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the best segmentation, scores and checksums of the best four, and the round trip's result."""
    ship(spark)
    return sp_nbest.segment(docs, PIECE_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_windows),
    ("personal data", personal_data),
    ("SentencePiece segmentation", pieces),
]

#: Certified cutoffs, components and segmentations have no form in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
