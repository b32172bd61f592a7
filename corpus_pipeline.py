"""A training corpus from ``documents``: good, different, uncontaminated and without secrets, packed into sequences."""

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from curveloom.llm import decontam, packing, quality, secrets, simhash  # noqa: E402
from curveloom.llm.common import fresh, read, written  # noqa: E402
from curveloom.llm.queries import vocabulary  # noqa: E402


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality scorer, trained on this table's weak labels, rejects.

    Missing and empty texts are judged by the scorer's bias, and rows of equal texts stay or go together.
    """
    found = quality.scored(docs)
    return found.where(~F.col(found.columns[-1])).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, that of the smallest id; of rows that repeat it one stays.

    Missing and empty texts have the same fingerprint, so they are one group.
    """
    return simhash.representatives(docs, words=3, radius=2)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item within its edit budget; missing and empty texts hold none."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; ``n_chars`` counts the new text where one was replaced.

    Missing texts stay missing, and secrets that overlap are one mark.
    """
    found = fresh(docs, "found")[0]
    hit = F.col(f"{found}.n") > 0
    cleaned = docs.withColumn(found, secrets.without_secrets(F.col("text")))
    changed = cleaned.withColumn("text", F.when(hit, F.col(f"{found}.text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents and their places in sequences; a missing or empty text is its end mark alone."""
    return packing.packed(docs, vocabulary())


STAGES = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", uncontaminated),
    ("secret_scan", without_secrets),
    ("best_fit_packing", sequences),
]

# Fingerprints, alignments, fitted models and the packing have no SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a table that the next stage reads."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
