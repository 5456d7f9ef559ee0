"""Training-text pipeline: quality, repeated lines, near-duplicates, test items, mix.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; ``run`` writes each
result as Parquet in the shared folder and reads it for the next. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontamination, line_runs, quality_trees, source_mix, superminhash
from tidemill.scratch import write_table

_WORD = r"[^\x20\x09-\x0D]"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a predicted label of 1 stay; the trees learn from the labelled rows of ``docs``."""
    scored = quality_trees.score_quality(docs, _table(spark, folder, "labels"))
    return scored.where(F.col("predicted") == 1).select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Later copies of line runs of 50 words or more go, and with them documents that lose their last word.

    ``n_chars`` becomes the length of the text that is left.
    """
    cleaned = line_runs.remove_repeated_lines(docs, min_words=50)
    left = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(_WORD))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group with 80 of 100 five-word shingles in common stays."""
    return superminhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a test item, exact or edited, go."""
    return decontamination.decontaminate(docs, _table(spark, folder, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What the mix takes: a row per document with its words, its source's target and the words taken."""
    mixed = source_mix.mix(docs)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality", quality),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("mix", mix),
]

# Trees, signatures and alignments have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` in ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
