"""Folds by document number, and labelled samples of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str | Column, folds: int) -> Column:
    """Remainder of the checksum of the number written as text; NULL for a NULL number."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def held_out(doc_id: str | Column, folds: int, remainder: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == remainder, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, folds: int, remainder: int, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` documents outside the held-out fold.

    Rows without number or label take no part. Where a document has several labels the
    more frequent counts, a tie is 1. Which documents are taken depends on a hash of the
    number alone.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(fold("doc_id", folds) != remainder)
        .groupBy("doc_id")
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
