"""Parquet, text, sorted tables and document collections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Documents of a compressed file at most.
FILE_DOCUMENTS = 1_000_000


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_text(df: DataFrame, path: str) -> None:
    """One string column as lines of text; fails if ``path`` exists."""
    df.write.text(path)


def write_sorted(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    spread_by: Sequence[str | Column] | None = None,
    mode: str = "error",
) -> None:
    """Parquet ordered by ``keys`` across and inside files, so filters on them skip files.

    ``spread_by`` breaks ties between equal keys when rows are divided into files, so a
    frequent key covers several of them; by default a hash of the other columns. Where
    equal rows may be frequent give something that tells them apart, such as
    ``_metadata.row_index`` of a Parquet scan.
    """
    if spread_by is None:
        others = [name for name in df.columns if name not in keys]
        spread_by = [F.xxhash64(*others)] if others else []
    ordered = df.repartitionByRange(*keys, *spread_by).sortWithinPartitions(*keys)
    ordered.write.mode(mode).parquet(path)


def write_documents(
    documents: DataFrame,
    target: str | None = None,
    *,
    file_format: str = "json",
    options: Mapping[str, str] | None = None,
    mode: str = "error",
) -> None:
    """A document collection: JSON lines or nested Parquet files, or any installed
    document-store connector by its format name and options.

    JSON is compressed, as every document repeats its field names and shared objects; such a file is read
    by one task, so it holds ``FILE_DOCUMENTS`` at most. ``options`` may say otherwise.
    """
    writer = documents.write.format(file_format).mode(mode)
    if file_format == "json":
        writer = writer.options(ignoreNullFields="false", compression="gzip", maxRecordsPerFile=str(FILE_DOCUMENTS))
    writer.options(**(options or {})).save(target)
