"""From loosely typed results to keyed serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.casts import date_or_text, exactly, number_or_zero, parse_key_date
from tidemill.plans.transactions import category_rollup, daily_transactions
from tidemill.sinks.keyed import append_load

# Types wide enough for counts and sums of any size.
WIDE_COUNT, WIDE_MONEY = "bigint", "decimal(38,2)"
# Types of the serving columns.
COUNT_TYPE = "int"
MONEY_TYPE = "decimal(14,2)"


def _with_key(results: DataFrame, key: str) -> DataFrame:
    text = F.col(key).cast("string")
    return results.where(text.isNotNull() & (text != ""))


def normalize_results(
    results: DataFrame,
    *,
    key: str,
    key_type: str = "text",
    count: str = "transactions_count",
    total: str = "total_amount",
    mean: str = "avg_amount",
    strict: bool = True,
) -> DataFrame:
    """Typed rows; rows without a key are dropped, missing numbers are 0.

    Numbers are wide; ``serving_types`` makes them those of the serving table.

    ``key_type``: ``text`` keeps the key, ``date`` parses it (keys that are no date are in
    ``unparsed_results``), ``mixed`` normalizes dates and keeps other text as it is.
    """
    keyed = _with_key(results, key)
    text = F.col(key).cast("string")
    if key_type == "date":
        parsed = parse_key_date(text)
        keyed = keyed.where(parsed.isNotNull())
    elif key_type == "mixed":
        parsed = date_or_text(text)
    elif key_type == "text":
        parsed = text
    else:
        raise ValueError(f"unknown key type: {key_type}")
    return keyed.select(
        parsed.alias(key),
        number_or_zero(F.col(count), WIDE_COUNT, strict=strict).alias(count),
        number_or_zero(F.col(total), WIDE_MONEY, strict=strict).alias(total),
        number_or_zero(F.col(mean), WIDE_MONEY, strict=strict).alias(mean),
    )


def serving_types(
    results: DataFrame,
    *,
    count_type: str = COUNT_TYPE,
    money_type: str = MONEY_TYPE,
    total: str = "total_amount",
    total_type: str | None = None,
) -> DataFrame:
    """Normalized results in the types of the serving table; a value that does not fit fails the job.

    ``total_type``: of the column ``total``, which grows with the rows behind it, if it is not ``money_type``.
    """
    types = {WIDE_COUNT: count_type, WIDE_MONEY: money_type}
    wanted = {name: types[kind] for name, kind in results.dtypes if kind in types}
    if total_type is not None:
        wanted[total] = total_type
    return results.select(
        [exactly(F.col(name), wanted[name]).alias(name) if name in wanted else F.col(name) for name in results.columns]
    )


def unparsed_results(results: DataFrame, *, key: str) -> DataFrame:
    """The keyed rows ``normalize_results(..., key_type="date")`` leaves out, unchanged."""
    text = F.col(key).cast("string")
    return _with_key(results, key).where(parse_key_date(text).isNull())


def replace_aggregates(results: DataFrame, root: str, load_id: int) -> None:
    """Load normalized results so that each key's row replaces that of earlier loads.

    Read the table with ``tidemill.sinks.keyed.read_latest``.
    """
    append_load(results, root, load_id)


def migrate_days(transactions: DataFrame, root: str, load_id: int) -> None:
    """Load the daily report into its keyed serving table, whose totals are wide."""
    days = normalize_results(daily_transactions(transactions), key="transaction_date", key_type="date")
    replace_aggregates(serving_types(days, total_type=WIDE_MONEY), root, load_id)


def migrate_categories(logs: DataFrame, transactions: DataFrame, root: str, load_id: int) -> None:
    """Load the category report into its keyed serving table, whose totals are wide."""
    categories = normalize_results(category_rollup(logs, transactions), key="category_name")
    replace_aggregates(serving_types(categories, total_type=WIDE_MONEY), root, load_id)
