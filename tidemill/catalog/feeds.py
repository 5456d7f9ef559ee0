"""Readers, cleaning, loads and tables on the test tables.

Each query writes a whole test table in the format under test, below the shared folder, and
reads it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog import reports, tables
from tidemill.catalog.tables import as_double, table
from tidemill.functions.casts import parse_amount, parse_utc_ts
from tidemill.functions.records import decode_field, encode_rows, times_as_text
from tidemill.operators.clean import cast_columns, conform_to_schema, rejected, with_reject_reason
from tidemill.plans import comments, loads, serving
from tidemill.schemas import layout
from tidemill.scratch import new_path
from tidemill.sinks.files import write_sorted, write_text
from tidemill.sinks.kafka import partition_status
from tidemill.sinks.keyed import append_load, read_latest
from tidemill.sinks.tables import replace_table
from tidemill.sources.files import read_csv, read_delimited, read_parquet
from tidemill.sources.tables import read_table
from tidemill.streaming.decode import decode_records

ORDER_FILE = layout(
    order_id="long",
    user_id="long",
    order_date="timestamp",
    total_amount="decimal(12,2)",
    payment_status="string",
)
TRANSACTION_FILE = layout(
    transaction_id="long",
    user_id="long",
    amount="double",
    currency="string",
    transaction_date="timestamp",
    is_fraud="integer",
)
LOG_FILE = layout(
    transaction_id="long",
    category="string",
    logtimestamp="timestamp",
)
EVENT = layout(
    event_id="long",
    ts="timestamp",
    user_id="long",
    event_type="string",
    value="double",
    props="string",
)
DOCUMENT = layout(
    text="string",
    lang="string",
    source="string",
    n_chars="long",
)


def _delimited_file(df: DataFrame, sep: str, header: bool) -> str:
    path = new_path(df.sparkSession, "delimited")
    times_as_text(df).write.options(sep=sep, header=str(header).lower()).csv(path)
    return path


def _free_text_file(df: DataFrame) -> str:
    path = new_path(df.sparkSession, "free-text")
    df.write.options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return path


def _without_zone(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def csv_header_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = _free_text_file(table(spark, folder, "conversations"))
    inferred = read_csv(spark, path, infer=True)
    return inferred.withColumns(
        {"conv_id": F.col("conv_id").cast("bigint"), "turn": F.col("turn").cast("bigint")}
    )


def csv_to_parquet_clean(spark: SparkSession, folder: str) -> DataFrame:
    path = _free_text_file(table(spark, folder, "documents").drop("doc_id"))
    return comments.csv_to_parquet_clean(spark, path, new_path(spark, "clean"), DOCUMENT)


# Splits of a table that one task writes to a file: some hundred MB, which are read in splits again.
LARGE_FILE_SPLITS = 4


def csv_large_file(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned feed from a few large files of texts with line breaks, each read in splits."""
    path, documents = new_path(spark, "free-text"), table(spark, folder, "documents").drop("doc_id")
    files = -(-documents.rdd.getNumPartitions() // LARGE_FILE_SPLITS)
    documents.coalesce(max(files, 1)).write.options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return comments.csv_to_parquet_clean(spark, path, new_path(spark, "clean"), DOCUMENT, large_files=True)


def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that cleaning leaves out, with the reason: one number is spelled as text in part."""
    events = table(spark, folder, "events").withColumn(
        "value",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")),
    )
    path, rejects = _free_text_file(times_as_text(events)), new_path(spark, "rejects")
    comments.csv_to_parquet_clean(
        spark, path, new_path(spark, "clean"), EVENT, required=["event_id", "value"], rejects=rejects, free_text=False
    )
    return _without_zone(spark.read.parquet(rejects)).select("event_id", "ts", "user_id", "reject_reason")


def load_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = _delimited_file(tables.transactions(spark, folder), ",", header=False)
    name = f"transactions_{uuid.uuid4().hex}"
    try:
        return _without_zone(
            loads.load_transactions(
                spark, path, name, schema=TRANSACTION_FILE, location=new_path(spark, "transactions")
            )
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def delimited_logs(spark: SparkSession, folder: str) -> DataFrame:
    path = _delimited_file(tables.logs(spark, folder), ";", header=False)
    return _without_zone(read_delimited(spark, path, LOG_FILE, sep=";"))


def csv_with_names(spark: SparkSession, folder: str) -> DataFrame:
    path = _delimited_file(tables.orders(spark, folder), ",", header=True)
    orders = read_delimited(spark, path, ORDER_FILE, header=True)
    return as_double(_without_zone(orders), "total_amount")


def load_orders(spark: SparkSession, folder: str) -> DataFrame:
    path = _delimited_file(tables.orders(spark, folder), ";", header=True)
    name = f"orders_{uuid.uuid4().hex}"
    try:
        replace_table(spark.createDataFrame([], ORDER_FILE), name, location=new_path(spark, "orders"))
        loaded = loads.load_orders(spark, path, name, schema=ORDER_FILE, sep=";")
        return as_double(_without_zone(loaded), "total_amount")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def headerless_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts spelled in hundredths, times with zone text, the last field often missing."""
    orders = tables.orders(spark, folder).select(
        "order_id",
        F.concat((F.col("total_amount") * 100).cast("bigint").cast("string"), F.lit("e-2")).alias("amount"),
        F.when(
            F.col("payment_status") != "P",
            F.date_format("order_date", "yyyy-MM-dd HH:mm:ss' +0000 UTC'"),
        ).alias("born"),
    )
    path = _delimited_file(orders, ",", header=False)
    read = read_delimited(spark, path, "order_id bigint, amount string, born string")
    return read.select(
        "order_id",
        parse_amount(F.col("amount")).cast("double").alias("amount"),
        parse_utc_ts(F.col("born")).cast("timestamp_ntz").alias("born"),
    )


def parquet_projection(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_parquet(spark, f"{folder}/lineitem.parquet")
    return lines.select(F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("category"))


def parquet_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Lines from a date on; the filter reaches the scan."""
    lines = read_parquet(spark, f"{folder}/lineitem.parquet")
    return lines.where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("category")
    )


def table_source(spark: SparkSession, folder: str) -> DataFrame:
    name = f"customers_{uuid.uuid4().hex}"
    table(spark, folder, "customer").createOrReplaceTempView(name)
    customers = read_table(spark, name).select("c_custkey", "c_name", "c_acctbal")
    spark.catalog.dropTempView(name)
    return customers


def typed_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Every column as text, one spelled badly in part, cast back in one projection."""
    orders = tables.transactions(spark, folder)
    text = times_as_text(orders).select(
        [F.col(name).cast("string").alias(name) for name in orders.columns]
    )
    bad = F.col("currency") == "5-LOW"
    broken = text.withColumns(
        {
            "user_id": F.when(bad, F.lit("unknown")).otherwise(F.concat("user_id", F.lit(".0"))),
            "transaction_date": F.when(bad, F.regexp_replace("transaction_date", " ", "T")).otherwise(
                F.col("transaction_date")
            ),
            "is_fraud": F.when(F.col("is_fraud") == "1", F.lit("True")).otherwise(F.lit("False")),
        }
    )
    schema = layout(
        transaction_id="long",
        user_id="integer",
        amount="double",
        currency="string",
        transaction_date="timestamp",
        is_fraud="boolean",
    )
    return _without_zone(cast_columns(broken, schema))


def conformed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows matched to a schema by name: one column cast, one missing, one left out."""
    schema = layout(
        value="integer",
        event_id="long",
        user_id="string",
        ts="timestamp",
        note="string",
    )
    return _without_zone(conform_to_schema(table(spark, folder, "events"), schema))


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose value is no number, after decoding, with the reason."""
    events = table(spark, folder, "events").withColumn(
        "value",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")),
    )
    decoded = cast_columns(events, EVENT)
    found = rejected(with_reject_reason(decoded, ["event_id", "ts", "value"]))
    return _without_zone(found.select("event_id", "ts", "reject_reason"))


def normalize_results(spark: SparkSession, folder: str) -> DataFrame:
    """Daily results as loose text: two date spellings, numbers missing on some days."""
    daily = reports.daily_transactions(spark, folder)
    day = F.col("transaction_date")
    loose = daily.select(
        F.when(F.dayofmonth(day) <= 15, day.cast("string"))
        .otherwise(F.concat(day.cast("string"), F.lit(" 10:11:12")))
        .alias("transaction_date"),
        F.when(F.month(day) != 2, F.col("transactions_count").cast("string")).alias("transactions_count"),
        F.when(F.month(day) == 3, F.lit("")).otherwise(F.col("total_amount").cast("string")).alias("total_amount"),
        F.col("avg_amount").cast("string").alias("avg_amount"),
    )
    typed = serving.normalize_results(loose, key="transaction_date", key_type="date")
    return as_double(typed, "total_amount", "avg_amount")


def normalize_categories(spark: SparkSession, folder: str) -> DataFrame:
    rollup = reports.category_rollup(spark, folder)
    loose = rollup.select([F.col(name).cast("string").alias(name) for name in rollup.columns])
    typed = serving.normalize_results(loose, key="category_name")
    return as_double(typed, "total_amount", "avg_amount")


def publish_json(spark: SparkSession, folder: str) -> DataFrame:
    """Rows as JSON records in text files, as they would be in a topic, decoded again."""
    path = new_path(spark, "records")
    write_text(encode_rows(times_as_text(table(spark, folder, "events"))), path)
    return _without_zone(decode_records(spark.read.text(path), EVENT))


def publish_status(spark: SparkSession, folder: str) -> DataFrame:
    """Records to be published, added up over the publishing tasks."""
    records = encode_rows(times_as_text(table(spark, folder, "events")))
    return partition_status(records).agg(F.sum("records").alias("records"))


def json_field(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", decode_field(F.col("props"), "k int").getField("k").alias("k")
    )


def replace_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders loaded, then the pending ones again with a higher total."""
    orders = tables.orders(spark, folder)
    root = new_path(spark, "keyed")
    append_load(orders, root, 1)
    pending = orders.where(F.col("payment_status") == "P")
    changed = pending.withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(12,2)"))
    serving.replace_aggregates(changed, root, 2)
    return as_double(read_latest(spark, root, ["order_id"]), "total_amount")


def migrated_days(spark: SparkSession, folder: str) -> DataFrame:
    """All days loaded, then the odd ones again with higher amounts: those replace the first."""
    root, first = new_path(spark, "days"), tables.transactions(spark, folder)
    odd = first.where(F.dayofmonth("transaction_date") % 2 == 1)
    second = odd.withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)"))
    for load_id, deals in enumerate((first, second), 1):
        serving.migrate_days(deals, root, load_id)
    return as_double(read_latest(spark, root, ["transaction_date"]), "total_amount", "avg_amount")


def migrated_categories(spark: SparkSession, folder: str) -> DataFrame:
    """All categories loaded, then one again with higher amounts."""
    root = new_path(spark, "categories")
    logs, deals = tables.logs(spark, folder), tables.transactions(spark, folder)
    higher = deals.withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)"))
    serving.migrate_categories(logs, deals, root, 1)
    serving.migrate_categories(logs.where(F.col("category") == "R"), higher, root, 2)
    return as_double(read_latest(spark, root, ["category_name"]), "total_amount", "avg_amount")


def sorted_layout(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "sorted")
    write_sorted(
        table(spark, folder, "lineitem"), path, ["l_shipdate"], spread_by=[F.col("_metadata.row_index")]
    )
    return spark.read.parquet(path)


def land_raw_comments(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "landed")
    comments.land_raw_comments(
        table(spark, folder, "events"),
        path,
        key=["event_id"],
        required=["event_id", "user_id"],
        day_of="ts",
        then_by="user_id",
    )
    return spark.read.parquet(path)


QUERIES = {
    "csv_header_inferred": csv_header_inferred,
    "csv_to_parquet_clean": csv_to_parquet_clean,
    "csv_large_file": csv_large_file,
    "csv_rejects": csv_rejects,
    "load_transactions": load_transactions,
    "delimited_logs": delimited_logs,
    "csv_with_names": csv_with_names,
    "load_orders": load_orders,
    "headerless_amounts": headerless_amounts,
    "parquet_projection": parquet_projection,
    "parquet_filter": parquet_filter,
    "table_source": table_source,
    "typed_casts": typed_casts,
    "conformed_rows": conformed_rows,
    "rejected_rows": rejected_rows,
    "normalize_results": normalize_results,
    "normalize_categories": normalize_categories,
    "publish_json": publish_json,
    "publish_status": publish_status,
    "json_field": json_field,
    "replace_aggregates": replace_aggregates,
    "migrated_days": migrated_days,
    "migrated_categories": migrated_categories,
    "sorted_layout": sorted_layout,
    "land_raw_comments": land_raw_comments,
}

_ORDERS = """
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date,
           o_totalprice AS total_amount, o_orderstatus AS payment_status
    FROM orders
"""


def _normalized_categories(count_type: str, rollup: str) -> str:
    return f"""
        SELECT category_name, CAST(transactions_count AS {count_type}) AS transactions_count, total_amount,
               CAST(CAST(CAST(avg_amount AS VARCHAR) AS DECIMAL(14,2)) AS DOUBLE) AS avg_amount
        FROM ({rollup})
    """


SQL = {
    "csv_header_inferred": "SELECT conv_id, turn, role, text FROM conversations",
    "csv_to_parquet_clean": """
        SELECT DISTINCT text, lang, source, n_chars FROM documents
        WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL
    """,
    "csv_large_file": """
        SELECT DISTINCT text, lang, source, n_chars FROM documents
        WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL
    """,
    "csv_rejects": """
        SELECT event_id, ts, user_id, 'value' AS reject_reason
        FROM events WHERE event_type = 'error'
    """,
    "load_transactions": """
        SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount,
               o_orderpriority AS currency, o_orderdate AS transaction_date,
               CAST(o_orderstatus = 'F' AS INTEGER) AS is_fraud
        FROM orders
    """,
    "delimited_logs": """
        SELECT l_orderkey AS transaction_id, l_returnflag AS category, l_shipdate AS logtimestamp
        FROM lineitem
    """,
    "csv_with_names": _ORDERS,
    "load_orders": _ORDERS,
    "headerless_amounts": """
        SELECT o_orderkey AS order_id, o_totalprice AS amount,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS born
        FROM orders
    """,
    "parquet_projection": "SELECT l_orderkey AS order_id, l_returnflag AS category FROM lineitem",
    "parquet_filter": """
        SELECT l_orderkey AS order_id, l_returnflag AS category
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01 00:00:00'
    """,
    "table_source": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "typed_casts": """
        SELECT o_orderkey AS transaction_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS INTEGER) END AS user_id,
               o_totalprice AS amount, o_orderpriority AS currency,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS transaction_date,
               o_orderstatus = 'F' AS is_fraud
        FROM orders
    """,
    "conformed_rows": """
        SELECT CAST(trunc(value) AS INTEGER) AS value, event_id, CAST(user_id AS VARCHAR) AS user_id,
               ts, CAST(NULL AS VARCHAR) AS note
        FROM events
    """,
    "rejected_rows": """
        SELECT event_id, ts, 'value' AS reject_reason FROM events WHERE event_type = 'error'
    """,
    "normalize_results": """
        SELECT day AS transaction_date,
               CASE WHEN month(day) = 2 THEN 0 ELSE CAST(orders_in_day AS BIGINT) END AS transactions_count,
               CASE WHEN month(day) = 3 THEN 0.0 ELSE CAST(total AS DOUBLE) END AS total_amount,
               CAST(CAST(CAST(CAST(total AS DOUBLE) / orders_in_day AS VARCHAR) AS DECIMAL(14,2))
                    AS DOUBLE) AS avg_amount
        FROM (
            SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS orders_in_day,
                   SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS total
            FROM orders GROUP BY CAST(o_orderdate AS DATE)
        )
    """,
    "normalize_categories": _normalized_categories("BIGINT", reports.SQL["category_rollup"]),
    "publish_json": """
        SELECT event_id, ts, user_id, event_type, value, props FROM events
    """,
    "publish_status": "SELECT COUNT(*) AS records FROM events",
    "json_field": "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events",
    "replace_aggregates": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date,
               CAST(CAST(o_totalprice AS DECIMAL(12,2))
                    + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS DOUBLE) AS total_amount,
               o_orderstatus AS payment_status
        FROM orders
    """,
    "migrated_days": """
        SELECT day AS transaction_date, CAST(orders_in_day AS INTEGER) AS transactions_count,
               CAST(total AS DOUBLE) AS total_amount,
               CAST(CAST(CAST(CAST(total AS DOUBLE) / orders_in_day AS VARCHAR) AS DECIMAL(14,2))
                    AS DOUBLE) AS avg_amount
        FROM (
            SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS orders_in_day,
                   SUM(CAST(o_totalprice AS DECIMAL(12,2)) + dayofmonth(o_orderdate) % 2) AS total
            FROM orders GROUP BY CAST(o_orderdate AS DATE)
        )
    """,
    "migrated_categories": f"""
        {_normalized_categories("INTEGER", reports.SQL["category_rollup"])} WHERE category_name <> 'R'
        UNION ALL
        {_normalized_categories("INTEGER", reports.category_rollup_sql(1))} WHERE category_name = 'R'
    """,
    "sorted_layout": "SELECT * FROM lineitem",
    "land_raw_comments": "SELECT *, CAST(ts AS DATE) AS ts_day FROM events",
}
