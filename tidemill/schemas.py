"""Schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ARRAY_OF_TEXT = ArrayType(StringType())


def layout(**columns: str | DataType) -> StructType:
    """Schema from column names and types; needs no running session."""
    schema = StructType()
    for name, data_type in columns.items():
        schema.add(name, data_type)
    return schema


# Table layouts.
TRANSACTIONS = layout(
    transaction_id="integer",
    user_id="integer",
    amount="double",
    currency="string",
    transaction_date="timestamp",
    is_fraud="integer",
)
LOGS = layout(
    log_id="integer",
    transaction_id="integer",
    category="string",
    comment="string",
    logtimestamp="timestamp",
)
ORDERS = layout(
    order_id="integer",
    user_id="integer",
    order_date="timestamp",
    total_amount="decimal(12,2)",
    payment_status="string",
)
ORDER_ITEMS = layout(
    item_id="integer",
    order_id="integer",
    product_name="string",
    product_price="decimal(12,2)",
    quantity="integer",
)
COMMENTS = layout(
    comment_id="string",
    score="float",
    self_text="string",
    subreddit="string",
    created_time="timestamp",
    post_id="string",
    author_name="string",
    controversiality="float",
    ups="integer",
    downs="integer",
    user_is_verified="boolean",
    user_account_created_time="timestamp",
    user_awardee_karma="float",
    user_awarder_karma="float",
    user_link_karma="float",
    user_comment_karma="float",
    user_total_karma="float",
    post_score="integer",
    post_self_text="string",
    post_title="string",
    post_upvote_ratio="float",
    post_thumbs_ups="integer",
    post_total_awards_received="integer",
    post_created_time="timestamp",
)
COMMENT_KEY = "comment_id"
COMMENT_REQUIRED = ("comment_id", "post_id")
MESSAGE = layout(
    msg="string",
)
PEOPLE = layout(
    id="integer",
    name="string",
    sex="string",
    amount="string",
    born="string",
)

# Layouts of the nested sample document; keys may be missing in any record.
USER = layout(
    id="long",
    name="string",
    email="string",
    age="long",
    status="string",
    logins=ARRAY_OF_TEXT,
)
USER_TRANSACTION = layout(
    transaction_id="string",
    user_id="long",
    amount="double",
    currency="string",
    timestamp="string",
    status="string",
    items=ARRAY_OF_TEXT,
)
USER_DOCUMENT = layout(users=ArrayType(USER), transactions=ArrayType(USER_TRANSACTION))


def comments_raw() -> StructType:
    """Landing layout: text everywhere but ``score``; the two required keys not nullable."""
    return StructType(
        [
            StructField(
                field.name,
                IntegerType() if field.name == "score" else StringType(),
                field.name not in COMMENT_REQUIRED,
            )
            for field in COMMENTS
        ]
    )


def comments_serving() -> StructType:
    """Serving layout: as ``COMMENTS`` with an integer ``score``."""
    return StructType(
        [
            StructField(field.name, IntegerType() if field.name == "score" else field.dataType)
            for field in COMMENTS
        ]
    )


def with_text_times(schema: StructType) -> StructType:
    """``schema`` as it travels in a JSON record: timestamps are text until decoded."""
    return StructType(
        [
            StructField(
                field.name,
                StringType() if isinstance(field.dataType, TimestampType) else field.dataType,
            )
            for field in schema
        ]
    )


def as_text(schema: StructType) -> StructType:
    """``schema`` with every column read as text, for casting afterwards."""
    return StructType([StructField(field.name, StringType()) for field in schema])


def serving_result(key: str, key_type) -> StructType:
    """Serving layout of an aggregate: one key, a count and two money columns."""
    return StructType(
        [
            StructField(key, key_type),
            StructField("transactions_count", IntegerType()),
            StructField("total_amount", DecimalType(14, 2)),
            StructField("avg_amount", DecimalType(14, 2)),
        ]
    )
