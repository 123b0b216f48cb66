"""Test tables mapped onto the retail shapes.

Every mapping is a projection of a whole table.  Clean events and recommender tables are
written once per session under the shared folder and read back, the way a pipeline's
queries read its stored tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.functions.contract import CONTRACT_COLUMNS, LAST_TIMESTAMP_MS, sorted_json
from cartlark.operators.normalize import with_event_id
from cartlark.plans import etl
from cartlark.session import shared_dir, use_utc

# SQL texts, so that importing this module needs no session.
EPOCH_MS = "unix_millis(cast(ts as timestamp))"
DAYPART = "floor(hour(cast(ts as timestamp)) / 4)"
PROPS_KEY = "cast(get_json_object(props, '$.k') as bigint)"
USER = "user_id"
KEY = "k"
# Finer shoppers and products for the recommender: a user by daypart, a product by price
# band.  Long tails give unseen users and items without leaving any row out.
SHOPPER = "user_id * 6 + daypart"
PRODUCT = f"{KEY} + 100 * floor(value / 10)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _read_out(events: DataFrame) -> DataFrame:
    """Events with instant, daypart and key read out of their columns."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.expr(EPOCH_MS).alias("timestamp"),
        F.expr(DAYPART).alias("daypart"),
        F.expr(PROPS_KEY).alias("k"),
        "user_id", "event_type", "value",
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, stored for steps that go over the rows several times: instants and JSON are
    read once per row, not once per rule and scan.  Rows are dealt out before that, since a
    file of few row groups is read by as few tasks, and so would be every later step."""
    def dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = table(spark, sf_dir, "events")
        return _read_out(events.hint("rebalance", F.col("event_id")))

    return stored(spark, sf_dir, "event_rows", dealt)


def _raw_events(events: DataFrame, visitor: str, item: str) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        "seq",
        "timestamp",
        F.expr(visitor).alias("visitorid"),
        F.when(kind == "click", "addtocart")
        .when(kind == "purchase", "transaction")
        .otherwise(kind)
        .alias("event"),
        F.expr(item).alias("itemid"),
        F.when(kind == "purchase", F.col("seq").cast("string")).alias("transactionid"),
    )


def _raw_properties(events: DataFrame, item: str) -> DataFrame:
    return events.filter(F.col("event_type").isin("signup", "error")).select(
        "timestamp",
        F.expr(item).alias("itemid"),
        F.when(F.col("event_type") == "signup", "categoryid").otherwise("available")
        .alias("property"),
        # A value below one unit stands for a text value, which is no category.
        F.when(F.col("value") < 1, F.concat(F.lit("n"), F.floor("value").cast("string")))
        .otherwise(F.floor(F.col("value") / 10).cast("string"))
        .alias("value"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_events(_read_out(table(spark, sf_dir, "events")), USER, KEY)


#: What replaces the text of rows by the remainder of their number: blanks, words, signs,
#: fractions, and instants beyond the calendar.
SPOILED = {
    "timestamp": (20, ("", "soon", "-5", "9300000000000000")),
    "visitorid": (23, ("  ", "x7", "-1")),
    "itemid": (29, (None, "1.5", "-3")),
}


def text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as padded text in mixed case, with planted defects."""
    raw, seq = raw_events(spark, sf_dir), F.col("seq")

    def spoiled(name: str):
        every, values = SPOILED[name]
        text = F.concat(F.lit(" "), F.col(name).cast("string"), F.lit(" "))
        for i, value in enumerate(values):
            text = F.when(seq % every == i, F.lit(value).cast("string")).otherwise(text)
        return text.alias(name)

    event = F.when(seq % 3 == 0, F.upper("event")).otherwise(F.concat(F.col("event"), F.lit("  ")))
    return raw.select(
        "seq", *map(spoiled, SPOILED), event.alias("event"),
        F.when(seq % 5 == 0, "  ").otherwise(F.col("transactionid")).alias("transactionid"),
    )


def spoiled_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as facts that nothing has checked."""
    def number(name: str):
        text = F.trim(F.col(name))
        return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))

    seq, time = F.col("seq"), number("timestamp")
    return text_events(spark, sf_dir).select(
        F.when(seq % 31 == 0, "XYZ").when(seq % 31 != 1, F.sha2(seq.cast("string"), 256))
        .alias("event_id"),
        time.alias("source_timestamp_ms"),
        F.when(time <= LAST_TIMESTAMP_MS, F.timestamp_millis(time)).alias("event_time"),
        number("visitorid").alias("visitor_id"),
        number("itemid").alias("item_id"),
        F.lower(F.trim("event")).alias("event_type"),
    )


def raw_item_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_properties(_read_out(table(spark, sf_dir, "events")), KEY)


def shopper_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_events(event_rows(spark, sf_dir), SHOPPER, PRODUCT)


def shopper_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_properties(event_rows(spark, sf_dir), PRODUCT)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with customer and date of their order, joined once for events and properties."""
    def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = table(spark, sf_dir, "lineitem")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate",
            "o_custkey", "o_orderdate",
        )

    return stored(spark, sf_dir, "order_lines", joined)


def bulk_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as events: the large table."""
    flag = F.col("l_returnflag")
    return _order_lines(spark, sf_dir).select(
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.col("o_custkey").alias("visitorid"),
        F.when(flag == "A", "view").when(flag == "N", "addtocart").otherwise("transaction")
        .alias("event"),
        F.col("l_partkey").alias("itemid"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transactionid"),
    )


def bulk_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order line also observes, at order date, the supplier group of its part."""
    return _order_lines(spark, sf_dir).select(
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
        F.col("l_partkey").alias("itemid"),
        F.lit("categoryid").alias("property"),
        F.col("l_suppkey").cast("string").alias("value"),
    )


def kafka_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(raw_events(spark, sf_dir))


def as_messages(raw: DataFrame) -> DataFrame:
    """Contract messages with one planted defect for each of the items 1 to 6, and every
    message of item 7 delivered twice."""
    item = F.col("itemid")
    source = with_event_id(raw).select(
        "seq",
        F.when(item != 3, F.col("event_id")).otherwise("xyz").alias("event_id"),
        F.col("timestamp").alias("source_timestamp_ms"),
        F.when(item == 5, "not-a-time")
        .otherwise(
            F.date_format(
                F.timestamp_millis("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
            )
        )
        .alias("occurred_at"),
        F.when(item == 1, -F.col("visitorid") - 1)
        .when(item != 4, F.col("visitorid"))
        .alias("visitor_id"),
        item.alias("item_id"),
        F.col("event").alias("event_type"),
        F.col("transactionid").alias("transaction_id"),
        F.lit("replay").alias("source"),
        F.when(item == 2, 2).otherwise(1).cast("bigint").alias("schema_version"),
    )
    value = F.when(F.col("item_id") == 6, "{bad").otherwise(sorted_json(CONTRACT_COLUMNS))
    copies = F.when(F.col("item_id") == 7, F.array(F.lit(0), F.lit(1_000_000_000))).otherwise(
        F.array(F.lit(0))
    )
    return source.withColumn("copy", F.explode(copies)).select(
        F.lit("user_events").alias("topic"),
        F.pmod("seq", F.lit(3)).cast("int").alias("partition"),
        (F.col("seq") + F.col("copy")).alias("offset"),
        F.timestamp_millis("source_timestamp_ms").alias("timestamp"),
        F.col("visitor_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


_stored: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str,
    build: Callable[[SparkSession, str], DataFrame],
) -> DataFrame:
    """The table ``name``, written on first use by this session."""
    key = (use_utc(spark).sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/{name}"
        build(spark, sf_dir).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def shared_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """One folder of this session for what is not a single table."""
    key = (use_utc(spark).sparkContext.applicationId, sf_dir, name)
    return _stored.setdefault(key, f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/{name}")


def _stored_clean(
    spark: SparkSession, sf_dir: str, name: str,
    read: Callable[[SparkSession, str], tuple[DataFrame, DataFrame]],
) -> DataFrame:
    key = (use_utc(spark).sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/{name}"
        etl.store_clean_events(*read(spark, sf_dir), path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def stored_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw events and item properties over the stored rows."""
    rows = event_rows(spark, sf_dir)
    return _raw_events(rows, USER, KEY), _raw_properties(rows, KEY)


def build_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.build_clean_events(*stored_raw(spark, sf_dir))


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_clean(spark, sf_dir, "clean", stored_raw)


def shopper_clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_clean(
        spark, sf_dir, "shopper_clean", lambda s, d: (shopper_events(s, d), shopper_properties(s, d))
    )


def build_bulk_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.build_clean_events(bulk_events(spark, sf_dir), bulk_properties(spark, sf_dir))


def bulk_clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Seven years of days over few rows: one directory per day would be all small files.
    return stored(spark, sf_dir, "bulk_clean", build_bulk_clean)
