"""Batch ETL: raw events and item properties to clean events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.functions.contract import BATCH_SOURCE, HISTORICAL_BATCH_ID, SCHEMA_VERSION
from cartlark.operators.asof import asof_join
from cartlark.operators.normalize import (
    identifying_fields,
    normalize_events,
    unchecked_number,
    with_event_id,
)
from cartlark.operators.sessions import with_sessions
from cartlark.sources.files import read_events_csv, read_item_properties_csv, require_columns

CLEAN_COLUMNS = (
    "event_id", "source_timestamp_ms", "event_time", "visitor_id", "item_id", "event_type",
    "transaction_id", "category_id", "session_id", "day_of_week", "hour", "event_date",
)
STAGED_COLUMNS = (
    "ingest_batch_id", "event_id", "source_timestamp_ms", "event_time", "visitor_id",
    "item_id", "event_type", "transaction_id", "category_id", "session_id", "source",
    "schema_version",
)


def _category_values(properties: DataFrame) -> DataFrame:
    return (
        properties.filter((F.col("property") == "categoryid") & F.col("value").rlike("^[0-9]+$"))
        .select("itemid", "timestamp", F.col("value").try_cast("bigint").alias("category_id"))
        .dropna()
    )


def category_observations(properties: DataFrame) -> DataFrame:
    """``(itemid, timestamp, category_id)`` from the property log: numeric category values,
    one per item and time (the largest when a time repeats)."""
    return (
        _category_values(properties)
        .groupBy("itemid", "timestamp")
        .agg(F.max("category_id").alias("category_id"))
    )


def with_category(
    events: DataFrame, properties: DataFrame, unique: bool = False,
    counted: DataFrame | None = None, **limits: int
) -> DataFrame:
    """Events plus the category that was valid for their item at their time.  ``unique``,
    ``counted`` and ``limits`` are those of :func:`cartlark.operators.asof.asof_join`."""
    return asof_join(
        events, _category_values(properties), key="itemid", time="timestamp",
        value="category_id", unique=unique, counted=counted, **limits,
    )


def _clean_rows(
    raw_events: DataFrame, properties: DataFrame, session_gap_minutes: float
) -> DataFrame:
    events = identifying_fields(normalize_events(raw_events))
    told = properties.filter(F.col("property") == "categoryid").select("itemid")
    enriched = with_category(
        events, properties, unique=True,
        counted=unchecked_number(raw_events, "itemid").unionByName(told),
    )
    sessions = with_sessions(
        enriched, gap_minutes=session_gap_minutes, keys_from=events,
        counted=unchecked_number(raw_events, "visitorid"),
    )
    return sessions.withColumn("event_date", F.to_date(F.timestamp_millis("timestamp")))


def _clean_columns(rows: DataFrame) -> DataFrame:
    event_time = F.timestamp_millis("timestamp")
    return with_event_id(rows).select(
        "event_id",
        F.col("timestamp").alias("source_timestamp_ms"),
        event_time.alias("event_time"),
        F.col("visitorid").alias("visitor_id"),
        F.col("itemid").alias("item_id"),
        F.col("event").alias("event_type"),
        F.col("transactionid").alias("transaction_id"),
        "category_id",
        "session_id",
        F.dayofweek(event_time).alias("day_of_week"),
        F.hour(event_time).alias("hour"),
        "event_date",
    )


def build_clean_events(
    raw_events: DataFrame, properties: DataFrame, session_gap_minutes: float = 30
) -> DataFrame:
    """The clean event table: unique events with category as of event time and session.

    The rows, five short columns, move twice: by item, where copies are dropped and the
    category is found, and by visitor, where sessions are numbered.  Raw rows are read beside
    that to find heavy items and visitors, which moves counts only.  The id, the widest column,
    is taken after the last shuffle.
    """
    return _clean_columns(_clean_rows(raw_events, properties, session_gap_minutes))


def store_clean_events(
    raw_events: DataFrame, properties: DataFrame, path: str, session_gap_minutes: float = 30
) -> None:
    """:func:`build_clean_events`, written as by :func:`write_clean_events`; rows move to their
    date before the id is taken."""
    rows = _clean_rows(raw_events, properties, session_gap_minutes)
    _write_dates(_clean_columns(rows.hint("rebalance", F.col("event_date"))), path)


def category_match_rate(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count("*").alias("events"),
        F.count("category_id").alias("matched"),
        F.round(F.try_divide(F.count("category_id"), F.count("*")), 6).alias("match_rate"),
    )


def staged_events(
    clean: DataFrame, batch_id: int = HISTORICAL_BATCH_ID, source: str = BATCH_SOURCE
) -> DataFrame:
    """Clean or streamed events in the staging shape, with their provenance.  Streamed
    events have no category or session yet."""
    optional = {"category_id": "bigint", "session_id": "string"}
    missing = {c: F.lit(None).cast(t) for c, t in optional.items() if c not in clean.columns}
    own = {} if "source" in clean.columns else {"source": F.lit(source)}
    version = {"schema_version": F.lit(SCHEMA_VERSION).cast("smallint")}
    staged = clean.withColumns(
        {"ingest_batch_id": F.lit(batch_id).cast("bigint"), **missing, **own, **version}
    )
    return require_columns(staged, STAGED_COLUMNS, "clean events").select(*STAGED_COLUMNS)


def run_batch_etl(
    spark: SparkSession, events_path: str, property_paths: list[str], output_path: str,
    session_gap_minutes: float = 30,
) -> DataFrame:
    """CSV to partitioned Parquet.  Returns the written table, so that counting or loading
    it does not repeat the work."""
    store_clean_events(
        read_events_csv(spark, events_path),
        read_item_properties_csv(spark, property_paths),
        output_path, session_gap_minutes,
    )
    return spark.read.parquet(output_path)


def write_clean_events(clean: DataFrame, path: str) -> None:
    """One directory per date.  The rebalance hint lets adaptive execution pack small dates
    together and split a date that holds a large share of the rows."""
    _write_dates(clean.hint("rebalance", F.col("event_date")), path)


def _write_dates(clean: DataFrame, path: str) -> None:
    clean.write.mode("overwrite").partitionBy("event_date").parquet(path)


def compact_clean_events(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite many small files into few per date."""
    write_clean_events(spark.read.parquet(source), target)
