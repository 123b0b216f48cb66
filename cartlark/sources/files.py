"""File sources with explicit schemas, and the required-column check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from cartlark.functions.contract import ITEM_PROPERTY_SCHEMA, RAW_EVENT_KEYS, RAW_EVENT_SCHEMA

INTERACTION_COLUMNS = ("visitor_id", "item_id", "event_type", "event_time")


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {', '.join(missing)}")
    return df


def read_events_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw events with typed columns; a malformed cell reads as null."""
    return spark.read.schema(RAW_EVENT_SCHEMA).csv(
        path if isinstance(path, str) else list(path), header=True
    )


def read_events_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw events as text, by header name, so that rejected rows keep what they said."""
    return require_columns(
        spark.read.csv(path, header=True, inferSchema=False), RAW_EVENT_KEYS, "events CSV"
    )


def read_item_properties_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The item property change log, one frame over all its parts."""
    return spark.read.schema(ITEM_PROPERTY_SCHEMA).csv(list(paths), header=True)


def read_clean_events(spark: SparkSession, path: str) -> DataFrame:
    """Clean events from Parquet, or from CSV when the path says so."""
    if path.lower().endswith(".csv"):
        df = spark.read.csv(path, header=True, inferSchema=False)
        typed = {"source_timestamp_ms": "bigint", "visitor_id": "bigint", "item_id": "bigint"}
        typed |= {"category_id": "double", "day_of_week": "int", "hour": "int"}
        df = df.withColumns({c: df[c].try_cast(t) for c, t in typed.items() if c in df.columns})
    else:
        df = spark.read.parquet(path)
    return require_columns(df, INTERACTION_COLUMNS, "clean events")
