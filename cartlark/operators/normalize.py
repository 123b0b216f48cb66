"""Raw rows to contract events, with a reason for every row left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlark.functions.contract import (
    LAST_TIMESTAMP_MS,
    REPLAY_SOURCE,
    SCHEMA_VERSION,
    event_fingerprint,
    is_supported,
    iso_instant,
)

ID_FIELDS = ("timestamp", "visitorid", "itemid")


def _text(df: DataFrame, name: str) -> Column:
    return F.trim(F.col(name).cast("string")) if name in df.columns else F.lit(None).cast("string")


def _is_typed(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, T.IntegralType)


def _missing(df: DataFrame, name: str) -> Column:
    if _is_typed(df, name):
        return F.col(name).isNull()
    text = _text(df, name)
    return text.isNull() | (text == "")


def _whole_number(df: DataFrame, name: str) -> Column:
    if _is_typed(df, name):
        return F.col(name).cast("bigint")
    text = _text(df, name)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def _event(raw: DataFrame) -> Column:
    return F.lower(F.coalesce(_text(raw, "event"), F.lit("")))


def _typed(raw: DataFrame) -> list[Column]:
    transaction = _text(raw, "transactionid")
    return [
        *(_whole_number(raw, name).alias(name) for name in ID_FIELDS),
        _event(raw).alias("event"),
        F.when(transaction != "", transaction).alias("transactionid"),
    ]


def _classified(raw: DataFrame) -> DataFrame:
    """Typed columns beside the raw ones, and the first rule a row breaks (or null)."""
    rules = []
    for name in ID_FIELDS:
        number = _whole_number(raw, name)
        rules += [
            (f"{name}:blank", _missing(raw, name)),
            (f"{name}:not_whole", number.isNull()),
            (f"{name}:below_zero", number < 0),
        ]
    rules += [
        ("timestamp:out_of_range", _whole_number(raw, "timestamp") > LAST_TIMESTAMP_MS),
        ("event:unsupported", ~is_supported(_event(raw))),
    ]
    reason = F.coalesce(*(F.when(broken, F.lit(code)) for code, broken in rules))
    return raw.select(F.struct(*raw.columns).alias("raw"), reason.alias("reason"), *_typed(raw))


def normalize_events(raw: DataFrame) -> DataFrame:
    """Trimmed, typed and validated rows; anything that breaks a rule is left out.

    A row breaks no rule if its event is supported and its numbers lie in their ranges, which
    reads each field once; which rule it breaks is a matter for the rejected rows."""
    known = (
        is_supported(_event(raw))
        & _whole_number(raw, "timestamp").between(0, LAST_TIMESTAMP_MS)
        & (_whole_number(raw, "visitorid") >= 0)
        & (_whole_number(raw, "itemid") >= 0)
    )
    return raw.filter(known).select(*_typed(raw)).select(
        "timestamp", "visitorid", "event", "itemid", "transactionid"
    )


def unchecked_number(raw: DataFrame, name: str) -> DataFrame:
    """One field of all raw rows as a number, those that break a rule included: enough to
    count in, and cheaper than :func:`normalize_events`."""
    return raw.select(_whole_number(raw, name).alias(name))


def rejected_events(raw: DataFrame) -> DataFrame:
    """The complement of :func:`normalize_events`: raw columns plus the broken rule."""
    return _classified(raw).filter(F.col("reason").isNotNull()).select("raw.*", "reason")


def filter_event_types(events: DataFrame, column: str = "event") -> DataFrame:
    return events.filter(is_supported(column))


def with_event_id(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "event_id", event_fingerprint("timestamp", "visitorid", "event", "itemid", "transactionid")
    )


def identifying_fields(events: DataFrame) -> DataFrame:
    """The five fields that identify an event; no transaction and an empty one are the same."""
    return events.select(
        "timestamp", "visitorid", "event", "itemid",
        F.nullif("transactionid", F.lit("")).alias("transactionid"),
    )


def distinct_events(events: DataFrame) -> DataFrame:
    """One row per event, by its five identifying fields.

    The event id is a one-to-one function of these fields, so this keeps the rows that a
    deduplication by id would keep, shuffles short fields instead of 64-character digests,
    and collapses copies before the shuffle.
    """
    return identifying_fields(events).distinct()


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per event id."""
    return with_event_id(distinct_events(events))


def to_contract(events: DataFrame, source: str = REPLAY_SOURCE) -> DataFrame:
    """Normalised rows in the nine-field contract shape."""
    return with_event_id(events).select(
        "event_id",
        F.col("timestamp").alias("source_timestamp_ms"),
        iso_instant(F.col("timestamp")).alias("occurred_at"),
        F.col("visitorid").alias("visitor_id"),
        F.col("itemid").alias("item_id"),
        F.col("event").alias("event_type"),
        F.col("transactionid").alias("transaction_id"),
        F.lit(source).alias("source"),
        F.lit(SCHEMA_VERSION).cast("bigint").alias("schema_version"),
    )
