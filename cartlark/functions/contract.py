"""The event contract as column expressions, shared by batch and stream."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the contract: event types in funnel order, their interaction
# weights, provenance labels, version and the shape of an event id.
EVENT_TYPES = ("view", "addtocart", "transaction")
EVENT_WEIGHTS = {"view": 1.0, "addtocart": 3.0, "transaction": 5.0}
REPLAY_SOURCE = "retailrocket_replay"
BATCH_SOURCE = "retailrocket_batch"
SCHEMA_VERSION = 1
# The last millisecond of the year 9999: later instants have no four-digit year.
LAST_TIMESTAMP_MS = 253_402_300_799_999
EVENT_ID_PATTERN = "^[0-9a-f]{64}$"
HISTORICAL_BATCH_ID = -1
UNKNOWN_CATEGORY = -1

RAW_EVENT_SCHEMA = (
    "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid string"
)
ITEM_PROPERTY_SCHEMA = "timestamp bigint, itemid bigint, property string, value string"
CONTRACT_SCHEMA = (
    "event_id string, source_timestamp_ms bigint, occurred_at string, visitor_id bigint, "
    "item_id bigint, event_type string, transaction_id string, source string, "
    "schema_version bigint"
)
CONTRACT_COLUMNS = tuple(field.split()[0] for field in CONTRACT_SCHEMA.split(", "))
RAW_EVENT_KEYS = ("timestamp", "visitorid", "event", "itemid")


def is_event(name: str, column: str = "event_type") -> Column:
    return F.col(column) == name


def is_supported(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).isin(*EVENT_TYPES)


def interaction_weight(column: str = "event_type") -> Column:
    """Implicit-feedback strength of one event; null for unsupported types."""
    weight = F.lit(None).cast("double")
    for name, value in EVENT_WEIGHTS.items():
        weight = F.when(is_event(name, column), F.lit(value)).otherwise(weight)
    return weight


def event_fingerprint(
    timestamp_ms: str, visitor: str, event: str, item: str, transaction: str
) -> Column:
    """SHA-256 over the five identifying fields, a missing transaction reading as empty."""
    return F.sha2(
        F.concat_ws(
            "|", timestamp_ms, visitor, event, item, F.coalesce(F.col(transaction), F.lit(""))
        ),
        256,
    )


def iso_instant(timestamp_ms: Column) -> Column:
    """ISO-8601 with a +00:00 offset; whole seconds are written without a fraction."""
    moment = F.timestamp_millis(timestamp_ms)
    return F.when(
        F.pmod(timestamp_ms, F.lit(1000)) == 0, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssxxx")
    ).otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def sorted_json(columns: Iterable[str]) -> Column:
    """Compact JSON object with keys in name order and explicit nulls."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def ratio(numerator: str, denominator: str) -> Column:
    """Numerator per denominator, null on a zero denominator, to six places."""
    return F.round(
        F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double")), 6
    )
