"""Kafka source and the record shape of the Kafka and JSON-lines sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.functions.contract import CONTRACT_COLUMNS, sorted_json


def source_options(
    brokers: str, topic: str, *, start: str = "earliest", may_lose: bool = False,
    rows_per_batch: int = 0,
) -> dict[str, str]:
    """Connector options of a stream.

    ``start`` matters for a first run only; a checkpoint goes on from its own offsets.  A stream
    whose offsets have expired fails unless it ``may_lose`` them.  ``rows_per_batch`` of 0 sets
    no limit.
    """
    options = {
        "kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": start,
        "failOnDataLoss": str(not may_lose).lower(),
    }
    if rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    return options


def read_kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def to_kafka_records(contract_events: DataFrame) -> DataFrame:
    """Key by visitor so that one visitor's events stay ordered in one partition."""
    return contract_events.select(
        F.col("visitor_id").cast("string").cast("binary").alias("key"),
        sorted_json(CONTRACT_COLUMNS).cast("binary").alias("value"),
        F.array(
            F.struct(
                F.lit("schema_version").alias("key"),
                F.col("schema_version").cast("string").cast("binary").alias("value"),
            )
        ).alias("headers"),
    )


def write_kafka(contract_events: DataFrame, bootstrap_servers: str, topic: str) -> None:
    (
        to_kafka_records(contract_events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .save()
    )


def to_json_lines(contract_events: DataFrame) -> DataFrame:
    return contract_events.select(sorted_json(CONTRACT_COLUMNS).alias("value"))


def write_json_lines(contract_events: DataFrame, path: str) -> None:
    to_json_lines(contract_events).write.mode("overwrite").text(path)
