"""Streaming over a file source that has the Kafka columns; stores in Parquet and Derby."""

import hashlib
import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartlark.plans.etl import staged_events
from cartlark.sources.fact_store import JdbcFactStore, ParquetFactStore, load_historical
from cartlark.sources.versioned_store import VersionedFactStore
from cartlark.streaming.event_stream import (
    LateRows,
    STATE,
    StreamConfig,
    batch_writer,
    parse_events,
    remembered,
    running,
    sinks,
    split_events,
    valid_events,
)

ENVELOPE = (
    "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"
)
NOON = 1_704_110_400_000  # 2024-01-01T12:00:00Z


def message(ms, visitor=1, item=2, event="view", **changes):
    body = {
        "event_id": hashlib.sha256(f"{ms}|{visitor}|{event}|{item}|".encode()).hexdigest(),
        "source_timestamp_ms": ms,
        "occurred_at": f"2024-01-01T{ms // 3_600_000 % 24:02d}:{ms // 60_000 % 60:02d}:00+00:00",
        "visitor_id": visitor, "item_id": item, "event_type": event, "transaction_id": None,
        "source": "test", "schema_version": 1,
    }
    return json.dumps({**body, **changes})


def send(spark, folder, *values):
    """One source file, hence part of one trigger."""
    rows = [("user_events", 0, n, None, None, value.encode()) for n, value in enumerate(values)]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(str(folder))


def records(spark, folder):
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run_once(spark, folder, config):
    outputs = sinks(records(spark, folder), config)
    with running(outputs, config, availableNow=True) as queries:
        for query in queries.values():
            query.awaitTermination()
        return {name: str(query.id) for name, query in queries.items()}


@pytest.fixture
def config(tmp_path):
    return StreamConfig(str(tmp_path / "home"))


DEFECTS = {
    "missing_required_field": [message(NOON, visitor_id=None), "{bad", message(NOON, item_id="x"), ""],
    "unsupported_event_type": [message(NOON, event_type="refund")],
    "negative_identifier": [message(NOON, visitor_id=-1), message(NOON, source_timestamp_ms=-1)],
    "invalid_event_id": [message(NOON, event_id="XYZ")],
    "unsupported_schema_version": [message(NOON, schema_version=2)],
    "invalid_occurred_at": [message(NOON, occurred_at="not-a-time"), message(NOON, occurred_at=None)],
}


def test_every_defect_has_its_reason(spark):
    rows = [(reason, v.encode()) for reason, values in DEFECTS.items() for v in values]
    table = spark.createDataFrame(
        [("t", 0, n, None, None, v) for n, (_, v) in enumerate(rows)], ENVELOPE
    )
    valid, quarantined = split_events(table)
    assert valid.isEmpty()
    assert {r["offset"]: r["error_reason"] for r in quarantined.collect()} == {
        n: reason for n, (reason, _) in enumerate(rows)
    }


def test_reasons_follow_their_priority(spark):
    worst = message(NOON, event_type="refund", visitor_id=-1, event_id="x", schema_version=3)
    table = spark.createDataFrame([("t", 0, 0, None, None, worst.encode())], ENVELOPE)
    assert split_events(table)[1].first()["error_reason"] == "unsupported_event_type"


def test_stream_splits_deduplicates_and_restarts(spark, tmp_path, config):
    source = tmp_path / "in"
    send(spark, source, message(NOON), message(NOON), message(NOON + 1000, event="addtocart"),
         *(v for values in DEFECTS.values() for v in values))
    run_once(spark, source, config)
    store = config.store()
    assert store.facts(spark).count() == 2
    assert spark.read.parquet(config.folder("rejected")).count() == sum(map(len, DEFECTS.values()))
    send(spark, source, message(NOON), message(NOON + 2000))
    run_once(spark, source, config)  # goes on from the checkpoint
    assert store.facts(spark).count() == 3
    ledger = store.ledger(spark).collect()
    assert sum(r["row_count"] for r in ledger) == 3
    assert len({r["query_id"] for r in ledger}) == 1
    facts = store.facts(spark)
    assert facts.filter("category_id is not null or session_id is not null").isEmpty()


def test_late_events_are_dropped_and_counted(spark, tmp_path, config):
    source = tmp_path / "in"
    late, in_time = NOON - 3_600_000, NOON - 300_000
    # Rows are late against the watermark of the batch before, hence the second row at noon.
    for ms in (NOON, NOON + 1, late, in_time):
        send(spark, source, message(ms))
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        names = run_once(spark, source, config)
        kept = {r["source_timestamp_ms"] for r in config.store().facts(spark).collect()}
        # More reports than a query remembers.
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
        for step in range(4):
            send(spark, source, message(NOON + 2 + step), message(late - step))
        assert run_once(spark, source, config) == names
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(listener)
    assert kept == {NOON, NOON + 1, in_time}
    assert listener.dropped[names["accepted"]] == 5


def test_state_lies_in_files_and_shrinks_with_the_watermark(spark, tmp_path, config):
    source = tmp_path / "in"
    send(spark, source, *(message(NOON + n) for n in range(5)))
    run_once(spark, source, config)
    assert remembered(spark, config).count() == 5
    assert all(spark.conf.get(name, None) is None for name in STATE)
    offsets = Path(config.checkpoint("accepted"), "offsets", "0").read_text()
    assert "RocksDBStateStoreProvider" in offsets
    assert list(Path(config.checkpoint("accepted"), "state").rglob("*.changelog"))
    # An hour on, none of the five can come again; the ids of the last two batches remain.
    for step in (1, 2):
        send(spark, source, message(NOON + step * 3_600_000))
        run_once(spark, source, config)
    assert remembered(spark, config).count() <= 2
    assert config.store().facts(spark).count() == 7


def test_own_state_settings_go_first(spark, tmp_path, config):
    name = next(iter(STATE))
    heap = STATE[name].replace("RocksDB", "HDFSBacked")
    spark.conf.set(name, heap)
    try:
        send(spark, tmp_path / "in", message(NOON))
        run_once(spark, tmp_path / "in", config)
        assert spark.conf.get(name) == heap
        assert heap in Path(config.checkpoint("accepted"), "offsets", "0").read_text()
    finally:
        spark.conf.unset(name)


def test_new_checkpoint_restarts_batch_numbers_without_losing_data(spark, tmp_path, config):
    source = tmp_path / "in"
    send(spark, source, message(NOON))
    run_once(spark, source, config)
    other = StreamConfig(config.home, checkpoints=str(tmp_path / "elsewhere"))
    send(spark, source, message(NOON + 5000))
    run_once(spark, source, other)
    facts = config.store().facts(spark)
    assert facts.count() == 2 == facts.select("event_id").distinct().count()
    assert config.store().ledger(spark).select("query_id").distinct().count() == 2


def valid_batch(spark, *times):
    table = spark.createDataFrame(
        [("t", 0, n, None, None, message(t).encode()) for n, t in enumerate(times)], ENVELOPE
    )
    return valid_events(parse_events(table))


def derby(tmp_path, spark):
    store = JdbcFactStore(
        f"jdbc:derby:{tmp_path}/db{uuid.uuid4().hex};create=true",
        {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, write_partitions=2,
    )
    spark.sparkContext._jvm.java.lang.Class.forName(store.properties["driver"])
    store.create_tables(spark, staged_text="clob")
    return store


@pytest.fixture(params=["parquet", "derby"])
def store(request, spark, tmp_path):
    return derby(tmp_path, spark) if request.param == "derby" else ParquetFactStore(str(tmp_path / "s"))


def test_replayed_batches_add_nothing(spark, tmp_path, store):
    write = batch_writer(str(tmp_path / "files"), store)
    write(valid_batch(spark, NOON, NOON + 1), 0)
    write(valid_batch(spark, NOON, NOON + 1), 0)
    write(valid_batch(spark, NOON + 1, NOON + 2), 1)
    assert store.facts(spark).count() == 3
    assert {(r["batch_id"], r["pipeline_name"]) for r in store.ledger(spark).collect()} == {
        (0, "user_events_stream"), (1, "user_events_stream"),
    }


def test_a_batch_that_failed_before_its_ledger_entry_is_written_again(spark, tmp_path, store):
    batch = valid_batch(spark, NOON, NOON + 1)
    store.write(batch, 0, "q")  # the job is lost here
    assert not store.is_complete(spark, 0, "q")
    rows = store.write(batch, 0, "q")
    store.complete(spark, 0, "q", rows)
    assert store.is_complete(spark, 0, "q") and not store.is_complete(spark, 0, "other")
    assert store.facts(spark).count() == 2


def test_empty_batches_leave_no_trace(spark, tmp_path, store):
    batch_writer(str(tmp_path / "files"), store)(valid_batch(spark, NOON).filter("false"), 0)
    assert store.ledger(spark).isEmpty()


def test_historical_load_is_repeatable(spark, store):
    clean = valid_batch(spark, NOON, NOON + 1).drop("source", "schema_version").withColumns(
        {"category_id": F.lit(7).cast("bigint"), "session_id": F.lit("1-1")}
    )
    assert load_historical(clean.filter("false"), store) == 0
    assert store.ledger(spark).isEmpty()
    for _ in range(2):
        load_historical(clean, store)
        assert store.facts(spark).count() == 2
    assert {(r["source"], r["category_id"]) for r in store.facts(spark).collect()} == {
        ("retailrocket_batch", 7)
    }
    assert [r["pipeline_name"] for r in store.ledger(spark).collect()] == ["historical_batch_load"]


def clean_batch(spark, *times):
    return valid_batch(spark, *times).drop("source", "schema_version").withColumns(
        {"category_id": F.lit(7).cast("bigint"), "session_id": F.lit("1-1")}
    )


def test_historical_loads_add_up(spark, store):
    first = clean_batch(spark, *[NOON + n for n in range(10)])
    second = clean_batch(spark, *[NOON + 86_400_000 * n for n in range(1, 6)])
    both = clean_batch(spark, NOON, NOON + 86_400_000, NOON + 500)
    for load, facts in ((first, 10), (second, 15), (first, 15), (both, 16), (second, 16)):
        load_historical(load, store)
        assert store.facts(spark).count() == facts
    assert store.ledger(spark).count() == 3
    assert len({r["query_id"] for r in store.ledger(spark).collect()}) == 3


def test_loads_may_be_named(spark, store):
    assert load_historical(clean_batch(spark, NOON), store, "may") == 1
    assert load_historical(clean_batch(spark, NOON + 1), store, "may") == 0
    assert store.facts(spark).count() == 1


def test_two_streams_do_not_move_each_others_rows(spark, store):
    store.write(valid_batch(spark, NOON, NOON + 1), 0, "a")
    rows = store.write(valid_batch(spark, NOON + 2), 0, "b")
    store.complete(spark, 0, "b", rows)
    assert not store.is_complete(spark, 0, "a")
    rows = store.write(valid_batch(spark, NOON, NOON + 1), 0, "a")
    assert rows == 2
    store.complete(spark, 0, "a", rows)
    assert store.facts(spark).count() == 3


def test_a_batch_reads_the_facts_of_its_dates_only(spark, tmp_path):
    store = ParquetFactStore(str(tmp_path / "s"))
    load_historical(clean_batch(spark, *[NOON + 86_400_000 * n for n in range(4)]), store)
    touched = store._read(spark, "facts/day=2015-05-08", "facts/day=none")
    held = {f.split("day=")[1][:10] for f in store._read(spark, "facts").inputFiles()}
    assert len(held) == 4 and (touched is None or len(touched.inputFiles()) == 1)
    moved = store.compact(spark, str(tmp_path / "t"))
    assert moved.facts(spark).count() == 4 and moved.ledger(spark).count() == 1
    assert load_historical(clean_batch(spark, *[NOON + 86_400_000 * n for n in range(4)]), moved) == 0


def test_a_failing_commit_rolls_back(spark, tmp_path):
    store = derby(tmp_path, spark)
    broken = valid_batch(spark, NOON).withColumn("visitor_id", F.lit(-1).cast("bigint"))
    rows = store.write(broken, 0, "q")
    with pytest.raises(Exception, match="(?i)constraint"):
        store.complete(spark, 0, "q", rows)
    assert store.facts(spark).isEmpty() and store.ledger(spark).isEmpty()


def test_facts_of_a_database_are_read_in_parallel(spark, tmp_path):
    store = derby(tmp_path, spark)
    assert store.facts(spark).isEmpty()
    times = [NOON + n * n * 1000 for n in range(40)]
    load_historical(clean_batch(spark, *times), store)
    for parts in (1, 2, 7, 100):
        facts = store.facts(spark, parts)
        assert facts.rdd.getNumPartitions() == min(parts, 40)
        assert sorted(r["source_timestamp_ms"] for r in facts.collect()) == times


def test_the_ledger_counts_new_facts(spark, store):
    for batch_id, times in enumerate([(NOON, NOON + 1), (NOON + 1, NOON + 2)]):
        rows = store.write(valid_batch(spark, *times), batch_id, "q")
        store.complete(spark, batch_id, "q", rows)
    assert {r["batch_id"]: r["row_count"] for r in store.ledger(spark).collect()} == {0: 2, 1: 1}


def test_staging_needs_all_columns(spark):
    with pytest.raises(ValueError, match="event_id, event_time"):
        staged_events(spark.createDataFrame(
            [(1, 2, 3, "view", "x")],
            "source_timestamp_ms bigint, visitor_id bigint, item_id bigint, event_type string, "
            "transaction_id string"))


def test_config_from_environment():
    env = {"CARTLARK_STREAM_HOME": "/h", "CARTLARK_STREAM_TOPIC": "other", "PATH": "/bin"}
    config = StreamConfig.from_env(env)
    assert (config.home, config.topic, config.watermark) == ("/h", "other", "10 minutes")
    assert isinstance(config.store(), ParquetFactStore)
    jdbc = {"URL": "jdbc:postgresql://db/x", "USER": "u", "DRIVER": "org.postgresql.Driver"}
    env |= {f"CARTLARK_STREAM_JDBC_{name}": value for name, value in jdbc.items()}
    store = StreamConfig.from_env(env).store()
    assert store.url == jdbc["URL"]
    assert store.properties == {"user": "u", "driver": "org.postgresql.Driver"}
    with pytest.raises(ValueError, match="HOME"):
        StreamConfig.from_env({})


def test_the_source_loses_nothing_unless_it_may():
    base = {"CARTLARK_STREAM_HOME": "/h", "CARTLARK_STREAM_BROKERS": "b:9092"}
    options = StreamConfig.from_env(base).source()
    assert options == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "user_events",
        "startingOffsets": "earliest", "failOnDataLoss": "true",
    }
    own = {"START": "latest", "MAY_LOSE": "yes", "ROWS_PER_BATCH": "5000", "FACTS": "versioned"}
    config = StreamConfig.from_env(base | {f"CARTLARK_STREAM_{k}": v for k, v in own.items()})
    assert config.source() == options | {
        "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5000",
    }
    assert config.store() == VersionedFactStore("/h/versions")
    for name in ("MAY_LOSE", "FACTS"):
        with pytest.raises(ValueError, match=name):
            StreamConfig.from_env(base | {f"CARTLARK_STREAM_{name}": "perhaps"})
