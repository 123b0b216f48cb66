import json

import pytest
from pyspark.sql import functions as F

from cartlark.plans import artifacts
from cartlark.sources import versioned_store
from cartlark.sources.commit_log import CommitLog, Files
from cartlark.sources.fact_store import load_historical
from cartlark.sources.versioned_store import Conflict, VersionedFactStore, publish, published
from cartlark.streaming.event_stream import batch_writer
from test_streaming import NOON, clean_batch, valid_batch

DAY = 86_400_000


@pytest.fixture
def store(tmp_path):
    return VersionedFactStore(str(tmp_path / "s"))


def load(store, spark, batch_id, *times):
    rows = store.write(valid_batch(spark, *times), batch_id, "q")
    return store.complete(spark, batch_id, "q", rows)


def times(store, spark, version=None):
    return sorted(r["source_timestamp_ms"] for r in store.facts(spark, version).collect())


def test_of_two_writers_of_a_version_one_succeeds(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    assert log.head(spark) == 0 and log.read(spark) == []
    assert log.append(spark, 1, {"n": 1}) and not log.append(spark, 1, {"n": 2})
    assert log.append(spark, 2, {"n": 3}) and [c["n"] for c in log.read(spark)] == [1, 3]
    assert Files(spark).names(log.path) == ["00000000000000000001.json", "00000000000000000002.json"]


def test_nothing_is_read_before_its_commit(spark, store):
    assert store.facts(spark).isEmpty() and store.ledger(spark).isEmpty()
    store.write(valid_batch(spark, NOON, NOON + 1), 0, "q")  # and the job is lost
    assert store.facts(spark).isEmpty() and not store.is_complete(spark, 0, "q")
    assert load(store, spark, 0, NOON, NOON + 1) == 2
    assert times(store, spark) == [NOON, NOON + 1] and store.is_complete(spark, 0, "q")
    assert store.write(valid_batch(spark, NOON + 7), 0, "q") == 0
    assert store.complete(spark, 0, "q", 0) == 0
    assert store.ledger(spark).first()["row_count"] == 2


def test_old_versions_stay_readable(spark, store):
    load(store, spark, 0, NOON)
    load(store, spark, 1, NOON, NOON + 1, NOON + DAY)
    assert times(store, spark, 0) == []
    assert times(store, spark, 1) == [NOON]
    assert times(store, spark) == times(store, spark, 2) == [NOON, NOON + 1, NOON + DAY]
    assert store.ledger(spark, 1).count() == 1
    with pytest.raises(ValueError, match="no version 3"):
        store.facts(spark, 3)


def test_a_writer_that_was_overtaken_looks_again(spark, store):
    slow = store.write(valid_batch(spark, NOON, NOON + 1, NOON + 2), 0, "slow")
    assert slow == 3
    load(store, spark, 0, NOON + 1, NOON + 5)
    assert store.complete(spark, 0, "slow", slow) == 2
    assert times(store, spark) == [NOON, NOON + 1, NOON + 2, NOON + 5]
    rows = {r["query_id"]: r["row_count"] for r in store.ledger(spark).collect()}
    assert rows == {"q": 2, "slow": 2}


def test_two_writers_at_the_same_moment(spark, store, monkeypatch):
    first = store.write(valid_batch(spark, NOON, NOON + 1), 0, "a")
    append, calls = CommitLog.append, []

    def racing(log, session, version, commit):
        if not calls:
            calls.append(version)
            load(store, spark, 9, NOON + 1)  # between reading the head and committing
        return append(log, session, version, commit)

    monkeypatch.setattr(CommitLog, "append", racing)
    assert store.complete(spark, 0, "a", first) == 1
    assert times(store, spark) == [NOON, NOON + 1] and store.log.head(spark) == 2


def test_compaction_in_place_keeps_a_batch_written_meanwhile(spark, store, monkeypatch):
    for n in range(4):
        load(store, spark, n, NOON + n, NOON + DAY + n)
    before, files = times(store, spark), len(store.version(spark).files)
    written, raced = VersionedFactStore._written, []

    def meanwhile(self, session, rows):
        found = written(self, session, rows)
        if not raced:
            raced.append(1)
            load(store, spark, 50, NOON + 100)
        return found

    monkeypatch.setattr(VersionedFactStore, "_written", meanwhile)
    version = store.compact(spark)
    assert version == 6 and times(store, spark) == sorted([*before, NOON + 100])
    assert files == 8 and len(store.version(spark).files) == 3
    assert times(store, spark, 4) == before and store.ledger(spark).count() == 5
    assert store.compact(spark) == 7 and store.compact(spark) is None
    assert store.compact(spark, small_bytes=1) is None


def test_files_that_were_replaced_are_not_taken_out_twice(spark, store):
    for n in range(2):
        load(store, spark, n, NOON + n)
    base = store.version(spark)
    store.compact(spark)
    with pytest.raises(Conflict):
        store._commit(spark, store.version(spark), lambda v: {
            "add": {}, "remove": list(base.files), "entry": None})


def test_the_state_is_written_down_now_and_then(spark, store, monkeypatch):
    monkeypatch.setattr(versioned_store, "STATE_EVERY", 2)
    for n in range(5):
        load(store, spark, n, NOON + n)
    assert Files(spark).names(f"{store.path}/state") == [f"{n:020d}.json" for n in (2, 4)]
    reads = []
    read = CommitLog.read
    monkeypatch.setattr(CommitLog, "read", lambda log, s, after=0, upto=None: reads.append(
        (after, upto)) or read(log, s, after, upto))
    assert times(store, spark) == [NOON + n for n in range(5)] and reads == [(4, 5)]
    assert times(store, spark, 3) == [NOON, NOON + 1, NOON + 2] and reads[-1] == (2, 3)


def test_streams_and_historical_loads_use_it_like_the_others(spark, tmp_path, store):
    write = batch_writer(str(tmp_path / "files"), store)
    write(valid_batch(spark, NOON, NOON + 1), 0)
    write(valid_batch(spark, NOON, NOON + 1), 0)
    write(valid_batch(spark, NOON + 1, NOON + 2), 1)
    assert store.facts(spark).count() == 3 and store.ledger(spark).count() == 2
    assert load_historical(clean_batch(spark, NOON + 1, NOON + 9), store) in (1, 2)
    assert load_historical(clean_batch(spark, NOON + 1, NOON + 9), store) == 0
    assert store.facts(spark).count() == 4
    write(valid_batch(spark, NOON).filter("false"), 7)
    assert store.ledger(spark).count() == 3


def test_a_model_is_published_whole_or_not_at_all(spark, tmp_path):
    path, one = str(tmp_path / "m"), spark.range(3)
    with pytest.raises(ValueError, match="no version"):
        published(spark, path)
    assert publish(spark, path, {"a": one, "b": one, "c": one, "d": one}, epoch=4) == 1
    broken = one.withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        publish(spark, path, {"a": spark.range(9), "b": spark.range(9), "c": spark.range(9), "d": broken})
    assert {n: t.count() for n, t in published(spark, path).items()} == dict.fromkeys("abcd", 3)
    assert publish(spark, path, {"a": spark.range(5)}) == 2
    assert published(spark, path)["a"].count() == 5 and published(spark, path, 1)["a"].count() == 3
    assert json.loads(Files(spark).read(f"{path}/log/{1:020d}.json"))["epoch"] == 4


def test_model_and_evaluation_tables_are_published(spark, tmp_path):
    from test_recommend import train_rows

    train = train_rows(spark)
    vectors = spark.createDataFrame([(1, [1.0])], "user_id bigint, embedding array<double>")
    items = vectors.withColumnRenamed("user_id", "item_id")
    path = str(tmp_path / "model")
    assert artifacts.publish_model(train, spark.range(1), vectors, items, path) == 1
    assert len(published(spark, path)) == 10
    rows, protocol = spark.range(2), spark.range(1)
    assert artifacts.publish_evaluation(rows, protocol, str(tmp_path / "e")) == 1
    found = published(spark, str(tmp_path / "e"))
    assert found["metrics"].count() == 2 and "loaded_at" in found["protocol"].columns
