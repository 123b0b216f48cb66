import random

import pytest
from pyspark.sql import functions as F

from cartlark.operators.positions import dense_index, nth_key, with_position, with_previous
from cartlark.operators import split
from cartlark.operators.split import split_metadata, split_part, temporal_split


def test_positions_follow_the_order_with_hot_values_and_copies(spark):
    rng = random.Random(1)
    rows = [(7 if rng.random() < 0.4 else rng.randrange(50), rng.randrange(5)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(8)
    found = with_position(df, ["a", F.desc("b")]).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(3000))
    assert [(r["a"], r["b"]) for r in found] == sorted(rows, key=lambda r: (r[0], -r[1]))


def test_previous_crosses_run_borders(spark):
    values = random.Random(2).sample(range(100_000), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(8)
    found = {r["v"]: r["previous"] for r in with_previous(df, ["v"], "v").collect()}
    ordered = sorted(values)
    assert found == dict(zip(ordered, [None, *ordered[:-1]], strict=True))


def test_dense_index(spark):
    df = spark.createDataFrame([(5,), (-3,), (5,), (1 << 60,)], "x bigint")
    assert {r["x"]: r["index"] for r in dense_index(df, "x").collect()} == {
        -3: 0, 5: 1, 1 << 60: 2,
    }


@pytest.mark.parametrize("spread", [3, 1000, 1 << 62])
def test_nth_key_equals_sorting(spark, spread):
    rng = random.Random(3)
    rows = [
        (rng.randrange(-spread, spread), 9 if rng.random() < 0.5 else rng.randrange(4),
         rng.choice("abé") * rng.randrange(3))
        for _ in range(500)
    ]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c string")
    ordered = sorted(rows)
    for n in (1, 2, 250, 499, 500):
        assert tuple(nth_key(df, ["a", "b", "c"], n, fanout=4, leaf=3)) == ordered[n - 1]


def hourly(spark, n):
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).alias("event_time"),
        (F.col("id") % 2 + 1).alias("visitor_id"),
        F.col("id").alias("item_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.lit("view").alias("event_type"),
    )


@pytest.mark.parametrize("with_id", [True, False])
def test_split_never_moves_the_future_into_train(spark, with_id):
    events = hourly(spark, 20)
    split = temporal_split(events if with_id else events.drop("event_id"))
    train, validation, test = (
        split_part(split, part).agg(F.min("event_time"), F.max("event_time"), F.count("*")).first()
        for part in ("train", "validation", "test")
    )
    assert train[1] < validation[0] and validation[1] < test[0]
    assert [p[2] for p in (train, validation, test)] == [16, 2, 2]
    row = split_metadata(split).first()
    assert (row["train_rows"], row["train_end"], row["validation_end"]) == (16, train[1], validation[1])


def test_split_cuts_inside_one_instant(spark):
    same = hourly(spark, 50).withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    counts = {r["split"]: r["count"] for r in temporal_split(same).groupBy("split").count().collect()}
    assert counts == {"train": 40, "validation": 5, "test": 5}
    copies = same.drop("event_id").withColumns({"visitor_id": F.lit(1), "item_id": F.lit(1)})
    counts = {r["split"]: r["count"] for r in temporal_split(copies).groupBy("split").count().collect()}
    assert counts == {"train": 40, "validation": 5, "test": 5}


@pytest.mark.parametrize("rows", [1, 2, 3])
def test_tiny_splits_keep_train_non_empty(spark, rows):
    counts = {r["split"]: r["count"]
              for r in temporal_split(hourly(spark, rows)).groupBy("split").count().collect()}
    assert counts == [{"train": 1}, {"train": 1, "validation": 1},
                      {"train": 2, "validation": 1}][rows - 1]


@pytest.mark.parametrize("fractions", [(0, 0.1), (1, 0), (0.8, 0.2), (0.5, -0.1)])
def test_split_arguments(spark, fractions):
    with pytest.raises(ValueError):
        temporal_split(hourly(spark, 5), *fractions)


def test_split_of_nothing(spark):
    with pytest.raises(ValueError, match="0 rows"):
        temporal_split(hourly(spark, 0))


@pytest.mark.parametrize("n", [700, 70_000])
def test_null_times_come_last_at_every_size(spark, n):
    events = spark.range(n).select(
        F.when(F.col("id") % 20 != 7, F.timestamp_seconds(F.col("id") % 50)).alias("event_time"),
        (F.col("id") % 13).alias("visitor_id"), (F.col("id") % 7).alias("item_id"),
        F.col("id").cast("string").alias("event_id"),
    )
    parts = temporal_split(events)
    counts = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert counts == {"train": n * 8 // 10, "validation": n // 10, "test": n // 10}
    assert parts.filter("event_time is null and split = 'train'").isEmpty()
    assert parts.filter("event_time is null").count() == n // 20
    assert parts.filter("event_time is null and split = 'validation'").isEmpty()


def test_a_cut_inside_a_hot_instant(spark):
    n = 150_000  # two thirds of the rows at one instant
    events = spark.range(n).select(
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(90_000)))
        .alias("event_time"),
        (F.col("id") % 1000).alias("visitor_id"), F.lit(1).cast("bigint").alias("item_id"),
        F.col("id").cast("string").alias("event_id"),
    )
    parts = temporal_split(events, 0.5, 0.25)
    counts = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert counts == {"train": n // 2, "validation": n // 4, "test": n // 4}
    order = F.struct("event_time", "visitor_id", "item_id", "event_id")
    ends = parts.groupBy("split").agg(F.min(order).alias("low"), F.max(order).alias("high"))
    ends = {r["split"]: r for r in ends.collect()}
    assert ends["train"]["high"] < ends["validation"]["low"]
    assert ends["validation"]["high"] < ends["test"]["low"]


def test_time_limits_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(10).select(F.timestamp_seconds("id").alias("event_time")).write.parquet(path)
    narrowed = spark.read.parquet(path).filter(split._within(0, split.MINUTE))
    plan = narrowed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan


@pytest.mark.parametrize(("rows", "fractions", "ends"), [
    (100, (0.29, 0.0), (29, 30)), (1, (0.8, 0.1), (1, 1)), (2, (0.1, 0.1), (1, 2)),
    (10, (0.7, 0.2), (7, 9)),
])
def test_sizes_round_down_exactly(rows, fractions, ends):
    sizes = split.split_sizes(rows, *fractions)
    assert (sizes.train_end, sizes.validation_end) == ends
