import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlark.functions.contract import RAW_EVENT_SCHEMA
from cartlark.operators.asof import asof_join, validity_intervals
from cartlark.operators.sessions import with_sessions
from cartlark.plans.analytics import (
    calendar,
    daily_trend,
    event_ratio_trend,
    funnel_daily,
    funnel_stages,
    kpis,
    user_activity,
)
from cartlark.plans.interactions import load_interactions
from cartlark.sources.files import read_clean_events
from cartlark.plans.etl import build_clean_events, compact_clean_events, run_batch_etl


def hot_points(seed, n, times):
    """Rows of which about a third belong to key one, with many equal times."""
    rng = random.Random(seed)
    return [(1 if rng.random() < 0.34 else rng.randrange(2, 12), rng.randrange(times))
            for _ in range(n)]


@pytest.mark.parametrize(
    "how",
    [{"broadcast_rows": 0, "bucket_width": w} for w in (1, 7, 50, 10_000)]
    + [{"broadcast_rows_per_key": 5}, {}],
)
def test_asof_join_is_the_latest_observation(spark, how):
    events = hot_points(1, 400, 300)
    observed = {}
    rng = random.Random(2)
    for key, time in hot_points(3, 120, 300):
        observed[key, time] = max(observed.get((key, time), -1), rng.randrange(100))
    rows = spark.createDataFrame(
        [(i, k, t) for i, (k, t) in enumerate(events)], "id int, k bigint, t bigint"
    )
    repeated = [(k, t, v) for (k, t), v in observed.items()]
    repeated += [(k, t, v - 1) for k, t, v in repeated[:20]]
    obs = spark.createDataFrame(repeated, "k bigint, t bigint, v bigint")
    found = {
        r["id"]: r["v"]
        for r in asof_join(rows, obs, key="k", time="t", value="v", **how).collect()
    }
    expected = {}
    for i, (k, t) in enumerate(events):
        past = [(ot, v) for (ok, ot), v in observed.items() if ok == k and ot <= t]
        expected[i] = max(past)[1] if past else None
    assert found == expected


def test_asof_join_without_observations(spark):
    rows = spark.createDataFrame([(1, 5)], "k bigint, t bigint")
    obs = spark.createDataFrame([], "k bigint, t bigint, v bigint")
    for limit in (0, 10):
        found = asof_join(rows, obs, key="k", time="t", value="v", broadcast_rows=limit)
        assert found.first()["v"] is None


def test_many_observations_of_one_key_are_not_broadcast(spark):
    rows = spark.createDataFrame([(1, 5)], "k bigint, t bigint")
    obs = spark.range(65).selectExpr("1L as k", "id as t", "id as v")

    def plan(df):
        joined = asof_join(rows, df, key="k", time="t", value="v")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" not in plan(obs)
    assert "strategy=broadcast" in plan(obs.limit(64))


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_validity_intervals(spark, width):
    times = sorted({t for _, t in hot_points(5, 60, 200)})
    obs = spark.createDataFrame([(1, t, t * 2) for t in times], "k bigint, t bigint, v bigint")
    found = validity_intervals(obs, key="k", time="t", bucket_width=width).orderBy("valid_from_ms")
    assert [(r["valid_from_ms"], r["valid_to_ms"]) for r in found.collect()] == list(
        zip(times, [*times[1:], None], strict=True)
    )


def minute(n):
    return n * 60_000


def test_gap_must_be_longer_than_the_limit(spark):
    times = [0, minute(30), minute(60) + 1, minute(60) + 1, minute(200)]
    rows = spark.createDataFrame([(7, t) for t in times], "visitorid bigint, timestamp bigint")
    found = with_sessions(rows).orderBy("timestamp").collect()
    assert [r["session_number"] for r in found] == [1, 1, 2, 2, 3]
    assert found[0]["session_id"] == "7-1"


def test_sessions_agree_with_session_window(spark):
    rng = random.Random(4)
    rows = [(1 if rng.random() < 0.4 else rng.randrange(2, 9), rng.randrange(minute(3000)))
            for _ in range(500)]
    events = spark.createDataFrame(rows, "visitorid bigint, timestamp bigint")
    ours = with_sessions(events).select("session_id").distinct().count()
    theirs = (
        events.withColumn("t", F.timestamp_millis("timestamp"))
        .groupBy("visitorid", F.session_window("t", "30 minutes")).count().count()
    )
    assert ours == theirs
    in_order = Window.partitionBy("visitorid").orderBy("timestamp")
    steps = with_sessions(events).withColumn(
        "step", F.col("session_number") - F.lag("session_number").over(in_order)
    )
    assert {r["step"] for r in steps.select("step").distinct().collect()} == {None, 0, 1}


def test_session_gap_must_not_be_negative(spark):
    rows = spark.createDataFrame([(1, 1)], "visitorid bigint, timestamp bigint")
    with pytest.raises(ValueError):
        with_sessions(rows, gap_minutes=-1)


EVENTS_CSV = """timestamp,visitorid,event,itemid,transactionid
1440900000999,1,view,10,
1440900000999,1,view,10,
1440900100000,1,transaction,10,5
1440990000000,2,addtocart,11,
-5,2,view,11,
1440990000000,2,refund,11,
"""
PROPERTIES_CSV = """timestamp,itemid,property,value
1440900050000,10,categoryid,77
1440900000000,10,categoryid,76
1440900000000,10,categoryid,75
1440900050001,10,categoryid,n99
1440900050001,10,categoryid,99999999999999999999
1440900050001,10,available,1
"""


def test_batch_etl_from_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text(EVENTS_CSV)
    (tmp_path / "p.csv").write_text(PROPERTIES_CSV)
    out = str(tmp_path / "clean")
    clean = run_batch_etl(spark, str(tmp_path / "e.csv"), [str(tmp_path / "p.csv")], out)
    rows = {(r["visitor_id"], r["source_timestamp_ms"]): r for r in clean.collect()}
    assert len(rows) == 3
    first = rows[1, 1440900000999]
    assert (first["category_id"], first["session_id"], first["hour"]) == (76, "1-1", 2)
    assert first["event_time"].microsecond == 999_000
    assert first["day_of_week"] == 1  # a Sunday
    assert rows[1, 1440900100000]["category_id"] == 77
    assert rows[2, 1440990000000]["category_id"] is None
    assert sorted(p.name for p in (tmp_path / "clean").glob("event_date=*")) == [
        "event_date=2015-08-30", "event_date=2015-08-31",
    ]


def test_compaction_leaves_one_file_per_small_date(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "date_add(date'2024-01-01', cast(id % 2 as int)) event_date")
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    rows.repartition(8).write.partitionBy("event_date").parquet(source)
    compact_clean_events(spark, source, target)
    assert len(list((tmp_path / "many").rglob("*.parquet"))) == 16
    assert len(list((tmp_path / "few").rglob("*.parquet"))) == 2
    assert spark.read.parquet(target).count() == 100


def test_plans_have_no_cross_join_and_no_window_over_everything(spark):
    raw = spark.createDataFrame([(1, 1, "view", 1, None)], RAW_EVENT_SCHEMA)
    properties = spark.createDataFrame(
        [], "timestamp bigint, itemid bigint, property string, value string"
    )
    plan = build_clean_events(raw, properties)._jdf.queryExecution().executedPlan().toString()
    for bad in ("SinglePartition", "CartesianProduct", "NestedLoop"):
        assert bad not in plan


def events(spark, *rows):
    return spark.createDataFrame(
        rows, "day string, visitor_id bigint, item_id bigint, event_type string, category_id bigint"
    ).withColumn("event_time", F.to_timestamp("day"))


def test_funnel_counts_distinct_users_and_keeps_zero_denominators_blank(spark):
    table = events(
        spark,
        ("2024-01-01", 1, 1, "view", None), ("2024-01-01", 1, 2, "view", None),
        ("2024-01-01", 2, 1, "view", None), ("2024-01-01", 2, 1, "addtocart", None),
        ("2024-01-03", 3, 1, "transaction", None),
    )
    first, third = funnel_daily(table).orderBy("metric_date").collect()
    assert (first["view_users"], first["cart_users"], first["purchase_users"]) == (2, 1, 0)
    assert (first["view_to_cart_user_rate"], first["cart_to_purchase_user_rate"]) == (0.5, 0.0)
    assert third["view_to_purchase_user_rate"] is None
    stages = [(r["stage_order"], r["stage"], r["users"]) for r in funnel_stages(table).collect()]
    assert stages == [(1, "1. View users", 2), (2, "2. Cart users", 1), (3, "3. Purchase users", 1)]
    assert [r["total_events"] for r in daily_trend(table).orderBy("calendar_date").collect()] == [
        4, None, 1,
    ]
    ratios = event_ratio_trend(table).orderBy("calendar_date").collect()
    assert [r["view_to_cart_event_ratio"] for r in ratios] == [0.333333, None, None]


def test_activity_bucket_edges(spark):
    sizes = [1, 2, 5, 6, 10, 11, 25, 26, 50, 51]
    rows = [("2024-01-01", v, 1, "view", None) for v, n in enumerate(sizes) for _ in range(n)]
    found = user_activity(events(spark, *rows)).orderBy("bucket_order").collect()
    assert [(r["activity_bucket"], r["user_count"]) for r in found] == [
        ("1 event", 1), ("2-5 events", 2), ("6-10 events", 2), ("11-25 events", 2),
        ("26-50 events", 2), ("51+ events", 1),
    ]


def test_calendar_week_starts_on_monday(spark):
    table = events(spark, ("2024-01-06", 1, 1, "view", None), ("2024-01-08", 1, 1, "view", None))
    days = calendar(table).orderBy("calendar_date").collect()
    assert [(r["day_of_week"], r["day_of_week_number"]) for r in days] == [
        ("Saturday", 6), ("Sunday", 7), ("Monday", 1),
    ]


def test_empty_table(spark):
    table = events(spark).filter("false")
    assert calendar(table).isEmpty()
    assert [r["users"] for r in funnel_stages(table).collect()] == [0, 0, 0]
    assert kpis(table).first()["total_events"] == 0


def test_clean_events_are_read_back_from_csv_and_parquet(spark, tmp_path):
    rows = events(spark, ("2024-01-01", 1, 2, "view", 7), ("2024-01-02", 1, 2, "view", None))
    rows.write.parquet(str(tmp_path / "clean"))
    (tmp_path / "clean.csv").write_text(
        "visitor_id,item_id,event_type,event_time,category_id\n"
        "1,2,VIEW,2024-01-01 00:00:00+00:00,7.0\n1,2,view,2024-01-02 00:00:00+00:00,\n"
    )
    found = [
        sorted(
            (str(r["event_time"]), r["visitor_id"], r["category_id"], r["event_type"])
            for r in load_interactions(read_clean_events(spark, str(tmp_path / name))).collect()
        )
        for name in ("clean", "clean.csv")
    ]
    assert found[0] == found[1] and [r[2] for r in found[0]] == [7, -1]
    (tmp_path / "bad.csv").write_text("visitor_id,item_id\n1,2\n")
    with pytest.raises(ValueError, match="event_time, event_type"):
        read_clean_events(spark, str(tmp_path / "bad.csv"))


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_trends_scan_the_facts_once(spark, tmp_path):
    from cartlark.plans import analytics

    path = str(tmp_path / "facts")
    spark.createDataFrame(
        [(1_700_000_000_000 + 86_400_000 * d, "view") for d in (0, 0, 3)], "ms bigint, event_type string"
    ).select(F.timestamp_millis("ms").alias("event_time"), "event_type").write.parquet(path)
    facts = spark.read.parquet(path)
    trend = analytics.daily_trend(facts)
    assert scans(trend) == 1 and scans(analytics.event_ratio_trend(facts)) == 1
    rows = trend.orderBy("calendar_date").collect()
    assert [r["total_events"] for r in rows] == [2, None, None, 1]
    assert analytics.daily_trend(facts.filter("false")).isEmpty()
