"""Steps that several queries need are taken once, and over no wider rows than they look at."""

import pytest
from pyspark.sql import functions as F
from test_heavy import BOUNDS, hot_rows

from cartlark.operators import heavy, ranking
from cartlark.operators.asof import asof_join
from cartlark.operators.normalize import unchecked_number
from cartlark.operators.sessions import with_sessions
from cartlark.plans import etl, recommend
from workload import queries, tables

SF = "/root/testdata/sf0.001"


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("bound", BOUNDS)
def test_counting_more_rows_changes_nothing(spark, bound):
    rows = spark.createDataFrame(hot_rows(5, 300, 10_000_000), "visitorid bigint, timestamp bigint")
    told = spark.createDataFrame(hot_rows(6, 90, 10_000_000), "visitorid bigint, timestamp bigint")
    told = told.withColumn("value", F.col("timestamp") % 7)
    more = rows.select("visitorid").unionByName(told.select("visitorid")).unionByName(
        spark.sql("select if(id < 100, null, id % 4) as visitorid from range(400)")
    )
    by = {"key": "visitorid", "time": "timestamp", "value": "value", "broadcast_rows": 0}
    assert same(
        asof_join(rows, told, **by, light_rows=bound, counted=more), asof_join(rows, told, **by)
    )
    assert same(
        with_sessions(rows, light_rows=bound, counted=more), with_sessions(rows)
    )


def test_heavy_keys_are_counted_in_unchecked_rows(spark, monkeypatch):
    plans = []

    def noted(df, key, *bound):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return heavy.heavy_keys(df, key, *bound)

    monkeypatch.setattr("cartlark.operators.asof.heavy_keys", noted)
    monkeypatch.setattr("cartlark.operators.asof._fits_broadcast", lambda *_: False)
    monkeypatch.setattr("cartlark.operators.sessions.heavy_keys", noted)
    etl.build_clean_events(tables.shopper_events(spark, SF), tables.shopper_properties(spark, SF))
    assert len(plans) == 2 and not any("purchase" in plan or "RLIKE" in plan for plan in plans)


def test_unchecked_numbers_are_those_of_the_rows(spark):
    raw = spark.createDataFrame([(" 7 ",), ("7",), ("x",), (None,)], "itemid string")
    assert [r[0] for r in unchecked_number(raw, "itemid").collect()] == [7, 7, None, None]


def test_lists_at_hand_are_used_for_users_without_a_vector(spark, monkeypatch):
    users = spark.range(6).select(F.col("id").alias("user_id"))
    vectors = spark.sql("select id as user_id, array(1D, id * 1D) as embedding from range(2)")
    items = spark.sql("select id as item_id, array(id * 1D, 1D) as embedding from range(5)")
    ranked = spark.sql("select id as item_id, 9D - id as score, id as popularity_rank from range(5)")
    seen = spark.createDataFrame([(3, 0), (3, 2), (4, 4), (5, 1)], "user_id bigint, item_id bigint")
    alone = recommend.recommend(users, vectors, items, ranked, seen, 2)
    lists = ranking.popularity_top_k(users, ranked, seen, 2).persist()
    expected = alone.collect()
    assert [r["item_id"] for r in sorted(expected, key=lambda r: (r["user_id"], r["rank"]))
            if r["user_id"] > 2] == [1, 3, 0, 1, 0, 2]

    def again(*_):
        raise AssertionError("made again")

    monkeypatch.setattr(recommend, "popularity_top_k", again)
    found = recommend.recommend(users, vectors, items, ranked, seen, 2, popular=lists).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))


def test_evaluation_ranks_popular_items_once(spark, monkeypatch):
    calls = []

    def counted(*arguments, **options):
        calls.append(1)
        return popularity_top_k(*arguments, **options)

    popularity_top_k = ranking.popularity_top_k
    monkeypatch.setattr(tables, "_stored", {})
    monkeypatch.setattr(ranking, "popularity_top_k", counted)
    monkeypatch.setattr(recommend, "popularity_top_k", counted)
    queries.QUERIES["selected_metric"](spark, SF)
    assert len(calls) == 1
    assert "Join" not in queries._user_vectors(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
