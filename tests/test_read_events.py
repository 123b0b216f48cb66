"""Raw columns are read once, however many steps go over the rows."""

import pytest
from pyspark.sql import functions as F

from cartlark.operators.normalize import normalize_events, rejected_events
from cartlark.plans.etl import build_clean_events, store_clean_events
from workload import queries, tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("mapped", [tables.shopper_events, tables.shopper_properties, tables.build_clean])
def test_json_and_instants_are_not_read_again(spark, mapped):
    assert "get_json_object" not in plan(mapped(spark, SF))


def test_stored_rows_are_the_events(spark):
    raw = tables.table(spark, SF, "events")
    direct = raw.select(
        "event_id", F.expr("user_id * 6 + floor(hour(cast(ts as timestamp)) / 4)").alias("v"),
        F.expr("cast(get_json_object(props, '$.k') as bigint) + 100 * floor(value / 10)").alias("i"),
    )
    read = tables.shopper_events(spark, SF).select("seq", "visitorid", "itemid")
    assert read.count() == raw.count()
    assert read.exceptAll(direct).isEmpty() and direct.exceptAll(read).isEmpty()


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    rows = spark.range(200_000, numPartitions=1).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01' as ts", "id as user_id",
        "'view' as event_type", "1.0D as value", "concat('{\"k\": ', id % 9, '}') as props",
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    read = tables.event_rows(spark, str(tmp_path))
    sizes = [r["count"] for r in read.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 200_000 and len(sizes) > 1


def test_audits_do_not_read_json_of_events_again(spark):
    assert "get_json_object" not in plan(queries.table_audits(spark, SF))


def test_a_field_is_checked_once(spark):
    raw = tables.raw_events(spark, SF)
    # Once to check it and once to return it.
    assert plan(normalize_events(raw)).count("get_json_object") <= 2


def test_every_row_is_either_kept_or_rejected(spark):
    numbers = [None, "", " ", "x", "1.5", "-1", "+0", " 7 ", "253402300799999", "253402300800000",
               "9223372036854775808"]
    rows = [(t, v, e, i, "") for t in numbers for v in numbers for i in numbers
            for e in (None, " VIEW ", "click")]
    raw = spark.createDataFrame(
        rows, "timestamp string, visitorid string, event string, itemid string, transactionid string"
    )
    kept, rejected = normalize_events(raw), rejected_events(raw)
    assert kept.count() + rejected.count() == len(rows)
    good = {"+0", " 7 ", "253402300799999"}
    wide = good | {"253402300800000"}
    assert kept.count() == sum(
        t in good and v in wide and i in wide and e == " VIEW " for t, v, e, i, _ in rows
    )


def test_stored_clean_events_are_the_built_ones(spark, tmp_path):
    source = tables.stored_raw(spark, SF)
    built = build_clean_events(*source)
    store_clean_events(*source, str(tmp_path / "clean"))
    found = spark.read.parquet(str(tmp_path / "clean")).select(*built.columns)
    assert built.exceptAll(found).isEmpty() and found.exceptAll(built).isEmpty()
