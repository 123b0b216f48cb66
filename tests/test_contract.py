import hashlib
import json

import pytest

from cartlark.functions.contract import RAW_EVENT_SCHEMA
from cartlark.operators.normalize import (
    dedup_events,
    normalize_events,
    rejected_events,
    to_contract,
    with_event_id,
)
from cartlark.plans.analytics import constraint_audit
from cartlark.plans.replay import replay_delays
from cartlark.sources.files import (
    read_events_csv,
    read_events_csv_text,
    read_item_properties_csv,
    require_columns,
)
from cartlark.sources.kafka import to_json_lines, to_kafka_records, write_json_lines

TEXT = "timestamp string, visitorid string, event string, itemid string, transactionid string"
SAMPLE = """timestamp,visitorid,event,itemid,transactionid
1710000000500,31,view,7,
1710000060000,32,addtocart,8,
1710000060000,32,transaction,8,T-4
1710003600000,31,view,9,
"""


def text_rows(spark, *rows):
    return spark.createDataFrame(rows, TEXT)


def test_event_id_is_the_digest_of_the_five_fields(spark):
    rows = text_rows(
        spark,
        ("1710000000000", "31", "view", "7", ""),
        ("5", "7", "transaction", "9", "é|x"),
    )
    found = {r["event_id"] for r in with_event_id(normalize_events(rows)).collect()}
    expected = {
        hashlib.sha256(text.encode()).hexdigest()
        for text in ("1710000000000|31|view|7|", "5|7|transaction|9|é|x")
    }
    assert found == expected


def test_normalisation_trims_lowers_and_blanks(spark):
    row = normalize_events(text_rows(spark, (" 10 ", "1", "  VIEW ", " 2", "   "))).first()
    assert row.asDict() == {
        "timestamp": 10, "visitorid": 1, "event": "view", "itemid": 2, "transactionid": None,
    }


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        (("", "1", "view", "2", None), "timestamp:blank"),
        (("1", None, "view", "2", None), "visitorid:blank"),
        (("1", "x", "view", "2", None), "visitorid:not_whole"),
        (("1", "1", "view", "2.5", None), "itemid:not_whole"),
        (("1", "1", "view", "9" * 20, None), "itemid:not_whole"),
        (("-1", "x", "view", "2", None), "timestamp:below_zero"),
        (("253402300800000", "1", "view", "2", None), "timestamp:out_of_range"),
        (("9300000000000000", "1", "refund", "2", None), "timestamp:out_of_range"),
        (("1", "1", "refund", "2", None), "event:unsupported"),
        (("1", "1", None, "2", None), "event:unsupported"),
    ],
)
def test_rejected_rows_carry_the_first_broken_rule(spark, row, reason):
    rows = text_rows(spark, row)
    assert [r["reason"] for r in rejected_events(rows).collect()] == [reason]
    assert normalize_events(rows).isEmpty()


def test_every_row_is_accepted_or_rejected(spark):
    rows = text_rows(
        spark, ("1", "1", "view", "2", None), ("x", "1", "view", "2", None),
        (None, None, None, None, None),
    )
    assert normalize_events(rows).count() + rejected_events(rows).count() == 3


def test_contract_json(spark):
    rows = text_rows(
        spark, ("1710000000000", "31", "view", "7", ""),
        ("1710000000123", "31", "transaction", "7", "9"),
    )
    texts = [r["value"] for r in to_json_lines(to_contract(normalize_events(rows))).collect()]
    whole, fraction = sorted((json.loads(t) for t in texts), key=lambda p: p["source_timestamp_ms"])
    assert whole["schema_version"] == 1
    assert whole["occurred_at"] == "2024-03-09T16:00:00+00:00"
    assert whole["transaction_id"] is None
    assert fraction["occurred_at"] == "2024-03-09T16:00:00.123000+00:00"
    for text in texts:
        assert text == json.dumps(json.loads(text), separators=(",", ":"), sort_keys=True)


def test_kafka_record_shape(spark):
    rows = text_rows(spark, ("1", "77", "view", "2", None))
    record = to_kafka_records(to_contract(normalize_events(rows))).first()
    assert bytes(record["key"]) == b"77"
    assert json.loads(bytes(record["value"]))["visitor_id"] == 77
    assert [(h["key"], bytes(h["value"])) for h in record["headers"]] == [("schema_version", b"1")]


def test_csv_round_trip_and_dedup(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(SAMPLE + "1710000000500,31,view,7,\nbroken,1,view,2,\n")
    typed = read_events_csv(spark, str(path))
    assert typed.filter("timestamp is null").count() == 1
    assert dedup_events(normalize_events(typed)).count() == 4
    text = read_events_csv_text(spark, str(path))
    assert [r["reason"] for r in rejected_events(text).collect()] == [
        "timestamp:not_whole"
    ]


def test_json_lines_sink(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(SAMPLE)
    out = str(tmp_path / "lines")
    write_json_lines(to_contract(normalize_events(read_events_csv(spark, str(path)))), out)
    assert spark.read.json(out).count() == 4


def test_property_csv_reads_all_parts(spark, tmp_path):
    for part in (1, 2):
        (tmp_path / f"p{part}.csv").write_text(
            f"timestamp,itemid,property,value\n{part},7,categoryid,{part}0\n"
        )
    paths = [str(tmp_path / f"p{part}.csv") for part in (1, 2)]
    assert {r["value"] for r in read_item_properties_csv(spark, paths).collect()} == {"10", "20"}


def test_missing_columns_are_named_in_order(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("visitorid,event\n1,view\n")
    with pytest.raises(ValueError, match="missing columns: itemid, timestamp"):
        read_events_csv_text(spark, str(path))
    with pytest.raises(ValueError, match="missing columns: b, c"):
        require_columns(spark.createDataFrame([(1,)], "a int"), ["c", "b", "a"])


def test_replay_order_and_delays(spark):
    rows = spark.createDataFrame(
        [
            (2000, 1, "view", 10, None), (1000, 1, "view", 11, None), (2000, 2, "view", 10, None),
            (9000, 1, "view", 12, None), (2000, 1, "view", 10, None),
        ],
        RAW_EVENT_SCHEMA,
    )
    delays = replay_delays(to_contract(rows), speed=2.0, max_delay_seconds=1.5)
    ordered = delays.orderBy("source_timestamp_ms", "event_id", "delay_seconds").collect()
    assert ordered[0]["item_id"] == 11 and ordered[0]["delay_seconds"] == 0.0
    by_time = {}
    for row in ordered:
        by_time.setdefault(row["source_timestamp_ms"], []).append(row["delay_seconds"])
    # One row of an instant waits for the gap; its equals, copies included, do not wait.
    assert {t: sorted(d) for t, d in by_time.items()} == {
        1000: [0.0], 2000: [0.0, 0.0, 0.5], 9000: [1.5],
    }


@pytest.mark.parametrize(("speed", "cap"), [(0, 1), (-1, 1), (1, -1)])
def test_replay_arguments(spark, speed, cap):
    with pytest.raises(ValueError):
        replay_delays(spark.createDataFrame([], "source_timestamp_ms bigint, event_id string"),
                      speed, cap)


def test_constraint_audit_finds_planted_violations(spark):
    good = "a" * 64
    rows = [
        (good, 1, 1, 1, "view"), (good, 1, 1, 1, "view"), ("XYZ", -1, 1, 1, "view"),
        ("b" * 64, 1, None, -5, "refund"),
    ]
    events = spark.createDataFrame(
        rows,
        "event_id string, source_timestamp_ms bigint, visitor_id bigint, item_id bigint, "
        "event_type string",
    ).selectExpr("*", "timestamp_millis(source_timestamp_ms) as event_time")
    found = {r["rule"]: r["violations"] for r in constraint_audit(events).collect()}
    broken = {rule: n for rule, n in found.items() if n}
    assert broken == {
        "event_id unique": 1, "event_id pattern": 1, "event_type supported": 1,
        "visitor_id not null": 1, "source_timestamp_ms non-negative": 1, "item_id non-negative": 1,
    }
