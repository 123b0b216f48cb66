"""Stored results kept up to date load by load, against building them at once."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartlark.operators.asof import extend_intervals, interval_changes, validity_intervals
from cartlark.operators.positions import dense_index, index_entries
from cartlark.operators.sessions import continue_sessions, open_sessions, with_sessions
from cartlark.plans import analytics, audience
from cartlark.plans.interactions import grown_vocabulary, vocabulary
from cartlark.session import materialize

OBSERVED = "k bigint, t bigint, v bigint"
EVENT = "event_id bigint, visitorid bigint, timestamp bigint"
CLEAN = "event_time timestamp, visitor_id bigint, item_id bigint, event_type string"


def ids(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def texts(df, *columns):
    """Rows in an order that nulls do not upset."""
    return sorted(map(str, df.select(*columns).collect()))


# --- dictionaries ---------------------------------------------------------------------


def test_old_indices_stay_and_new_values_follow_in_order(spark):
    first = spark.createDataFrame([("m",), ("c",), ("c",)], "name string")
    held = dense_index(first, "name")
    later = spark.createDataFrame([("z",), ("m",), (None,), ("a",), ("a",)], "name string")
    grown = held.unionByName(index_entries(held, later, "name"))
    assert ids(grown, "name", "index") == [("a", 2), ("c", 0), ("m", 1), ("z", 3)]
    assert index_entries(grown, first.union(later), "name").isEmpty()


def test_a_dictionary_grows_from_nothing_and_by_nothing(spark):
    none = spark.createDataFrame([], "name string, index bigint")
    rows = spark.createDataFrame([("b",), ("a",)], "name string")
    assert ids(index_entries(none, rows, "name"), "name", "index") == [("a", 0), ("b", 1)]
    assert index_entries(none, rows.limit(0), "name").isEmpty()
    assert dict(index_entries(none, rows, "name").dtypes) == dict(none.dtypes)


# --- validity intervals -----------------------------------------------------------------


def observations(seed, n, times):
    rng = random.Random(seed)
    return [(1 if rng.random() < 0.34 else rng.randrange(2, 9), rng.randrange(times),
             rng.randrange(50)) for _ in range(n)]


def at_once(spark, rows, width):
    frame = spark.createDataFrame(rows, OBSERVED).groupBy("k", "t").agg(F.max("v").alias("v"))
    return validity_intervals(frame, key="k", time="t", bucket_width=width)


@pytest.mark.parametrize("seed, width", [(1, 1), (2, 7), (3, 1_000)])
def test_intervals_do_not_depend_on_the_order_of_arrival(spark, seed, width):
    rows = observations(seed, 240, 200)
    columns = ("k", "valid_from_ms", "valid_to_ms", "v")
    held = at_once(spark, rows[:80], width)
    for load in (rows[80:90], rows[60:170], rows[170:]):  # repeats some rows of the first
        held = materialize(extend_intervals(
            held, spark.createDataFrame(load, OBSERVED), key="k", time="t", value="v",
            bucket_width=width,
        ))
    expected = at_once(spark, rows, width)
    assert texts(held, *columns) == texts(expected, *columns)


def test_only_intervals_that_hold_an_observation_are_replaced(spark):
    held = at_once(spark, [(1, t, t) for t in range(0, 1_000, 10)] + [(2, 5, 5)], 100)
    new = spark.createDataFrame([(1, 255, 7), (1, 257, 8), (1, 990, 1_000), (3, 4, 4)], OBSERVED)
    outdated, current = interval_changes(held, new, key="k", time="t", value="v")
    assert ids(outdated, "k", "valid_from_ms") == [(1, 250), (1, 990)]
    found = {(r["k"], r["valid_from_ms"]): (r["valid_to_ms"], r["v"]) for r in current.collect()}
    assert found == {
        (1, 250): (255, 250), (1, 255): (257, 7), (1, 257): (260, 8),
        (1, 990): (None, 1_000), (3, 4): (None, 4),
    }


def test_an_observation_before_all_others_ends_at_the_first(spark):
    held = at_once(spark, [(1, 50, 5), (1, 90, 9)], 10)
    new = spark.createDataFrame([(1, 3, 0), (1, 8, 1)], OBSERVED)
    outdated, current = interval_changes(held, new, key="k", time="t", value="v")
    assert outdated.isEmpty()
    assert ids(current, "valid_from_ms", "valid_to_ms", "v") == [(3, 8, 0), (8, 50, 1)]


def test_intervals_without_held_or_new_rows(spark):
    rows = spark.createDataFrame([(1, 5, 5), (1, 2, 2)], OBSERVED)
    built = at_once(spark, [(1, 5, 5), (1, 2, 2)], 10)
    columns = {"key": "k", "time": "t", "value": "v"}
    grown = extend_intervals(built.limit(0), rows, **columns)
    assert texts(grown, *built.columns) == texts(built, *built.columns)
    same = extend_intervals(built, rows.limit(0), **columns)
    assert texts(same, *built.columns) == texts(built, *built.columns)


# --- sessions -----------------------------------------------------------------------------


def visits(seed, n):
    rng = random.Random(seed)
    day = 86_400_000
    return [(i, 1 if rng.random() < 0.34 else rng.randrange(2, 12),
             rng.randrange(3) * day + rng.randrange(0, day, 400_000) + rng.choice((0, 1)))
            for i in range(n)]


def by_loads(spark, loads):
    held = materialize(with_sessions(spark.createDataFrame(loads[0], EVENT)))
    still_open = open_sessions(held)
    for load in loads[1:]:
        arrived = materialize(
            continue_sessions(spark.createDataFrame(load, EVENT), held, still_open)
        )
        still_open = materialize(open_sessions(arrived, still_open))
        held = materialize(held.join(arrived, "event_id", "left_anti").unionByName(arrived))
    return held


@pytest.mark.parametrize("order", ["in time", "mixed"])
def test_sessions_by_loads_equal_sessions_at_once(spark, order):
    rows = visits(5, 300)
    rows.sort(key=lambda row: row[2] if order == "in time" else row[0])
    loads = [rows[:90], rows[90:95], rows[95:220], rows[220:]]
    expected = with_sessions(spark.createDataFrame(rows, EVENT))
    columns = ("event_id", "session_number", "session_id")
    assert ids(by_loads(spark, loads), *columns) == ids(expected, *columns)


def test_an_open_session_goes_on_at_the_gap_and_ends_beyond_it(spark):
    gap = 30 * 60_000
    held = with_sessions(spark.createDataFrame([(1, 7, 0), (2, 8, 0), (3, 9, 0)], EVENT))
    load = [(4, 7, gap), (5, 8, gap + 1), (6, 5, 3), (7, 9, 0)]
    found = continue_sessions(spark.createDataFrame(load, EVENT), held, open_sessions(held))
    assert ids(found, "event_id", "session_id") == [(4, "7-1"), (5, "8-2"), (6, "5-1"), (7, "9-1")]


def test_a_late_event_joins_two_sessions_of_its_visitor(spark):
    gap = 30 * 60_000
    held = with_sessions(spark.createDataFrame([(1, 7, 0), (2, 7, 2 * gap), (3, 8, 0)], EVENT))
    assert ids(held, "event_id", "session_id") == [(1, "7-1"), (2, "7-2"), (3, "8-1")]
    load = spark.createDataFrame([(4, 7, gap), (5, 8, 9 * gap)], EVENT)
    found = continue_sessions(load, held, open_sessions(held))
    # Visitor 7 is returned as a whole, visitor 8 by its new row.
    assert ids(found, "event_id", "session_id") == [(1, "7-1"), (2, "7-1"), (4, "7-1"), (5, "8-2")]


def test_sessions_of_an_empty_load_and_on_an_empty_table(spark):
    rows = spark.createDataFrame([(1, 7, 0)], EVENT)
    held = with_sessions(rows)
    assert continue_sessions(rows.limit(0), held, open_sessions(held)).isEmpty()
    nothing = materialize(held.limit(0))
    found = continue_sessions(rows, nothing, open_sessions(nothing))
    assert ids(found, "event_id", "session_id") == [(1, "7-1")]


# --- bitmaps --------------------------------------------------------------------------------


def clean_rows(seed, n):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    return [(start + dt.timedelta(minutes=rng.randrange(6 * 1_440)),
             1 if rng.random() < 0.34 else rng.randrange(80_000), rng.randrange(300),
             rng.choice(("view", "view", "addtocart", "transaction"))) for _ in range(n)]


def ids_as_they_are(spark, n, key, index):
    return spark.range(n).select(F.col("id").alias(key), F.col("id").alias(index))


SLICES = (
    {}, {"hours": [9, 10, 23]},
    {"date_from": dt.date(2024, 1, 2), "date_to": dt.date(2024, 1, 4)},
    {"date_from": dt.date(2024, 1, 3), "hours": [0]}, {"date_from": dt.date(2025, 1, 1)},
)


def test_bitmaps_of_any_slice_equal_the_facts(spark):
    """Ids run over three buckets; the second load is appended, with new users."""
    rows = clean_rows(3, 2_000)
    edges = [(rows[0][0], user, 1, "view") for user in (0, 32_767, 32_768, 32_769, 65_536)]
    rows += edges
    facts = spark.createDataFrame(rows, CLEAN)
    users = ids_as_they_are(spark, 80_000, "visitor_id", "user_index")
    items = ids_as_they_are(spark, 300, "item_id", "item_index")
    loads = [spark.createDataFrame(part, CLEAN) for part in (rows[:700], rows[700:])]
    first, second = (audience.member_bitmaps(load, users, items) for load in loads)
    table = materialize(first.unionByName(second))
    for cut in SLICES:
        part, few = (analytics.slice_events(df, **cut) for df in (facts, table))
        assert audience.kpis(few).first() == analytics.kpis(part).first(), cut
        assert ids(audience.funnel_stages(few), "stage_order", "stage", "users") == ids(
            analytics.funnel_stages(part), "stage_order", "stage", "users"
        ), cut


def test_bitmaps_by_growing_dictionaries(spark):
    rows = clean_rows(4, 600)
    first, second = (spark.createDataFrame(part, CLEAN) for part in (rows[:200], rows[200:]))
    old = [
        vocabulary(first, "visitor_id", "user_index"), vocabulary(first, "item_id", "item_index")
    ]
    new = [grown_vocabulary(held, second, *held.columns) for held in old]
    table = audience.member_bitmaps(first, *old).unionByName(audience.member_bitmaps(second, *new))
    facts = spark.createDataFrame(rows, CLEAN)
    assert audience.kpis(table).first() == analytics.kpis(facts).first()


def test_bitmaps_refuse_unknown_ids_and_count_events_without_one(spark):
    noon = dt.datetime(2024, 1, 1, 12, tzinfo=dt.UTC)
    users = ids_as_they_are(spark, 3, "visitor_id", "user_index")
    items = ids_as_they_are(spark, 3, "item_id", "item_index")
    unknown = spark.createDataFrame([(noon, 9, 1, "view")], CLEAN)
    with pytest.raises(PySparkException, match="no user_index for visitor_id 9"):
        audience.member_bitmaps(unknown, users, items).collect()
    nameless = spark.createDataFrame([(noon, None, 1, "view"), (noon, 2, 1, "view")], CLEAN)
    found = audience.kpis(audience.member_bitmaps(nameless, users, items)).first()
    assert found.asDict() == analytics.kpis(nameless).first().asDict()
    assert (found["total_events"], found["total_users"], found["views"]) == (2, 1, 2)
