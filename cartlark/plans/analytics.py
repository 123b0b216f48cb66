"""Daily metrics, funnels, rankings, calendar and KPI measures over clean events."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlark.functions.contract import (
    BATCH_SOURCE,
    EVENT_ID_PATTERN,
    LAST_TIMESTAMP_MS,
    is_event,
    is_supported,
    ratio,
)

# Dashboard row limits, activity buckets (label, largest count) and the
# funnel stages in order.
TOP_ITEMS = 20
TOP_CATEGORIES = 15
ACTIVITY_BUCKETS = (
    ("1 event", 1),
    ("2-5 events", 5),
    ("6-10 events", 10),
    ("11-25 events", 25),
    ("26-50 events", 50),
    ("51+ events", None),
)
FUNNEL_STAGES = (
    (1, "1. View users", "view"),
    (2, "2. Cart users", "addtocart"),
    (3, "3. Purchase users", "transaction"),
)


def event_date() -> Column:
    return F.to_date("event_time")


def slice_events(
    events: DataFrame, date_from: dt.date | None = None, date_to: dt.date | None = None,
    hours: list[int] | None = None,
) -> DataFrame:
    """Report slicers.  A table partitioned by ``event_date`` is pruned by the date range."""
    day = F.col("event_date") if "event_date" in events.columns else event_date()
    hour = F.col("hour") if "hour" in events.columns else F.hour("event_time")
    if date_from is not None:
        events = events.filter(day >= F.lit(date_from))
    if date_to is not None:
        events = events.filter(day <= F.lit(date_to))
    if hours is not None:
        events = events.filter(hour.isin(*hours))
    return events


def _type_counts(views: str = "views", carts: str = "cart_adds", purchases: str = "purchases"):
    return (
        F.count_if(is_event("view")).alias(views),
        F.count_if(is_event("addtocart")).alias(carts),
        F.count_if(is_event("transaction")).alias(purchases),
    )


def _summed_counts() -> tuple[Column, ...]:
    return tuple(F.sum(c).alias(c) for c in ("views", "cart_adds", "purchases"))


def user_daily_metrics(events: DataFrame) -> DataFrame:
    per_item = events.groupBy(event_date().alias("metric_date"), "visitor_id", "item_id").agg(
        *_type_counts()
    )
    return per_item.groupBy("metric_date", "visitor_id").agg(
        *_summed_counts(), F.count("*").alias("distinct_items")
    )


def item_daily_metrics(events: DataFrame) -> DataFrame:
    per_user = events.groupBy(event_date().alias("metric_date"), "item_id", "visitor_id").agg(
        F.max("category_id").alias("category_id"), *_type_counts()
    )
    return per_user.groupBy("metric_date", "item_id").agg(
        F.max("category_id").alias("category_id"),
        *_summed_counts(),
        F.count("*").alias("unique_users"),
    )


def _stage_flags(events: DataFrame, *keys: Column | str) -> DataFrame:
    """One row per key and visitor, with a 0/1 flag per funnel stage.  Distinct users then
    become plain sums, with partial sums before both shuffles."""
    return events.groupBy(*keys, "visitor_id").agg(
        *(
            F.max(F.when(is_event(event), 1).otherwise(0)).alias(f"stage_{order}")
            for order, _, event in FUNNEL_STAGES
        )
    )


def funnel_daily(events: DataFrame) -> DataFrame:
    """Distinct users per stage and day.  Stages are independent populations."""
    daily = (
        _stage_flags(events, event_date().alias("metric_date"))
        .groupBy("metric_date")
        .agg(
            F.sum("stage_1").alias("view_users"),
            F.sum("stage_2").alias("cart_users"),
            F.sum("stage_3").alias("purchase_users"),
        )
    )
    return daily.withColumns(
        {
            "view_to_cart_user_rate": ratio("cart_users", "view_users"),
            "cart_to_purchase_user_rate": ratio("purchase_users", "cart_users"),
            "view_to_purchase_user_rate": ratio("purchase_users", "view_users"),
        }
    )


def funnel_stages(events: DataFrame) -> DataFrame:
    """The three stages as rows, from one pass."""
    return stage_rows(
        _stage_flags(events).agg(
            *(F.sum(f"stage_{order}").alias(f"stage_{order}") for order, *_ in FUNNEL_STAGES)
        )
    )


def stage_rows(totals: DataFrame) -> DataFrame:
    """One row of users per stage (``stage_1`` ...) as a row per stage; none reads as zero."""
    stages = F.array(
        *(
            F.struct(
                F.lit(order).alias("stage_order"),
                F.lit(label).alias("stage"),
                F.coalesce(F.col(f"stage_{order}"), F.lit(0)).alias("users"),
            )
            for order, label, _ in FUNNEL_STAGES
        )
    )
    return totals.select(F.inline(stages))


def item_totals(events: DataFrame) -> DataFrame:
    per_user = events.groupBy("item_id", "visitor_id").agg(
        F.max("category_id").alias("category_id"), *_type_counts()
    )
    return (
        per_user.groupBy("item_id")
        .agg(
            F.max("category_id").alias("category_id"),
            *_summed_counts(),
            F.count("*").alias("unique_users"),
        )
        .withColumn("view_to_purchase_rate", ratio("purchases", "views"))
    )


def category_totals(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(
            *_type_counts(),
            F.count_distinct("visitor_id").alias("unique_users"),
            F.count_distinct("item_id").alias("distinct_items"),
        )
    )


def _purchase_ranking(totals: DataFrame, key: str, limit: int) -> DataFrame:
    """The best ``limit`` rows by purchases, then views, then key.  The limit cuts first
    (top-n per partition), so the numbering window sees at most ``limit`` rows."""
    order = (F.desc("purchases"), F.desc("views"), F.asc(key))
    best = totals.filter("purchases > 0").orderBy(*order).limit(limit)
    return best.withColumn("purchase_rank", F.row_number().over(Window.orderBy(*order)))


def _ranked_label(kind: str, key: str) -> Column:
    return F.concat(
        F.lpad(F.col("purchase_rank").cast("string"), 2, "0"),
        F.lit(f". {kind} "),
        F.col(key).cast("string"),
    )


def top_items(events: DataFrame, limit: int = TOP_ITEMS) -> DataFrame:
    return _purchase_ranking(item_totals(events), "item_id", limit).select(
        "purchase_rank",
        _ranked_label("Item", "item_id").alias("item_id"),
        F.concat(F.lit("Category "), F.col("category_id").cast("string")).alias("category_id"),
        "views", "cart_adds", "purchases", "unique_users", "view_to_purchase_rate",
    )


def top_categories(events: DataFrame, limit: int = TOP_CATEGORIES) -> DataFrame:
    return _purchase_ranking(category_totals(events), "category_id", limit).select(
        "purchase_rank",
        _ranked_label("Category", "category_id").alias("category_id"),
        "views", "cart_adds", "purchases", "unique_users", "distinct_items",
    )


def user_activity(events: DataFrame) -> DataFrame:
    """How many users sent how many events."""
    bucket_order = F.lit(len(ACTIVITY_BUCKETS))
    label = F.lit(ACTIVITY_BUCKETS[-1][0])
    for order, (name, largest) in reversed(list(enumerate(ACTIVITY_BUCKETS[:-1], start=1))):
        inside = F.col("event_count") <= largest
        bucket_order = F.when(inside, order).otherwise(bucket_order)
        label = F.when(inside, name).otherwise(label)
    return (
        events.groupBy("visitor_id").agg(F.count("*").alias("event_count"))
        .groupBy(label.alias("activity_bucket"), bucket_order.alias("bucket_order"))
        .agg(F.count("*").alias("user_count"))
    )


def dashboard_fact_events(events: DataFrame, source: str = BATCH_SOURCE) -> DataFrame:
    return events.select(
        event_date().alias("event_date"),
        F.hour("event_time").cast("smallint").alias("event_hour"),
        "visitor_id", "item_id", "category_id", "event_type",
        F.col("source") if "source" in events.columns else F.lit(source).alias("source"),
    )


def calendar(events: DataFrame) -> DataFrame:
    """Every day from the first to the last event."""
    day = F.col("calendar_date")
    return (
        events.agg(F.min(event_date()).alias("first"), F.max(event_date()).alias("last"))
        .filter("first is not null")
        .select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("calendar_date"))
        .select(
            day,
            F.year(day).alias("calendar_year"),
            F.month(day).alias("calendar_month_number"),
            F.date_format(day, "MMM").alias("calendar_month"),
            (F.weekday(day) + 1).alias("day_of_week_number"),
            F.date_format(day, "EEEE").alias("day_of_week"),
        )
    )


def _on_calendar(daily: DataFrame) -> DataFrame:
    """Daily rows on the full calendar; a day without events stays blank.

    The days are few, so they are gathered into one map that both ends of the calendar and
    the values are taken from: the events are scanned once and nothing is joined."""
    day = F.col("calendar_date")
    values = [c for c in daily.columns if c != "calendar_date"]
    gathered = daily.filter(day.isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct(day, F.struct(*values)))).alias("_by_day"),
        F.min(day).alias("_first"), F.max(day).alias("_last"),
    )
    days = F.explode(F.expr("sequence(_first, _last, interval 1 day)"))
    return (
        gathered.filter("_first is not null").select("_by_day", days.alias("calendar_date"))
        .withColumn("_values", F.try_element_at("_by_day", day))
        .select("calendar_date", *(F.col(f"_values.{c}").alias(c) for c in values))
    )


def daily_trend(events: DataFrame) -> DataFrame:
    daily = events.groupBy(event_date().alias("calendar_date")).agg(
        F.count("*").alias("total_events"), *_blank_type_counts()
    )
    return _on_calendar(daily)


def _blank_type_counts() -> tuple[Column, ...]:
    """Counts per type that read as blank, not zero, where a type did not occur."""
    return tuple(
        F.nullif(F.count_if(is_event(event)), F.lit(0)).alias(name)
        for event, name in (
            ("view", "views"), ("addtocart", "cart_adds"), ("transaction", "transactions")
        )
    )


def kpis(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("total_events"),
        F.count_distinct("visitor_id").alias("total_users"),
        F.count_distinct("item_id").alias("total_items"),
        *_type_counts(purchases="transactions"),
    )


def _with_event_ratios(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "view_to_cart_event_ratio": ratio("cart_adds", "views"),
            "cart_to_purchase_event_ratio": ratio("transactions", "cart_adds"),
            "view_to_purchase_event_ratio": ratio("transactions", "views"),
        }
    ).drop("views", "cart_adds", "transactions")


def event_ratios(events: DataFrame) -> DataFrame:
    """Ratios of event counts, as opposed to the distinct-user rates of the funnel."""
    return _with_event_ratios(events.agg(*_type_counts(purchases="transactions")))


def event_ratio_trend(events: DataFrame) -> DataFrame:
    daily = events.groupBy(event_date().alias("calendar_date")).agg(*_blank_type_counts())
    return _on_calendar(_with_event_ratios(daily))


def snapshot_totals(
    items: DataFrame, categories: DataFrame, activity: DataFrame, stages: DataFrame
) -> DataFrame:
    """The sum measures over the ranking, activity and funnel tables, one row each."""
    def totals(df: DataFrame, measures: dict[str, str]) -> DataFrame:
        rows = F.array(*(
            F.struct(F.lit(name).alias("measure"), F.sum(column).cast("bigint").alias("total"))
            for name, column in measures.items()
        ))
        return df.agg(rows.alias("rows")).select(F.inline("rows"))

    parts = [
        totals(items, {"item_views": "views", "item_purchases": "purchases",
                       "item_cart_adds": "cart_adds"}),
        totals(categories, {"category_purchases": "purchases", "category_views": "views"}),
        totals(activity, {"users_in_bucket": "user_count"}),
        totals(stages, {"funnel_users": "users"}),
    ]
    return reduce(DataFrame.unionByName, parts)


def constraint_audit(events: DataFrame) -> DataFrame:
    """Violations per table rule, as rows.  Repeated ids count every row after the first."""
    blank = {
        f"{c} not null": F.count_if(F.col(c).isNull())
        for c in ("event_id", "source_timestamp_ms", "event_time", "visitor_id", "item_id",
                  "event_type")
    }
    ranges = {
        f"{c} non-negative": F.count_if(F.col(c) < 0)
        for c in ("source_timestamp_ms", "visitor_id", "item_id")
    }
    rules = {
        "event_id unique": F.count("event_id") - F.count_distinct("event_id"),
        "event_id pattern": F.count_if(~F.col("event_id").rlike(EVENT_ID_PATTERN)),
        "event_type supported": F.count_if(~is_supported("event_type")),
        "source_timestamp_ms in range": F.count_if(
            F.col("source_timestamp_ms") > LAST_TIMESTAMP_MS
        ),
        **blank,
        **ranges,
    }
    counted = events.agg(*(v.alias(f"rule_{i}") for i, v in enumerate(rules.values())))
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("rule"), F.col(f"rule_{i}").alias("violations"))
            for i, name in enumerate(rules)
        )
    )
    return counted.select(F.inline(rows))


def key_audit(table: str, rows: DataFrame, key: list[str], required: tuple[str, ...] = ()) -> DataFrame:
    """``(table, rule, violations)``: rows beyond the first of each key, and nulls in the key
    and the ``required`` columns.  Rows are folded by key, so a repeated key is one partial
    count in every task."""
    columns = [*key, *(c for c in required if c not in key)]
    folded = rows.groupBy(*key).agg(
        F.count("*").alias("_n"),
        *(F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)),
    )
    rules = {"key unique": F.sum(F.col("_n") - 1)}
    rules |= {f"{c} not null": F.sum(f"_null_{i}") for i, c in enumerate(columns)}
    return folded.agg(
        F.array(*(
            F.struct(F.lit(name).alias("rule"), F.coalesce(n, F.lit(0)).alias("violations"))
            for name, n in rules.items()
        )).alias("rules")
    ).select(F.lit(table).alias("table"), F.inline("rules"))


def reference_audit(
    table: str, rows: DataFrame, column: str, parents: DataFrame, parent: str
) -> DataFrame:
    """Rows whose value is not null and not among the parent's; values are folded first."""
    values = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    missing = values.join(parents.select(F.col(parent).alias(column)), column, "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(f"{column} references {parent}").alias("rule"),
        "violations",
    )
