"""Hard negatives by coordinate pruning over length buckets.

Rows are ordered by label and falling length and cut into buckets of bounded size, however
many rows share a label, a length or a vector.  A bucket keeps sorted lists of normalised
coordinates.  For an inner product of at least ``theta``, an anchor and a row no longer than
the bucket's longest need a cosine that confines each of the row's coordinates to a range
around the anchor's: the ranges of the anchor's strongest (focus) coordinates are looked up in
the sorted lists, the candidate sets are intersected, and survivors are scored exactly.
Buckets too short to reach ``theta`` are never sent the anchor.

``theta`` comes from what is known already.  For positives, each anchor first meets the longest
bucket of its label, whose k-th best score is a floor for all others.  For negatives, the floor
is the margin times the positive's score.  In a bucket it rises to the k-th best score of rows
probed first.  Blocks of the stated anchors meet the buckets; at most ``k`` rows per anchor (and
positive) and bucket leave a task.

Rows with a null id or label, a null or empty vector, or null or non-finite components take
no part; a vector is compared with vectors of its own length only.  Equal rows (id, label and
vector) count once.  Other rows with one id are rows of their own: an anchor is left out of its
own partners, another row with its id is not.  Scores are compared to 38 digits, and those
outside 64 bits are returned as the nearest 64-bit value.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

from decimal import Decimal
from math import acos, cos, inf, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlark.llm import common
from cartlark.llm.exact_topk import usable, whole_components
from cartlark.operators.positions import with_position

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this many hundredths of the positive's score, and at most all.
MARGIN = 80
#: Components of a bucket and of a block of anchors, so that wide vectors give fewer rows.
BUCKET_CELLS = 1 << 20
ANCHOR_CELLS = 1 << 18
#: Coordinates of an anchor whose ranges are intersected, and rows probed for a floor.
FOCUS = 6
PROBED = 128
#: Width added to cosines and ranges, far above the rounding of 64-bit arithmetic.
SLACK = 1e-9
#: Parts into which the buckets are dealt when blocks are matched with them.
SPREAD = 64
_WIDEST = 10**38 - 1
_FOUND = "key bigint, slot int, partner bigint, partner_key bigint, score decimal(38,0)"


# --- one bucket -------------------------------------------------------------------------------


class Bucket:
    """Rows of one bucket with sorted lists of normalised coordinates, made when first used."""

    def __init__(self, rows: pd.DataFrame, scale: int):
        rows = rows.sort_values("key", ignore_index=True)
        self.ids, self.keys = rows["id"].to_numpy(), rows["key"].to_numpy()
        self.labels = rows["label"].to_numpy()
        self.whole = whole_components(np.stack(rows["vector"]), scale)
        plain = self.whole.astype(np.float64)
        lengths = np.linalg.norm(plain, axis=1)
        self.longest = float(lengths.max())
        self.most = float(np.abs(plain).max())
        self.unit = plain / np.maximum(lengths, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def scores(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Exact scores, with unbounded whole numbers where 64 bits might not do."""
        self.scored += len(places)
        rows = self.whole[places]
        most = float(np.abs(query).max(initial=0)) * self.most * max(1, len(query))
        if rows.dtype == object or query.dtype == object or most >= 2.0**62:
            rows, query = rows.astype(object), query.astype(object)
        return rows @ query

    def near(self, direction: np.ndarray) -> np.ndarray:
        """Some rows around the anchor's own place in the list of its strongest coordinate."""
        f = int(np.abs(direction).argmax())
        order, values = self.sorted_list(f)
        first = max(0, int(np.searchsorted(values, direction[f])) - PROBED // 2)
        return order[first : first + PROBED]

    def candidates(self, direction: np.ndarray, length: float, theta: float) -> np.ndarray:
        """Every row that may score ``theta`` with a query of this direction and length."""
        everything = np.arange(len(self.ids))
        reach = length * self.longest
        if not theta > 0 or not np.isfinite(reach):
            return everything
        cosine = theta / reach - SLACK if reach else inf
        if cosine > 1:
            return everything[:0]
        if cosine <= 0:
            return everything
        radius, ranges = acos(cosine), []
        for f in np.argsort(-np.abs(direction))[:FOCUS]:
            angle = acos(min(1.0, max(-1.0, direction[f])))
            low = cos(min(pi, angle + radius)) - SLACK
            high = cos(max(0.0, angle - radius)) + SLACK
            values = self.sorted_list(int(f))[1]
            first, last = np.searchsorted(values, low), np.searchsorted(values, high, "right")
            ranges.append((last - first, first, last, low, high, f))
        ranges.sort(key=lambda r: r[0])
        _, first, last, _, _, f = ranges[0]
        places = self.lists[int(f)][0][first:last]
        for _, _, _, low, high, f in ranges[1:]:
            x = self.unit[places, f]
            places = places[(x >= low) & (x <= high)]
        return places


def _best(places, scores, bucket: Bucket, k: int):
    """Places and scores of the k best, ties by id and then by row."""
    order = np.lexsort((bucket.keys[places], bucket.ids[places], -scores))[:k]
    return places[order], scores[order]


def _floor(scores: np.ndarray, k: int, least):
    """The k-th best score, if there are as many and it is above ``least``."""
    return max(least, np.sort(scores)[-k]) if len(scores) >= k else least


def positives_in(bucket: Bucket, key, label, query, floor, k: int):
    """The k best rows of the anchor's label that score ``floor`` or more."""
    def own(places):
        return places[(bucket.labels[places] == label) & (bucket.keys[places] != key)]

    length = float(np.linalg.norm(query.astype(np.float64)))
    direction = query.astype(np.float64) / max(length, 1e-300)
    probed = own(bucket.near(direction))
    theta = _floor(bucket.scores(query, probed), k, floor)
    places = own(bucket.candidates(direction, length, float(theta)))
    return _best(places, bucket.scores(query, places), bucket, k)


def negatives_in(bucket: Bucket, label, query, targets: list, k: int, margin: int):
    """For each positive's score the k best rows of other labels in its range.

    One candidate set serves all positives: its floor is the least that any of them needs.
    """
    def other(places):
        return places[bucket.labels[places] != label]

    def fitting(places, scores, target):
        fits = (100 * scores >= margin * target) & (scores <= target)
        return places[fits], scores[fits]

    length = float(np.linalg.norm(query.astype(np.float64)))
    direction = query.astype(np.float64) / max(length, 1e-300)
    probed = other(bucket.near(direction))
    known = bucket.scores(query, probed)
    needs = [
        _floor(fitting(probed, known, t)[1], k, margin * t / 100) for t in targets
    ]
    places = other(bucket.candidates(direction, length, float(min(needs))))
    scores = bucket.scores(query, places)
    return [_best(*fitting(places, scores, t), bucket, k) for t in targets]


# --- Spark ------------------------------------------------------------------------------------


def _length(vector: str, scale: int) -> Column:
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    return F.sqrt(F.aggregate(whole, F.lit(0.0), lambda s, x: s + x * x))


def _dealt(rows: DataFrame, anchors: Column, scale: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``key`` (place in the order) and ``bucket``, and the anchors with ``block``."""
    rows = (
        rows.withColumn("is_anchor", F.coalesce(anchors, F.lit(False)))
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("vector"))
        .select("id", "label", "vector", "is_anchor").distinct()
        .withColumns({"dims": F.size("vector"), "length": _length("vector", scale)})
    )
    order = ["dims", "label", F.desc("length"), "id"]
    placed = common.stored(with_position(rows, order, "key"), "rows")
    widest = placed.agg(F.max("dims")).first()[0] or 1
    per_bucket = max(1, BUCKET_CELLS // widest)
    placed = placed.withColumn("bucket", F.floor(F.col("key") / per_bucket))
    per_block = max(1, ANCHOR_CELLS // widest)
    asked = placed.filter("is_anchor").drop("bucket", "is_anchor")
    asked = with_position(asked, ["key"], "place")
    asked = asked.withColumn("block", F.floor(F.col("place") / per_block)).drop("place")
    return placed.drop("is_anchor"), asked


def _searched(asked: DataFrame, rows: DataFrame, pairs: DataFrame, scale: int, search) -> DataFrame:
    """``search(bucket, anchor)`` for every anchor and bucket of the block pairs.

    ``pairs(dims, block, bucket, longest)``; an anchor goes along if ``reach`` (the length that
    it needs in a row) is not above the bucket's longest.
    """
    key = ["dims", "block", "bucket"]
    left = asked.join(pairs, ["dims", "block"]).filter("reach <= longest").drop("longest")
    held = rows.select("dims", "bucket", "key", "id", "label", "vector").join(
        pairs.select(*key), ["dims", "bucket"]
    )

    def run(_, anchors: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(members):
            bucket = Bucket(members, scale)
            queries = whole_components(np.stack(anchors["vector"]), scale)
            for anchor, query in zip(anchors.itertuples(), queries, strict=True):
                for slot, (places, scores) in search(bucket, anchor, query):
                    out += [
                        (anchor.key, slot, bucket.ids[p], bucket.keys[p],
                         Decimal(min(max(int(s), -_WIDEST), _WIDEST)))
                        for p, s in zip(places, scores, strict=True)
                    ]
        columns = [f.split()[0] for f in _FOUND.split(", ")]
        return pd.DataFrame(out, columns=columns)

    return left.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(run, _FOUND)


def _k_best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "partner", "partner_key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _reach(theta: Column) -> Column:
    """The least length of a row that can score ``theta``; nothing is needed for 0 or less."""
    needed = theta.cast("double") / F.col("length") * F.lit(1 - SLACK)
    return F.when((theta > 0) & (F.col("length") > 0), needed).otherwise(
        F.when(theta > 0, F.lit(inf)).otherwise(F.lit(0.0))
    )


def positives(asked: DataFrame, rows: DataFrame, k: int = POSITIVES, scale: int = SCALE) -> DataFrame:
    """``key``, ``rank``, ``partner`` and ``score`` of each anchor's best rows of its label."""
    # One row per bucket and label in it: a few more than there are buckets.
    held = common.stored(
        rows.groupBy("dims", "bucket", "label").agg(F.max("length").alias("longest")), "buckets"
    )
    first = held.groupBy("dims", "label").agg(F.min("bucket").alias("bucket"))
    kin = asked.select("dims", "label", "block").distinct()
    unlimited = asked.withColumns({"reach": F.lit(0.0), "floor": F.lit(None).cast("decimal(38,0)")})

    def search(bucket: Bucket, anchor, query):
        floor = -inf if pd.isna(anchor.floor) else int(anchor.floor)
        return [(0, positives_in(bucket, anchor.key, anchor.label, query, floor, k))]

    def pairs(found: DataFrame) -> DataFrame:
        each = found.groupBy("dims", "block", "bucket").agg(F.max("longest").alias("longest"))
        return common.stored(each, "pairs")

    start = pairs(kin.join(first, ["dims", "label"]).withColumn("longest", F.lit(inf)))
    near = common.stored(_k_best(_searched(unlimited, rows, start, scale, search), k), "near")
    floors = near.filter(F.col("rank") == k).select("key", F.col("score").alias("floor"))
    limited = asked.join(floors, "key", "left").withColumn(
        "reach", F.coalesce(_reach(F.col("floor")), F.lit(0.0))
    )
    limited = common.stored(limited, "anchors")
    least = limited.groupBy("dims", "label", "block").agg(F.min("reach").alias("reach"))
    rest = pairs(
        least.join(held, ["dims", "label"]).filter("reach <= longest")
        .join(start.select("dims", "block", "bucket"), ["dims", "block", "bucket"], "left_anti")
    )
    far = _searched(limited, rows, rest, scale, search)
    columns = ["key", "slot", "partner", "partner_key", "score"]
    return _k_best(near.select(columns).union(far.select(columns)), k)


def hard_negatives(
    rows: DataFrame, anchors: Column, k_positives: int = POSITIVES, k_negatives: int = NEGATIVES,
    margin: int = MARGIN, scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score`` for ``id``, ``label``, ``vector`` rows; ``anchors`` marks the queries."""
    rows, asked = _dealt(rows, anchors, scale)
    asked = common.stored(asked, "asked")
    chosen = common.stored(positives(asked, rows, k_positives, scale), "positives")
    # A positive below zero has no range: 80 hundredths of it lie above it.
    target = F.struct(F.col("rank").alias("slot"), "score")
    targets = chosen.filter("score >= 0").groupBy("key").agg(
        F.array_sort(F.collect_list(target)).alias("targets"), F.min("score").alias("least")
    )
    seeking = common.stored(
        asked.join(targets, "key").withColumn(
            "reach", _reach(F.col("least").cast("double") * margin / 100)
        ).drop("least"),
        "seeking",
    )
    blocks = seeking.groupBy("dims", "block").agg(
        F.min("reach").alias("reach"), F.min("label").alias("low"), F.max("label").alias("high")
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    buckets = rows.groupBy("dims", "bucket").agg(
        F.max("length").alias("longest"), F.min("label").alias("_low"),
        F.max("label").alias("_high"),
    ).withColumn("part", (F.col("bucket") % SPREAD).cast("int"))
    # Blocks and buckets of one and the same label have no negatives for each other.
    alike = "low = high and _low = _high and low = _low"
    pairs = common.stored(
        blocks.join(buckets, ["dims", "part"]).filter(f"reach <= longest and not ({alike})")
        .select("dims", "block", "bucket", "longest"),
        "pairs",
    )

    def search(bucket: Bucket, anchor, query):
        slots = [t["slot"] for t in anchor.targets]
        scores = [int(t["score"]) for t in anchor.targets]
        return zip(slots, negatives_in(bucket, anchor.label, query, scores, k_negatives, margin))

    found = _k_best(_searched(seeking, rows, pairs, scale, search), k_negatives)
    long = [F.lit(v).cast("decimal(38,0)") for v in (-(2**63), 2**63 - 1)]

    def bounded(score: str) -> Column:
        return F.greatest(F.least(F.col(score), long[1]), long[0]).cast("bigint")

    positive = chosen.select(
        "key", F.col("rank").alias("slot"), F.col("partner").alias("positive_id"),
        bounded("score").alias("positive_score"),
    )
    return (
        found.join(positive, ["key", "slot"])
        .join(asked.select("key", F.col("id").alias("anchor_id")), "key")
        .select("anchor_id", "positive_id", "rank", F.col("partner").alias("negative_id"),
                "positive_score", bounded("score").alias("negative_score"))
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector as an anchor; every seventh row's label is shifted first."""
    label = F.col("label")
    rows = common.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
    )
    return hard_negatives(rows, F.col("id") % 100 == 0)


OP11_SQL = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and label is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
           cast(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from rows a join rows c on a.vec_id <> c.vec_id and len(a.v) = len(c.v)
    where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, cast(row_number() over best as integer) as "rank",
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
window best as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over best <= 5
"""
