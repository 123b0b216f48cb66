"""A cell index over item vectors, and exact top-k that visits only cells that can matter.

Centres are fitted on a bounded sample (``SAMPLE_PER_CELL`` rows a cell); every item is then
put into the cell of its nearest centre, and a cell keeps the widest angle between its centre
and an item.  A user's cosine with an item of a cell is at most that of the angle to the
centre less the widest angle.  Each user first visits the cell of the nearest centre, which
gives a k-th score; only cells whose bound reaches it are visited then.  Nothing is
approximate: the sample decides how much is skipped, never what is found.

Cells of many items are cut into parts by the items' ids.  What moves is counted in larger
units: like cells lie on one shelf of a bounded number of items, and a user is sent to a shelf
once, with the cells to visit there; users of like centres form shards of a bounded size, which
share the copies of the items that any of them visits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlark.session import materialize

#: Cells at most, so that centres and angles are small wherever they are sent.
MOST_CELLS = 4096
SAMPLE_PER_CELL = 32
FIT_ROUNDS = 6
#: Items that lie together where cells are smaller.
SHELF_ROWS = 16_384
#: Users below which more shards do not help to keep cores busy.
LEAST_USERS_PER_SHARD = 1024
#: Rows compared with all centres at a time: 32 MB a matrix of 4,096 cells.
ROWS_AT_ONCE = 1024
#: Slack of bounds, above the rounding of scores to six places.
SLACK = 2e-6


@dataclass(frozen=True)
class CellIndex:
    """``items(item_id, embedding, cell, part, block)`` and, per cell, its centre, its widest
    angle, the number of its parts, and the first and last shelf (``block``) that holds one."""

    items: DataFrame
    centres: np.ndarray
    angles: np.ndarray
    parts: dict[int, int]
    shelves: dict[int, tuple[int, int]]


def unit_rows(vectors: pd.Series) -> np.ndarray:
    matrix = np.array(vectors.tolist(), dtype="float64")
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def fit_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres by rounds of nearest centre and mean direction, from evenly spread rows."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(FIT_ROUNDS):
        starts = range(0, len(sample), ROWS_AT_ONCE)
        nearest = np.concatenate(
            [(sample[i : i + ROWS_AT_ONCE] @ centres.T).argmax(1) for i in starts]
        )
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.iloc[start : start + ROWS_AT_ONCE]


def angles_to(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(matrix @ centres.T, -1.0, 1.0))


def like(centres: np.ndarray, groups: int) -> np.ndarray:
    """The group of like centres that each centre belongs to, at most ``groups`` of them."""
    if groups >= len(centres):
        return np.arange(len(centres))
    return angles_to(centres, fit_centres(centres, max(1, groups))).argmin(1)


def shard_count(context: SparkContext, users: int, users_per_shard: int) -> int:
    """Shards of at most ``users_per_shard``, smaller ones where there would be too few groups
    to keep all cores busy."""
    busy = min(3 * context.defaultParallelism, ceil(users / LEAST_USERS_PER_SHARD))
    return max(1, ceil(users / users_per_shard), busy)


def _on_shelves(
    sizes: dict[int, int], parts: dict[int, int], centres: np.ndarray, shelf_rows: int
) -> list[tuple[int, int, int]]:
    """``(cell, part, shelf)``, at most ``shelf_rows`` items on a shelf, or one part of more."""
    alike = like(centres, ceil(sum(sizes.values()) / shelf_rows))
    dealt, shelf, held = [], 0, 0
    for cell in sorted(sizes, key=lambda c: (alike[c], c)):
        rows = ceil(sizes[cell] / parts[cell])
        for part in range(parts[cell]):
            if held and held + rows > shelf_rows:
                shelf, held = shelf + 1, 0
            dealt.append((cell, part, shelf))
            held += rows
    return dealt


def build_cells(
    items: DataFrame, item_count: int, rows_per_part: int, seed: int = 42, *,
    shelf_rows: int = SHELF_ROWS,
) -> CellIndex:
    """Index of ``items(item_id, embedding)``, whose vectors are usable and equally long."""
    context = items.sparkSession.sparkContext
    cells = min(MOST_CELLS, max(1, ceil(item_count / rows_per_part)))
    sample = (
        items.select("embedding").orderBy(F.xxhash64(F.lit(seed), "item_id"), "item_id")
        .limit(cells * SAMPLE_PER_CELL).toPandas()
    )
    centres = fit_centres(unit_rows(sample["embedding"]), cells)
    told = context.broadcast(centres)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            angle = angles_to(unit_rows(batch["embedding"]), told.value)
            cell = angle.argmin(1)
            yield batch.assign(cell=cell, angle=angle[np.arange(len(cell)), cell])

    kind = items.schema["embedding"].dataType.simpleString()
    id_kind = items.schema["item_id"].dataType.simpleString()
    put = materialize(items.select("item_id", "embedding").mapInPandas(
        placed, f"item_id {id_kind}, embedding {kind}, cell int, angle double"
    ))
    facts = put.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("angle")).collect()
    angles = np.full(len(centres), -np.inf)  # an empty cell is never visited
    sizes, parts, shelves = {}, {}, {}
    for row in facts:  # at most one row per cell
        angles[row["cell"]] = row["angle"]
        sizes[row["cell"]] = row["n"]
        parts[row["cell"]] = ceil(row["n"] / rows_per_part)
    placed_parts = _on_shelves(sizes, parts, centres, shelf_rows)
    for cell, _, shelf in placed_parts:  # parts of a cell follow each other
        shelves[cell] = (shelves.get(cell, (shelf, shelf))[0], shelf)
    spark = items.sparkSession
    counted = spark.createDataFrame(list(parts.items()), "cell int, parts int")
    blocks = spark.createDataFrame(placed_parts, "cell int, part int, block int")
    # At most MOST_CELLS rows, and one for each part.
    dealt = put.join(F.broadcast(counted), "cell").select(
        "item_id", "embedding", "cell", F.pmod(F.xxhash64("item_id"), "parts").cast("int").alias("part"),
    ).join(F.broadcast(blocks), ["cell", "part"])
    return CellIndex(dealt, centres, angles, parts, shelves)


def _home(users: DataFrame, index: CellIndex, users_per_shard: int) -> DataFrame:
    """Users with the cell of their nearest centre and a shard of users like them: small homes
    of like centres share one, large ones are cut."""
    told = users.sparkSession.sparkContext.broadcast((index.centres, np.isinf(index.angles)))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, empty = told.value
        for batch in _slices(batches):
            angle = angles_to(unit_rows(batch["embedding"]), centres)
            angle[:, empty] = np.inf
            yield batch.assign(home=angle.argmin(1))

    kinds = [users.schema[c].dataType.simpleString() for c in ("user_id", "embedding")]
    at_home = materialize(users.select("user_id", "embedding").mapInPandas(
        nearest, f"user_id {kinds[0]}, embedding {kinds[1]}, home int"
    ))
    held = {r["home"]: r["n"] for r in at_home.groupBy("home").agg(F.count("*").alias("n")).collect()}
    context = users.sparkSession.sparkContext
    wards = like(index.centres, shard_count(context, sum(held.values()), users_per_shard)).tolist()
    together: dict[int, int] = {}
    for home, n in held.items():
        together[wards[home]] = together.get(wards[home], 0) + n
    rows = [(h, wards[h], ceil(together[wards[h]] / users_per_shard)) for h in held]
    shards = users.sparkSession.createDataFrame(rows, "home int, ward bigint, shards int")
    return at_home.join(F.broadcast(shards), "home").select(  # at most MOST_CELLS rows
        "user_id", "embedding", "home",
        (F.col("ward") * (1 << 32) + F.pmod(F.xxhash64("user_id"), "shards")).alias("shard"),
    )


def _in_reach(users: DataFrame, index: CellIndex) -> DataFrame:
    """Per shelf the ``cells``, home left out, whose bound reaches the user's ``floor``."""
    holds = np.zeros((1 + max(last for _, last in index.shelves.values()), len(index.centres)), bool)
    for cell, (first, last) in index.shelves.items():
        holds[first : last + 1, cell] = True
    told = users.sparkSession.sparkContext.broadcast((index.centres, index.angles, holds))

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, angles, holds = told.value
        for batch in _slices(batches):
            least = np.maximum(0.0, angles_to(unit_rows(batch["embedding"]), centres) - angles)
            floor = batch["floor"].fillna(-2.0).to_numpy()[:, None]
            may = (np.cos(least) >= floor - SLACK) & np.isfinite(angles)
            may[np.arange(len(batch)), batch["home"]] = False
            for block, cells in enumerate(map(np.flatnonzero, holds)):
                here = may[:, cells].any(1)
                visits = [cells[row] for row in may[np.ix_(here, cells)]]
                yield batch.loc[here, ["user_id", "shard"]].assign(block=block, cells=visits)

    kind = users.schema["user_id"].dataType.simpleString()
    return users.select("user_id", "shard", "embedding", "home", "floor").mapInPandas(
        reached, f"user_id {kind}, shard bigint, block int, cells array<int>"
    )


def visited(
    users: DataFrame, index: CellIndex, seen: DataFrame, k: int, users_per_shard: int,
    score_group: Callable[[DataFrame, DataFrame, DataFrame], DataFrame],
    best: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """Partial results of all visits, and the visits themselves (``user_id``, ``cell``).

    ``score_group(asking, hidden, offered)`` scores users against those items of the same
    ``shard`` and ``block`` whose ``cell`` is among the user's ``cells``; ``best`` keeps the k
    best rows per user with their ``place``.
    """
    users = materialize(_home(users, index, users_per_shard))
    # A seen pair is hidden where it is scored: among the visits to home cells, or the others.
    hidden = materialize(
        seen.join(users.select("user_id", "shard", "home"), "user_id")
        .join(index.items.select("item_id", "block", "cell"), "item_id")
        .select("shard", "block", "user_id", "item_id", (F.col("cell") == F.col("home")).alias("near"))
    )

    def search(asking: DataFrame, unwanted: DataFrame) -> DataFrame:
        wanted = asking.select("shard", F.explode("cells").alias("cell")).distinct()
        # Aliases keep the two sides' columns apart, as both descend from the users.
        columns = [F.col(c).alias(c) for c in ("shard", "block", "item_id", "embedding", "cell")]
        offered = index.items.join(materialize(wanted), "cell").select(columns)
        return score_group(asking, unwanted.drop("near"), offered)

    reach = [(c, b) for c, (first, last) in index.shelves.items() for b in range(first, last + 1)]
    blocks = users.sparkSession.createDataFrame(reach, "home int, block int")
    at_home = users.join(F.broadcast(blocks), "home").select(  # one row per cell and shelf
        "shard", "block", "user_id", "embedding", F.array("home").alias("cells")
    )
    first = materialize(best(search(at_home, hidden.filter("near"))))
    floors = first.filter(F.col("place") == k).select("user_id", F.col("score").alias("floor"))
    known = users.join(floors, "user_id", "left")
    others = materialize(_in_reach(known, index))
    vectors = users.select("user_id", "embedding")
    second = search(others.join(vectors, "user_id"), hidden.filter("not near"))
    visits = users.select("user_id", F.col("home").alias("cell")).unionByName(
        others.select("user_id", F.explode("cells").alias("cell")).distinct()
    )
    return first.drop("place").unionByName(second), visits
