"""Keys that hold too many rows for one group.

A group of a bounded number of rows needs one shuffle and a sort.  Keys beyond the bound are
found first, by counts per hash slot, and only they take an operator's finer way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlark.session import materialize

#: Rows of a key that may be sorted as one group.
LIGHT_ROWS = 262_144
SLOTS = 16_384


def heavy_keys(df: DataFrame, key: str, light_rows: int = LIGHT_ROWS) -> DataFrame | None:
    """The values of ``key`` with more than ``light_rows`` rows, or None where there are none.

    Rows are counted per slot of the key's digest, at most ``SLOTS`` counts a task; keys are
    counted only in slots that hold more than the bound.  There is at most one heavy key per
    ``light_rows`` rows, so the result may be broadcast.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    counts = df.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    full = [r["slot"] for r in counts.filter(F.col("n") > light_rows).select("slot").collect()]
    if not full:
        return None
    found = materialize(
        df.filter(slot.isin(*full)).groupBy(key).agg(F.count("*").alias("n"))
        .filter(F.col("n") > light_rows).select(key)
    )
    return None if found.isEmpty() else found


def parted(df: DataFrame, key: str, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of light keys (and of no key), and rows of heavy ones."""
    keys = F.broadcast(heavy)
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")
