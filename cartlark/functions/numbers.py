"""Whole-number arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value: Column, width: int) -> Column:
    """``value`` by ``width``, rounded down, for whole numbers of any size and sign."""
    by = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, by), by)
