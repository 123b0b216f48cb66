"""Dense-vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_FLOOR = 1e-12


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda total, term: total + term,
    )


def norm(vector: Column) -> Column:
    return F.greatest(F.sqrt(dot(vector, vector)), F.lit(NORM_FLOOR))


def cosine(left: Column, right: Column) -> Column:
    return dot(left, right) / (norm(left) * norm(right))


def unit(vector: Column) -> Column:
    """The direction of ``vector`` at length one, however short it is: learned factors shrink far
    below ``NORM_FLOOR``.  A zero vector stays zero."""
    length = F.sqrt(dot(vector, vector))
    # The length stands beside the values: inside a lambda it would be taken for each of them.
    lengths = F.array_repeat(F.when(length > 0, length).otherwise(F.lit(1.0)), F.size(vector))
    return F.zip_with(vector, lengths, lambda x, length: x.cast("double") / length)


def softplus(x: Column) -> Column:
    """log(1 + e^x) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
