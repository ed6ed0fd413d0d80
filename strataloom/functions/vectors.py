"""Vector functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_score(a: Column, b: Column) -> Column:
    """(1 + cosine) / 2, as vector indexes score."""
    return (1 + dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))) / 2
