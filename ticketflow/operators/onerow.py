"""Put global aggregates side by side.

A global aggregate (``df.agg(...)`` without grouping) has exactly one row,
so joining several of them on a constant is bounded by construction: each
side is broadcast (its size is one row), no pairs are ever multiplied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ONE = "__one"


def side_by_side(frames: Sequence[DataFrame]) -> DataFrame:
    """Columns of several one-row global aggregates in one row."""
    if not frames:
        raise ValueError("nothing to combine")
    out = frames[0].withColumn(_ONE, F.lit(1))
    for f in frames[1:]:
        out = out.join(F.broadcast(f.withColumn(_ONE, F.lit(1))), _ONE, "inner")
    return out.drop(_ONE)
