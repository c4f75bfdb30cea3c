"""Join helpers: broadcast only behind a size check.

``broadcast_if_small`` hints a broadcast only when the optimizer's size
estimate of the side (for a file scan: the bytes of the files read, scaled
by the columns kept) is below a bound; otherwise the join stays a shuffle
join and AQE may still switch it at run time from *measured* sizes. Sides
whose estimate is unknown (e.g. an aggregate over a fact table) are never
hinted, so a broadcast never grows with the data unchecked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer estimate of the frame's size in bytes, or None if unknown."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(str(size.toString()))
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. Spark Connect)
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def membership_flag(df: DataFrame, value_col: str, ref: DataFrame, ref_col: str,
                    flag: str, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Add ``flag`` = value is not NULL and not among the reference values.

    A left join against the *distinct* reference keys plus a marker column:
    the anti side of a semi join expressed as a per-row flag. Each input row
    matches at most one reference row, so the row count is unchanged.
    """
    marker = f"__hit_{flag}"
    key = f"__key_{flag}"
    keys = (ref.select(F.col(f"`{ref_col}`").alias(key)).where(F.col(key).isNotNull())
            .distinct().withColumn(marker, F.lit(True)))
    keys = broadcast_if_small(keys, max_bytes)
    out = df.join(keys, F.col(f"`{value_col}`") == F.col(key), "left")
    return (out.withColumn(flag, F.col(f"`{value_col}`").isNotNull() & F.col(marker).isNull())
            .drop(key, marker))
