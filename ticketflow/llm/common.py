"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.arrow import map_arrow, ship_package  # noqa: F401
from ticketflow.session import scratch_path, table_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

# Bytes of rows (as written) up to which a side may be broadcast.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is a plain reference, so an expensive expression bound
    here is not copied into every place that uses it.
    """
    return F.transform(F.array(value), body)[0]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: consumers scan the files, and a lost executor costs a
    re-read rather than a recomputation.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, row_bytes: int | Column,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Hint a broadcast if ``row_bytes``, summed over the rows, stay in the bound.

    A column gives the bytes of rows of no fixed size. ``df`` should be a
    written table, since it is counted. Returns the frame and whether it was
    hinted; unhinted, the join is a shuffle join.
    """
    if isinstance(row_bytes, Column):
        total = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]
    else:
        total = df.count() * row_bytes
    if total <= max_bytes:
        return F.broadcast(df), True
    return df, False
