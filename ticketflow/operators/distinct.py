"""Exact distinct counts by bitmap.

Whole numbers, and texts that are whole numbers written plainly, are counted in
bitmaps: a task sets bits of the number ranges that it meets, and what is shuffled is
one bitmap a range and task instead of every key. Other texts, and numbers so far apart that
bitmaps would be larger than the keys, are counted by ``count_distinct``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.operators.onerow import side_by_side

# Numbers a bitmap covers, and the bytes of bitmap that a row may cost.
RANGE = 32_768
BYTES_PER_ROW = 16


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _number(df: DataFrame, column: str) -> Column:
    """The value as a whole number if it is one in its plain form, else NULL."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return _q(column).cast("bigint")
    if isinstance(kind, T.StringType):
        n = _q(column).try_cast("bigint")
        return F.when(n.cast("string") == _q(column), n)
    return F.lit(None).cast("bigint")


def count_distinct_exact(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row with the distinct non-NULL values of ``columns[name]`` as ``name``.

    One small job looks at the ranges of the numbers first; then one scan fills the
    bitmaps of all columns that are dense enough, and one counts the rest, if any.
    """
    names = list(columns)
    numbers = {n: _number(df, columns[n]) for n in names}
    look = df.agg(F.count(F.lit(1)).alias("rows"), *[x for i, n in enumerate(names) for x in (
        F.min(numbers[n]).alias(f"lo{i}"), F.max(numbers[n]).alias(f"hi{i}"), F.count(numbers[n]).alias(f"n{i}"),
        F.count(_q(columns[n])).alias(f"all{i}"))]).first()
    dense, rest = [], []
    for i, n in enumerate(names):
        found = look[f"n{i}"]
        fits = found and (look[f"hi{i}"] - look[f"lo{i}"]) // 8 <= max(BYTES_PER_ROW * found, RANGE)
        if fits:
            dense.append(n)
        if look[f"all{i}"] > (found if fits else 0):
            rest.append(n)
    parts = []
    if dense:
        value = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), numbers[n].alias("value"))
                                    for i, n in enumerate(dense)]))
        bits = (df.select(value.alias("x")).where("x.value is not null")
                .groupBy("x.column", F.bitmap_bucket_number("x.value").alias("range"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("x.value")).alias("bits")))
        parts.append(bits.agg(*[F.coalesce(F.sum(F.when(F.col("column") == i, F.bitmap_count("bits"))), F.lit(0))
                                .cast("bigint").alias(f"__dense_{n}") for i, n in enumerate(dense)]))
    if rest:
        parts.append(df.agg(*[F.count_distinct(F.when(numbers[n].isNull(), _q(columns[n])) if n in dense else _q(columns[n]))
                              .alias(f"__rest_{n}") for n in rest]))
    one = side_by_side(parts) if parts else df.sparkSession.range(1).select()
    zero = F.lit(0).cast("bigint")
    return one.select(*[((F.col(f"__dense_{n}") if n in dense else zero) + (F.col(f"__rest_{n}") if n in rest else zero)).alias(n)
                        for n in names])
