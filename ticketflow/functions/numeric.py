"""Numeric cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_as_null(c: str | Column) -> Column:
    """Float NaN → SQL NULL; every other value (0, 0.0, NULL) unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float/double column, keep the rest as is.

    NaN poisons averages (``avg({NaN, 2.0})`` is NaN), so this runs before
    aggregation and before any serving load.
    """
    fixes = {
        f.name: nan_as_null(F.col(f"`{f.name}`")).cast(f.dataType)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(fixes) if fixes else df
