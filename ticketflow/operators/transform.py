"""Cleaning, derived columns and dimension enrichment of valid requests.

All of it but the dedup and the joins is a ``Project`` chain that Catalyst
collapses into one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.functions.text import upper_trim
from ticketflow.functions.timecols import parse_ts, resolution_days, resolution_hours
from ticketflow.operators.dedup import dedup_first
from ticketflow.operators.joins import broadcast_if_small, estimated_bytes
from ticketflow.settings import DEFAULT_SETTINGS, MISSING_FILL, PipelineSettings

DERIVED_COLUMNS = ("resolution_hours", "resolution_days", "created_year", "created_month",
                   "created_hour", "created_day_of_week")
DIM_COLUMNS = ("agency_id", "dim_agency_name", "complaint_type_id", "complaint_category", "borough_id")
PARTITION_COLUMNS = ("created_year", "created_month")


def dedup_requests(df: DataFrame, settings: PipelineSettings = DEFAULT_SETTINGS,
                   key: str = "unique_key") -> DataFrame:
    """One row per key, the first in the declared order (skew-safe aggregate)."""
    order = [c for c in settings.order_columns if c in df.columns]
    return dedup_first(df, key, order)


def standardize_fields(df: DataFrame) -> DataFrame:
    """agency / borough / status upper-trimmed; complaint_type / descriptor trimmed."""
    fixes = {c: upper_trim(c) for c in ("agency", "borough", "status") if c in df.columns}
    fixes.update({c: F.trim(F.col(c)) for c in ("complaint_type", "descriptor") if c in df.columns})
    return df.withColumns(fixes)


def fill_missing(df: DataFrame, columns: Sequence[str] = ("descriptor", "city")) -> DataFrame:
    """NULL (only NULL, not ``''``) → ``UNKNOWN``."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(MISSING_FILL)) for c in columns
                           if c in df.columns})


def parse_dates(df: DataFrame, columns: Sequence[str] = ("created_date", "closed_date")) -> DataFrame:
    """Text dates → ``timestamp_ntz``; unparseable values → NULL."""
    return df.withColumns({c: parse_ts(F.col(c)) for c in columns if c in df.columns})


def add_derived(df: DataFrame) -> DataFrame:
    """Resolution hours / days (NULL while open) and calendar columns.

    Day of week: 1 = Sunday … 7 = Saturday.
    """
    created, closed = F.col("created_date"), F.col("closed_date")
    return df.withColumns({
        "resolution_hours": resolution_hours(created, closed),
        "resolution_days": resolution_days(created, closed),
        "created_year": F.year(created),
        "created_month": F.month(created),
        "created_hour": F.hour(created),
        "created_day_of_week": F.dayofweek(created),
    })


def with_month(df: DataFrame) -> DataFrame:
    """The calendar columns by which curated rows are partitioned, of rows whose dates are still text."""
    created = parse_ts("created_date")
    return df.withColumns({"created_year": F.year(created), "created_month": F.month(created)})


def dimensions_fit(dims: Sequence[DataFrame], settings: PipelineSettings = DEFAULT_SETTINGS) -> bool:
    """Whether all of them are broadcast, so that enriched rows stay where they are."""
    sizes = [estimated_bytes(d) for d in dims]
    return all(n is not None and n <= settings.broadcast_max_bytes for n in sizes)


def enrich_requests(df: DataFrame, dim_agency: DataFrame, dim_complaint_type: DataFrame,
                    dim_borough: DataFrame, settings: PipelineSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Left joins to the three dimensions (ids, canonical agency name, category).

    Fact keys are standardised, dimension keys are taken as stored, so a
    dimension key with other case or outer spaces does not match (NULL ids).
    Dimensions are broadcast when their estimated size is under the bound;
    otherwise the joins stay shuffle joins.
    """
    mb = settings.broadcast_max_bytes
    a = broadcast_if_small(dim_agency.select(
        "agency_id", F.col("agency_code").alias("__agency_code"),
        F.col("agency_name").alias("dim_agency_name")), mb)
    t = broadcast_if_small(dim_complaint_type.select(
        "complaint_type_id", F.col("complaint_type").alias("__complaint_type"),
        F.col("category").alias("complaint_category")), mb)
    b = broadcast_if_small(dim_borough.select(
        "borough_id", F.col("borough").alias("__borough")), mb)
    return (df.join(a, F.col("agency") == F.col("__agency_code"), "left").drop("__agency_code")
            .join(t, F.col("complaint_type") == F.col("__complaint_type"), "left")
            .drop("__complaint_type")
            .join(b, F.col("borough") == F.col("__borough"), "left").drop("__borough"))


def curate(valid: DataFrame, dim_agency: DataFrame, dim_complaint_type: DataFrame,
           dim_borough: DataFrame, settings: PipelineSettings = DEFAULT_SETTINGS,
           known_unique: bool = False) -> DataFrame:
    """valid → dedup → standardise → fill → parse + derive → enrich.

    ``known_unique``: every key has one row already, as the duplicate flag
    leaves it, so nothing is looked for.
    """
    df = valid if known_unique else dedup_requests(valid, settings)
    df = standardize_fields(df)
    df = fill_missing(df)
    df = add_derived(parse_dates(df))
    return enrich_requests(df, dim_agency, dim_complaint_type, dim_borough, settings)
