"""Summary marts and the analytical / dashboard queries over them.

Averages of resolution hours are computed exactly from integer hundredths
(sum and count are partial-aggregated longs), so a mart value never depends
on how partial sums were combined across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.functions.timecols import half_up_avg_cents, hours_to_cents, resolution_hours
from ticketflow.operators.onerow import side_by_side
from ticketflow.settings import CLOSED_STATUS

MONTHLY_KEY = ("created_year", "created_month", "borough", "complaint_category")
DAILY_KEY = ("request_date", "borough", "complaint_category")
MART_MEASURES = ("total_requests", "avg_resolution_hours", "closed_requests", "unresolved_requests")


def _measures() -> list[Column]:
    hours = F.col("resolution_hours")
    return [
        F.count(F.lit(1)).alias("total_requests"),
        half_up_avg_cents(F.sum(hours_to_cents(hours)), F.count(hours)).alias("avg_resolution_hours"),
        F.count_if(F.col("status") == CLOSED_STATUS).alias("closed_requests"),
        F.count_if(hours.isNull()).alias("unresolved_requests"),
    ]


def monthly_summary(curated: DataFrame) -> DataFrame:
    """Requests per (year, month, borough, category): count, avg hours (2 dp),
    closed and unresolved counts."""
    return curated.groupBy(*MONTHLY_KEY).agg(*_measures())


def daily_summary(curated: DataFrame) -> DataFrame:
    """The same measures per (calendar date, borough, category)."""
    return (curated.groupBy(F.to_date("created_date").alias("request_date"),
                            "borough", "complaint_category").agg(*_measures()))


def monthly_summary_head(monthly: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` mart rows by month, then volume desc (ties broken by key)."""
    return monthly.orderBy(
        F.col("created_month").asc(), F.col("total_requests").desc(),
        F.col("created_year").asc(), F.col("borough").asc_nulls_last(),
        F.col("complaint_category").asc_nulls_last()).limit(n)


def monthly_volume(curated: DataFrame, year: int | None = None) -> DataFrame:
    """Requests per (year, month); ``year`` filters on the partition column."""
    df = curated if year is None else curated.where(F.col("created_year") == F.lit(year))
    return (df.groupBy("created_year", "created_month").agg(F.count(F.lit(1)).alias("total_requests"))
            .orderBy("created_year", "created_month"))


def top_complaint_types(curated: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` (complaint type, category) by volume; ties broken by name."""
    return (curated.groupBy("complaint_type", "complaint_category")
            .agg(F.count(F.lit(1)).alias("total"))
            .orderBy(F.col("total").desc(), F.col("complaint_type").asc_nulls_last(),
                     F.col("complaint_category").asc_nulls_last())
            .limit(n))


def top_category_per_borough_month(monthly: DataFrame, with_year: bool = False) -> DataFrame:
    """Rank-1 categories per (borough, month) by volume, ties kept.

    The partition is (borough, month) without the year, as the source query
    has it; ``with_year=True`` adds the year to the partition.
    """
    part = ["borough", "created_month"] + (["created_year"] if with_year else [])
    w = Window.partitionBy(*part).orderBy(F.col("total_requests").desc())
    cols = (["created_year"] if with_year else []) + [
        "created_month", "borough", "complaint_category", "total_requests", "category_rank"]
    return (monthly.withColumn("category_rank", F.rank().over(w))
            .where(F.col("category_rank") == 1)
            .select(*cols)
            .orderBy(*(["created_year"] if with_year else []), "created_month", "borough",
                     "complaint_category"))


def category_totals_ytd(monthly: DataFrame) -> DataFrame:
    """Per category: summed volume and the *unweighted* mean of the monthly
    averages (2 dp), volume descending."""
    cents = hours_to_cents(F.col("avg_resolution_hours"))
    return (monthly.groupBy("complaint_category").agg(
                F.sum("total_requests").alias("total_requests"),
                half_up_avg_cents(F.sum(cents), F.count(cents)).alias("avg_resolution_hours"))
            .orderBy(F.col("total_requests").desc(), F.col("complaint_category").asc_nulls_last()))


def daily_trend(daily: DataFrame, borough: str | None = None) -> DataFrame:
    """Total requests per day (optionally of one borough)."""
    df = daily if borough is None else daily.where(F.col("borough") == F.lit(borough))
    return (df.groupBy("request_date").agg(F.sum("total_requests").alias("total_requests"))
            .orderBy("request_date"))


def borough_category_totals(monthly: DataFrame) -> DataFrame:
    """Total requests per (borough, category): the stacked-bar view."""
    return (monthly.groupBy("borough", "complaint_category")
            .agg(F.sum("total_requests").alias("total_requests"))
            .orderBy("borough", "complaint_category"))


def borough_category_pivot(monthly: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Wide form: one row per borough, one column per category (fixed list, so
    no extra job to discover the values)."""
    return (monthly.groupBy("borough").pivot("complaint_category", list(categories))
            .agg(F.sum("total_requests")).orderBy("borough"))


def resolution_by_category(curated: DataFrame, borough: str | None = None) -> DataFrame:
    """Request-weighted mean resolution hours per category over closed
    requests, slowest first."""
    df = curated if borough is None else curated.where(F.col("borough") == F.lit(borough))
    hours = F.col("resolution_hours")
    return (df.where(hours.isNotNull()).groupBy("complaint_category").agg(
                half_up_avg_cents(F.sum(hours_to_cents(hours)), F.count(hours))
                .alias("avg_resolution_hours"),
                F.count(F.lit(1)).alias("closed_requests"))
            .orderBy(F.col("avg_resolution_hours").desc_nulls_last(),
                     F.col("complaint_category").asc_nulls_last()))


def reconcile(fact: DataFrame, mart: DataFrame, label: str) -> DataFrame:
    """``count(*)`` of the fact vs ``sum(total_requests)`` of a mart (one row)."""
    a = fact.agg(F.count(F.lit(1)).alias("raw_total"))
    b = mart.agg(F.coalesce(F.sum("total_requests"), F.lit(0)).cast("long").alias(f"{label}_total"))
    return side_by_side([a, b]).withColumn("match", F.col("raw_total") == F.col(f"{label}_total"))


def fractional_hours(requests: DataFrame) -> DataFrame:
    """Per-request resolution hours with sub-hour precision (rounding check)."""
    return requests.select("unique_key", "complaint_type",
                           resolution_hours("created_date", "closed_date").alias("resolution_hours"))


def fractional_hours_summary(requests: DataFrame) -> DataFrame:
    """Exact per-type mean of the sub-hour resolution times."""
    h = fractional_hours(requests)
    hours = F.col("resolution_hours")
    return h.groupBy("complaint_type").agg(
        F.count(F.lit(1)).alias("requests"),
        half_up_avg_cents(F.sum(hours_to_cents(hours)), F.count(hours)).alias("avg_resolution_hours"),
        F.min(hours).alias("min_resolution_hours"), F.max(hours).alias("max_resolution_hours"))

