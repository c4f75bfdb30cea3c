"""Marts that follow an append: partial states by batch, refreshed where they changed.

A state row holds what a mart group needs in a form that adds up: rows, closed and
unresolved rows, and the number and sum of resolution times in hundredths. Each
batch stores the states of its own rows in its own folder, sorted by month. A refresh
sums the states of the months that the batch touched (months are pushed-down filters)
and overwrites only their partitions of the mart; curated rows are never read again.
Running a batch again replaces its states, so nothing is counted twice; the months that it
held before are refreshed too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.functions.timecols import half_up_avg_cents, hours_to_cents
from ticketflow.plans.marts import DAILY_KEY, MONTHLY_KEY
from ticketflow.session import path_exists
from ticketflow.settings import CLOSED_STATUS

PARTITIONS = ("created_year", "created_month")
STATE = ("total_requests", "closed_requests", "unresolved_requests", "closed_hours", "hour_cents")


@dataclass(frozen=True)
class MartSpec:
    """Group columns of a mart and how they follow from curated rows."""

    name: str
    key: tuple[str, ...]
    columns: dict[str, Column] | None = None


MONTHLY = MartSpec("monthly", MONTHLY_KEY)


def daily_spec() -> MartSpec:
    return MartSpec("daily", DAILY_KEY, {"request_date": F.to_date("created_date")})


def partial_states(curated: DataFrame, spec: MartSpec) -> DataFrame:
    """The state of every group of ``curated``, with the partition columns of its month."""
    rows = curated.withColumns(spec.columns) if spec.columns else curated
    hours = F.col("resolution_hours")
    keys = list(dict.fromkeys([*spec.key, *PARTITIONS]))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_requests"), F.count_if(F.col("status") == CLOSED_STATUS).alias("closed_requests"),
        F.count_if(hours.isNull()).alias("unresolved_requests"), F.count(hours).alias("closed_hours"),
        F.sum(hours_to_cents(hours)).alias("hour_cents"))


def mart_of_states(states: DataFrame, spec: MartSpec) -> DataFrame:
    """The mart rows that the states add up to."""
    keys = list(dict.fromkeys([*spec.key, *PARTITIONS]))
    total = states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in STATE])
    return total.select(*keys, "total_requests",
                        half_up_avg_cents(F.col("hour_cents"), F.col("closed_hours")).alias("avg_resolution_hours"),
                        "closed_requests", "unresolved_requests")


class MergeableMart:
    """States and mart of one spec under ``path``."""

    def __init__(self, spark: SparkSession, path: str, spec: MartSpec):
        self.spark, self.spec = spark, spec
        self.states, self.mart = f"{path.rstrip('/')}/states", f"{path.rstrip('/')}/mart"

    def _overwrite(self, df: DataFrame, path: str, by: tuple[str, ...]) -> None:
        """Replace the partitions that ``df`` has rows of, and no others."""
        (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(path))

    def _months(self, states: DataFrame) -> list[tuple[int | None, int | None]]:
        """The months of some states: a dozen rows a year."""
        return [tuple(r) for r in states.select(*PARTITIONS).distinct().collect()]

    def append(self, curated: DataFrame, batch: int) -> list[tuple[int | None, int | None]]:
        """Store the states of a batch and refresh the months that it touches; returns those months.

        A month whose last rows a changed rerun takes away keeps its old mart rows.
        """
        spark, own = self.spark, f"{self.states}/batch={batch}"
        states = partial_states(curated, self.spec).withColumn("batch", F.lit(batch))
        schema = states.schema
        every = (spark.read.schema(schema).parquet(self.states) if path_exists(spark, self.states)
                 else spark.createDataFrame([], schema))
        before = self._months(every.where(F.col("batch") == batch))
        (states.drop("batch").repartition(*PARTITIONS).sortWithinPartitions(*PARTITIONS)
         .write.mode("overwrite").parquet(own))
        every = spark.read.schema(schema).parquet(self.states)
        months = sorted({*before, *self._months(every.where(F.col("batch") == batch))}, key=repr)
        if not months:
            return []
        touched = F.lit(False)
        for y, m in months:
            touched = touched | (F.col(PARTITIONS[0]).eqNullSafe(F.lit(y)) & F.col(PARTITIONS[1]).eqNullSafe(F.lit(m)))
        self._overwrite(mart_of_states(every.where(touched), self.spec), self.mart, PARTITIONS)
        return months

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.mart)
