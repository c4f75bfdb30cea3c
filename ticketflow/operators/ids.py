"""Surrogate ids = 1-based position in key order.

A dimension is first counted (one aggregate job, a scalar to the driver).
Up to ``local_rows`` rows — a proven bound — it is numbered by one
``row_number() OVER (ORDER BY k)`` task. Beyond that, rows are
range-partitioned on ``k`` and the partition index is kept in a reliable
checkpoint (fixed under AQE re-planning and task retries); each range
numbers its own rows and a prefix sum over the per-range counts — one row
per range, broadcast — offsets them. Keys must be unique (dimension keys are).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.session import ensure_checkpoint_dir


def sequential_ids(df: DataFrame, key: str, id_col: str, local_rows: int = 1_000_000,
                   partitions: int | None = None) -> DataFrame:
    order = F.col(key).asc_nulls_first()
    if df.count() <= local_rows:
        return df.withColumn(id_col, F.row_number().over(Window.orderBy(order)).cast("long"))
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, local = "__range", "__local"
    ranged = (df.repartitionByRange(n, order)
              .withColumn(part, F.spark_partition_id())
              .checkpoint(eager=True))
    numbered = ranged.withColumn(local, F.row_number().over(Window.partitionBy(part).orderBy(order)))
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        part,
        F.coalesce(F.sum("__n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    out = numbered.join(F.broadcast(offsets), part, "inner")  # one row per range
    return out.withColumn(id_col, (F.col("__off") + F.col(local)).cast("long")).drop(part, local, "__off")
