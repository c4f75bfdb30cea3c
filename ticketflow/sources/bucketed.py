"""Tables bucketed and sorted by key, so that work by key needs no exchange.

Rows of a key lie in one bucket file of a catalog table, sorted by key. Aggregates
and joins by that key between tables of the same number of buckets then read their
buckets side by side, once written. A bucket is the unit of work, so their number
follows that of the rows (``buckets_for``), and this storage is for keys that are meant to be unique, not for keys that hold a large share of the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.dedup import dedup_first
from ticketflow.session import ROWS_PER_TASK, on_exit, scratch_path

_DATABASES: dict[str, str] = {}


def _database(spark: SparkSession) -> str:
    """A database under the checkpoint folder, one an application, dropped when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _DATABASES:
        name = "ticketflow_buckets_" + uuid.uuid4().hex[:8]
        spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db-buckets')}'")
        on_exit(spark, lambda: spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE"))
        _DATABASES[app] = name
    return _DATABASES[app]


# Spark's own limit (spark.sql.sources.bucketing.maxBuckets).
MAX_BUCKETS = 100_000


def buckets_for(rows: int, at_least: int, rows_per_bucket: int = ROWS_PER_TASK) -> int:
    """Buckets that hold about ``rows_per_bucket`` rows each: ``at_least``, doubled as often as needed.

    Numbers of this form divide each other, and tables of one number are joined without an exchange.
    """
    n = at_least
    while n * rows_per_bucket < rows and n * 2 <= MAX_BUCKETS:
        n *= 2
    return n


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, database: str | None = None) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` buckets sorted by ``key`` and read it back.

    Rows are dealt by the key first, so that each bucket is one file.
    """
    spark = df.sparkSession
    table = f"`{database or _database(spark)}`.`{name}`"
    (df.repartition(buckets, F.col(f"`{key}`")).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .format("parquet").saveAsTable(table))
    return spark.table(table)


def dedup_bucketed(table: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row a key, the first in ``order``, of a table bucketed by ``key``: no exchange."""
    return dedup_first(table, key, order, check_unique=False)


def join_bucketed(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Sort-merge join by ``key`` of two tables with the same buckets: no exchange."""
    return left.hint("merge").join(right, key, how)
