"""The marts in the catalog: external table in place, managed marts, a view.

The curated stage table is registered as an external partitioned table where
it lies (no copy). Both marts are dropped and created again as managed tables
from their one definition in ``marts``; the database lives under the
checkpoint folder, never in a machine-local warehouse. Queries over the catalog
use the functions of ``marts`` on ``spark.table``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.transform import PARTITION_COLUMNS
from ticketflow.plans import marts as M
from ticketflow.plans.flow import Stages
from ticketflow.session import on_exit, scratch_path
from ticketflow.sources import files as FS

REQUESTS, MONTHLY, DAILY = ("service_requests", "borough_category_monthly_summary",
                            "borough_category_daily_summary")
YTD = "category_totals_ytd"


class SqlCatalog:
    """One database with the curated table registered at ``path`` and both marts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.db = "ticketflow_" + uuid.uuid4().hex[:12]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db} LOCATION '{scratch_path(spark, 'db')}'")
        on_exit(spark, lambda: spark.sql(f"DROP DATABASE IF EXISTS {self.db} CASCADE"))
        FS.register_external_table(spark, self.db, REQUESTS, path, PARTITION_COLUMNS)
        self.build_marts()

    def name(self, table: str) -> str:
        return f"`{self.db}`.`{table}`"

    def build_marts(self) -> None:
        """Drop and create both marts (idempotent reruns)."""
        for table, mart in ((MONTHLY, M.monthly_summary), (DAILY, M.daily_summary)):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            mart(self.requests()).write.saveAsTable(self.name(table))

    def requests(self) -> DataFrame:
        return self.spark.table(self.name(REQUESTS))

    def monthly(self) -> DataFrame:
        return self.spark.table(self.name(MONTHLY))

    def daily(self) -> DataFrame:
        return self.spark.table(self.name(DAILY))

    def create_view(self) -> str:
        """Create or replace the stored year-to-date view; any session of the catalog can read it.

        Averages of the monthly averages are exact integer HALF_UP, as in ``marts``.
        """
        cents, n = "cast(round(avg_resolution_hours * 100) as decimal(38,0))", "cast(count(avg_resolution_hours) as decimal(38,0))"
        name = self.name(YTD)
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {name} AS
            SELECT complaint_category, sum(total_requests) AS total_requests,
              CASE WHEN count(avg_resolution_hours) > 0
                THEN ((cast(sum({cents}) as decimal(38,0)) * 2 + {n}) div ({n} * 2)) / 100D END AS avg_resolution_hours
            FROM {self.name(MONTHLY)} GROUP BY complaint_category
            ORDER BY total_requests DESC, complaint_category ASC NULLS LAST""")
        return name

    def ytd_view(self) -> DataFrame:
        """The stored view, read through a session of its own."""
        return self.spark.newSession().table(self.create_view())

    def tables(self) -> DataFrame:
        """The table listing of the database (views left out)."""
        return (self.spark.sql(f"SHOW TABLES IN {self.db}").where("not isTemporary").where(F.col("tableName") != YTD)
                .select(F.col("tableName").alias("table_name")))

    def table_rows(self) -> DataFrame:
        """(table_name, rows) of every listed table."""
        out = None
        for r in self.tables().collect():  # the three tables of this catalog
            one = self.spark.table(self.name(r.table_name)).agg(F.count(F.lit(1)).alias("rows"))
            one = one.select(F.lit(r.table_name).alias("table_name"), "rows")
            out = one if out is None else out.unionByName(one)
        return out


_CATALOGS: dict[tuple, SqlCatalog] = {}


def catalog_for(spark: SparkSession, stages: Stages) -> SqlCatalog:
    """The catalog over the stages' curated table, built once per written table."""
    path = stages.path_of("curated")
    key = (spark.sparkContext.applicationId, path)
    if key not in _CATALOGS:
        _CATALOGS[key] = SqlCatalog(spark, path)
    return _CATALOGS[key]
