"""File sinks and their read-back scans: CSV, partitioned Parquet, mirrors,
catalog tables over existing Parquet, and the serving-table load.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.functions.numeric import nan_to_null
from ticketflow.operators.hash_tree import BUCKETS, compare_trees, hash_tree
from ticketflow.operators.onerow import side_by_side
from ticketflow.session import ROWS_PER_TASK, path_exists, scratch_path, sized_shuffles

# CSV options that keep text exactly (outer spaces, embedded quotes/newlines).
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "escape": '"', "quoteAll": "false"}
CSV_READ = {"header": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "escape": '"', "multiLine": "true"}


# Rows up to which an export may go through one task into one file.
SINGLE_FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              single_file_rows: int = SINGLE_FILE_ROWS, compression: str | None = None) -> None:
    """CSV with header, overwrite. ``single_file`` (for small marts handed to
    a BI tool) writes one file if the counted rows are within the bound;
    larger frames stay several files. ``compression`` (such as ``gzip``) is for large
    landings: files of at most ``ROWS_PER_TASK`` rows, as each is then read by one task."""
    out = df.coalesce(1) if single_file and df.count() <= single_file_rows else df
    w = out.write.mode("overwrite").options(**CSV_WRITE)
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_TASK)
    w.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with header and a declared schema (no inference job)."""
    return spark.read.schema(schema).options(**CSV_READ).csv(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str],
                      mode: str = "overwrite") -> None:
    """Partitioned Parquet; rebalanced first so AQE sizes the files per value
    (big values split over tasks, small ones merged) instead of every task
    writing a small file for every value."""
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; ``col=value`` directories become partition columns."""
    return spark.read.parquet(path)


def ddl_columns(schema: T.StructType, exclude: Sequence[str] = ()) -> str:
    """Column DDL from a schema (Spark type names), skipping ``exclude``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
                     if f.name not in exclude)


def register_external_table(spark: SparkSession, database: str, table: str, path: str,
                            partition_cols: Sequence[str]) -> str:
    """Catalog table over existing partitioned Parquet; partitions registered.

    DDL is generated from the data's own schema, data columns and partition
    columns separated; returns the qualified table name.
    """
    schema = spark.read.parquet(path).schema
    data_cols = ddl_columns(schema, exclude=partition_cols)
    part_cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
                          if f.name in partition_cols)
    name = f"`{database}`.`{table}`"
    if not spark.catalog.databaseExists(database):
        # a new database gets a shared location, never a machine-local warehouse
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` "
                  f"LOCATION '{scratch_path(spark, 'db-' + database)}'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({data_cols}, {part_cols}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def mirror(spark: SparkSession, src: DataFrame, dst_path: str,
           partition_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """Copy a dataset to another filesystem URI and read the copy back."""
    if partition_by:
        src = src.hint("rebalance", *partition_by)
    w = src.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(dst_path)
    return spark.read.format(fmt).load(dst_path)


def _kept(spark: SparkSession, name: str):
    def keep(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return keep


def _bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``missing_rows`` of ``left`` and ``extra_rows`` of ``right``, each row as often as it has no partner.

    Both counts of the ``exceptAll`` of either side come from one shuffle of the rows.
    """
    n = "__copies"
    both = left.withColumn(n, F.lit(1).cast("long")).union(right.withColumn(n, F.lit(-1).cast("long")))
    more = F.col(n)
    per_row = both.groupBy(*[F.col(f"`{c}`") for c in left.columns]).agg(F.sum(n).alias(n))
    return per_row.agg(F.coalesce(F.sum(F.when(more > 0, more)), F.lit(0)).cast("long").alias("missing_rows"),
                       F.coalesce(F.sum(F.when(more < 0, -more)), F.lit(0)).cast("long").alias("extra_rows"))


def reconcile_copy(src: DataFrame, copy: DataFrame, compare_rows: bool = False, key: Sequence[str] = (),
                   partition_by: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Counts and row-content differences (bag semantics) of a copy, one row.

    Both sides get a hash tree (one aggregate scan each, see ``hash_tree``); counts come
    from the roots. Only rows of leaves that differ are compared, with their numbers of
    copies, in one aggregate for both ways, so a copy with few damaged rows costs little more than
    the two scans. ``key`` keeps an altered row in the leaf of its original,
    ``partition_by`` makes differing partitions filters of the scan.
    Equal sums of different rows are possible but improbable; ``compare_rows``
    compares all rows whatever the trees say.
    """
    spark, cols = src.sparkSession, src.columns
    copy = copy.select(*[F.col(f"`{c}`") for c in cols])
    keep = _kept(spark, "hash-leaves")
    trees = [hash_tree(df, key, partition_by, buckets, keep) for df in (src, copy)]
    one = side_by_side([t.leaves.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias(n))
                        for t, n in zip(trees, ("source_rows", "copy_rows"))])
    if compare_rows:
        left, right = src, copy
    else:
        found = compare_trees(*trees, keep)
        left, right = (found.rows(src), found.rows(copy)) if found else (src.limit(0), copy.limit(0))
    # the counts bound the rows that are compared
    rows = one.agg((F.sum("source_rows") + F.sum("copy_rows")).alias("n")).first()["n"]
    with sized_shuffles(spark, -(-rows // ROWS_PER_TASK)):
        differing = _kept(spark, "differing-rows")(_bag_difference(left, right))
    one = side_by_side([one, differing])
    return one.withColumn("match", (F.col("source_rows") == F.col("copy_rows"))
                          & (F.col("missing_rows") == 0) & (F.col("extra_rows") == 0))


def serving_load(spark: SparkSession, df: DataFrame, columns: Sequence[str], path: str,
                 table: str) -> DataFrame:
    """Truncate-and-reload of a serving table with the listed columns.

    NaN becomes NULL first; the reload is an overwrite of the table's
    storage. Returns (table, source_rows, loaded_rows, match). On a JDBC
    target the same frame goes to ``write.jdbc(mode="overwrite",
    truncate=True)``; no rows pass through the driver.
    """
    out = nan_to_null(df.select(*columns))
    out.write.mode("overwrite").parquet(path)
    loaded = spark.read.parquet(path)
    a = df.agg(F.count(F.lit(1)).alias("source_rows"))
    b = loaded.agg(F.count(F.lit(1)).alias("loaded_rows"))
    return (side_by_side([a, b]).select(F.lit(table).alias("table_name"), "source_rows", "loaded_rows")
            .withColumn("match", F.col("source_rows") == F.col("loaded_rows")))


PARTS = ("valid", "rejected")


@contextmanager
def _open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Tasks of partitioned writes run inside keep fewer than ``n`` files open instead of sorting their rows by partition."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(name)
    spark.conf.set(name, str(max(int(old), n)))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def write_split(flagged: DataFrame, path: str, reasons_col: str = "_rejection_reasons") -> DataFrame:
    """Valid and rejected rows by one write, and the counts of the report observed in it.

    The rows go to ``part=valid`` and ``part=rejected`` under ``path`` as CSV with
    header, in one scan of ``flagged``; both keep the reason column, which is empty
    for valid rows and left out when they are read (``read_split``). A task writes both
    sides at once, so that its rows are not sorted by side. Returns the observed
    totals as one row (see ``quality.total_metrics``).
    """
    from ticketflow.operators.quality import total_metrics
    from ticketflow.settings import REJECTION_REASONS
    spark = flagged.sparkSession
    seen = Observation(f"split_{uuid.uuid4().hex[:8]}")
    rows = (flagged.observe(seen, *total_metrics())
            .drop(*[c for c in REJECTION_REASONS if c in flagged.columns])
            .withColumn("part", F.when(F.col(reasons_col) == "", F.lit(PARTS[0])).otherwise(F.lit(PARTS[1]))))
    with _open_writers(spark, len(PARTS) + 1):  # at this number a task begins to sort
        rows.write.mode("overwrite").options(**CSV_WRITE).partitionBy("part").csv(path)
    return spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in seen.get.items()])


def read_split(spark: SparkSession, path: str, part: str, schema: T.StructType, multiline: bool = False,
               reasons_col: str = "_rejection_reasons") -> DataFrame:
    """One side of a split as rows of ``schema`` (the raw columns; rejected rows with the reason column).

    Files split by size; ``multiline`` is for values with line breaks, one task a file.
    """
    full = schema if reasons_col in schema.names else T.StructType([*schema.fields, T.StructField(reasons_col, T.StringType())])
    options = {**CSV_READ, "multiLine": str(multiline).lower()}
    folder = f"{path.rstrip('/')}/part={part}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)  # a side without rows has no folder
    return spark.read.schema(full).options(**options).csv(folder).select(*[F.col(f"`{c}`") for c in schema.names])


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as a single JSON file (the frame is one row)."""
    report.coalesce(1).write.mode("overwrite").json(path)
