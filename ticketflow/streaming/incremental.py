"""Incremental landing: fresh slice, resume from the landed cursor, append.

The source is pulled in cursor order. A landing that already holds rows is
resumed from its last row — the maximum of the order tuple, one aggregate. Rows
after that cursor are appended, and so are rows that tie with it and are not
landed yet (a difference of multisets over the tied rows only), so a pull that
was cut inside a group of ties is completed. A fresh landing overwrites.
Spark needs no page loop: all of that is one batch.

``stream_landed_files`` is the Structured Streaming form of the same idea
for landed page files: the file source's checkpoint remembers which files
were processed, so each ``availableNow`` run appends exactly the new ones.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ticketflow.session import scratch_path
from ticketflow.sources import pages as PG

# Landed files that one micro-batch takes.
FILES_PER_BATCH = 10_000
# Name of the count that a landing stream observes, and how long its last events may take.
LANDED = "landed_rows"
LISTENER_SECONDS = 60


def _cursor_values(landed: DataFrame, order: Sequence[Column]) -> tuple[list[Any] | None, int]:
    """Last landed order tuple (NULLs last) and row count — one row to the driver.

    Values come back as typed literal columns (text cast to the order
    column's own type), so a ``timestamp_ntz`` cursor stays wall-clock time
    whatever the session time zone.
    """
    agg = PG.last_landed(landed, order)
    types = {f.name: f.dataType for f in agg.schema["m"].dataType.fields}
    row = agg.first()
    if row is None or row["rows_written"] == 0 or row["m"] is None:
        return None, 0
    values: list[Any] = []
    for i in range(len(order)):
        v = row["m"][f"v{i}"]
        t = types[f"v{i}"]
        if v is None or isinstance(t, T.StringType):
            values.append(v)
        elif isinstance(t, (T.FloatType, T.DoubleType)):
            values.append(F.lit(repr(float(v))).cast(t))
        else:
            values.append(F.lit(str(v)).cast(t))
    return values, int(row["rows_written"])


def land(df: DataFrame, path: str, resume: bool) -> None:
    df.write.mode("append" if resume else "overwrite").parquet(path)


def first_landing(spark: SparkSession, source: DataFrame, start: str, end: str,
                  order: Sequence[Column], rows: int, path: str | None = None,
                  ts_col: str = "created_date") -> DataFrame:
    """A fresh landing of the first ``rows`` rows of the range (a capped pull).

    ``ts_col`` is the column the date range applies to (text is parsed; a
    stored timestamp column makes the range a pushed-down scan filter)."""
    path = path or scratch_path(spark, "landing")
    page = PG.keyset_page(source, order, None, rows, where=PG.in_date_range(ts_col, start, end))
    land(page, path, resume=False)
    return spark.read.parquet(path)


def resume_and_append(spark: SparkSession, source: DataFrame, start: str, end: str,
                      order: Sequence[Column], path: str, max_records: int | None = None,
                      ts_col: str = "created_date") -> DataFrame:
    """Append what the landing lacks (up to the remaining quota); returns the landing.

    ``max_records`` caps the landing as a whole, with the rows landed before.
    """
    landed = spark.read.parquet(path)
    cursor, written = _cursor_values(landed, order)
    in_range = source.where(PG.in_date_range(ts_col, start, end))
    rest = in_range
    if cursor is not None:
        tied = PG.same_as_cursor(order, cursor)
        missed = in_range.where(tied).exceptAll(landed.select(*source.columns).where(tied))
        rest = in_range.where(PG.after_cursor(order, cursor)).unionByName(missed)
    if max_records is not None:
        rest = rest.orderBy(*PG.order_columns(order)).limit(max(0, max_records - written))
    if cursor is not None:
        # the plan reads the landing that it appends to
        staged = f"{path.rstrip('/')}-batch-{uuid.uuid4().hex[:8]}"
        land(rest, staged, resume=False)
        rest = spark.read.schema(rest.schema).parquet(staged)
    land(rest, path, resume=cursor is not None)
    return spark.read.parquet(path)


def incremental_slice(spark: SparkSession, source: DataFrame, start: str, end: str,
                      order: Sequence[Column], first_rows: int,
                      ts_col: str = "created_date", max_records: int | None = None) -> DataFrame:
    """Fresh landing of ``first_rows`` rows, then a resumed append of the rest
    (up to ``max_records`` in all)."""
    path = scratch_path(spark, "landing")
    first = first_rows if max_records is None else min(first_rows, max_records)
    first_landing(spark, source, start, end, order, first, path, ts_col=ts_col)
    return resume_and_append(spark, source, start, end, order, path, max_records, ts_col=ts_col)


def manifest(landed: DataFrame, order: Sequence[Column], start: str, end: str,
             max_records: int | None, output: str | None = None, started: str | None = None,
             finished: str | None = None, completed: bool = True) -> DataFrame:
    """One row describing a landing: range, cap, output, times, rows, last cursor, completion."""
    cur = PG.resume_cursor(landed, order, ["created_date", "unique_key"])
    return cur.select(
        F.lit(output).cast("string").alias("output_location"),
        F.lit(started).cast("string").alias("started_at"),
        F.lit(finished).cast("string").alias("finished_at"),
        F.lit(start).alias("query_start_date"),
        F.lit(end).alias("query_end_date"),
        F.lit(max_records).cast("long").alias("max_records_cap"),
        F.col("rows_written").alias("total_records_downloaded"),
        F.col("last_created_date").alias("last_cursor_created_date"),
        F.col("last_unique_key").alias("last_cursor_unique_key"),
        F.lit(completed).alias("completed"),
    )


def stream_landed_files(spark: SparkSession, landing_dir: str, schema: T.StructType,
                        sink_dir: str, checkpoint_dir: str, fmt: str = "json",
                        multiline: bool = True, files_per_batch: int = FILES_PER_BATCH) -> int:
    """Append every not-yet-processed landed file to ``sink_dir`` (Parquet).

    Runs one ``availableNow`` micro-batch sequence and stops; the checkpoint
    records processed files, so a rerun after new files land picks up only
    those. A backlog is taken in batches of at most ``files_per_batch`` files.
    Returns the number of rows the run appended: rows are counted as they are
    written, and a batch that is tried again counts once.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "json":
        reader = reader.option("multiLine", multiline)
    stream = (reader.load(landing_dir).select(*[f.name for f in schema.fields])
              .observe(LANDED, F.count(F.lit(1)).alias("rows")))
    counter = _LandedRows()
    spark.streams.addListener(counter)
    try:
        q = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start(sink_dir))
        counter.run_id = str(q.runId)
        q.awaitTermination()
        counter.ended.wait(LISTENER_SECONDS)
    finally:
        spark.streams.removeListener(counter)
    return counter.total()


class _LandedRows(StreamingQueryListener):
    """Rows of every batch, kept by run: progress kept by a query itself is cut after 100 batches."""

    def __init__(self) -> None:
        self.rows: dict[tuple[str, int], int] = {}
        self.run_id = ""
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(LANDED)
        if seen is not None:
            self.rows[str(event.progress.runId), event.progress.batchId] = seen["rows"]

    def onQueryTerminated(self, event) -> None:
        # events come in order, so every batch of that run has been counted
        if not self.run_id or str(event.runId) == self.run_id:
            self.ended.set()

    def total(self) -> int:
        return sum(n for (run, _), n in self.rows.items() if run == self.run_id)
