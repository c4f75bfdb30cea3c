"""Keyset slices, resume cursors and landed JSON pages.

The source API is read in keyset order ``(created_date, unique_key)``: a page
is "rows after the cursor, in order, first n". Here the same slice is a
filter + ``orderBy`` + ``limit`` (planned as ``TakeOrderedAndProject``, a
per-task top-n and a merge — no full sort), and the resume cursor of an
existing landing is one aggregate (``max`` of the order tuple + ``count``).
The date range and cursor predicates reach the Parquet scan as pushed
filters where they are on stored columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.arrow import map_arrow
from ticketflow.functions.timecols import parse_ts


def in_date_range(c: str | Column, start: str, end: str) -> Column:
    """``start 00:00:00 <= ts <= end 23:59:59`` (whole seconds, inclusive)."""
    ts = parse_ts(F.col(c) if isinstance(c, str) else c)
    lo = F.lit(f"{start} 00:00:00").try_cast("timestamp_ntz")
    hi = F.lit(f"{end} 23:59:59").try_cast("timestamp_ntz")
    return ts.between(lo, hi)


def after_cursor(cols: Sequence[Column], values: Sequence[Any]) -> Column:
    """Lexicographic ``(cols) > (values)`` with NULLs ordered last.

    ``values`` are literals (a resume cursor is one row), so NULL handling
    is resolved while building the predicate.
    """
    pred = F.lit(False)
    eq_prefix = F.lit(True)
    for c, v in zip(cols, values):
        if v is None:
            gt, eq = F.lit(False), c.isNull()
        else:
            gt, eq = c.isNull() | (c > F.lit(v)), c.isNotNull() & (c == F.lit(v))
        pred = pred | (eq_prefix & gt)
        eq_prefix = eq_prefix & eq
    return pred


def order_columns(order: Sequence[Column]) -> list[Column]:
    return [c.asc_nulls_last() for c in order]


def keyset_page(df: DataFrame, order: Sequence[Column], cursor: Sequence[Any] | None,
                limit: int, where: Column | None = None) -> DataFrame:
    """First ``limit`` rows after ``cursor`` (a prefix of ``order``) in ``order``."""
    if where is not None:
        df = df.where(where)
    if cursor is not None:
        df = df.where(after_cursor(order[:len(cursor)], cursor))
    return df.orderBy(*order_columns(order)).limit(max(0, int(limit)))


def page_limit(page_size: int, max_records: int | None, written: int) -> int:
    """Rows to ask for next: the page size, capped by the remaining quota."""
    if max_records is None:
        return page_size
    return max(0, min(page_size, max_records - written))


def same_as_cursor(cols: Sequence[Column], values: Sequence[Any]) -> Column:
    """``(cols) = (values)``, NULLs equal."""
    pred = F.lit(True)
    for c, v in zip(cols, values):
        pred = pred & (c.isNull() if v is None else c.isNotNull() & (c == F.lit(v)))
    return pred


def last_landed(landed: DataFrame, order: Sequence[Column], report: Sequence[str] = ()) -> DataFrame:
    """One row: the maximum ``m`` of the order tuple (NULLs last) and ``rows_written``.

    ``m.v0 …`` are the order values (parsed ones, so mixed text formats of one
    column don't matter), ``m.r0 …`` the ``report`` columns of that row.
    """
    fields = []
    for i, c in enumerate(order):
        fields += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    fields += [F.col(c).alias(f"r{i}") for i, c in enumerate(report)]
    return landed.agg(F.max(F.struct(*fields)).alias("m"), F.count(F.lit(1)).alias("rows_written"))


def resume_cursor(landed: DataFrame, order: Sequence[Column], report: Sequence[str]) -> DataFrame:
    """One row: the ``report`` columns of the last landed row (``last_*``) and the row count.

    Rows are landed in cursor order, so the last row is the maximum of the
    order tuple. An empty landing gives NULLs and 0.
    """
    return last_landed(landed, order, report).select(
        *[F.col(f"m.r{i}").alias(f"last_{c}") for i, c in enumerate(report)], "rows_written")


# Rows of the pages that share a file: a compressed file is read by one task.
FILE_ROWS = 250_000


def _page_lines(page_size: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[dict]]:
    """JSON texts of rows to JSON arrays of ``page_size`` consecutive ones (the last of fewer)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        held: list[str] = []
        for batch in batches:
            rows = batch.column(0).to_pylist()
            at = 0
            while at < len(rows):
                more = rows[at:at + page_size - len(held)]
                held, at = [*held, *more], at + len(more)
                if len(held) == page_size:
                    yield {"value": [f"[{','.join(held)}]"]}
                    held = []
        if held:
            yield {"value": [f"[{','.join(held)}]"]}

    return run


def land_pages(df: DataFrame, path: str, page_size: int, file_rows: int = FILE_ROWS) -> None:
    """Write rows as JSON pages: one JSON array of up to ``page_size`` rows per line, gzip-compressed.

    A page is ``page_size`` consecutive rows of one input partition, put together in the
    task that reads them, so nothing is shuffled or sorted and a task holds one page,
    whatever the key distribution or the number of identical copies. A file has
    ``file_rows`` rows or one page, so its share of a later scan is bounded too.
    """
    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    (map_arrow(rows, _page_lines(page_size), "value string").write.mode("overwrite")
     .option("maxRecordsPerFile", max(1, file_rows // page_size)).option("compression", "gzip").text(path))


def read_pages(spark: SparkSession, path: str, schema: T.StructType,
               multiline: bool = False) -> DataFrame:
    """Scan JSON pages with a declared schema: an array on each line, or with
    ``multiline`` one array per file, over any number of lines."""
    return (spark.read.schema(schema).option("multiLine", multiline).json(path)
            .select(*[f.name for f in schema.fields]))
