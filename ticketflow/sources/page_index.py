"""Pages in cursor order and a sparse index, so that a slice opens few page files.

``land_sorted_pages`` writes rows in the order of the cursor, at most
``page_rows`` to a file, so the files hold consecutive ranges. The index has one row
for each file: first and last cursor and the number of rows. A slice after a cursor
finds its first file by binary search over the last cursors and stops at the file in
which the limit or the end of the range must be reached; other files are not opened.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from datetime import datetime
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.sources import pages as PG

# One index row a file: at 100 TB and 128 MB a file, under a million.
MAX_INDEX_ROWS = 5_000_000


def land_sorted_pages(df: DataFrame, path: str, order: Sequence[str], page_rows: int) -> None:
    """Write ``df`` as Parquet page files of consecutive rows in ``order`` (NULLs last).

    Ranges are sorted on their own, each in its own files; rows that tie in the whole
    order lie in one range, which is cut into files of ``page_rows`` like any other.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").option("maxRecordsPerFile", page_rows).parquet(path))


def _cursor(order: Sequence[str]) -> Column:
    """Compares like ``order`` with NULLs last, whatever engine compares it."""
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def build_index(spark: SparkSession, pages: str, order: Sequence[str], index: str) -> DataFrame:
    """Write the index of landed pages ``(file, first, last, rows)``, in cursor order; one scan of the order columns."""
    cursor = _cursor(order)
    rows = (spark.read.parquet(pages).select("*", F.col("_metadata.file_path").alias("file")).groupBy("file")
            .agg(F.min(cursor).alias("first"), F.max(cursor).alias("last"), F.count(F.lit(1)).alias("rows")))
    rows.repartitionByRange(F.col("first"), F.col("last")).sortWithinPartitions("first", "last").write.mode("overwrite").parquet(index)
    return spark.read.parquet(index)


def _key(values: Sequence[Any]) -> tuple:
    """Python form of a cursor: NULLs after values."""
    return tuple((v is None, 0 if v is None else v) for v in values)


def _struct_key(row: T.Row, n: int) -> tuple:
    return _key([row[f"v{i}"] for i in range(n)])


class PageIndex:
    """The index in memory: one entry a page file, checked against a bound."""

    def __init__(self, index: DataFrame, columns: int, max_rows: int = MAX_INDEX_ROWS):
        entries = index.orderBy("first", "last", "file").limit(max_rows + 1).collect()
        if len(entries) > max_rows:
            raise ValueError(f"more than {max_rows} page files; land larger pages")
        entries.sort(key=lambda r: (_struct_key(r["first"], columns), _struct_key(r["last"], columns)))
        self.files = [r.file for r in entries]
        self.first = [_struct_key(r["first"], columns) for r in entries]
        self.last = [_struct_key(r["last"], columns) for r in entries]
        self.passed = [0, *accumulate(r["rows"] for r in entries)]

    def files_for(self, after: Sequence[Any] | None, limit: int | None = None,
                  until: Sequence[Any] | None = None) -> list[str]:
        """Files that can hold the first ``limit`` rows after the cursor ``after`` and up to ``until``.

        Both may be prefixes of the order. The rows of the first file may all lie
        before the cursor, so the limit is counted from the second one.
        """
        start = 0
        if after is not None:
            key = _key(after)
            # rows that tie with a cursor prefix are not after it
            start = bisect_right([x[:len(key)] for x in self.last], key)
        stop = len(self.files)
        # files that begin after the end of the range hold none of it
        if until is not None:
            key = _key(until)
            stop = bisect_right([x[:len(key)] for x in self.first], key)
        if limit is not None and start < stop:
            # files from `start + 1` on hold only rows after the cursor
            stop = min(stop, bisect_left(self.passed, self.passed[start + 1] + limit, start + 1))
        return self.files[start:stop]


def _literals(order: Sequence[str], values: Sequence[Any], schema: T.StructType) -> list[Any]:
    """Typed literals; times go through text, so that they stay wall-clock times in any session zone."""
    return [None if v is None else F.lit(str(v) if isinstance(v, datetime) else v).cast(schema[c].dataType)
            for c, v in zip(order, values)]


def indexed_page(spark: SparkSession, index: PageIndex, order: Sequence[str], schema: T.StructType,
                 cursor: Sequence[Any] | None, limit: int, until: Sequence[Any] | None = None) -> DataFrame:
    """The first ``limit`` rows after ``cursor`` and not after ``until``, from the page files that can hold them."""
    files = index.files_for(cursor, limit, until)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    columns = [F.col(c) for c in order]
    within = None if until is None else ~PG.after_cursor(columns[:len(until)], _literals(order, until, schema))
    after = None if cursor is None else _literals(order, cursor, schema)
    return PG.keyset_page(rows, columns, after, limit, within)
