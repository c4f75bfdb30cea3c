"""Raw request scans: explicit all-string schema, contract check, NA tokens.

A raw request file is read once with a declared schema (no inference job,
no type guessing: keys and zips keep leading zeros). Spark splits the input
itself, so there is no chunk loop; every later stage is a lazy plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.functions.text import null_if_token
from ticketflow.settings import NA_TOKENS, OPTIONAL_COLUMNS, REQUIRED_COLUMNS

RAW_COLUMNS: tuple[str, ...] = REQUIRED_COLUMNS + OPTIONAL_COLUMNS


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


RAW_SCHEMA = string_schema(RAW_COLUMNS)


class ContractError(ValueError):
    """The input lacks required columns."""


def missing_columns(columns: Sequence[str], required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    """Required columns absent from ``columns``, in contract order."""
    have = set(columns)
    return [c for c in required if c not in have]


def check_contract(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Raise listing the missing required columns; schema only, runs no job."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise ContractError(f"input is missing required columns: {missing}")
    return df


def contract_report(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One row per required column: present or not (a DataFrame, for checks)."""
    spark = df.sparkSession
    have = set(df.columns)
    rows = [(i + 1, c, c in have) for i, c in enumerate(required)]
    return spark.createDataFrame(rows, "position int, column_name string, present boolean")


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line only (reads the first line, no scan)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    import csv
    import io
    return next(csv.reader(io.StringIO(first[0][0])))


# Text of a line that is no record, and the file it came from.
BAD_LINE, BAD_FILE = "_bad_line", "_file"


def read_raw_csv_checked(spark: SparkSession, path: str | Sequence[str], extra_columns: Sequence[str] | None = None,
                         na_tokens: Sequence[str] = NA_TOKENS, multiline: bool = False,
                         columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Scan raw request CSV(s) with header as strings: ``(records, bad lines)``.

    A line with fewer or more fields than the header is no record: it is neither padded
    nor cut, but comes with its file as ``(BAD_LINE, BAD_FILE)`` in the second frame.
    Records and bad lines together are the lines of the files without headers and empty lines.
    ``columns`` names the fields of files that have no header line.

    The header is checked against the contract before any data job runs.
    Contract columns come first; the other header columns follow as strings
    (all of them, or only ``extra_columns`` when given). Files of one path
    share a header: a file whose header differs from the first one's is
    rejected when it is read. Paths given as a list may have headers of their
    own; their columns are aligned by name. Files split by size;
    ``multiline`` keeps quoted fields with line breaks intact but makes each
    file one task.
    """
    if not isinstance(path, str):
        both = [read_raw_csv_checked(spark, p, extra_columns, na_tokens, multiline, columns) for p in path]
        frames, bad = [x for x, _ in both], [x for _, x in both]
        extras = sorted({c for f in frames for c in f.columns if c not in RAW_COLUMNS})
        return align_union(frames, [*RAW_COLUMNS, *extras]), align_union(bad, [BAD_LINE, BAD_FILE])
    header = list(columns) if columns is not None else csv_header(spark, path)
    missing = missing_columns(header)
    if missing:
        raise ContractError(f"raw file is missing required columns: {missing}")
    extras = [c for c in header if c not in RAW_COLUMNS] if extra_columns is None else \
        [c for c in extra_columns if c in header and c not in RAW_COLUMNS]
    wanted = [c for c in RAW_COLUMNS if c in header] + extras
    schema = string_schema([*header, BAD_LINE])
    lines = (spark.read.schema(schema)
             .option("header", columns is None)
             .option("enforceSchema", columns is not None)  # else checks each file's header by name
             .option("multiLine", multiline)
             .option("escape", '"')
             .option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", BAD_LINE)
             .option("columnPruning", False)  # a pruned scan doesn't count fields
             .csv(path))
    # the scan must read a column beside the text of the bad line: this condition always holds
    read = F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0
    rows = lines.where(F.col(BAD_LINE).isNull() & read).select(*[F.col(f"`{c}`") for c in wanted])
    bad = lines.where(F.col(BAD_LINE).isNotNull() & read).select(BAD_LINE, F.col("_metadata.file_path").alias(BAD_FILE))
    for c in OPTIONAL_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    return normalize_na(rows, na_tokens), bad


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], extra_columns: Sequence[str] | None = None,
                 na_tokens: Sequence[str] = NA_TOKENS, multiline: bool = False,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """The records of ``read_raw_csv_checked``; lines that are none are left out."""
    return read_raw_csv_checked(spark, path, extra_columns, na_tokens, multiline, columns)[0]


def normalize_na(df: DataFrame, tokens: Sequence[str] = NA_TOKENS,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-value NA tokens (``N/A``, ``null``, ``""`` …) → NULL in string columns."""
    names = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    return df.withColumns({c: null_if_token(F.col(f"`{c}`"), tokens) for c in names})


def align_union(frames: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Bag union of heterogeneous record batches.

    Column set = sorted union of all names (or the given list); names a batch
    lacks become NULL, names outside ``columns`` are dropped.
    """
    if not frames:
        raise ValueError("no frames to union")
    names = list(columns) if columns is not None else sorted({c for f in frames for c in f.columns})
    out = None
    for f in frames:
        g = f.select(*[F.col(f"`{c}`") for c in f.columns if c in names])
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    for c in names:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*[F.col(f"`{c}`") for c in names])
