"""Record pages whose keys are not known beforehand.

A page is a JSON array of records; a record may have keys that others lack. Pages
are read as VARIANT values, so nothing is inferred or lost. One discovery pass
aggregates the keys of all records (``schema_of_variant_agg`` of the values of each
key); the columns are then the sorted union of keys, and a record without a key has
NULL there. A landing that must keep the header of its first pull passes these
``keys`` again: keys that are not among them are then left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# More keys than a table may have columns mean that keys hold data.
MAX_KEYS = 10_000


class TooManyKeysError(ValueError):
    """The pages have more different keys than a table may have columns."""


def read_records(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """``record``: one VARIANT for each record of the pages, in whatever order files are read.

    A page is an array on each line, or with ``multiline`` one array per file; a line
    that is a single record is a page of one. A line that is no JSON gives one NULL record.
    """
    lines = spark.read.text(path, wholetext=multiline).where(F.trim("value") != "")
    page = F.try_parse_json("value")
    records = F.coalesce(F.try_variant_get(page, "$", "array<variant>"), F.array(page))
    return lines.select(F.explode(records).alias("record"))


def _entries(record: Column) -> Column:
    """The record as a map of its keys; NULL if it is no object."""
    return F.try_variant_get(record, "$", "map<string,variant>")


def discover_keys(records: DataFrame) -> DataFrame:
    """``(key, value_type, records)`` of every key of the records, in one pass.

    ``value_type`` is the merged type of the key's values (``VOID`` if all are null),
    ``records`` counts the records that have the key. Partially aggregated by key, so
    no more than the keys of a task are shuffled.
    """
    return (records.select(F.explode(_entries(F.col("record"))).alias("key", "value")).groupBy("key")
            .agg(F.schema_of_variant_agg("value").alias("value_type"), F.count(F.lit(1)).alias("records")))


def sorted_keys(discovered: DataFrame, max_keys: int = MAX_KEYS) -> list[str]:
    """The discovered keys in order; at most ``max_keys`` names reach the driver."""
    rows = discovered.select("key").orderBy("key").limit(max_keys + 1).collect()
    if len(rows) > max_keys:
        raise TooManyKeysError(f"more than {max_keys} different keys")
    return [r.key for r in rows]


def as_columns(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A text column for each key, NULL where a record lacks it or has null.

    Text values stay as they are, numbers and flags take their JSON form, nested
    values their JSON text. Records that are no objects have NULL in all columns.
    """
    entries = F.try_variant_get("record", "$", "map<string,string>")
    return records.select(F.coalesce(entries, F.create_map().cast("map<string,string>")).alias("entries")).select(
        *[F.try_element_at("entries", F.lit(k)).alias(k) for k in keys])


def read_discovered(spark: SparkSession, path: str, keys: Sequence[str] | None = None,
                    multiline: bool = False) -> DataFrame:
    """The records of landed pages as text columns: the sorted union of all keys, or ``keys``.

    Without ``keys`` one job discovers them first; the rows are a second, lazy scan.
    """
    records = read_records(spark, path, multiline)
    return as_columns(records, sorted_keys(discover_keys(records)) if keys is None else keys)
