"""Arrow functions over the partitions of a frame, with this package importable in Python workers."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (elsewhere they need it installed or sent with ``--py-files``)."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join(x for x in [root, *paths] if x)


def map_arrow(df: DataFrame, fn, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` for a function from an iterator of batches to one of
    column dictionaries; columns are cast to the declared schema."""
    spark_schema = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark_schema)
    ship_package(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(batches):
            arrays = [cols[f.name] if isinstance(cols[f.name], pa.Array)
                      else pa.array(cols[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(
                [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, arrow)],
                schema=arrow)

    return df.mapInArrow(run, spark_schema)
