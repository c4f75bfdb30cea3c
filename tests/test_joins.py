"""Size-checked broadcast and membership flags."""

from pyspark.sql import functions as F

from ticketflow.operators.joins import broadcast_if_small, estimated_bytes, membership_flag
from ticketflow.operators.onerow import side_by_side


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_under_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # no automatic broadcast
    try:
        big = spark.range(0, 20_000).withColumnRenamed("id", "k")
        small = spark.range(0, 10).withColumnRenamed("id", "k")
        size = estimated_bytes(small)
        assert size is not None and size > 0
        hinted = big.join(broadcast_if_small(small, max_bytes=size), "k")
        assert "BroadcastHashJoin" in _plan(hinted)
        refused = big.join(broadcast_if_small(small, max_bytes=size - 1), "k")
        assert "BroadcastHashJoin" not in _plan(refused)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_membership_flag_keeps_rows_and_ignores_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string")
    ref = spark.createDataFrame([("a",), ("a",), (None,)], "r string")   # repeated + NULL reference values
    out = membership_flag(df, "v", ref, "r", "unknown_v")
    got = sorted((r["v"] or "", r["unknown_v"]) for r in out.collect())
    assert got == [("", False), ("a", False), ("a", False), ("b", True)]
    assert out.columns == ["v", "unknown_v"]


def test_side_by_side_combines_one_row_aggregates(spark):
    a = spark.range(5).agg(F.count(F.lit(1)).alias("n"))
    b = spark.range(3).agg(F.sum("id").alias("s"))
    assert [tuple(r) for r in side_by_side([a, b]).collect()] == [(5, 3)]
