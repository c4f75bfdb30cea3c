"""Hash trees, bitmap counts, bad lines, the one-pass split, bucketed tables and the stored view."""

import random

import pytest
from pyspark.sql import functions as F

from ticketflow.operators import hash_tree as HT
from ticketflow.operators import quality as Q
from ticketflow.operators.distinct import count_distinct_exact
from ticketflow.plans import flow
from ticketflow.plans.sql_marts import catalog_for
from ticketflow.session import scratch_path
from ticketflow.settings import REJECTION_REASONS, REQUIRED_COLUMNS
from ticketflow.sources import bucketed as BK
from ticketflow.sources import files as FS
from ticketflow.sources import raw as R

from conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- hash tree

@pytest.fixture(scope="module")
def table(spark):
    return spark.range(3000).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 7).cast("int").alias("p"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 2).alias("v"), F.lit("x").alias("a.b"))


def test_equal_tables_end_at_the_root(table):
    a = HT.hash_tree(table, ["k"], ["p"], 64)
    b = HT.hash_tree(table.repartition(3), ["k"], ["p"], 64)
    assert HT.compare_trees(a, b) is None
    assert sum(r.rows for r in a.nodes().collect()) == 3000 == a.root()[0]


def test_only_damaged_leaves_are_compared(spark, table):
    damaged = table.where("k <> '70'").unionByName(table.where("k = '77'")).withColumn(
        "v", F.when(F.col("k") == "707", F.lit(None)).otherwise(F.col("v")))  # all of p = 0
    a, b = (HT.hash_tree(t, ["k"], ["p"], 64) for t in (table, damaged))
    found = HT.compare_trees(a, b)
    assert found.partitions == [(0,)] and 1 <= found.leaves.count() <= 3
    rows = found.rows(table)
    assert rows.count() < 60 and {r.p for r in rows.collect()} == {0}
    rec = FS.reconcile_copy(table, damaged, key=["k"], partition_by=["p"], buckets=64).first()
    assert tuple(rec) == (3000, 3000, 2, 2, False)


@pytest.mark.parametrize("key,by", [((), ()), (("k",), ()), (("k",), ("p",)), ((), ("p",))])
def test_reconcile_counts_any_damage(spark, table, key, by):
    rng = random.Random(3)
    for copies in (1, 3):
        rows = [tuple(r) for r in table.limit(400).collect()] * copies
        other = [r for r in rows if rng.random() > 0.02] + [r for r in rows if rng.random() < 0.02]
        other = [(r[0], None if rng.random() < 0.05 else r[1], r[2], r[3]) for r in other]
        src, dst = (spark.createDataFrame(x, table.schema) for x in (rows, other))
        want = (src.exceptAll(dst).count(), dst.exceptAll(src).count())
        got = FS.reconcile_copy(src, dst, key=key, partition_by=by, buckets=16).first()
        assert (got.missing_rows, got.extra_rows) == want
        assert (got.source_rows, got.copy_rows) == (len(rows), len(other))


def test_empty_tables_and_shapes(spark, table):
    none = table.where("false")
    assert tuple(FS.reconcile_copy(none, none).first()) == (0, 0, 0, 0, True)
    assert tuple(FS.reconcile_copy(table, none, key=["k"], partition_by=["p"]).first()) == (3000, 0, 3000, 0, False)
    with pytest.raises(ValueError):
        HT.compare_trees(HT.hash_tree(table, ["k"]), HT.hash_tree(table, ["p"]))


# ---------------------------------------------------------------- distinct counts

def test_bitmap_counts_equal_count_distinct(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "7", "07", "x", "-3", "70000", "+7", " 7", str(rng.randrange(500))]), rng.choice([None, *range(-40, 40)]),
             rng.randrange(-2**62, 2**62), rng.choice([1.5, None, 2.0])) for _ in range(800)]
    df = spark.createDataFrame(rows, "t string, i int, far bigint, d double").withColumn("a.b", F.col("i"))
    cols = {"t": "t", "i": "i", "far": "far", "d": "d", "dotted": "a.b"}
    got = count_distinct_exact(df, cols).first()
    want = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(n) for n, c in cols.items()]).first()
    assert got.asDict() == want.asDict()
    assert tuple(count_distinct_exact(df.where("false"), cols).first()) == (0,) * 5
    assert tuple(count_distinct_exact(spark.createDataFrame([(None,)], "i int"), {"i": "i"}).first()) == (0,)


def test_dense_keys_are_not_shuffled_one_by_one(spark):
    df = spark.range(200_000).select((F.col("id") % 150_000).cast("string").alias("k"))
    path = scratch_path(spark, "t_dense")
    df.write.parquet(path)
    out = count_distinct_exact(spark.read.parquet(path), {"n": "k"})
    assert out.first().n == 150_000
    assert "bitmap_construct_agg" in _plan(out) and "partial_count(distinct" not in _plan(out).lower()


# ---------------------------------------------------------------- bad lines

def test_bad_lines_are_kept_apart(spark):
    header = ",".join(REQUIRED_COLUMNS)
    good = ["1,a,b,c,d,e,f,g,h,i", '2,"a,1",b,c,d,e,f,g,h,i', ",,,,,,,,,"]
    bad = ["3,short", "4,a,b,c,d,e,f,g,h,i,more", "just text"]
    path = scratch_path(spark, "t_bad")
    spark.createDataFrame([(x,) for x in [header, *good[:2], *bad, "", good[2]]], "value string").coalesce(1).write.text(path)
    rows, quarantine = R.read_raw_csv_checked(spark, path)
    assert sorted((r.unique_key or "") for r in rows.collect()) == ["", "1", "2"]
    found = quarantine.collect()
    assert sorted(r[R.BAD_LINE] for r in found) == sorted(bad)
    assert all("part-" in r[R.BAD_FILE] for r in found)
    assert rows.count() + quarantine.count() == 6  # the lines of the file without header and empty line
    assert rows.select("status").where("status is not null").count() == 2  # a pruned read leaves bad lines out too
    assert R.read_raw_csv(spark, path).count() == 3


def test_bad_lines_of_several_headers_and_of_none(spark):
    header = ",".join(REQUIRED_COLUMNS)
    a, b, c = (scratch_path(spark, n) for n in ("t_bad_a", "t_bad_b", "t_bad_c"))
    for path, lines in ((a, [header, "1,a,b,c,d,e,f,g,h,i", "x"]), (b, [header + ",city", "2,a,b,c,d,e,f,g,h,i,j", "3,a,b,c,d,e,f,g,h,i"]),
                        (c, ["5,a,b,c,d,e,f,g,h,i", "6"])):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows, bad = R.read_raw_csv_checked(spark, [a, b])
    assert sorted(r.unique_key for r in rows.collect()) == ["1", "2"]
    assert sorted(r[R.BAD_LINE] for r in bad.collect()) == ["3,a,b,c,d,e,f,g,h,i", "x"]
    rows, bad = R.read_raw_csv_checked(spark, c, columns=REQUIRED_COLUMNS)
    assert [r.unique_key for r in rows.collect()] == ["5"] and [r[R.BAD_LINE] for r in bad.collect()] == ["6"]


def test_run_pipeline_quarantines_bad_lines(spark):
    path, out = scratch_path(spark, "t_run_in"), scratch_path(spark, "t_run_out")
    rows = [f"{i},2023-01-0{1 + i % 9}T00:00:00,,A,Agency,Noise,,B,1234{i % 10},Open" for i in range(30)]
    spark.createDataFrame([(x,) for x in [",".join(REQUIRED_COLUMNS), *rows, "31,cut"]], "value string").coalesce(1).write.text(path)
    st = flow.run_pipeline(spark, path, out)
    assert st.counts["quarantine"] == 1 and st.counts["raw"] == 30
    kept = spark.read.parquet(f"{out}/processed/quarantine").collect()
    assert [(r.problem, r[R.BAD_LINE]) for r in kept] == [("malformed", "31,cut")]
    report = spark.read.json(f"{out}/processed/ingestion_report").first()
    valid = FS.read_split(spark, f"{out}/processed/requests", "valid", st.raw.schema)
    assert report.total_rows == 30 and report.valid_rows == valid.count()


# ---------------------------------------------------------------- one-pass split

def test_split_and_report_from_one_write(spark):
    rows = [(str(i), "a;b" if i % 3 == 0 else "", *[i % 3 == 0 and j < 2 for j in range(len(REJECTION_REASONS))]) for i in range(20)]
    schema = "unique_key string, _rejection_reasons string, " + ", ".join(f"{r} boolean" for r in REJECTION_REASONS)
    flagged, path = spark.createDataFrame(rows, schema), scratch_path(spark, "t_split")
    totals = FS.write_split(flagged, path)
    assert totals.first().asDict() == Q._totals(flagged).first().asDict()
    assert Q.frame_of_totals(totals).first() == Q.report_frame(flagged).first()
    raw, rejected = flagged.select("unique_key").schema, flagged.select("unique_key", "_rejection_reasons").schema
    assert sorted(r.unique_key for r in FS.read_split(spark, path, "valid", raw).collect()) == sorted(r[0] for r in rows if not r[1])
    assert sorted(map(tuple, FS.read_split(spark, path, "rejected", rejected).collect())) == sorted(r[:2] for r in rows if r[1])
    FS.write_split(flagged.where("_rejection_reasons = ''"), path)
    assert FS.read_split(spark, path, "rejected", rejected).count() == 0  # no rejected row, no folder
    assert FS.write_split(flagged.where("false"), path).first().total_rows == 0


# ---------------------------------------------------------------- bucketed tables

def test_dedup_and_join_of_bucketed_tables_need_no_exchange(spark):
    rng = random.Random(7)
    rows = [(None if rng.random() < 0.1 else str(rng.randrange(80)), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, n int")
    a = BK.save_bucketed(df, "t_a", "k", 4)
    b = BK.save_bucketed(df.where("n % 2 = 0").withColumnRenamed("n", "m"), "t_b", "k", 4)
    first = BK.dedup_bucketed(a, "k", ["n"])
    want = {}
    for k, n in rows:
        want[k] = min(want.get(k, n), n)
    assert {r.k: r.n for r in first.collect()} == want
    joined = BK.join_bucketed(a, b, "k")
    assert joined.count() == df.alias("x").join(df.where("n % 2 = 0").alias("y"), F.col("x.k") == F.col("y.k")).count()
    for plan in (_plan(first), _plan(BK.join_bucketed(a, b, "k"))):
        assert "Exchange" not in plan and "Bucketed: true" in plan


# ---------------------------------------------------------------- stored view

def test_another_session_reads_the_stored_view(spark):
    st = flow.testdata_stages(spark, SF0001)
    cat = catalog_for(spark, st)
    name = cat.create_view()
    other = spark.newSession()
    rows = other.table(name).collect()
    assert rows == other.sql(f"SELECT * FROM {name}").collect() and len(rows) >= 4
    from ticketflow.plans import marts as M
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.category_totals_ytd(cat.monthly()).collect()))
    assert not any(r.isTemporary for r in other.sql(f"SHOW VIEWS IN {cat.db}").collect())


def test_a_file_rewritten_below_changes_the_fingerprint(spark):
    import os

    from ticketflow.plans.flow import _fingerprint
    path = scratch_path(spark, "fingerprint")
    spark.range(10).selectExpr("id", "id % 2 as part").write.partitionBy("part").parquet(path)
    local = path.removeprefix("file://").removeprefix("file:")
    before = _fingerprint(spark, [path])
    assert before == _fingerprint(spark, [path])
    below = os.path.join(local, "part=1")
    name = next(os.path.join(below, n) for n in os.listdir(below) if n.endswith(".parquet"))
    later = os.stat(name).st_mtime + 100
    os.utime(name, (later, later))
    assert _fingerprint(spark, [path]) != before
