"""What a task sorts, holds or writes does not grow with the input."""

import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ticketflow.operators import dedup as DD
from ticketflow.operators import transform as TR
from ticketflow.plans import flow, registry
from ticketflow.session import ROWS_PER_TASK, released_shuffles, scratch_path, sized_shuffles, tasks_for
from ticketflow.sources import bucketed as BK
from ticketflow.sources import files as FS
from ticketflow.sources import pages as PG
from ticketflow.sources import raw as R
from ticketflow.sources import testdata as TD


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark, n=300, keys=60):
    rng = random.Random(5)
    rows = [(None if rng.random() < 0.1 else str(rng.randrange(keys)), rng.choice([None, 1, 2, 3]), i) for i in range(n)]
    return rows, spark.createDataFrame(rows + rows[:40], "k string, o int, n int")


def test_a_query_builds_only_the_stages_it_reads(spark):
    flow.clear_cache()
    try:
        st = flow.testdata_stages(spark, SF0001)
        assert not st.paths
        registry.q_raw_scan(spark, SF0001).count()
        assert list(st.paths) == ["raw"]
        registry.q_valid_requests(spark, SF0001).count()
        assert set(st.paths) == {"raw", "key_census", "flagged"}
        registry.q_borough_category_pivot(spark, SF0001).count()
        assert "daily" not in st.paths and "monthly" in st.paths
        assert registry.q_handover_counts(spark, SF0001).count() == len(flow.HANDOVERS)
        assert set(flow.HANDOVERS) <= set(st.counts)
    finally:
        flow.clear_cache()


def test_shuffles_of_stages_are_sized_and_set_back(spark):
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    with sized_shuffles(spark, 99):
        assert spark.conf.get(name) == "99"
    with sized_shuffles(spark, 1):
        assert spark.conf.get(name) == old
    assert spark.conf.get(name) == old
    assert tasks_for(spark, 400 * ROWS_PER_TASK) == 400


def test_flagged_rows_are_dealt_by_their_number(spark, monkeypatch):
    rows, df = _rows(spark)
    seen = []
    monkeypatch.setattr(DD, "tasks_for", lambda _, n: seen.append(n) or 13)
    out = DD.flag_repeats(df, "k", ["o"], "dup", max_repeated_keys=0)
    assert ", 13)" in _plan(out) and seen == [340]
    got = out.collect()
    assert len(got) == 340 and not any(r.dup for r in got if r.k is None)
    assert sum(not r.dup for r in got if r.k is not None) == len({r[0] for r in rows if r[0] is not None})
    assert out.columns == ["k", "o", "n", "dup"]


@pytest.mark.parametrize("hot_over", [1_000_000, 5])
def test_rows_of_single_keys_are_settled_without_a_shuffle(spark, monkeypatch, hot_over):
    rng = random.Random(3)
    rows = [(rng.choice([None, f"s{i}"]), 1, i) for i in range(3000)] + [(f"r{rng.randrange(300)}", rng.choice([None, 1]), 7) for _ in range(900)]
    df = spark.createDataFrame(rows + [("hot", 1, 1)] * 20, "k string, o int, n int")
    dealt = []
    monkeypatch.setattr(DD, "tasks_for", lambda _, n: dealt.append(n) or 3)
    out = DD.flag_repeats(df, "k", ["o"], "dup", hot_over=hot_over, max_repeated_keys=0)
    assert 800 < dealt[-1] < 0.5 * len(rows) and out.columns == ["k", "o", "n", "dup"]
    monkeypatch.setattr(DD, "MAX_LEFT_SHARE", 0)
    whole = DD.flag_repeats(df, "k", ["o"], "dup", hot_over=hot_over, max_repeated_keys=0)
    assert dealt[-1] == len(rows) + 20  # every row goes through the window
    assert sorted(map(repr, out.collect())) == sorted(map(repr, whole.collect()))


def test_filter_bits_keep_every_repeated_key(spark):
    for kind, values in (("bigint", list(range(-500, 500))), ("string", [f"k{i}" for i in range(1000)])):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, f"`a b` {kind}")
        repeated = spark.createDataFrame([(v,) for v in values[::4]], f"__hk {kind}")
        for blocks in (1, 2):
            some, others = DD.split_by_bits(df, "a b", repeated, blocks, 250)
            some, others = [r[0] for r in some.collect()], [r[0] for r in others.collect()]
            assert set(values[::4]) <= set(some) and sorted(some + others, key=repr) == sorted(values + [None] * 5, key=repr)
            assert others.count(None) == 5 and len(some) < 600
    assert DD.filter_blocks(1, 1 << 26) == 1 and DD.filter_blocks(10, 10) == 0
    assert DD.filter_blocks(10 ** 12, 1 << 26) * DD.BLOCK_BITS // 8 <= 1 << 26
    assert DD.left_share(100, 40, 20, 0) == 1.0 and 0.4 < DD.left_share(10_000, 4_000, 2_000, 16) < 0.5


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_a_stage_leaves_its_table_and_not_its_shuffles(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old, before = spark.conf.get(name), _shuffle_files(spark)
    paths = {}
    df = spark.range(0, 1000, 1, 3).groupBy((F.col("id") % 100).alias("k")).count()
    kept = flow.write_table(df, "t_kept", paths=paths, compression=flow.SCRATCH_CODEC)
    until = time.time() + 20  # they are deleted in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(name) == old
    with pytest.raises(ValueError), released_shuffles(spark):
        raise ValueError
    assert spark.conf.get(name) == old
    assert kept.count() == 100 and glob.glob(f"{paths['t_kept'].removeprefix('file:')}/*.zstd.parquet")


def test_raw_rows_land_in_slices_of_order_keys(spark, monkeypatch, tmp_path):
    for t in ("orders", "lineitem"):  # keys that are NULL, lines and orders without a partner
        key = t[0] + "_orderkey"
        df = spark.read.parquet(f"{SF0001}/{t}.parquet")
        odd = df.limit(20).withColumn(key, F.when(F.rand(1) < 0.5, F.lit(-7 if t == "orders" else -8).cast("bigint")))
        df.unionByName(odd).write.parquet(f"{tmp_path}/{t}.parquet")
    for t in ("customer", "nation", "region", "part"):
        spark.read.parquet(f"{SF0001}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    whole = TD.raw_requests(spark, str(tmp_path))
    assert len(TD.raw_slices(spark, str(tmp_path))) == 1
    monkeypatch.setattr(TD, "BYTES_PER_SLICE", 1)
    slices = TD.raw_slices(spark, str(tmp_path))
    assert len(slices) == TD.MAX_SLICES and all(s.count() for s in slices)
    seen, want = flow.testdata_stages(spark, str(tmp_path)), sorted(map(repr, whole.collect()))
    assert sorted(map(repr, seen.raw.select(whole.columns).collect())) == want and seen.counts["raw"] == len(want)
    assert sum(r.count("unique_key=None") for r in want) >= 20


def test_curated_rows_are_dealt_before_they_are_widened(spark, monkeypatch):
    kept = []

    def keep(df, name, part=(), widen=None):
        kept.append((name, df.columns, widen is not None))
        return flow.write_table(df, name, part, widen=widen)

    plain = flow.testdata_stages(spark, SF0001, materialize=False)

    def stages():
        return flow.compose(plain._raw, plain._refs, plain.settings, keep)

    narrow = stages().curated
    monkeypatch.setattr(TR, "estimated_bytes", lambda _: None)  # the size of the dimensions isn't known
    wide = stages().curated
    (_, a, first), (_, b, second) = [x for x in kept if x[0] == "curated"]
    assert first and not second and {"complaint_category", "resolution_hours"} <= set(b) - set(a)
    assert narrow.schema == wide.schema and set(plain.curated.columns) == set(wide.columns)
    rows = [sorted(map(repr, df.select(wide.columns).collect())) for df in (narrow, wide, plain.curated)]
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_dedup_deals_rows_by_their_number_and_splits_hot_keys_off(spark, monkeypatch):
    rows, df = _rows(spark)
    last = lambda r: (r[1] is None, r[1] or 0, r[2])
    want = {k: min((r for r in rows if r[0] == k), key=last) for k in {r[0] for r in rows}}
    monkeypatch.setattr(DD, "tasks_for", lambda _, n: 13)
    for hot_over in (1_000_000, 8, 1):  # none, some (with the NULL key) and most keys are hot
        out = DD.dedup_first(df, "k", ["o"], hot_over=hot_over)
        assert ", 13)" in _plan(out)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want.values(), key=repr)


def test_buckets_follow_the_rows():
    assert BK.buckets_for(0, 8) == BK.buckets_for(8 * ROWS_PER_TASK, 8) == 8
    assert BK.buckets_for(8 * ROWS_PER_TASK + 1, 8) == 16
    assert BK.buckets_for(216_000_000, 8) == 1024
    assert BK.buckets_for(10 ** 15, 8) <= BK.MAX_BUCKETS


def test_damaged_rows_are_counted_both_ways_in_one_shuffle(spark):
    src = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (4, "d")], "k int, v string")
    copy = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, None), (4, "d")], "k int, v string")
    out = FS._bag_difference(src, copy)
    assert _plan(out).count("Exchange hashpartitioning") == 1
    assert tuple(out.first()) == (src.exceptAll(copy).count(), copy.exceptAll(src).count()) == (2, 2)


def test_split_does_not_sort_rows_by_side(spark):
    path, name = scratch_path(spark, "t_open").removeprefix("file:"), "spark.sql.maxConcurrentOutputFileWriters"
    spark.sql(f"CREATE TABLE t_open_writers (v STRING, part STRING) USING CSV PARTITIONED BY (part) LOCATION '{path}'")
    try:
        write = "EXPLAIN INSERT INTO t_open_writers SELECT CAST(id AS STRING), CAST(id % 2 AS STRING) FROM range(9)"
        old = spark.conf.get(name)
        assert "Sort" in spark.sql(write).first()[0]
        with FS._open_writers(spark, len(FS.PARTS) + 1):
            assert "Sort" not in spark.sql(write).first()[0]
        assert spark.conf.get(name) == old
    finally:
        spark.sql("DROP TABLE t_open_writers")


def test_pages_are_put_together_without_a_shuffle(spark):
    text = [None, "é,]", 'a "q"\n', ""]
    df = spark.range(0, 1000, 1, 3).select(F.col("id").cast("string").alias("unique_key"), F.array(*map(F.lit, text))[
        (F.col("id") % 4).cast("int")].alias("a.b"))
    path = scratch_path(spark, "t_dealt").removeprefix("file:")
    PG.land_pages(df, path, page_size=60, file_rows=120)
    pages = spark.read.text(path).select(F.from_json("value", "array<map<string,string>>").alias("p"), F.input_file_name().alias("f"))
    sizes = [r.n for r in pages.select(F.size("p").alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) == 60 and len(sizes) == 18  # 333 or 334 rows a task: 5 pages and a rest
    assert pages.groupBy("f").count().agg(F.max("count")).first()[0] == 2
    assert {os.path.splitext(n)[1] for n in os.listdir(path) if n.startswith("part-")} == {".gz"}
    back = spark.read.schema(df.schema).json(path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_compressed_csv_reads_back_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(FS, "ROWS_PER_TASK", 10)
    df = spark.range(35).select(*[(F.col("id").cast("string") if c == "unique_key" else F.lit("x, y")).alias(c) for c in R.RAW_COLUMNS])
    path = scratch_path(spark, "t_gz").removeprefix("file:")
    FS.write_csv(df.coalesce(1), path, compression="gzip")
    assert sum(n.endswith(".csv.gz") and n.startswith("part-") for n in os.listdir(path)) == 4
    assert sorted(map(tuple, R.read_raw_csv(spark, path).collect())) == sorted(map(tuple, df.collect()))
