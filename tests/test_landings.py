"""Pages without a schema, page index, key state over landings, marts that follow appends."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.plans import marts as M
from ticketflow.plans import mergeable as MM
from ticketflow.session import scratch_path
from ticketflow.sources import key_discovery as KD
from ticketflow.sources import page_index as PI
from ticketflow.sources import pages as PG
from ticketflow.streaming import seen_keys as SK


def _write_lines(spark, lines):
    path = scratch_path(spark, "t_pages")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


# ---------------------------------------------------------------- key discovery

def test_keys_that_come_and_go(spark):
    pages = [[{"b": "1", "a": "x"}, {"b": None}], [{"c d": 2.5, "a.b": True}, {"it's \"q\"": "y", "é": {"n": [1, 2]}}], []]
    path = _write_lines(spark, [json.dumps(p, ensure_ascii=False) for p in pages] + ["", '{"a": "single"}', "no json", "[3, null]"])
    got = KD.read_discovered(spark, path)
    assert got.columns == sorted(["b", "a", "c d", "a.b", "it's \"q\"", "é"])
    rows = [r.asDict() for r in got.collect()]
    assert len(rows) == 8
    filled = sorted(sorted((k, v) for k, v in r.items() if v is not None) for r in rows)
    assert filled == sorted([[], [], [], [], [("a", "x"), ("b", "1")], [("a", "single")], [("a.b", "true"), ("c d", "2.5")],
                             [("it's \"q\"", "y"), ("é", '{"n":[1,2]}')]])
    keys = {r["key"]: (r["value_type"], r["records"]) for r in KD.discover_keys(KD.read_records(spark, path)).collect()}
    assert keys["b"] == ("STRING", 2) and keys["a"] == ("STRING", 2) and keys["a.b"] == ("BOOLEAN", 1)


def test_fixed_header_leaves_later_keys_out(spark):
    path = _write_lines(spark, [json.dumps([{"k": "1", "z": "2"}, {"new": "3", "k": "4"}])])
    got = KD.read_discovered(spark, path, keys=["k", "z", "gone"])
    assert sorted(map(tuple, got.collect())) == [("1", "2", None), ("4", None, None)]


def test_no_pages_and_too_many_keys(spark):
    assert KD.read_discovered(spark, _write_lines(spark, ["[]"])).columns == []
    path = _write_lines(spark, [json.dumps([{f"k{i}": i for i in range(30)}])])
    with pytest.raises(KD.TooManyKeysError):
        KD.sorted_keys(KD.discover_keys(KD.read_records(spark, path)), max_keys=29)


def test_multiline_pages_and_one_discovery_pass(spark):
    path = _write_lines(spark, ['[{"a": "1",', ' "b": "2"}, {"c": "3"}]'])
    got = KD.read_discovered(spark, path, multiline=True)
    assert sorted(map(tuple, got.collect()), key=repr) == [("1", "2", None), (None, None, "3")]
    plan = KD.discover_keys(KD.read_records(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


# ---------------------------------------------------------------- page index

@pytest.fixture(scope="module")
def landed(spark):
    """600 rows on 40 times (so that many tie), some without a time or a key; 25 rows a page file."""
    rng = random.Random(4)
    t0 = datetime(2023, 1, 1)
    rows = [(None if i % 29 == 0 else t0 + timedelta(hours=rng.randrange(40)),
             None if i % 31 == 0 else str(rng.randrange(50)), i) for i in range(600)]
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("key", T.StringType()),
                           T.StructField("n", T.LongType())])
    path = scratch_path(spark, "t_sorted")
    PI.land_sorted_pages(spark.createDataFrame(rows, schema), path, ["ts", "key", "n"], 25)
    index = PI.PageIndex(PI.build_index(spark, path, ["ts", "key", "n"], scratch_path(spark, "t_index")), 3)
    ordered = sorted(rows, key=lambda r: [(v is None, v if v is not None else 0) for v in r])
    return schema, index, ordered


def _order_key(values):
    return [(v is None, v if v is not None else 0) for v in values]


@pytest.mark.parametrize("after,limit,until", [
    (None, 30, None), ((datetime(2023, 1, 1, 5),), 60, None), ((datetime(2023, 1, 1, 5), "2"), 1, None),
    ((datetime(2023, 1, 1, 5), "2", 300), 70, None), ((datetime(2023, 1, 2, 12), None), 40, None),
    ((None,), 10, None), ((None, "20"), 10, None), ((None, None, 0), 50, None), ((datetime(2022, 1, 1),), 10_000, None),
    ((datetime(2023, 1, 1, 3),), 10_000, (datetime(2023, 1, 1, 6),)), (None, 0, None), ((datetime(2024, 1, 1),), 5, (datetime(2024, 1, 2),))])
def test_indexed_slices(spark, landed, after, limit, until):
    schema, index, ordered = landed
    got = [tuple(r) for r in PI.indexed_page(spark, index, ["ts", "key", "n"], schema, after, limit, until).collect()]
    want = [r for r in ordered if after is None or _order_key(r[:len(after)]) > _order_key(after)]
    want = [r for r in want if until is None or _order_key(r[:len(until)]) <= _order_key(until)]
    assert got == want[:limit]


def test_a_slice_opens_only_the_pages_that_can_hold_it(spark, landed):
    schema, index, ordered = landed
    assert len(index.files) >= 24 and index.passed[-1] == 600
    for at in (0, 100, 333, 570):
        files = index.files_for(ordered[at], 25)
        assert 1 <= len(files) <= 3
        page = PI.indexed_page(spark, index, ["ts", "key", "n"], schema, ordered[at], 25)
        assert [tuple(r) for r in page.collect()] == ordered[at + 1:at + 26]
        assert len(page.inputFiles()) == len(files)
    assert set(index.files_for((datetime(2023, 1, 1, 7),), None, (datetime(2023, 1, 1, 8),))) < set(index.files)
    assert index.files_for(ordered[-1], 25) == []


def test_index_is_bounded(spark, landed):
    _, index, _ = landed
    rows = spark.createDataFrame([("f", (False, 1), (False, 2), 3)] * 3, "file string, first struct<n0:boolean,v0:int>, last struct<n0:boolean,v0:int>, rows bigint")
    with pytest.raises(ValueError):
        PI.PageIndex(rows, 1, max_rows=2)


def test_missing_pages_are_never_opened(spark):
    """A slice works though other page files are gone."""
    path = scratch_path(spark, "t_gone")
    df = spark.range(100).select(F.col("id").alias("k"))
    PI.land_sorted_pages(df, path, ["k"], 10)
    index = PI.PageIndex(PI.build_index(spark, path, ["k"], scratch_path(spark, "t_gone_index")), 1)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for f in index.files[:2]:
        p = hadoop(f)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    got = PI.indexed_page(spark, index, ["k"], df.schema, (60,), 15)
    assert [r.k for r in got.collect()] == list(range(61, 76))


# ---------------------------------------------------------------- seen keys

def _landing(n, seed):
    rng = random.Random(seed)
    return [(None if rng.random() < 0.1 else f"k{rng.randrange(120)}", seed, i) for i in range(n)]


def _flags(df):
    return sorted(tuple(r) for r in df.select("wave", "n", "dup").collect())


def test_three_landings_flag_what_one_landing_of_all_flags(spark):
    schema = "key string, wave int, n int"
    waves = [spark.createDataFrame(_landing(150, w), schema) for w in (1, 2, 3)]
    sink = scratch_path(spark, "t_seen_out")
    state = SK.SeenKeys(spark, scratch_path(spark, "t_seen"), "key", slots=8)
    for i, rows in enumerate(waves):
        SK.land_batch(state, rows, i, ["wave", "n"], "dup", sink)
    whole = waves[0].union(waves[1]).union(waves[2])
    one = SK.flag_repeats(whole, "key", ["wave", "n"], "dup")
    want = _flags(one)
    assert _flags(spark.read.parquet(sink)) == want and any(d for _, _, d in want)
    # each batch again, in any order
    stored = sorted(r.key for r in spark.read.parquet(f"{state.path}/keys").collect())
    assert len(stored) == len(set(stored))
    for i in (2, 0, 1):
        SK.land_batch(state, waves[i], i, ["wave", "n"], "dup", sink)
    assert _flags(spark.read.parquet(sink)) == want
    assert sorted(r.key for r in spark.read.parquet(f"{state.path}/keys").collect()) == stored


def test_the_filter_loses_no_key_and_spares_new_ones(spark):
    state = SK.SeenKeys(spark, scratch_path(spark, "t_bloom"), "key", slots=2)
    rows = spark.range(4000).select(F.concat(F.lit("old"), "id").alias("key"))
    state.add(rows, 0)
    keys = state._batch_keys(rows.union(spark.range(4000).select(F.concat(F.lit("new"), "id").alias("key"))))
    hits = [r.key for r in state.maybe_seen(keys, 1).collect()]
    assert sum(k.startswith("old") for k in hits) == 4000
    assert sum(k.startswith("new") for k in hits) < 200
    assert state.maybe_seen(keys, 0).count() == 0  # a batch doesn't see itself
    assert state._known(keys, 1).count() == 4000


def test_stream_of_landings(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_s_in", "t_s_out", "t_s_ckpt"))
    state = SK.SeenKeys(spark, scratch_path(spark, "t_s_state"), "key", slots=4)
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.LongType())])
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], schema).coalesce(1).write.parquet(f"{landing}/w=1")
    SK.stream_flagged(spark, landing, schema, state, ["n"], "dup", sink, ckpt)
    SK.stream_flagged(spark, landing, schema, state, ["n"], "dup", sink, ckpt)  # nothing new
    spark.createDataFrame([("b", 5), ("c", 6), (None, 7)], schema).coalesce(1).write.parquet(f"{landing}/w=2")
    SK.stream_flagged(spark, landing, schema, state, ["n"], "dup", sink, ckpt)
    assert sorted((r.n, r.dup) for r in spark.read.parquet(sink).collect()) == [
        (1, False), (2, True), (3, False), (4, False), (5, True), (6, False), (7, False)]


# ---------------------------------------------------------------- mergeable marts

def _curated(spark, rows):
    return spark.createDataFrame(
        [(datetime(y, m, d), y, m, b, c, s, h) for y, m, d, b, c, s, h in rows],
        "created_date timestamp_ntz, created_year int, created_month int, borough string, complaint_category string, "
        "status string, resolution_hours double")


def _random_rows(seed, n, months):
    rng = random.Random(seed)
    return [(y, m, rng.randint(1, 28), rng.choice(["A", "B", None]), rng.choice(["x", "y"]),
             "CLOSED" if rng.random() < 0.6 else "OPEN", round(rng.random() * 99, 2) if rng.random() < 0.6 else None)
            for y, m in (rng.choice(months) for _ in range(n))]


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def _files(spark, path):
    return {r.f for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


@pytest.mark.parametrize("daily", [False, True])
def test_mart_after_appends_equals_a_rebuild(spark, daily):
    spec = MM.daily_spec() if daily else MM.MONTHLY
    build = M.daily_summary if daily else M.monthly_summary
    mart = MM.MergeableMart(spark, scratch_path(spark, "t_mart"), spec)
    batches = [_curated(spark, _random_rows(1, 200, [(2022, 11), (2022, 12), (2023, 1)])),
               _curated(spark, _random_rows(2, 100, [(2023, 2)])),
               _curated(spark, _random_rows(3, 40, [(2022, 12), (2023, 2)]))]
    whole = None
    for i, b in enumerate(batches):
        before = _files(spark, mart.mart) if i else set()
        months = mart.append(b, i)
        whole = b if whole is None else whole.union(b)
        full = build(whole)
        assert _rows(mart.read(), full.columns) == _rows(full, full.columns)
        touched = {f"created_year={y}/created_month={m}/" for y, m in months}
        kept = {f for f in before if not any(t in f for t in touched)}
        assert kept <= _files(spark, mart.mart)  # other months keep their files
        assert not {f for f in before - kept} & _files(spark, mart.mart)
    assert months == [(2022, 12), (2023, 2)]
    mart.append(batches[2], 2)  # a rerun counts nothing twice
    assert _rows(mart.read(), full.columns) == _rows(full, full.columns)
    assert mart.append(batches[0].where("false"), 7) == []


def test_a_changed_rerun_refreshes_the_months_it_left(spark):
    mart = MM.MergeableMart(spark, scratch_path(spark, "t_rerun"), MM.MONTHLY)
    base, late = _random_rows(5, 60, [(2023, 1), (2023, 2)]), _random_rows(6, 10, [(2023, 1)])
    mart.append(_curated(spark, base), 0)
    mart.append(_curated(spark, late), 1)
    moved = [(2023, 2, *r[2:]) for r in late]
    assert mart.append(_curated(spark, moved), 1) == [(2023, 1), (2023, 2)]
    full = M.monthly_summary(_curated(spark, base + moved))
    assert _rows(mart.read(), full.columns) == _rows(full, full.columns)
