"""Scans, contract, keyset slices, landings, file sinks and catalog tables."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.session import scratch_path
from ticketflow.sources import files as FS
from ticketflow.sources import pages as PG
from ticketflow.sources import raw as R
from ticketflow.streaming import incremental as INC

COLS = list(R.RAW_COLUMNS)


def _raw(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in COLS) for r in rows], R.RAW_SCHEMA)


def test_contract_check_lists_missing_columns(spark):
    df = spark.createDataFrame([("1", "x")], "unique_key string, agency string")
    with pytest.raises(R.ContractError) as e:
        R.check_contract(df)
    assert "created_date" in str(e.value) and "unique_key" not in str(e.value).split(":")[1]


def test_csv_roundtrip_keeps_text_and_contract(spark):
    raw = _raw(spark, [dict(unique_key="00083", borough=" brooklyn ", status=" closed", descriptor='a "q", b'),
                       dict(unique_key="2", incident_zip="01234")])
    path = scratch_path(spark, "t_csv")
    FS.write_csv(raw, path)
    back = R.read_raw_csv(spark, path)
    assert sorted(map(tuple, R.read_raw_csv(spark, path, multiline=True).collect()), key=repr) == \
        sorted(map(tuple, raw.collect()), key=repr)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, raw.collect()), key=repr)
    bad = scratch_path(spark, "t_csv_bad")
    FS.write_csv(raw.drop("status"), bad)
    with pytest.raises(R.ContractError):
        R.read_raw_csv(spark, bad)


def test_keyset_page_cursor_and_quota(spark):
    rows = [dict(unique_key=k, created_date=d) for k, d in [
        ("1", "2023-01-01T00:00:00"), ("2", "2023-01-01T00:00:00"), ("10", "2023-01-01T00:00:00"),
        ("3", "2023-01-02T00:00:00"), ("4", "2023-01-03T23:59:59"), ("5", "2023-01-04T00:00:00")]]
    raw = _raw(spark, rows)
    order = [PG.parse_ts(F.col("created_date")), F.col("unique_key")]
    rng = PG.in_date_range("created_date", "2023-01-01", "2023-01-03")
    cur = (F.lit("2023-01-01 00:00:00").try_cast("timestamp_ntz"), "10")
    got = [r["unique_key"] for r in PG.keyset_page(raw, order, cur, 10, where=rng).collect()]
    assert got == ["2", "3", "4"]  # key compared as text: "2" > "10"; day 4 out of range
    assert PG.page_limit(25_000, 30, 20) == 10 and PG.page_limit(25_000, 30, 40) == 0
    assert PG.page_limit(25_000, None, 10) == 25_000


def test_after_cursor_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, None), (None, None)], "a int, b int")
    got = sorted(map(tuple, df.where(PG.after_cursor([F.col("a"), F.col("b")], [1, 5])).collect()),
                 key=repr)
    assert got == sorted([(1, None), (2, None), (None, None)], key=repr)


def test_resume_cursor_and_incremental_landing(spark):
    rows = [dict(unique_key=str(i), created_date=f"2023-01-{1 + i // 3:02d}T00:00:00.000") for i in range(12)]
    raw = _raw(spark, rows)
    order = [PG.parse_ts(F.col("created_date")), F.col("unique_key")]
    empty = spark.createDataFrame([], R.RAW_SCHEMA)
    r0 = PG.resume_cursor(empty, order, ["created_date", "unique_key"]).first()
    assert (r0["last_created_date"], r0["last_unique_key"], r0["rows_written"]) == (None, None, 0)
    path = scratch_path(spark, "t_landing")
    first = INC.first_landing(spark, raw, "2023-01-01", "2023-01-31", order, 5, path)
    c = PG.resume_cursor(first, order, ["created_date", "unique_key"]).first()
    assert c["rows_written"] == 5 and c["last_unique_key"] == "4"
    landed = INC.resume_and_append(spark, raw, "2023-01-01", "2023-01-31", order, path)
    assert sorted(r["unique_key"] for r in landed.collect()) == sorted(str(i) for i in range(12))
    capped = INC.resume_and_append(spark, raw, "2023-01-01", "2023-01-31", order,
                                      INC.first_landing(spark, raw, "2023-01-01", "2023-01-31", order, 2,
                                                        scratch_path(spark, "t_l2")).inputFiles()[0]
                                      .rsplit("/", 1)[0], max_records=7)
    assert capped.count() == 7
    report = INC.manifest(landed, order, "2023-01-01", "2023-01-31", None, output=path, started="s", finished="f")
    out = scratch_path(spark, "t_manifest")
    FS.write_json_report(report, out)
    man = spark.read.schema(report.schema).json(out).first()
    assert man["total_records_downloaded"] == 12 and man["completed"] is True
    assert (man["output_location"], man["started_at"], man["finished_at"]) == (path, "s", "f")
    assert man["last_cursor_unique_key"] == "9"  # the last day has 9, 10 and 11, as text


@pytest.mark.parametrize("cut", range(8))
def test_a_landing_cut_inside_ties_is_completed(spark, cut):
    """Tied rows, identical rows and rows without a key, cut after each row."""
    day = "2023-01-0{}T00:00:00.000"
    rows = [dict(unique_key="1", created_date=day.format(1), agency="a"),
            dict(unique_key="1", created_date=day.format(1), agency="b"),
            dict(unique_key="1", created_date=day.format(1), agency="b"),
            dict(unique_key=None, created_date=day.format(1), agency="c"),
            dict(unique_key=None, created_date=day.format(1), agency="c"),
            dict(unique_key=None, created_date="2023-01-02 00:00:00"), dict(unique_key="7", created_date=day.format(2))]
    raw = _raw(spark, rows)
    order = [PG.parse_ts(F.col("created_date")), F.col("unique_key")]
    got = INC.incremental_slice(spark, raw, "2023-01-01", "2023-01-31", order, cut)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, raw.collect())))
    again = INC.incremental_slice(spark, raw, "2023-01-01", "2023-01-31", order, cut, max_records=5)
    assert again.count() == 5


def test_cursor_is_the_latest_time_not_the_largest_text(spark):
    raw = _raw(spark, [dict(unique_key="1", created_date="2023-01-01T09:00:00"),
                       dict(unique_key="2", created_date="2023-01-01 10:00:00")])
    order = [PG.parse_ts(F.col("created_date")), F.col("unique_key")]
    assert PG.resume_cursor(raw, order, ["created_date"]).first()["last_created_date"] == "2023-01-01 10:00:00"


def test_files_with_other_headers_are_rejected_or_aligned(spark):
    raw = _raw(spark, [dict(unique_key="k1", status="open"), dict(unique_key="k2", status="done")])
    one, two = scratch_path(spark, "t_h1"), scratch_path(spark, "t_h2")
    FS.write_csv(raw.where("unique_key = 'k1'"), one)
    FS.write_csv(raw.where("unique_key = 'k2'").select(*reversed(COLS)), two)
    got = {r.unique_key: r.status for r in R.read_raw_csv(spark, [one, two]).collect()}
    assert got == {"k1": "open", "k2": "done"}
    both = scratch_path(spark, "t_h3")
    raw.where("unique_key = 'k1'").coalesce(1).write.options(**FS.CSV_WRITE).csv(both)
    raw.where("unique_key = 'k2'").select(*reversed(COLS)).coalesce(1).write.mode("append").options(**FS.CSV_WRITE).csv(both)
    with pytest.raises(Exception, match="(?i)header"):
        R.read_raw_csv(spark, both).collect()


def test_single_file_export_is_bounded(spark):
    df = spark.range(0, 100, numPartitions=4)
    small, large = scratch_path(spark, "t_one"), scratch_path(spark, "t_many")
    FS.write_csv(df, small, single_file=True)
    FS.write_csv(df, large, single_file=True, single_file_rows=99)
    assert len(spark.read.text(small).inputFiles()) == 1 and len(spark.read.text(large).inputFiles()) == 4


def test_json_pages_and_alignment(spark):
    raw = _raw(spark, [dict(unique_key=str(i), agency="A", city=None if i % 2 else "X") for i in range(20)])
    path = scratch_path(spark, "t_pages")
    PG.land_pages(raw.repartition(3), path, page_size=6)
    assert spark.read.text(path).count() >= 4  # a page on each line
    whole = scratch_path(spark, "t_page_file")
    spark.read.text(path).limit(1).coalesce(1).write.text(whole)
    assert PG.read_pages(spark, whole, R.RAW_SCHEMA, multiline=True).count() <= 6
    back = PG.read_pages(spark, path, R.RAW_SCHEMA)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, map(tuple, raw.collect())))
    a = spark.createDataFrame([("1", "x")], "unique_key string, zeta string")
    b = spark.createDataFrame([("2", "y")], "unique_key string, alpha string")
    u = R.align_union([a, b])
    assert u.columns == ["alpha", "unique_key", "zeta"] and u.count() == 2
    assert R.align_union([a, b], ["unique_key", "city"]).columns == ["unique_key", "city"]


def test_streamed_landing_picks_up_only_new_files(spark):
    raw = _raw(spark, [dict(unique_key=str(i)) for i in range(10)])
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_sl", "t_ss", "t_sc"))
    raw.where(F.col("unique_key").cast("int") < 5).write.json(f"{landing}/batch=1")
    n1 = INC.stream_landed_files(spark, landing, R.RAW_SCHEMA, sink, ckpt, multiline=False)
    raw.where(F.col("unique_key").cast("int") >= 5).write.json(f"{landing}/batch=2")
    n2 = INC.stream_landed_files(spark, landing, R.RAW_SCHEMA, sink, ckpt, multiline=False)
    assert (n1, n2) == (5, 5)
    assert sorted(r["unique_key"] for r in spark.read.parquet(sink).collect()) == sorted(map(str, range(10)))


def test_partitioned_table_mirror_and_serving(spark):
    df = spark.createDataFrame([(2023, 1, "a", 1.0), (2023, 2, "b", float("nan")), (2024, 1, "c", None)],
                               "created_year int, created_month int, v string, x double")
    path = scratch_path(spark, "t_part")
    FS.write_partitioned(df, path, ["created_year", "created_month"])
    name = FS.register_external_table(spark, "tf_test_db", "t_part", path, ["created_year", "created_month"])
    assert FS.show_partitions(spark, name).count() == 3
    assert spark.table(name).where("created_year = 2023").count() == 2
    copy = FS.mirror(spark, df, scratch_path(spark, "t_mirror"), ["created_year"])
    rec = FS.reconcile_copy(df.select("created_year", "created_month", "v"), copy).first()
    assert rec["match"] is True and rec["missing_rows"] == 0
    s = FS.serving_load(spark, df, ["v", "x"], scratch_path(spark, "t_srv"), "t").first()
    assert (s["source_rows"], s["loaded_rows"], s["match"]) == (3, 3, True)
    assert FS.ddl_columns(df.schema, ["created_year"]).startswith("`created_month` int")


def test_landing_and_derived_columns_ignore_session_time_zone(spark):
    from ticketflow.operators.transform import add_derived, parse_dates
    rows = [dict(unique_key=str(i), created_date=f"2023-03-12T0{i % 4}:30:00.000",
                 closed_date="2023-03-12T05:00:00.000") for i in range(8)]
    raw = _raw(spark, rows)
    order = [PG.parse_ts(F.col("created_date")), F.col("unique_key")]
    results = []
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):  # 2023-03-12 02:00 is a DST gap in New York
            spark.conf.set("spark.sql.session.timeZone", tz)
            path = scratch_path(spark, "t_tz")
            INC.first_landing(spark, raw, "2023-03-12", "2023-03-12", order, 3, path)
            landed = INC.resume_and_append(spark, raw, "2023-03-12", "2023-03-12", order, path)
            derived = add_derived(parse_dates(raw)).select("unique_key", "resolution_hours",
                                                           "created_hour", "created_day_of_week")
            results.append((sorted(r["unique_key"] for r in landed.collect()),
                            sorted(map(tuple, derived.collect()))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results[0] == results[1]
    assert results[0][0] == sorted(str(i) for i in range(8))


def test_reconcile_copy_finds_content_differences(spark):
    src = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    same = spark.createDataFrame([(2, "b"), (1, "a"), (1, "a")], "k int, v string")
    changed = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    r = FS.reconcile_copy(src, same).first()
    assert (r["missing_rows"], r["extra_rows"], r["match"]) == (0, 0, True)
    r = FS.reconcile_copy(src, changed).first()
    assert (r["source_rows"], r["copy_rows"], r["missing_rows"], r["extra_rows"], r["match"]) == (3, 3, 1, 1, False)


def test_reconcile_copy_sees_a_value_moved_over_a_null(spark):
    src = spark.createDataFrame([("k1", "desc", None)], "k string, a string, b string")
    moved = spark.createDataFrame([("k1", None, "desc")], "k string, a string, b string")
    r = FS.reconcile_copy(src, moved).first()
    assert (r["missing_rows"], r["extra_rows"], r["match"]) == (1, 1, False)
    assert FS.reconcile_copy(src, src, compare_rows=True).first()["match"] is True


def test_a_backlog_is_streamed_in_bounded_batches(spark):
    landing, sink, ckpt = (scratch_path(spark, n).removeprefix("file:") for n in ("backlog-files", "backlog-sink", "backlog-ckpt"))
    schema = T.StructType([T.StructField("k", T.StringType())])
    for wave in (range(120), range(120, 125)):
        rows = [(str(i),) for i in wave]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").option("maxRecordsPerFile", 1).json(landing)
        files = sum(1 for n in os.listdir(landing) if n.startswith("part-"))
        n = INC.stream_landed_files(spark, landing, schema, sink, ckpt, multiline=False, files_per_batch=1)
        assert n == len(rows)
    assert sorted(int(r.k) for r in spark.read.parquet(sink).collect()) == list(range(125))
    # the first run had more batches than a query keeps the progress of
    assert files == 125 and max(int(n) for n in os.listdir(os.path.join(ckpt, "commits")) if n.isdigit()) == 124
    assert INC.stream_landed_files(spark, landing, schema, sink, ckpt, multiline=False) == 0
