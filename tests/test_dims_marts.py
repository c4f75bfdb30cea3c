"""Dimensions, surrogate ids, marts and the view."""

from datetime import datetime

from pyspark.sql import functions as F

from ticketflow.operators import dims as D
from ticketflow.operators.ids import sequential_ids
from ticketflow.plans import marts as M
from ticketflow.sources.raw import RAW_SCHEMA

COLS = [f.name for f in RAW_SCHEMA.fields]


def _raw(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in COLS) for r in rows], RAW_SCHEMA)


def test_dim_agency_mode_ties_and_conflicts(spark):
    rows = ([dict(agency="DOT", agency_name="Transport")] * 2 + [dict(agency="DOT", agency_name="DOT dept")] * 2
            + [dict(agency="NYPD", agency_name="Police")] * 3 + [dict(agency=None, agency_name=None)])
    raw = _raw(spark, rows)
    got = [tuple(r) for r in D.dim_agency(raw).orderBy("agency_id").collect()]
    assert got == [(1, "DOT", "DOT dept", 4), (2, "NYPD", "Police", 3), (3, "UNKNOWN", "UNKNOWN", 1)]
    conf = sorted(tuple(r) for r in D.agency_name_conflicts(raw).collect())
    assert conf == [("DOT", "DOT dept", 2), ("DOT", "Transport", 2)]


def test_dim_borough_and_complaint_type(spark):
    raw = _raw(spark, [dict(borough=" brooklyn\t", complaint_type="Noise - Street/Sidewalk"),
                       dict(borough="BROOKLYN", complaint_type="Street Condition"),
                       dict(borough=None, complaint_type="Taxi")])
    b = [tuple(r) for r in D.dim_borough(raw).orderBy("borough_id").collect()]
    assert b == [(1, "BROOKLYN", 2), (2, "UNKNOWN", 1)]
    t = {r["complaint_type"]: (r["complaint_type_id"], r["category"])
         for r in D.dim_complaint_type(raw).collect()}
    assert t == {"Noise - Street/Sidewalk": (1, "Noise"), "Street Condition": (2, "Parks & Trees"),
                 "Taxi": (3, "Other")}
    rep = D.build_report(raw, D.dim_agency(raw), D.dim_complaint_type(raw), D.dim_borough(raw)).first()
    assert rep["rows_processed"] == 3
    assert rep["complaint_type_other_category_pct"] == 33.33
    assert D.build_report(D.value_counts(raw), D.dim_agency(raw), D.dim_complaint_type(raw),
                          D.dim_borough(raw)).first() == rep


def test_sequential_ids_distributed_path_matches_local(spark):
    df = spark.range(0, 500).select(F.format_string("k%04d", (F.col("id") * 7919) % 500).alias("k"))
    local = sequential_ids(df, "k", "id", local_rows=10_000)
    dist = sequential_ids(df, "k", "id", local_rows=0, partitions=7)
    a = sorted(tuple(r) for r in local.collect())
    b = sorted(tuple(r) for r in dist.collect())
    assert a == b
    assert [r[1] for r in a] == list(range(1, 501))


def _curated(spark):
    rows = [
        (datetime(2023, 1, 5, 10), 2.0, "CLOSED", "BROOKLYN", "Noise", "Loud"),
        (datetime(2023, 1, 6, 10), 3.01, "CLOSED", "BROOKLYN", "Noise", "Loud"),
        (datetime(2023, 1, 6, 11), None, "OPEN", "BROOKLYN", "Noise", "Loud"),
        (datetime(2023, 1, 7, 10), None, "OPEN", "QUEENS", "Noise", "Loud"),
        (datetime(2023, 2, 1, 10), 1.005, "CLOSED", "QUEENS", "Animal", "Dog"),
        (datetime(2023, 2, 1, 10), 5.0, "CLOSED", "QUEENS", "Noise", "Loud"),
    ]
    df = spark.createDataFrame(rows, "created_date timestamp, resolution_hours double, status string, "
                                     "borough string, complaint_category string, complaint_type string")
    return df.withColumn("created_year", F.year("created_date")).withColumn(
        "created_month", F.month("created_date"))


def test_monthly_mart_measures(spark):
    m = {(r["created_month"], r["borough"], r["complaint_category"]): r
         for r in M.monthly_summary(_curated(spark)).collect()}
    b = m[(1, "BROOKLYN", "Noise")]
    assert (b["total_requests"], b["closed_requests"], b["unresolved_requests"]) == (3, 2, 1)
    assert b["avg_resolution_hours"] == 2.51  # (200 + 301) / 2 = 250.5 cents -> HALF_UP
    q = m[(1, "QUEENS", "Noise")]
    assert q["avg_resolution_hours"] is None   # every request open: NULL, not NaN


def test_daily_mart_and_reconcile(spark):
    cur = _curated(spark)
    daily = M.daily_summary(cur)
    assert daily.count() == 5
    r = M.reconcile(cur, daily, "daily").first()
    assert (r["raw_total"], r["daily_total"], r["match"]) == (6, 6, True)


def test_rank_keeps_ties_and_ytd_is_unweighted(spark):
    mart = spark.createDataFrame(
        [(2023, 1, "B", "Noise", 5, 10.0), (2023, 1, "B", "Animal", 5, 2.0), (2023, 1, "B", "Other", 1, None),
         (2023, 2, "B", "Noise", 1, 1.0)],
        "created_year int, created_month int, borough string, complaint_category string, "
        "total_requests long, avg_resolution_hours double")
    top = [(r["created_month"], r["complaint_category"], r["category_rank"])
           for r in M.top_category_per_borough_month(mart).collect()]
    assert top == [(1, "Animal", 1), (1, "Noise", 1), (2, "Noise", 1)]
    ytd = {r["complaint_category"]: (r["total_requests"], r["avg_resolution_hours"])
           for r in M.category_totals_ytd(mart).collect()}
    assert ytd["Noise"] == (6, 5.5)     # mean of 10.0 and 1.0, not volume-weighted
    assert ytd["Other"] == (1, None)


def test_all_dimensions_matches_separate_builds(spark):
    from ticketflow.settings import PipelineSettings
    rows = ([dict(agency="DOT", agency_name="Transport", complaint_type="Street Condition", borough=" queens")] * 2
            + [dict(agency="NYPD", agency_name="Police", complaint_type="Noise", borough="BRONX")] * 3
            + [dict(agency=None, agency_name=None, complaint_type=None, borough=None)])
    raw = _raw(spark, rows)
    want = ([(1, "DOT", "Transport", 2), (2, "NYPD", "Police", 3), (3, "UNKNOWN", "UNKNOWN", 1)],
            [(1, "Noise", "Noise", 3), (2, "Street Condition", "Parks & Trees", 2), (3, "UNKNOWN", "Other", 1)],
            [(1, "BRONX", 3), (2, "QUEENS", 2), (3, "UNKNOWN", 1)])
    for local in (1_000_000, 0):   # one-task windows, then the range-partitioned path
        s = PipelineSettings(local_id_rows=local)
        got = D.split_dimensions(D.all_dimensions(D.value_counts(raw), s))
        assert tuple(sorted(map(tuple, g.collect())) for g in got) == want
