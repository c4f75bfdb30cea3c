"""Quality flags, reasons, split, report and thresholds."""


from ticketflow.operators import quality as Q
from ticketflow.operators.dedup import flag_repeats
from ticketflow.settings import PipelineSettings
from ticketflow.sources.raw import RAW_SCHEMA

COLS = [f.name for f in RAW_SCHEMA.fields]
SETTINGS = PipelineSettings(order_columns=("created_date", "closed_date"))


def _raw(spark, rows):
    full = [tuple(r.get(c) for c in COLS) for r in rows]
    return spark.createDataFrame(full, RAW_SCHEMA)


def _refs(spark):
    return {
        "agency": spark.createDataFrame([("NYPD",), ("DOT",)], "agency_code string"),
        "complaint_type": spark.createDataFrame([("Noise",), ("Pothole",)], "complaint_type string"),
        "borough": spark.createDataFrame([("BROOKLYN",), ("QUEENS",)], "borough string"),
    }


GOOD = dict(unique_key="1", created_date="2023-01-01T10:00:00.000", closed_date="2023-01-01T12:00:00.000",
            agency="NYPD", agency_name="Police", complaint_type="Noise", descriptor="x",
            borough="BROOKLYN", incident_zip="11201", status="Closed", city="NYC")


def _reasons(spark, rows):
    fl = Q.flag_requests(_raw(spark, rows), _refs(spark), SETTINGS)
    return {r["unique_key"] if r["unique_key"] is not None else "<null>": r[Q.REASONS_COL]
            for r in fl.collect()}


def test_every_reason_fires_alone(spark):
    rows = [
        dict(GOOD, unique_key="ok"),
        dict(GOOD, unique_key=None),
        dict(GOOD, unique_key="a", agency="  "),
        dict(GOOD, unique_key="b", complaint_type="\t"),
        dict(GOOD, unique_key="c", created_date="garbage"),
        dict(GOOD, unique_key="d", closed_date="2022-12-31T00:00:00.000"),
        dict(GOOD, unique_key="e", agency="FDNY"),
        dict(GOOD, unique_key="f", complaint_type="Rats"),
        dict(GOOD, unique_key="g", borough="Brooklyn"),
        dict(GOOD, unique_key="h", incident_zip="11201-1234"),
    ]
    got = _reasons(spark, rows)
    assert got["ok"] == ""
    assert got["<null>"] == "missing_unique_key"
    # a blank agency is both missing and unknown (raw value not in the set)
    assert got["a"] == "missing_agency;unknown_agency"
    assert got["b"] == "missing_complaint_type;unknown_complaint_type"
    assert got["c"] == "invalid_created_date"
    assert got["d"] == "closed_before_created"
    assert got["e"] == "unknown_agency"
    assert got["f"] == "unknown_complaint_type"
    assert got["g"] == "unknown_borough"  # case-sensitive on the raw value
    assert got["h"] == "invalid_zip_format"


def test_null_values_are_never_unknown_and_dates_edge_cases(spark):
    rows = [
        dict(GOOD, unique_key="n", agency=None, borough=None, incident_zip=None),
        dict(GOOD, unique_key="u", closed_date="not a date"),
        dict(GOOD, unique_key="s", closed_date=GOOD["created_date"]),
        dict(GOOD, unique_key="v", closed_date="   "),
    ]
    got = _reasons(spark, rows)
    assert got["n"] == "missing_agency"
    assert got["u"] == "" and got["s"] == "" and got["v"] == ""


def test_duplicates_first_copy_counts_even_when_rejected(spark):
    rows = [
        dict(GOOD, unique_key="k", created_date="2023-01-01T00:00:00.000", closed_date=None,
             agency="BAD"),
        dict(GOOD, unique_key="k", created_date="2023-02-01T00:00:00.000", closed_date=None),
        dict(GOOD, unique_key="k", created_date="2023-03-01T00:00:00.000", closed_date=None),
    ]
    fl = Q.flag_requests(_raw(spark, rows), _refs(spark), SETTINGS)
    got = sorted((r["created_date"], r[Q.REASONS_COL]) for r in fl.collect())
    assert got == [("2023-01-01T00:00:00.000", "unknown_agency"),
                   ("2023-02-01T00:00:00.000", "duplicate_unique_key"),
                   ("2023-03-01T00:00:00.000", "duplicate_unique_key")]
    assert Q.valid_rows(fl).count() == 0


def test_null_keys_are_never_duplicates(spark):
    rows = [dict(GOOD, unique_key=None), dict(GOOD, unique_key=None)]
    fl = Q.flag_requests(_raw(spark, rows), _refs(spark), SETTINGS)
    assert [r["duplicate_unique_key"] for r in fl.collect()] == [False, False]


def test_hot_key_path_equals_window_path(spark):
    base = [dict(GOOD, unique_key=str(i % 3), created_date=f"2023-01-{1 + i % 5:02d}T00:00:00.000",
                 closed_date=None if i % 4 == 0 else "2023-02-01T00:00:00.000") for i in range(40)]
    base += [dict(GOOD, unique_key="hot")] * 25 + [dict(GOOD, unique_key=None)] * 3
    raw = _raw(spark, base)
    order = ["created_date", "closed_date"]
    cold = flag_repeats(raw, "unique_key", order, "dup", max_repeated_keys=0)
    variants = [
        flag_repeats(raw, "unique_key", order, "dup"),
        flag_repeats(raw, "unique_key", order, "dup", max_repeated_share=1.0),  # repeated keys broadcast
        flag_repeats(raw, "unique_key", order, "dup", hot_over=2, max_hot_keys=10, chunk_rows=4,
                     max_repeated_share=1.0),
        flag_repeats(raw, "unique_key", order, "dup", hot_over=2, max_hot_keys=10, chunk_rows=4,
                     max_repeated_keys=0),                                   # full window + hot split
        flag_repeats(raw, "unique_key", order, "dup", hot_over=2, max_hot_keys=1, chunk_rows=4),
    ]
    a = sorted(repr(tuple(r)) for r in cold.collect())
    for v in variants:
        assert sorted(repr(tuple(r)) for r in v.collect()) == a
    assert len(a) == len(base)
    assert sum(1 for r in cold.collect() if r["dup"]) == len(base) - 3 - 4  # keys 0,1,2,hot keep one


def test_split_report_and_thresholds(spark):
    rows = [dict(GOOD, unique_key=str(i)) for i in range(6)]
    rows += [dict(GOOD, unique_key="0"), dict(GOOD, unique_key=None), dict(GOOD, unique_key="9",
                                                                            created_date="x")]
    fl = Q.flag_requests(_raw(spark, rows), _refs(spark), SETTINGS)
    rep = Q.ingestion_report(fl).first()
    assert (rep["total_rows"], rep["valid_rows"], rep["rejected_rows"]) == (9, 6, 3)
    assert rep["pass_rate_pct"] == 66.6667
    assert Q.valid_rows(fl).count() + Q.rejected_rows(fl).count() == 9
    assert Q.REASONS_COL not in Q.valid_rows(fl).columns
    counts = {r["reason"]: r["rows"] for r in Q.reason_counts(fl).collect()}
    assert counts == {"missing_unique_key": 1, "duplicate_unique_key": 1, "invalid_created_date": 1}
    text_counts = {r["reason"]: r["rows"] for r in Q.reason_counts_from_text(Q.rejected_rows(fl)).collect()}
    assert text_counts == counts
    checks = {r["check_name"]: r for r in Q.threshold_checks(fl, {"max_missing_id_rate": 0.2}).collect()}
    assert checks["missing_id_rate"]["value"] == 0.111111
    assert checks["missing_id_rate"]["within_threshold"] is True
    assert checks["invalid_date_rate"]["threshold"] is None       # missing key -> compared with 1
    assert checks["invalid_date_rate"]["within_threshold"] is True
    rep_json = Q.report_json(fl).first()[0]
    assert '"total_rows":9' in rep_json and '"missing_unique_key":1' in rep_json


def test_empty_input_reports_zero_and_no_checks(spark):
    fl = Q.flag_requests(spark.createDataFrame([], RAW_SCHEMA), _refs(spark), SETTINGS)
    rep = Q.ingestion_report(fl).first()
    assert (rep["total_rows"], rep["pass_rate_pct"]) == (0, 0.0)
    assert Q.threshold_checks(fl).count() == 0
    assert Q.reason_counts(fl).count() == 0


def test_constraints_and_uniqueness(spark):
    mart = spark.createDataFrame(
        [(2023, 1, "BROOKLYN", "Noise", 3, 1.5, 2, 1), (2023, 13, "B" * 21, None, -1, None, 0, 0),
         (2023, 1, "BROOKLYN", "Noise", 1, None, 0, 1)],
        "created_year int, created_month int, borough string, complaint_category string, "
        "total_requests long, avg_resolution_hours double, closed_requests long, unresolved_requests long")
    v = {r["rule"]: r["violations"] for r in
         Q.mart_constraints(mart, ["created_year", "created_month", "borough", "complaint_category"],
                            ["created_year", "created_month"]).collect()}
    assert v["created_month_between_1_12"] == 1
    assert v["borough_max_len"] == 1
    assert v["complaint_category_not_null"] == 1
    assert v["total_requests_non_negative"] == 1
    assert v["unique_created_year_created_month_borough_complaint_category"] == 1
    assert v["closed_requests_non_negative"] == 0


def test_unique_keys_need_no_shuffle(spark):
    raw = _raw(spark, [dict(GOOD, unique_key=str(i)) for i in range(10)] + [dict(GOOD, unique_key=None)])
    out = flag_repeats(raw, "unique_key", ["created_date"], "dup")
    assert [r["dup"] for r in out.collect()] == [False] * 11
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_of_any_column_type(spark):
    rows = [("a", [1, i % 2], {"x": i % 2}) for i in range(8)] + [("b", None, None), (None, [1], {})]
    df = spark.createDataFrame(rows, "k string, v array<int>, m map<string,int>")
    plain = flag_repeats(df, "k", [], "dup", max_repeated_keys=0)
    hot = flag_repeats(df, "k", [], "dup", hot_over=2, max_repeated_keys=0, chunk_rows=3)
    want = sorted(repr(tuple(r)) for r in plain.collect())
    assert sorted(repr(tuple(r)) for r in hot.collect()) == want and sum("True" in w for w in want) == 7


def test_a_type_without_an_order_is_refused_at_any_size(spark):
    import pytest
    df = spark.createDataFrame([("a", [{"x": 1}])], "k string, v array<map<string,int>>")
    for limit in (1, 1_000_000):
        with pytest.raises(TypeError):
            flag_repeats(df, "k", [], "dup", hot_over=limit)


def test_census_is_written_once_and_broadcasts_are_bounded(spark):
    raw = _raw(spark, [dict(GOOD, unique_key=str(i // 2)) for i in range(20)] + [dict(GOOD, unique_key=f"s{i}") for i in range(99)])
    kept = []

    def keep(df, name):
        kept.append(name)
        return spark.createDataFrame(df.collect(), df.schema)

    small = flag_repeats(raw, "unique_key", ["created_date"], "dup", keep=keep)
    large = flag_repeats(raw, "unique_key", ["created_date"], "dup", broadcast_max_bytes=10)
    assert kept == ["key_census"]
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
