"""Cleaning, derived columns and enrichment, from the rules of the blueprint."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest

from ticketflow.operators.transform import (
    add_derived, curate, dedup_requests, enrich_requests, fill_missing, parse_dates, standardize_fields,
)
from ticketflow.settings import PipelineSettings


@pytest.mark.parametrize("seed", range(3))
def test_survivor_of_a_key_does_not_depend_on_row_order(spark, seed):
    import random
    rows = [(f"t{k}", f"2021-05-{d:02d}", c) for k in range(4) for d in (9, 9, 12) for c in ("z", "q")]
    rows += [(None, "2020-02-29", "n1"), (None, None, "n0"), ("t1", None, "a")]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "unique_key string, created_date string, closed_date string").repartition(3)
    out = dedup_requests(df, PipelineSettings(order_columns=("created_date",))).collect()
    want = {f"t{k}": ("2021-05-09", "q") for k in range(4)} | {None: ("2020-02-29", "n1")}
    assert {r.unique_key: (r.created_date, r.closed_date) for r in out} == want


def test_survivor_is_rebuilt_with_every_column_type(spark):
    schema = ("unique_key string, created_date string, tags array<string>, place struct<x:int,y:string>, "
              "extra map<string,int>, raw binary, n double")
    row = ("k", "2021-01-01", ["b", None], (1, None), {"m": 2, "a": None}, b"\x00", float("nan"))
    later = ("k", "2021-01-02", None, None, None, None, None)
    df = spark.createDataFrame([later, row, row], schema)
    out = dedup_requests(df, PipelineSettings(order_columns=("created_date",))).first()
    assert (out.tags, out.place.x, out.extra, bytes(out.raw)) == (["b", None], 1, {"m": 2, "a": None}, b"\x00")


def test_outer_space_and_case_rules_differ_by_column(spark):
    cells = {"agency": ("dep  ", "DEP "), "borough": ("\tqueens", "\tQUEENS"), "status": ("Pending ", "PENDING"),
             "complaint_type": ("  Water leak", "Water leak"), "descriptor": (" a  b ", "a  b"), "city": (" x ", " x ")}
    df = spark.createDataFrame([tuple(v[0] for v in cells.values())], list(cells))
    got = standardize_fields(df).first().asDict()
    assert got == {c: v[1] for c, v in cells.items()}


def test_only_nulls_of_the_listed_columns_are_filled(spark):
    df = spark.createDataFrame([(None, "0", None), ("NULL", None, " ")], "descriptor string, city string, status string")
    assert [tuple(r) for r in fill_missing(df).collect()] == [("UNKNOWN", "0", None), ("NULL", "UNKNOWN", " ")]
    assert fill_missing(df, columns=("status", "absent")).first().status == "UNKNOWN"


def expected(created, closed):
    """Whole seconds each, hours HALF_UP to 2 dp, days by the calendar."""
    whole = lambda t: t.replace(microsecond=0)
    hours = Decimal((whole(closed) - whole(created)) // dt.timedelta(seconds=1)) / 3600
    return float(hours.quantize(Decimal("0.01"), ROUND_HALF_UP)), (closed.date() - created.date()).days


@pytest.mark.parametrize("created, closed", [
    ("2020-02-28T23:59:59.999", "2020-02-29T00:00:00.001"),   # leap day, one millisecond apart
    ("2019-12-31T22:10:05", "2020-01-01T01:46:23"),           # over a year's end
    ("2022-11-06T00:30:00", "2022-11-06T03:30:00"),           # a clock change elsewhere
    ("2021-07-04T08:00:00", "2021-07-04T08:00:54"),           # 0.015 h
    ("2021-07-04T08:00:00", "2024-07-04T07:59:59"),
])
def test_resolution_against_decimal_arithmetic(spark, created, closed):
    df = spark.createDataFrame([(created, closed)], "created_date string, closed_date string")
    r = add_derived(parse_dates(df)).first()
    assert (r.resolution_hours, r.resolution_days) == expected(dt.datetime.fromisoformat(created),
                                                               dt.datetime.fromisoformat(closed))


def test_calendar_columns_of_every_weekday_and_open_requests(spark):
    days = [dt.date(2024, 2, 25) + dt.timedelta(i) for i in range(7)]  # a Sunday first
    df = spark.createDataFrame([(f"{d} {i + 10}:00:00",) for i, d in enumerate(days)], "created_date string")
    df = df.selectExpr("created_date", "CAST(NULL AS STRING) AS closed_date")
    got = add_derived(parse_dates(df)).orderBy("created_date").collect()
    assert [(r.created_year, r.created_month, r.created_hour, r.created_day_of_week) for r in got] == [
        (2024, d.month, i + 10, i + 1) for i, d in enumerate(days)]
    assert all(r.resolution_hours is None and r.resolution_days is None for r in got)


def test_dates_that_parse_to_nothing(spark):
    texts = ["2021-02-29", "24:00", "", "2021/01/01", "20210101T000000", "yesterday", None]
    df = spark.createDataFrame([(t, t) for t in texts], "created_date string, closed_date string")
    assert all(r.created_date is None and r.closed_date is None for r in parse_dates(df).collect())


@pytest.fixture(scope="module")
def dims(spark):
    return (spark.createDataFrame([(5, "DEP", "Water Board"), (6, "dsny", "Sanitation")],
                                  "agency_id long, agency_code string, agency_name string"),
            spark.createDataFrame([(40, "Hydrant", "Water & Sewer"), (41, " Litter", "Sanitation")],
                                  "complaint_type_id long, complaint_type string, category string"),
            spark.createDataFrame([(3, "BRONX")], "borough_id long, borough string"))


def test_enrichment_matches_stored_keys_and_keeps_unmatched_rows(spark, dims):
    facts = [("DEP", "Hydrant", "BRONX"), ("DSNY", "Litter", "BRONX "), ("XYZ", None, None)]
    df = spark.createDataFrame(facts, "agency string, complaint_type string, borough string")
    got = {r.agency: (r.agency_id, r.dim_agency_name, r.complaint_type_id, r.complaint_category, r.borough_id)
           for r in enrich_requests(df, *dims).collect()}
    assert got == {"DEP": (5, "Water Board", 40, "Water & Sewer", 3), "DSNY": (None,) * 5, "XYZ": (None,) * 5}


def test_enrichment_is_the_same_without_broadcasts(spark, dims):
    df = spark.createDataFrame([("DEP", "Hydrant", "BRONX")] * 3, "agency string, complaint_type string, borough string")
    plain = enrich_requests(df, *dims, PipelineSettings(broadcast_max_bytes=0))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, enrich_requests(df, *dims).collect()))


def test_curate_trusts_a_flagged_input(spark, dims):
    cols = "unique_key string, created_date string, closed_date string, agency string, complaint_type string, " \
           "descriptor string, borough string, status string, city string"
    df = spark.createDataFrame([("1", "2021-01-01", None, " dep", "Hydrant ", None, "bronx", "open", None)] * 2, cols)
    assert curate(df, *dims, PipelineSettings(order_columns=())).count() == 1
    assert curate(df, *dims, PipelineSettings(order_columns=()), known_unique=True).count() == 2
