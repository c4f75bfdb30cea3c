"""Scalar expressions: categories, zip, blanks, NA tokens, NaN."""

import math

from pyspark.sql import functions as F

from ticketflow.functions.categories import categorize
from ticketflow.functions.numeric import nan_to_null
from ticketflow.functions.text import is_blank, is_valid_zip
from ticketflow.sources.raw import normalize_na


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_category_rules_first_match_and_substring_traps(spark):
    got = _one(spark, categorize, [
        "Street Condition", "Street Light Condition", "Illegal Parking", "Noise - Street/Sidewalk",
        "Traffic Signal Condition", "HEAT/HOT WATER", "Noise - Residential", "Taxi Complaint", None,
        "Blocked Crosswalk", "Animal in a Park", "Water System"])
    assert got == [
        "Parks & Trees",        # "street" contains "tree"
        "Parks & Trees",
        "Parking & Vehicles",   # rule 9 "parking" wins over rule 13
        "Noise",
        "Street & Sidewalk",
        "Housing & Buildings",
        "Noise",
        "Other",
        "Other",
        "Traffic & Safety",
        "Animal",
        "Water & Sewer",
    ]


def test_zip_format(spark):
    got = _one(spark, is_valid_zip, [None, "11201", " 11201 ", "11201-1234", "1120", "", "\t11201\n"])
    assert got == [True, True, True, False, False, False, True]


def test_blank_covers_all_whitespace(spark):
    got = _one(spark, is_blank, [None, "", "  ", "\t", "　", " x ", "N/A"])
    assert got == [True, True, True, True, True, False, False]


def test_na_tokens_become_null(spark):
    df = spark.createDataFrame([("N/A",), ("NA",), ("null",), ("",), ("n/a ",), ("value",)], "x string")
    got = [r[0] for r in normalize_na(df).collect()]
    assert got == [None, None, None, None, "n/a ", "value"]


def test_nan_is_replaced_in_every_floating_column_and_nowhere_else(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("NaN", 1, nan, 2.5), (None, None, -0.0, nan), ("x", 3, inf, -inf), ("", 0, None, 1e-320)]
    df = spark.createDataFrame(rows, "label string, n long, a double, b float")
    back = nan_to_null(df)
    assert back.dtypes == df.dtypes
    got = [tuple(r) for r in back.collect()]
    assert got[0] == ("NaN", 1, None, 2.5) and got[1] == (None, None, 0.0, None)
    assert got[2] == ("x", 3, inf, -inf) and got[3] == ("", 0, None, 0.0)
    assert math.copysign(1, got[1][2]) == -1


def test_nan_no_longer_spoils_an_aggregate(spark):
    df = spark.createDataFrame([("g", float("nan")), ("g", 4.0), ("h", float("nan"))], "k string, v double")
    got = {r.k: (r.s, r.n) for r in nan_to_null(df).groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n")).collect()}
    assert got == {"g": (4.0, 1), "h": (None, 0)}


def test_integer_division_is_exact_far_beyond_doubles(spark):
    from ticketflow.functions.timecols import half_up_avg_cents, int_div
    from ticketflow.operators.quality import pct_half_up
    pairs = [(2**53 + 1, 1), (10**17 + 7, 3), (9 * 10**18, 7), (5, 10**18), (0, 1)]
    pairs += [(10**11 - i * 7919, 10**11) for i in range(50)]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert [r[0] for r in df.select(int_div(F.col("a"), F.col("b"))).collect()] == [a // b for a, b in pairs]
    rates = [r[0] for r in df.where("b = 100000000000").select(pct_half_up(F.col("a"), F.col("b"), 4)).collect()]
    assert rates == [((2 * 10**6 * a + b) // (2 * b)) / 10**4 for a, b in pairs if b == 10**11]
    sums = [(4 * 10**17 + 1, 10**11), (10**11 + 5, 10), (7, 2)]
    df = spark.createDataFrame(sums, "s long, n long")
    got = [r[0] for r in df.select(half_up_avg_cents(F.col("s"), F.col("n"))).collect()]
    assert got == [((2 * s + n) // (2 * n)) / 100.0 for s, n in sums]


def test_declared_date_formats(spark):
    from ticketflow.functions.timecols import parse_ts
    texts = ["01/15/2023 10:00:00 AM", "15.01.2023", "2023-01-15T10:00:00", "01/15/2023 10:00", None]
    formats = ("MM/dd/yyyy hh:mm:ss a", "dd.MM.yyyy")
    got = _one(spark, lambda c: parse_ts(c, formats).cast("string"), texts)
    assert got == ["2023-01-15 10:00:00", "2023-01-15 00:00:00", "2023-01-15 10:00:00", None, None]
    assert _one(spark, lambda c: parse_ts(c).cast("string"), texts[:1]) == [None]
