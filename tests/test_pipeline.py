"""End to end over the driver tables: expected counts and curated-data rules."""

import os

import pytest
from pyspark.sql import functions as F

from ticketflow.operators import quality as Q
from ticketflow.plans import flow

from conftest import SF0001, SF001

pytestmark = pytest.mark.skipif(not os.path.exists(SF001), reason="driver tables not present")

EXPECTED_REASONS = {  # sf0.01
    "missing_unique_key": 257, "missing_complaint_type": 257, "duplicate_unique_key": 14168,
    "invalid_created_date": 66, "closed_before_created": 14524, "unknown_agency": 2476,
    "unknown_complaint_type": 638, "unknown_borough": 29727, "invalid_zip_format": 8598,
}


@pytest.fixture(scope="module")
def stages(spark):
    return flow.testdata_stages(spark, SF001)


def test_reason_counts_and_split(stages):
    got = {r["reason"]: r["rows"] for r in Q.reason_counts(stages.flagged).collect()}
    assert got == EXPECTED_REASONS
    rep = Q.ingestion_report(stages.flagged).first()
    assert (rep["total_rows"], rep["valid_rows"]) == (60257, 12789)
    assert stages.valid.where(F.col("closed_date").isNull()).count() == 7808


def test_curated_quality_rules(stages):
    s = Q.quality_profile(stages.curated).first()
    assert s["total_rows"] == 12789                      # = valid rows, nothing lost
    assert s["null_keys"] == 0
    assert s["distinct_keys"] == s["total_rows"]
    assert (s["min_month"], s["max_month"], s["distinct_months"]) == (1, 12, 12)
    assert 1995 <= s["min_year"] <= s["max_year"] <= 2001
    assert s["min_resolution_hours"] >= 0
    assert s["null_categories"] == 0
    assert s["null_boroughs"] == 0
    assert flow.unmatched_keys(stages.curated).first().asDict() == {
        "unmatched_agency": 0, "unmatched_complaint_type": 0, "unmatched_borough": 0}


def test_marts_reconcile(stages):
    from ticketflow.plans import marts as M
    for mart, label in ((stages.monthly, "m"), (stages.daily, "d")):
        assert M.reconcile(stages.curated, mart, label).first()["match"] is True
    v = Q.mart_constraints(stages.monthly, M.MONTHLY_KEY, ["created_year", "created_month"])
    assert all(r["violations"] == 0 for r in v.collect())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns[:4] == ["created_year", "created_month", "borough", "complaint_category"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert os.path.exists(SF0001)


def test_run_pipeline_over_raw_csv(spark):
    """The batch pipeline over a raw CSV, validated against its own dimensions."""
    from ticketflow.session import scratch_path
    from ticketflow.sources import files as FS
    from ticketflow.sources.testdata import raw_requests

    src = raw_requests(spark, SF0001)
    csv_dir = scratch_path(spark, "raw_csv_in")
    FS.write_csv(src, csv_dir)
    out = scratch_path(spark, "run_out")
    db = "tf_run_" + out.rsplit("-", 1)[-1]
    st = flow.run_pipeline(spark, csv_dir, out, database=db)
    n = src.count()
    assert st.counts["raw"] == st.counts["flagged"] == n
    reasons = {r["reason"]: r["rows"] for r in Q.reason_counts(st.flagged).collect()}
    # dimensions come from the same file: agencies and types are always known,
    # boroughs only when the raw text is already upper-case without spaces
    assert "unknown_agency" not in reasons and "unknown_complaint_type" not in reasons
    lower = src.where(F.col("borough") != F.upper(F.trim("borough"))).count()
    assert reasons["unknown_borough"] == lower
    ref = flow.testdata_stages(spark, SF0001)
    assert reasons["duplicate_unique_key"] == Q.reason_counts(ref.flagged).where(
        "reason = 'duplicate_unique_key'").first()["rows"]
    # both sides come from one partitioned write
    valid = spark.read.option("header", True).csv(f"{out}/processed/requests/part=valid").count()
    rejected = spark.read.option("header", True).option("multiLine", True).csv(
        f"{out}/processed/requests/part=rejected").count()
    assert valid + rejected == n
    rep = spark.read.json(f"{out}/processed/ingestion_report").first()
    assert rep["total_rows"] == n and rep["valid_rows"] == valid
    assert spark.read.json(f"{out}/reference/reference_build_report").first()["rows_processed"] == n
    assert spark.table(f"{db}.service_requests").count() == st.curated.count()
    total = spark.table(f"{db}.borough_category_monthly_summary").agg(F.sum("total_requests")).first()[0]
    assert total == st.curated.count()
    assert set(st.curated.columns) >= {"l_partkey", "resolution_hours", "complaint_category"}
