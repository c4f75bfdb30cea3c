"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each query runs over the whole input tables. Stage tables (flagged requests,
dimensions, curated table, marts) come from ``flow.testdata_stages``, which
writes them once per session and input version, as the batch pipeline hands
stage outputs to the next step.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.functions.categories import categorize
from ticketflow.functions.numeric import nan_to_null
from ticketflow.functions.text import is_blank
from ticketflow.functions.timecols import parse_ts
from ticketflow.operators import dims as D
from ticketflow.operators import quality as Q
from ticketflow.operators import transform as T
from ticketflow.operators.distinct import count_distinct_exact
from ticketflow.operators.joins import broadcast_if_small
from ticketflow.operators.onerow import side_by_side
from ticketflow.plans import flow
from ticketflow.plans import marts as M
from ticketflow.plans import mergeable as MM
from ticketflow.session import scratch_path
from ticketflow.settings import CATEGORY_RULES, REQUIRED_COLUMNS
from ticketflow.sources import bucketed as BK
from ticketflow.sources import files as FS
from ticketflow.sources import key_discovery as KD
from ticketflow.sources import page_index as PI
from ticketflow.sources import pages as PG
from ticketflow.sources import raw as R
from ticketflow.sources import testdata as TD
from ticketflow.streaming import incremental as INC
from ticketflow.streaming import seen_keys as SK

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries over the driver tables.
SLICE_START, SLICE_END = "1996-01-01", "1996-12-31"
PAGE_CURSOR = ("1996-06-30T00:00:00.000", "3")
PAGE_SIZE = 500
FIRST_LANDING_ROWS = 2_000  # rows of the first, interrupted pull of a landing
MAX_RECORDS = 5_000  # record cap of the capped landing
VOLUME_YEAR = 1997
FILTER_BOROUGH = "AMERICA"
BUCKETS = 8
TOP_N = 10
HEAD_N = 10

RAW_TEXT = list(R.RAW_COLUMNS)
MONTHLY_COLS = ["created_year", "created_month", "borough", "complaint_category", "total_requests",
                "avg_resolution_hours", "closed_requests", "unresolved_requests"]
DAILY_COLS = ["request_date", "borough", "complaint_category", "total_requests",
              "avg_resolution_hours", "closed_requests", "unresolved_requests"]


def _st(spark: SparkSession, sf: str) -> flow.Stages:
    return flow.testdata_stages(spark, sf)


def _raw_with(spark, sf, flags: list[str]) -> DataFrame:
    st = _st(spark, sf)
    return st.flagged.select(*RAW_TEXT, *flags)


def _source(spark, sf) -> DataFrame:
    """The raw landing with its parsed creation time: date ranges on it are
    pushed into the Parquet scan."""
    return _st(spark, sf).landed


TS = flow.LANDING_TS


def _cursor_order() -> list:
    """The documented keyset order; rows may tie in it or lack a key."""
    return [F.col(TS), F.col("unique_key")]


def _total_order() -> list:
    """The keyset order completed by every other column, for results cut at a row count."""
    return [*_cursor_order(), *[F.col(c) for c in (*TD.SOURCE_ORDER_COLUMNS, *RAW_TEXT) if c != "unique_key"]]


# ---------------------------------------------------------------- sources

def q_raw_scan(spark, sf):
    return _st(spark, sf).raw


def q_csv_roundtrip(spark, sf):
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    path = scratch_path(spark, "raw_csv")
    FS.write_csv(raw, path, compression="gzip")
    return R.read_raw_csv(spark, path)


def q_quarantined_lines(spark, sf):
    """Raw lines without a header, some cut short and some with fields too many: what was read and what was not."""
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in RAW_TEXT])
    n = F.coalesce(F.col("unique_key").cast("bigint") % 50, F.lit(0))
    planted = F.when(n == 1, F.concat_ws(",", *RAW_TEXT[:3])).when(n == 2, F.concat(line, F.lit(",x,y"))).otherwise(line)
    path, kept = scratch_path(spark, "raw_lines"), scratch_path(spark, "quarantine")
    raw.select(planted.alias("value")).write.text(path)
    rows, bad = R.read_raw_csv_checked(spark, path, columns=RAW_TEXT)
    bad.write.parquet(kept)
    bad = spark.read.parquet(kept)
    lines = spark.read.text(path).agg(F.lit("lines").alias("part"), F.count(F.lit(1)).alias("rows"),
                                      F.sum(F.length("value")).alias("characters"))
    fields = F.when(F.size(F.split(R.BAD_LINE, ",")) < len(RAW_TEXT), "too_few").otherwise("too_many")
    read = rows.agg(F.lit("read").alias("part"), F.count(F.lit(1)).alias("rows"),
                    F.sum(F.length(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in RAW_TEXT]))).alias("characters"))
    return lines.unionByName(read).unionByName(bad.groupBy(fields.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length(R.BAD_LINE)).alias("characters")))


def q_csv_two_headers(spark, sf):
    """Two inputs with differing headers, aligned by name."""
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    early = F.coalesce(F.col("created_date") < "1998", F.lit(False))
    paths = [scratch_path(spark, "raw_csv_a"), scratch_path(spark, "raw_csv_b")]
    FS.write_csv(raw.where(early), paths[0])
    FS.write_csv(raw.where(~early).select(*reversed(REQUIRED_COLUMNS)), paths[1])
    return R.read_raw_csv(spark, paths)


def q_json_pages_scan(spark, sf):
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    path = scratch_path(spark, "pages")
    PG.land_pages(raw, path, page_size=5_000)
    return PG.read_pages(spark, path, R.RAW_SCHEMA)


def _pages_of_two_waves(spark, sf) -> str:
    """Landed pages whose keys come and go: null values have no key, early records no
    city, late ones no descriptor but a key of their own."""
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    early = F.coalesce(F.col("created_date") < "1998", F.lit(False))
    path = scratch_path(spark, "open_pages")
    PG.land_pages(raw.where(early).drop("city"), f"{path}/early", page_size=5_000)
    late = raw.where(~early).drop("descriptor").withColumn("extra_field", F.length("complaint_type"))
    PG.land_pages(late, f"{path}/late", page_size=5_000)
    return f"{path}/*"


def q_discovered_pages(spark, sf):
    """Pages without a declared schema: a column for each key that any record has."""
    return KD.read_discovered(spark, _pages_of_two_waves(spark, sf))


def q_page_keys(spark, sf):
    return KD.discover_keys(KD.read_records(spark, _pages_of_two_waves(spark, sf)))


def q_schema_contract(spark, sf):
    raw = R.check_contract(_st(spark, sf).raw)
    rep = R.contract_report(raw)
    counts = raw.agg(*[F.count(F.col(c)).alias(c) for c in REQUIRED_COLUMNS],
                     *[F.count_if(is_blank(c)).alias(f"blank_{c}") for c in REQUIRED_COLUMNS])
    long = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null_rows"),
                 F.col(f"blank_{c}").alias("blank_rows")) for c in REQUIRED_COLUMNS])).alias("x")
    ).select("x.*")
    # ``long`` is one row per contract column (10 rows): a proven bound
    return rep.join(F.broadcast(long), "column_name", "left").select(
        "position", "column_name", "present", "non_null_rows", "blank_rows")


def q_keyset_page(spark, sf):
    limit = PG.page_limit(PAGE_SIZE, None, 0)
    return PG.keyset_page(_source(spark, sf), _total_order(),
                          (F.lit(PAGE_CURSOR[0]).try_cast("timestamp_ntz"), PAGE_CURSOR[1]),
                          limit, where=PG.in_date_range(TS, SLICE_START, SLICE_END)
                          ).select(*RAW_TEXT)


def q_keyset_page_indexed(spark, sf):
    """The same slice of pages in cursor order, through their index."""
    source = _source(spark, sf)
    order = [TS, "unique_key", *TD.SOURCE_ORDER_COLUMNS, *[c for c in RAW_TEXT if c != "unique_key"]]
    pages, path = scratch_path(spark, "sorted_pages"), scratch_path(spark, "page_index")
    PI.land_sorted_pages(source, pages, order, page_rows=20 * PAGE_SIZE)
    index = PI.PageIndex(PI.build_index(spark, pages, order, path), len(order))
    start = (datetime.fromisoformat(PAGE_CURSOR[0]), PAGE_CURSOR[1])
    end = (datetime.fromisoformat(f"{SLICE_END} 23:59:59"),)
    return PI.indexed_page(spark, index, order, source.schema, start, PAGE_SIZE, end).select(*RAW_TEXT)


def q_resume_cursor(spark, sf):
    """Cursor of a whole landing."""
    return PG.resume_cursor(_slice(spark, sf), _cursor_order(), ["created_date", "unique_key"])


def _slice(spark, sf) -> DataFrame:
    return INC.incremental_slice(spark, _source(spark, sf), SLICE_START, SLICE_END,
                                 _cursor_order(), FIRST_LANDING_ROWS, ts_col=TS)


def q_incremental_slice(spark, sf):
    """An interrupted pull and its completion hold every row of the range."""
    return _slice(spark, sf).select(*RAW_TEXT)


def q_capped_slice(spark, sf):
    """The same with a record cap over both pulls."""
    return INC.incremental_slice(spark, _source(spark, sf), SLICE_START, SLICE_END, _total_order(),
                                 FIRST_LANDING_ROWS, ts_col=TS, max_records=MAX_RECORDS).select(*RAW_TEXT)


def q_slice_manifest(spark, sf):
    """The manifest of a landing, written as a JSON report and read back."""
    landed, path = _slice(spark, sf), scratch_path(spark, "manifest")
    report = INC.manifest(landed, _cursor_order(), SLICE_START, SLICE_END, None, output="landing",
                          started="2024-01-01 00:00:00", finished="2024-01-01 00:00:01")
    FS.write_json_report(report, path)
    return spark.read.schema(report.schema).json(path)


def q_stream_landing(spark, sf):
    """Raw requests land as JSON files in two waves; two availableNow runs of
    the file stream append each wave once (the checkpoint remembers files)."""
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("stream_in", "stream_out", "stream_ckpt"))
    early = F.coalesce(F.col("created_date") < "1998", F.lit(False))
    raw.where(early).write.json(f"{landing}/wave=1")
    INC.stream_landed_files(spark, landing, R.RAW_SCHEMA, sink, ckpt, multiline=False)
    raw.where(~early).write.json(f"{landing}/wave=2")
    INC.stream_landed_files(spark, landing, R.RAW_SCHEMA, sink, ckpt, multiline=False)
    return spark.read.parquet(sink).select(*RAW_TEXT)


def q_align_union(spark, sf):
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    is_early = F.coalesce(F.col("created_date") < "1998", F.lit(False))
    early = raw.where(is_early).drop("city")
    late = (raw.where(~is_early).drop("descriptor")
            .withColumn("extra_field", F.lit("x")))
    return R.align_union([early, late], RAW_TEXT)


def q_partitioned_roundtrip(spark, sf):
    cur = _st(spark, sf).curated
    path = scratch_path(spark, "curated_copy")
    FS.write_partitioned(cur, path, T.PARTITION_COLUMNS)
    return FS.read_parquet(spark, path)


def q_external_table_scan(spark, sf):
    """The curated stage table, registered where it lies."""
    cat = _sql(spark, sf)
    parts = FS.show_partitions(spark, cat.name("service_requests")).count()
    return (cat.requests().groupBy("created_year", "created_month")
            .agg(F.count(F.lit(1)).alias("total_rows"))
            .withColumn("registered_partitions", F.lit(parts).cast("long")))


# ---------------------------------------------------------------- quality

def q_flag_missing_fields(spark, sf):
    return _raw_with(spark, sf, ["missing_unique_key", "missing_agency", "missing_complaint_type"])


def q_flag_duplicate_keys(spark, sf):
    return _raw_with(spark, sf, ["duplicate_unique_key"])


def q_seen_keys_landings(spark, sf):
    """Three landings, flagged one after the other by a stream that remembers their keys."""
    raw = _st(spark, sf).raw
    landing, sink, ckpt, path = (scratch_path(spark, n) for n in ("seen_in", "seen_out", "seen_ckpt", "seen_state"))
    state = SK.SeenKeys(spark, path, "unique_key")
    wave = (F.when(F.col("created_date") < "1995", 1).when(F.col("created_date") < "1998", 2).otherwise(3))
    for i in (1, 2, 3):
        raw.where(wave == i).write.parquet(f"{landing}/wave={i}")
        SK.stream_flagged(spark, landing, raw.schema, state, TD.TESTDATA_SETTINGS.order_columns,
                          "duplicate_unique_key", sink, ckpt, files_per_batch=1_000_000)
    return spark.read.parquet(sink).select(*RAW_TEXT, "duplicate_unique_key")


def q_flag_bad_dates(spark, sf):
    return _raw_with(spark, sf, ["invalid_created_date", "closed_before_created"])


def q_flag_unknown_values(spark, sf):
    return _raw_with(spark, sf, ["unknown_agency", "unknown_complaint_type", "unknown_borough"])


def q_flag_bad_zip(spark, sf):
    return _raw_with(spark, sf, ["invalid_zip_format"])


def q_unknown_agency_rows(spark, sf):
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    refs = TD.reference_sets(spark, sf)["agency"]
    return (raw.where(F.col("agency").isNotNull())
            .join(broadcast_if_small(refs.distinct()), F.col("agency") == F.col("agency_code"), "left_anti"))


def q_known_agency_rows(spark, sf):
    raw = _st(spark, sf).raw.select(*RAW_TEXT)
    refs = TD.reference_sets(spark, sf)["agency"]
    return raw.join(broadcast_if_small(refs.distinct()), F.col("agency") == F.col("agency_code"), "left_semi")


def q_rejection_reasons(spark, sf):
    return _raw_with(spark, sf, [Q.REASONS_COL])


def q_valid_requests(spark, sf):
    return _st(spark, sf).valid.select(*RAW_TEXT)


def q_rejected_requests(spark, sf):
    return _st(spark, sf).rejected.select(*RAW_TEXT, Q.REASONS_COL)


def q_rejection_reason_counts(spark, sf):
    return Q.reason_counts(_st(spark, sf).flagged)


def q_rejection_reason_text_counts(spark, sf):
    """Counts from the written reason text of the rejected rows."""
    return Q.reason_counts_from_text(_st(spark, sf).rejected)


def q_ingestion_report(spark, sf):
    return Q.ingestion_report(_st(spark, sf).flagged)


def q_threshold_checks(spark, sf):
    return Q.threshold_checks(_st(spark, sf).flagged, TD.TESTDATA_SETTINGS.thresholds)


def q_split_invariant(spark, sf):
    st = _st(spark, sf)
    tagged = (st.raw.select(F.lit("raw").alias("part"))
              .unionByName(st.valid.select(F.lit("valid").alias("part")))
              .unionByName(st.rejected.select(F.lit("rejected").alias("part"))))
    agg = tagged.agg(F.count_if(F.col("part") == "raw").alias("raw_rows"),
                     F.count_if(F.col("part") == "valid").alias("valid_rows"),
                     F.count_if(F.col("part") == "rejected").alias("rejected_rows"))
    return agg.withColumn("complete", F.col("raw_rows") == F.col("valid_rows") + F.col("rejected_rows"))


def q_quality_profile(spark, sf):
    return Q.quality_profile(_st(spark, sf).curated)


def q_mart_constraints(spark, sf):
    st = _st(spark, sf)
    m = Q.mart_constraints(st.monthly, M.MONTHLY_KEY, ["created_year", "created_month"]) \
        .withColumn("mart", F.lit("monthly"))
    d = Q.mart_constraints(st.daily, M.DAILY_KEY, ["request_date"]).withColumn("mart", F.lit("daily"))
    return m.unionByName(d).select("mart", "rule", "violations")


# ---------------------------------------------------------------- dimensions

def q_categorize(spark, sf):
    return _st(spark, sf).dim_complaint_type.select("complaint_type", "category")


def q_categorize_service_rules(spark, sf):
    raw = _st(spark, sf).raw
    return (raw.groupBy("complaint_type").agg(F.count(F.lit(1)).alias("requests"))
            .withColumn("category", categorize("complaint_type", CATEGORY_RULES)))


def q_dim_agency(spark, sf):
    return _st(spark, sf).dim_agency


def q_dim_complaint_type(spark, sf):
    return _st(spark, sf).dim_complaint_type


def q_dim_borough(spark, sf):
    return _st(spark, sf).dim_borough


def q_agency_name_conflicts(spark, sf):
    return D.agency_name_conflicts(_st(spark, sf).value_counts)


def q_dim_build_report(spark, sf):
    return flow.dimension_report(_st(spark, sf))


def q_borough_values(spark, sf):
    return _st(spark, sf).dim_borough.select("borough", "record_count")


def q_unmatched_dimension_keys(spark, sf):
    """All raw requests against dimensions that lack a key each."""
    st = _st(spark, sf)
    raw = T.standardize_fields(st.raw.select(*RAW_TEXT))
    return flow.unmatched_keys(T.enrich_requests(
        raw, st.dim_agency.where(F.col("agency_code") != TD.UNKNOWN_AGENCY),
        st.dim_complaint_type.where(F.col("complaint_type") != TD.UNKNOWN_COMPLAINT_TYPE),
        st.dim_borough.where(F.col("borough") != FILTER_BOROUGH), st.settings))


# ---------------------------------------------------------------- transform

def q_dedup_requests(spark, sf):
    return T.dedup_requests(_st(spark, sf).valid, TD.TESTDATA_SETTINGS).select(*RAW_TEXT)


def q_dedup_raw_requests(spark, sf):
    """All raw requests, of which many repeat a key; rows without one are one group."""
    return T.dedup_requests(_st(spark, sf).raw, TD.TESTDATA_SETTINGS).select(*RAW_TEXT)


def q_bucketed_dedup(spark, sf):
    """The same from a table bucketed by key."""
    raw = _st(spark, sf).raw
    raw = BK.save_bucketed(raw, f"raw_{uuid.uuid4().hex[:8]}", "unique_key", BK.buckets_for(raw.count(), BUCKETS))
    return BK.dedup_bucketed(raw, "unique_key", TD.TESTDATA_SETTINGS.order_columns).select(*RAW_TEXT)


def q_bucketed_key_join(spark, sf):
    """Raw rows of every curated request, by category: two bucketed tables joined by key."""
    st = _st(spark, sf)
    buckets = BK.buckets_for(st.raw.count(), BUCKETS)
    raw = BK.save_bucketed(st.raw.select("unique_key"), f"keys_{uuid.uuid4().hex[:8]}", "unique_key", buckets)
    curated = BK.save_bucketed(st.curated.select("unique_key", "complaint_category"), f"curated_{uuid.uuid4().hex[:8]}",
                               "unique_key", buckets)
    return (BK.join_bucketed(raw, curated, "unique_key").groupBy("complaint_category")
            .agg(F.count(F.lit(1)).alias("raw_rows")))


def q_standardize_fields(spark, sf):
    return T.standardize_fields(_st(spark, sf).valid.select(*RAW_TEXT))


def q_fill_missing(spark, sf):
    return T.fill_missing(T.standardize_fields(_st(spark, sf).valid.select(*RAW_TEXT)))


def q_add_derived(spark, sf):
    v = T.fill_missing(T.standardize_fields(_st(spark, sf).valid.select(*RAW_TEXT)))
    return T.add_derived(T.parse_dates(v)).select(
        "unique_key", "created_date", "closed_date", *T.DERIVED_COLUMNS)


def q_enrich_requests(spark, sf):
    return _st(spark, sf).curated.select(
        "unique_key", "agency", "complaint_type", "borough", *T.DIM_COLUMNS)


def q_stage_counts(spark, sf):
    st = _st(spark, sf)
    raw = side_by_side([st.raw.agg(F.count(F.lit(1)).alias("raw_rows"), F.count("unique_key").alias("raw_keys")),
                        count_distinct_exact(st.raw, {"raw_distinct": "unique_key"})])
    raw = raw.select("raw_rows", (F.col("raw_keys") - F.col("raw_distinct")).alias("raw_repeats"))
    valid = side_by_side([st.valid.agg(F.count(F.lit(1)).alias("valid_rows")),
                          count_distinct_exact(st.valid, {"distinct_valid_keys": "unique_key"})])
    cur = st.curated.agg(F.count(F.lit(1)).alias("curated_rows"))
    one = side_by_side([raw, valid, cur])
    return one.withColumn("duplicates_removed", F.col("valid_rows") - F.col("distinct_valid_keys"))


def q_nan_to_null(spark, sf):
    """The monthly mart with every third average lost to NaN."""
    lost = F.when(F.col("total_requests") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("avg_resolution_hours"))
    return nan_to_null(_st(spark, sf).monthly.select(*MONTHLY_COLS).withColumn("avg_resolution_hours", lost))


# ---------------------------------------------------------------- marts

def q_monthly_summary(spark, sf):
    return _st(spark, sf).monthly.select(*MONTHLY_COLS)


def q_monthly_summary_head(spark, sf):
    return M.monthly_summary_head(_st(spark, sf).monthly.select(*MONTHLY_COLS), HEAD_N)


def q_daily_summary(spark, sf):
    return _st(spark, sf).daily.select(*DAILY_COLS)


def _appended_mart(spark, sf, spec: MM.MartSpec) -> DataFrame:
    """A mart after three batches: old months, new months, and late rows of both; the last one runs twice."""
    curated = _st(spark, sf).curated
    late = F.pmod(F.xxhash64("unique_key"), F.lit(100)) == 0
    old = F.col("created_year") < VOLUME_YEAR
    mart = MM.MergeableMart(spark, scratch_path(spark, f"appended_{spec.name}"), spec)
    for i, part in enumerate((~late & old, ~late & ~old, late, late)):
        mart.append(curated.where(part), min(i, 2))
    return mart.read()


def q_monthly_summary_appended(spark, sf):
    return _appended_mart(spark, sf, MM.MONTHLY).select(*MONTHLY_COLS)


def q_daily_summary_appended(spark, sf):
    return _appended_mart(spark, sf, MM.daily_spec()).select(*DAILY_COLS)


def q_monthly_volume(spark, sf):
    return M.monthly_volume(_st(spark, sf).curated, VOLUME_YEAR)


def q_top_complaint_types(spark, sf):
    return M.top_complaint_types(_st(spark, sf).curated, TOP_N)


def q_top_category_per_borough_month(spark, sf):
    return M.top_category_per_borough_month(_st(spark, sf).monthly)


def q_top_category_per_borough_year_month(spark, sf):
    return M.top_category_per_borough_month(_st(spark, sf).monthly, with_year=True)


def q_category_totals_ytd(spark, sf):
    return M.category_totals_ytd(_st(spark, sf).monthly)


def q_daily_trend(spark, sf):
    return M.daily_trend(_st(spark, sf).daily)


def q_daily_trend_for_borough(spark, sf):
    return M.daily_trend(_st(spark, sf).daily, FILTER_BOROUGH)


def q_borough_category_totals(spark, sf):
    return M.borough_category_totals(_st(spark, sf).monthly)


def q_borough_category_pivot(spark, sf):
    st = _st(spark, sf)
    return M.borough_category_pivot(st.monthly, flow.categories_of(st.settings))


def q_resolution_by_category(spark, sf):
    return M.resolution_by_category(_st(spark, sf).curated)


def q_resolution_by_category_for_borough(spark, sf):
    return M.resolution_by_category(_st(spark, sf).curated, FILTER_BOROUGH)


def q_reconcile_monthly(spark, sf):
    st = _st(spark, sf)
    return M.reconcile(st.curated, st.monthly, "summary")


def q_reconcile_daily(spark, sf):
    st = _st(spark, sf)
    return M.reconcile(st.curated, st.daily, "daily")


def q_fractional_hours_summary(spark, sf):
    return M.fractional_hours_summary(TD.fractional_requests(spark, sf))


# ---------------------------------------------------------------- sinks

def q_serving_load(spark, sf):
    st = _st(spark, sf)
    m = FS.serving_load(spark, st.monthly, MONTHLY_COLS, scratch_path(spark, "serving_monthly"),
                        "borough_category_monthly_summary")
    d = FS.serving_load(spark, st.daily, DAILY_COLS, scratch_path(spark, "serving_daily"),
                        "borough_category_daily_summary")
    return m.unionByName(d)


def q_mirror_reconcile(spark, sf):
    st = _st(spark, sf)
    copy = FS.mirror(spark, st.curated, scratch_path(spark, "mirror"), T.PARTITION_COLUMNS)
    return FS.reconcile_copy(st.curated, copy, key=["unique_key"], partition_by=T.PARTITION_COLUMNS)


def q_mirror_reconcile_damaged(spark, sf):
    """A copy with lost, doubled and altered rows (a value moved to another column)."""
    st = _st(spark, sf)
    n = F.col("unique_key").cast("bigint") % 50
    src = st.curated.select("unique_key", "agency", "descriptor", "closed_date", "resolution_hours")
    moved = src.where(n == 3).select(
        "unique_key", F.col("descriptor").alias("agency"), F.col("agency").alias("descriptor"), "closed_date",
        "resolution_hours")
    copy = src.where((n != 1) & (n != 3)).unionByName(src.where(n == 2)).unionByName(moved)
    return FS.reconcile_copy(src, FS.mirror(spark, copy, scratch_path(spark, "damaged")), key=["unique_key"])


def q_mart_csv_export(spark, sf):
    st = _st(spark, sf)
    path = scratch_path(spark, "monthly_csv")
    m = st.monthly.select(*MONTHLY_COLS)
    FS.write_csv(m, path, single_file=True)
    return FS.read_csv(spark, path, m.schema)


def q_split_sink(spark, sf):
    """Both sides of the one write, read back."""
    st = _st(spark, sf)
    path = scratch_path(spark, "split_csv")
    FS.write_split(st.flagged, path)
    out = None
    for part, schema in (("valid", st.raw.schema), ("rejected", st.rejected.schema)):
        rows = FS.read_split(spark, path, part, schema)
        reasons = F.count(Q.REASONS_COL) if part == "rejected" else F.lit(0).cast("long")
        one = rows.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("rows"),
                       F.count_distinct("unique_key").alias("distinct_keys"), reasons.alias("rows_with_reasons"))
        out = one if out is None else out.unionByName(one)
    return out


def q_split_report(spark, sf):
    """The ingestion report from the counts observed while both sides were written."""
    totals = FS.write_split(_st(spark, sf).flagged, scratch_path(spark, "split_report"))
    rep = Q.report_of_totals(totals)
    return side_by_side([rep, Q.reasons_of_totals(totals).agg(
        F.map_from_entries(F.collect_list(F.struct("reason", "rows"))).alias("counts"))]).select(
        *rep.columns, F.explode("counts").alias("reason", "rows"))


def q_report_roundtrip(spark, sf):
    st = _st(spark, sf)
    path = scratch_path(spark, "ingestion_report_json")
    FS.write_json_report(Q.report_frame(st.flagged, TD.TESTDATA_SETTINGS.thresholds), path)
    back = spark.read.schema("total_rows long, valid_rows long, rejected_rows long, "
                             "pass_rate_pct double, rejection_reason_counts map<string,long>").json(path)
    return back.select("total_rows", "valid_rows", "rejected_rows", "pass_rate_pct",
                       F.explode("rejection_reason_counts").alias("reason", "rows"))


def q_handover_counts(spark, sf):
    return flow.handover_counts(_st(spark, sf))


# ---------------------------------------------------------------- catalog

def _sql(spark, sf):
    from ticketflow.plans.sql_marts import catalog_for
    return catalog_for(spark, _st(spark, sf))


def q_sql_tables(spark, sf):
    """The tables that the catalog lists, with their rows."""
    return _sql(spark, sf).table_rows()


def q_sql_monthly_summary(spark, sf):
    return _sql(spark, sf).monthly().select(*MONTHLY_COLS)


def q_sql_daily_summary(spark, sf):
    return _sql(spark, sf).daily().select(*DAILY_COLS)


def q_sql_monthly_summary_head(spark, sf):
    return M.monthly_summary_head(_sql(spark, sf).monthly().select(*MONTHLY_COLS), HEAD_N)


def q_sql_top_category_per_borough_month(spark, sf):
    return M.top_category_per_borough_month(_sql(spark, sf).monthly())


def q_sql_reconcile_monthly(spark, sf):
    cat = _sql(spark, sf)
    return M.reconcile(cat.requests(), cat.monthly(), "summary")


def q_sql_reconcile_daily(spark, sf):
    cat = _sql(spark, sf)
    return M.reconcile(cat.requests(), cat.daily(), "daily")


def q_sql_monthly_volume(spark, sf):
    return M.monthly_volume(_sql(spark, sf).requests(), VOLUME_YEAR)


def q_sql_top_complaint_types(spark, sf):
    return M.top_complaint_types(_sql(spark, sf).requests(), TOP_N)


def q_sql_category_totals_ytd(spark, sf):
    return _sql(spark, sf).ytd_view()


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
