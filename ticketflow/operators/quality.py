"""Row-level data-quality rules, the valid / rejected split and its report.

A census job for the duplicate flag (skew-safe, see ``dedup``), then one plan:
three membership flags against reference keys (size-checked broadcast joins), six per-row
predicates, and the reason text. Everything downstream — valid rows,
rejected rows, counts, thresholds — is a filter or one aggregate over that
flagged frame, so a single materialisation of it serves them all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.functions.text import is_blank, is_valid_zip, fits_length
from ticketflow.functions.timecols import int_div, parse_ts
from ticketflow.operators.dedup import flag_repeats
from ticketflow.operators.distinct import count_distinct_exact
from ticketflow.operators.joins import membership_flag
from ticketflow.operators.onerow import side_by_side
from ticketflow.settings import (
    BOROUGH_MAX_LEN, CATEGORY_MAX_LEN, DEFAULT_SETTINGS, DEFAULT_THRESHOLDS, REASON_SEPARATOR,
    REJECTION_REASONS, THRESHOLD_CHECKS, PipelineSettings,
)

REASONS_COL = "_rejection_reasons"


def row_flags() -> dict[str, Column]:
    """The per-row predicates (no join, no shuffle)."""
    created = parse_ts(F.col("created_date"))
    closed = parse_ts(F.col("closed_date"))
    return {
        "missing_unique_key": is_blank("unique_key"),
        "missing_agency": is_blank("agency"),
        "missing_complaint_type": is_blank("complaint_type"),
        "invalid_created_date": created.isNull(),
        "closed_before_created": F.coalesce(
            ~is_blank("closed_date") & closed.isNotNull() & created.isNotNull() & (closed < created),
            F.lit(False)),
        "invalid_zip_format": ~is_valid_zip("incident_zip"),
    }


def flag_duplicates(raw: DataFrame, settings: PipelineSettings = DEFAULT_SETTINGS,
                    keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    return flag_repeats(raw, "unique_key", settings.order_columns, "duplicate_unique_key",
                        hot_over=settings.hot_key_rows, max_hot_keys=settings.max_hot_keys,
                        chunk_rows=settings.copy_chunk_rows,
                        max_repeated_keys=settings.max_repeated_keys,
                        max_repeated_share=settings.max_repeated_share,
                        broadcast_max_bytes=settings.broadcast_max_bytes, keep=keep)


def flag_unknown(df: DataFrame, refs: Mapping[str, DataFrame],
                 settings: PipelineSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Unknown agency / complaint type / borough: raw value not in the reference
    keys (case- and space-sensitive; NULL is never unknown)."""
    df = membership_flag(df, "agency", refs["agency"], "agency_code", "unknown_agency",
                         settings.broadcast_max_bytes)
    df = membership_flag(df, "complaint_type", refs["complaint_type"], "complaint_type",
                         "unknown_complaint_type", settings.broadcast_max_bytes)
    df = membership_flag(df, "borough", refs["borough"], "borough", "unknown_borough",
                         settings.broadcast_max_bytes)
    return df


def reasons_text(reasons: Sequence[str] = REJECTION_REASONS) -> Column:
    """``;``-joined names of the true flags in fixed order; ``''`` when none."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(F.col(r), F.lit(r)) for r in reasons])


def flag_requests(raw: DataFrame, refs: Mapping[str, DataFrame],
                  settings: PipelineSettings = DEFAULT_SETTINGS,
                  keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Raw rows + one boolean per rejection reason + ``_rejection_reasons``.

    ``keep`` (optional) writes the key census, which several parts of the plan read."""
    df = flag_duplicates(raw, settings, keep)
    df = flag_unknown(df, refs, settings)
    df = df.withColumns(row_flags())
    return df.withColumn(REASONS_COL, reasons_text())


def drop_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[r for r in REJECTION_REASONS if r in df.columns])


def valid_rows(flagged: DataFrame) -> DataFrame:
    """Rows with no reason, without the reason column."""
    return drop_flags(flagged.where(F.col(REASONS_COL) == "")).drop(REASONS_COL)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    """Rows with at least one reason, the reason text kept."""
    return drop_flags(flagged.where(F.col(REASONS_COL) != ""))


def reason_counts(flagged: DataFrame) -> DataFrame:
    """(reason, rows) for every reason that occurs, via one partial aggregate
    of the flag columns (no explode of the text)."""
    return reasons_of_totals(_totals(flagged))


def reasons_of_totals(t: DataFrame) -> DataFrame:
    """(reason, rows) of counted or observed ``total_metrics``."""
    stacked = t.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("reason"), F.col(f"n_{r}").alias("rows")) for r in REJECTION_REASONS
    ])).alias("x")).select("x.reason", "x.rows")
    return stacked.where(F.col("rows") > 0)


def reason_counts_from_text(rejected: DataFrame) -> DataFrame:
    """(reason, rows) by splitting the written reason text (e.g. of a rejected file)."""
    return (rejected.select(F.explode(F.split(F.col(REASONS_COL), REASON_SEPARATOR)).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


def total_metrics() -> list[Column]:
    """The counts that the report needs, as aggregates or observed metrics of a flagged table."""
    valid = F.col(REASONS_COL) == ""
    return [F.count(F.lit(1)).alias("total_rows"), F.count_if(valid).alias("valid_rows"),
            F.count_if(~valid).alias("rejected_rows"),
            *[F.count_if(F.col(r)).alias(f"n_{r}") for r in REJECTION_REASONS]]


def _totals(flagged: DataFrame) -> DataFrame:
    return flagged.agg(*total_metrics())


def pct_half_up(num: Column, den: Column, dp: int, scale: int = 100) -> Column:
    """round(scale * num / den, dp) HALF_UP on the exact ratio; 0 when den is 0."""
    k = scale * 10 ** dp
    num, den = num.cast("decimal(20,0)"), den.cast("decimal(20,0)")
    return F.when(den > 0, int_div(num * F.lit(2 * k).cast("decimal(12,0)") + den, den * 2)
                  / F.lit(float(10 ** dp))).otherwise(F.lit(0.0))


def ingestion_report(flagged: DataFrame) -> DataFrame:
    """One row: total / valid / rejected rows and the pass rate (%, 4 dp)."""
    return report_of_totals(_totals(flagged))


def report_of_totals(t: DataFrame) -> DataFrame:
    """The report row of counted or observed ``total_metrics``."""
    return t.select(
        "total_rows", "valid_rows", "rejected_rows",
        pct_half_up(F.col("valid_rows"), F.col("total_rows"), 4).alias("pass_rate_pct"),
    )


def threshold_checks(flagged: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """(check, value 6 dp, threshold, within_threshold); no rows when input is empty.

    ``within`` compares the unrounded rate; a threshold missing from the map
    is reported as NULL and compared against 1.
    """
    return checks_of_totals(_totals(flagged), thresholds)


def checks_of_totals(t: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """The threshold checks of counted or observed ``total_metrics``."""
    thresholds = dict(DEFAULT_THRESHOLDS if thresholds is None else thresholds)
    total = F.col("total_rows")
    items = []
    for check, reason, key in THRESHOLD_CHECKS:
        n = F.col(f"n_{reason}")
        limit = thresholds.get(key)
        rate = n / total
        items.append(F.struct(
            F.lit(check).alias("check_name"),
            pct_half_up(n, total, 6, scale=1).alias("value"),
            F.lit(limit).cast("double").alias("threshold"),
            (rate <= F.lit(1.0 if limit is None else float(limit))).alias("within_threshold"),
        ))
    return (t.where(total > 0).select(F.explode(F.array(*items)).alias("c"))
            .select("c.check_name", "c.value", "c.threshold", "c.within_threshold"))


def report_frame(flagged: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """The whole ingestion report as one row: totals, pass rate, reason-count
    map and threshold-check map (written as one JSON object by a report sink)."""
    return frame_of_totals(_totals(flagged), thresholds)


def frame_of_totals(t: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """The whole report of counted or observed ``total_metrics``."""
    rep = report_of_totals(t)
    counts = reasons_of_totals(t).agg(
        F.map_from_entries(F.collect_list(F.struct("reason", "rows"))).alias("rejection_reason_counts"))
    checks = checks_of_totals(t, thresholds).agg(
        F.map_from_entries(F.collect_list(F.struct(
            "check_name", F.struct("value", "threshold", "within_threshold")))).alias("threshold_checks"))
    return side_by_side([rep, counts, checks])


def report_json(flagged: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """The ingestion report as one JSON text row."""
    one = report_frame(flagged, thresholds)
    return one.select(F.to_json(F.struct(*one.columns)).alias("report"))


def check_constraints(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) for each named row predicate, in one pass."""
    agg = df.agg(*[F.count_if(~F.coalesce(pred, F.lit(False))).alias(name)
                   for name, pred in rules.items()])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules
    ])).alias("x")).select("x.rule", "x.violations")


def duplicate_key_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Composite keys that occur more than once (a uniqueness check)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def mart_rules(date_cols: Sequence[str]) -> dict[str, Column]:
    """Serving-table constraints of a summary mart."""
    c = F.col
    rules: dict[str, Column] = {}
    for d in date_cols:
        rules[f"{d}_not_null"] = c(d).isNotNull()
    if "created_month" in date_cols:
        rules["created_month_between_1_12"] = c("created_month").between(1, 12)
    rules.update({
        "borough_not_null": c("borough").isNotNull(),
        "borough_max_len": fits_length("borough", BOROUGH_MAX_LEN),
        "complaint_category_not_null": c("complaint_category").isNotNull(),
        "complaint_category_max_len": fits_length("complaint_category", CATEGORY_MAX_LEN),
        "total_requests_non_negative": c("total_requests") >= 0,
        "closed_requests_non_negative": c("closed_requests") >= 0,
        "unresolved_requests_non_negative": c("unresolved_requests") >= 0,
        "avg_resolution_hours_fits_numeric_10_2": c("avg_resolution_hours").isNull()
        | (F.abs(c("avg_resolution_hours")) < 1e8),
    })
    return rules


def mart_constraints(mart: DataFrame, key: Sequence[str], date_cols: Sequence[str]) -> DataFrame:
    """Constraint violations of a mart plus its composite-key uniqueness."""
    viol = check_constraints(mart, mart_rules(date_cols))
    dup = duplicate_key_groups(mart, key).agg(
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("long").alias("violations")
    ).select(F.lit("unique_" + "_".join(key)).alias("rule"), "violations")
    return viol.unionByName(dup)


# What the curated table is profiled for: (result column, metric, profiled column).
CURATED_PROFILE: tuple[tuple[str, str, str], ...] = (
    ("total_rows", "rows", ""), ("distinct_keys", "distinct", "unique_key"), ("null_keys", "nulls", "unique_key"),
    ("min_month", "min", "created_month"), ("max_month", "max", "created_month"),
    ("distinct_months", "distinct", "created_month"), ("min_year", "min", "created_year"),
    ("max_year", "max", "created_year"), ("min_resolution_hours", "min", "resolution_hours"),
    ("null_categories", "nulls", "complaint_category"), ("null_boroughs", "nulls", "borough"))

_METRICS = {"rows": lambda _: F.count(F.lit(1)), "min": F.min, "max": F.max,
            "nulls": lambda c: F.count_if(F.col(c).isNull())}


def quality_profile(df: DataFrame, profile: Sequence[tuple[str, str, str]] = CURATED_PROFILE) -> DataFrame:
    """The listed data-quality metrics of a table in one row.

    Distinct counts are exact and use bitmaps where values are numbers, so that
    single keys are not shuffled; all other metrics are one aggregate.
    """
    plain = [_METRICS[metric](column).alias(name) for name, metric, column in profile if metric != "distinct"]
    distinct = {name: column for name, metric, column in profile if metric == "distinct"}
    parts = [df.agg(*plain)] if plain else []
    if distinct:
        parts.append(count_distinct_exact(df, distinct))
    return side_by_side(parts).select(*[name for name, _, _ in profile])
