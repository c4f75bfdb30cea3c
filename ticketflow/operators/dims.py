"""Reference dimensions built from the raw requests, and their build report.

All value counts come from one ``GROUPING SETS`` aggregate over the raw
requests — (agency, agency_name), (complaint_type), (borough) — so the raw
table is scanned and shuffled once for all three dimensions (partial +
final hash aggregate; a hot value is combined map-side). Each dimension is
then a small derivation of those counts with a surrogate id in key order
(``ids.sequential_ids``). Agency names resolve to the most frequent spelling
per code (ties: smallest name — a distributed frame has no file order);
codes with several spellings are reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.functions.categories import categorize
from ticketflow.functions.text import strip_ws
from ticketflow.functions.timecols import int_div
from ticketflow.operators.ids import sequential_ids
from ticketflow.operators.onerow import side_by_side
from ticketflow.settings import DEFAULT_CATEGORY, DEFAULT_SETTINGS, MISSING_FILL, PipelineSettings

DIM_INPUT_COLUMNS = ("agency", "agency_name", "complaint_type", "borough")


def dim_input(raw: DataFrame) -> DataFrame:
    """The four columns the dimensions read, NULL → ``UNKNOWN``."""
    return raw.select(*DIM_INPUT_COLUMNS).fillna(MISSING_FILL)


def value_counts(raw: DataFrame) -> DataFrame:
    """(set, agency, agency_name, complaint_type, borough, record_count) for the
    three grouping sets; ``set`` names the grouping set of the row."""
    d = dim_input(raw).select("agency", "agency_name", "complaint_type",
                              F.upper(strip_ws("borough")).alias("borough"))
    g = (d.groupingSets([["agency", "agency_name"], ["complaint_type"], ["borough"]],
                        "agency", "agency_name", "complaint_type", "borough")
         .agg(F.count(F.lit(1)).alias("record_count"), F.grouping_id().alias("gid")))
    kind = (F.when(F.col("gid") == 3, F.lit("agency"))       # (agency, agency_name)
             .when(F.col("gid") == 13, F.lit("complaint_type"))
             .otherwise(F.lit("borough")))
    return g.select(kind.alias("set"), "agency", "agency_name", "complaint_type", "borough",
                    "record_count")


def _counts(raw_or_counts: DataFrame) -> DataFrame:
    return raw_or_counts if "set" in raw_or_counts.columns else value_counts(raw_or_counts)


def agency_name_counts(raw: DataFrame) -> DataFrame:
    return (_counts(raw).where(F.col("set") == "agency")
            .select(F.col("agency").alias("agency_code"), "agency_name", "record_count"))


def dim_agency(raw: DataFrame, settings: PipelineSettings = DEFAULT_SETTINGS) -> DataFrame:
    """(agency_id, agency_code, agency_name, record_count); ``raw`` may be the
    raw requests or their ``value_counts``, as for the other two."""
    return split_dimensions(all_dimensions(raw, settings))[0]


def agency_name_conflicts(raw: DataFrame) -> DataFrame:
    """(agency_code, agency_name, record_count) for codes with more than one name."""
    names = agency_name_counts(raw)
    multi = (names.groupBy("agency_code").agg(F.count(F.lit(1)).alias("n_names"))
             .where(F.col("n_names") > 1).select("agency_code"))
    return names.join(multi, "agency_code", "left_semi")


def dim_complaint_type(raw: DataFrame, settings: PipelineSettings = DEFAULT_SETTINGS) -> DataFrame:
    """(complaint_type_id, complaint_type, category, record_count)."""
    return split_dimensions(all_dimensions(raw, settings))[1]


def dim_borough(raw: DataFrame, settings: PipelineSettings = DEFAULT_SETTINGS) -> DataFrame:
    """(borough_id, borough, record_count); borough stripped and upper-cased."""
    return split_dimensions(all_dimensions(raw, settings))[2]


def build_report(raw: DataFrame, agency: DataFrame, complaint: DataFrame,
                 borough: DataFrame) -> DataFrame:
    """One row: rows read, dimension sizes, conflicts, share of ``Other`` (%, 2 dp).

    ``raw`` may be the raw requests or their ``value_counts``; the borough
    values themselves are the rows of ``dim_borough``."""
    rows = _counts(raw).where(F.col("set") == "borough").agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("rows_processed"))
    a = agency.agg(F.count(F.lit(1)).alias("agency_count"))
    c = complaint.agg(
        F.count(F.lit(1)).alias("complaint_type_count"),
        F.coalesce(F.sum(F.when(F.col("category") == DEFAULT_CATEGORY, F.col("record_count"))),
                   F.lit(0)).alias("other_rows"))
    b = borough.agg(F.count(F.lit(1)).alias("borough_count"))
    conflicts = agency_name_conflicts(raw).agg(F.count_distinct("agency_code").alias("agency_conflict_count"))
    one = side_by_side([rows, a, c, b, conflicts])
    n = F.col("rows_processed")
    other_pct = F.when(n > 0, int_div(F.col("other_rows") * 20000 + n, n * 2) / F.lit(100.0)) \
        .otherwise(F.lit(0.0))
    return one.select("rows_processed", "agency_count", "agency_conflict_count",
                      "complaint_type_count", other_pct.alias("complaint_type_other_category_pct"),
                      "borough_count")


def all_dimensions(raw_or_counts: DataFrame,
                   settings: PipelineSettings = DEFAULT_SETTINGS) -> DataFrame:
    """The three dimensions in one table: (dim, dim_id, dim_key, name, category,
    record_count), ids 1.. in key order within each dimension.

    One count job proves every dimension small enough (``local_id_rows``)
    for a per-dimension ``row_number`` window; otherwise each dimension is
    numbered by the range-partitioned path of ``ids.sequential_ids``.
    """
    c = _counts(raw_or_counts)
    names = agency_name_counts(c)
    agency = names.groupBy("agency_code").agg(
        F.min(F.struct((-F.col("record_count")).alias("neg"), F.col("agency_name").alias("name")))
        .alias("best"),
        F.sum("record_count").alias("record_count"),
    ).select(F.lit("agency").alias("dim"), F.col("agency_code").alias("dim_key"),
             F.col("best.name").alias("name"), F.lit(None).cast("string").alias("category"),
             "record_count")
    types = (c.where(F.col("set") == "complaint_type")
             .select(F.lit("complaint_type").alias("dim"), F.col("complaint_type").alias("dim_key"),
                     F.lit(None).cast("string").alias("name"),
                     categorize("complaint_type", settings.category_rules).alias("category"),
                     "record_count"))
    boroughs = (c.where(F.col("set") == "borough")
                .select(F.lit("borough").alias("dim"), F.col("borough").alias("dim_key"),
                        F.lit(None).cast("string").alias("name"),
                        F.lit(None).cast("string").alias("category"), "record_count"))
    u = agency.unionByName(types).unionByName(boroughs)
    largest = u.groupBy("dim").count().agg(F.max("count")).first()[0] or 0
    cols = ["dim", "dim_id", "dim_key", "name", "category", "record_count"]
    if largest <= settings.local_id_rows:
        w = Window.partitionBy("dim").orderBy(F.col("dim_key").asc_nulls_first())
        return u.withColumn("dim_id", F.row_number().over(w).cast("long")).select(*cols)
    parts = [sequential_ids(u.where(F.col("dim") == d), "dim_key", "dim_id", 0)
             for d in ("agency", "complaint_type", "borough")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*cols)


def split_dimensions(dims: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dim_agency, dim_complaint_type, dim_borough) from ``all_dimensions``."""
    d = F.col("dim")
    agency = dims.where(d == "agency").select(
        F.col("dim_id").alias("agency_id"), F.col("dim_key").alias("agency_code"),
        F.col("name").alias("agency_name"), "record_count")
    types = dims.where(d == "complaint_type").select(
        F.col("dim_id").alias("complaint_type_id"), F.col("dim_key").alias("complaint_type"),
        "category", "record_count")
    boroughs = dims.where(d == "borough").select(
        F.col("dim_id").alias("borough_id"), F.col("dim_key").alias("borough"), "record_count")
    return agency, types, boroughs
