"""The driver tables seen as raw service requests, and their reference sets.

One raw request per (order, line item); orders without a line item give one
request with a NULL key. All raw columns are text, as in a raw CSV; three
typed source columns are carried along to complete the duplicate order.

Joins: ``orders ⟕ lineitem`` is written as an inner sort-merge join plus the
orders without a line item (``orders ▷ lineitem``): both are shuffle joins on
the order key in which AQE can split a skewed key on either side (a left
outer join could only split the preserved side). ``customer`` and ``part``
are left to the planner (broadcast only under the size threshold, else
sort-merge) and are joined to ``orders`` and ``lineitem`` before these meet, so
that a sort-merge join shuffles the narrow rows of one table and never the joined
ones; ``nation`` and ``region`` are broadcast only after their
estimated size is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.joins import broadcast_if_small, estimated_bytes
from ticketflow.session import table_path
from ticketflow.settings import NA_TOKENS, PipelineSettings
from ticketflow.sources.raw import RAW_COLUMNS, normalize_na

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"

# Extra raw columns (typed) that complete the duplicate order.
SOURCE_ORDER_COLUMNS = ("l_partkey", "l_suppkey", "l_extendedprice")

# Part-name keyword rules for the driver tables. Same shape and the same
# substring trap as the service categories ("cold" contains "old", so the
# "Cold Stock" rule only ever sees what earlier rules left over).
PART_CATEGORY_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Heavy Metal", ("anvil", "plate")),
    ("Vintage", ("old",)),
    ("Fasteners", ("bolt", "rod")),
    ("Mechanisms", ("gear", "gizmo", "widget")),
    ("Cold Stock", ("cold",)),
)

# Reference values the driver tables are checked against: every nation but
# the last is a known agency, every part name but one a known type.
UNKNOWN_AGENCY = "NATION_24"
UNKNOWN_COMPLAINT_TYPE = "red bolt"

TESTDATA_SETTINGS = PipelineSettings(
    category_rules=PART_CATEGORY_RULES,
    order_columns=("created_date", "closed_date") + SOURCE_ORDER_COLUMNS,
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# Bytes of stored input for one shuffle partition of the stages.
BYTES_PER_TASK = 16 * 1024 * 1024


def stage_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Shuffle partitions that keep a task's share of the raw requests the same for inputs of any size."""
    size = sum(estimated_bytes(read_table(spark, sf_dir, t)) or 0 for t in ("orders", "lineitem"))
    return max(1, -(-size // BYTES_PER_TASK))


# Bytes of stored orders and lines that are landed at once, and the most slices into which they are cut.
BYTES_PER_SLICE = 256 * 1024 * 1024
MAX_SLICES = 4


def raw_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw requests in slices of order keys, to be landed one after the other.

    The disk then holds the shuffles of one slice. Every slice reads the tables, so there are few of them.
    """
    size = sum(estimated_bytes(read_table(spark, sf_dir, t)) or 0 for t in ("orders", "lineitem"))
    n = min(MAX_SLICES, max(1, -(-size // BYTES_PER_SLICE)))
    return [raw_requests(spark, sf_dir, n, i) for i in range(n)]


def iso_text(c) -> F.Column:
    return F.date_format(c, ISO_FORMAT)


def raw_requests(spark: SparkSession, sf_dir: str, slices: int = 1, at: int = 0) -> DataFrame:
    """Raw request frame (all-string contract columns + typed order columns), or slice ``at`` of ``slices`` by order key."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    if slices > 1:  # rows without an order key are in one slice too
        o, li = (df.where(F.pmod(F.xxhash64(F.col(k).cast("bigint")), F.lit(slices)) == at)
                 for df, k in ((o, "o_orderkey"), (li, "l_orderkey")))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = broadcast_if_small(read_table(spark, sf_dir, "nation")
                           .select("n_nationkey", "n_name", "n_regionkey"))
    r = broadcast_if_small(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")

    o = o.join(c, o.o_custkey == c.c_custkey, "inner").drop("o_custkey", "c_custkey")
    parts = li.join(p, li.l_partkey == p.p_partkey, "left").drop("p_partkey")
    lines = o.join(parts.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "inner")
    # distinct keys: a hot order key is collapsed map-side before the anti join
    lineless = o.join(li.select("l_orderkey").distinct().hint("merge"),
                      F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    j = (lines.unionByName(lineless, allowMissingColumns=True)
         .join(n, F.col("c_nationkey") == n.n_nationkey, "inner")
         .join(r, n.n_regionkey == r.r_regionkey, "inner"))

    has_line = F.col("l_orderkey").isNotNull()
    raw = j.select(
        F.when(has_line, (F.col("o_orderkey") * 10 + F.col("l_linenumber")).cast("string"))
         .alias("unique_key"),
        F.when(F.col("o_orderkey") % 997 == 0, F.lit("not-a-date"))
         .otherwise(iso_text(F.col("o_orderdate"))).alias("created_date"),
        F.when(F.col("l_linestatus") == "F", iso_text(F.col("l_shipdate"))).alias("closed_date"),
        F.col("n_name").alias("agency"),
        # two spellings of every name, one of them more frequent
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("n_name"), F.lit(" Agency")))
         .otherwise(F.concat(F.lit("Agency of "), F.col("n_name"))).alias("agency_name"),
        F.col("p_name").alias("complaint_type"),
        F.when(F.col("l_returnflag") != "N",
               F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" "))).alias("descriptor"),
        F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name"))
         .otherwise(F.concat(F.lower(F.col("r_name")), F.lit(" "))).alias("borough"),
        F.when(F.col("l_linenumber") == 7, F.col("l_partkey").cast("string"))
         .otherwise(F.lpad(F.col("l_partkey").cast("string"), 5, "0")).alias("incident_zip"),
        F.when(F.col("l_linestatus") == "F", F.lit(" closed"))
         .when(F.col("l_linestatus") == "O", F.lit("open")).alias("status"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("city"),
        *[F.col(x) for x in SOURCE_ORDER_COLUMNS],
    )
    # Raw text goes through the same NA-token rule as a raw CSV scan.
    return normalize_na(raw, NA_TOKENS, RAW_COLUMNS)


def reference_sets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Known agencies / complaint types / boroughs (one column each)."""
    nation = read_table(spark, sf_dir, "nation")
    part = read_table(spark, sf_dir, "part")
    region = read_table(spark, sf_dir, "region")
    return {
        "agency": nation.where(F.col("n_name") != UNKNOWN_AGENCY)
                        .select(F.col("n_name").alias("agency_code")),
        "complaint_type": part.where(F.col("p_name") != UNKNOWN_COMPLAINT_TYPE)
                              .select(F.col("p_name").alias("complaint_type")),
        "borough": region.select(F.col("r_name").alias("borough")),
    }


def fractional_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests with sub-hour resolution times (created = event time,
    closed = 2024-02-01 00:00), to exercise fractional-hour rounding."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return ev.select(
        F.col("event_id").cast("string").alias("unique_key"),
        F.col("ts").alias("created_date"),
        F.lit("2024-02-01 00:00:00").try_cast("timestamp_ntz").alias("closed_date"),
        F.col("event_type").alias("complaint_type"),
    )
