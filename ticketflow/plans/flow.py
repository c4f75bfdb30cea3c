"""End-to-end stage composition: raw → dimensions → flagged → curated → marts.

``compose`` wires every stage as a DataFrame. With a ``keep`` function (as
``testdata_stages`` and ``run_pipeline`` pass) each stage is written as a
Parquet table — under the session's checkpoint directory, or under the
output directory of ``run_pipeline`` — and read back: the same hand-over
the batch pipeline makes between its steps. That cuts lineage (a lost
executor re-reads a written table instead of recomputing the whole chain),
gives the planner measured file sizes, so the dimension broadcasts are
checked against real bytes, and lets an ``Observation`` count each stage's
rows during its write. ``testdata_stages`` reuses written stages within a
session while the input files are unchanged; a stage is written when a query first
reads it or a stage made from it, so no query pays for stages it does not use.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import fields
from functools import cached_property
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticketflow.functions.timecols import parse_ts
from ticketflow.operators import dims as D
from ticketflow.operators import quality as Q
from ticketflow.operators import transform as T
from ticketflow.plans import marts as M
from ticketflow.session import released_shuffles, scratch_path, sized_shuffles
from ticketflow.settings import DEFAULT_SETTINGS, PipelineSettings
from ticketflow.sources import testdata as TD


LANDING_TS = "_created_ts"

# Tables that the steps hand over, in run order, and properties of ``Stages`` of other names.
HANDOVERS = ("raw", "dim_value_counts", "dimensions", "flagged", "curated", "monthly", "daily")
_PROPERTIES = {"raw": "landed", "dim_value_counts": "value_counts", "dimensions": "_dimensions"}

# Codec of tables that only the stages themselves read.
SCRATCH_CODEC = "zstd"


def write_table(df: DataFrame | Sequence[DataFrame], name: str, partition_by: tuple[str, ...] = (),
                counts: dict | None = None, path: str | None = None,
                paths: dict | None = None, compression: str | None = None,
                widen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Write ``df`` as Parquet (under the checkpoint directory unless ``path``
    is given) and read it back; the row count is observed during the write.
    What the write shuffled is deleted when it ends, so that the disk holds the
    tables and the shuffles of one stage, not of all. ``compression`` is the codec of
    the files (default: the session's). ``widen`` is applied to the dealt rows, so that
    columns it adds are not shuffled; it must not deal them anew. Several frames are
    the parts of one table, written one after the other.

    A partitioned write is rebalanced first: AQE cuts the data into
    advisory-size tasks per partition value (splitting big months, merging
    small ones), so files are neither tiny nor one-per-month giants.
    """
    parts = [df] if isinstance(df, DataFrame) else df
    spark, rows = parts[0].sparkSession, 0
    path = path or scratch_path(spark, name)
    for i, part in enumerate(parts):
        obs = Observation(f"rows_{name}_{uuid.uuid4().hex[:8]}")
        if partition_by:
            part = part.hint("rebalance", *partition_by)
        if widen is not None:
            part = widen(part)
        w = part.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append" if i else "overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if compression:
            w = w.option("compression", compression)
        with released_shuffles(spark):
            w.parquet(path)
        rows += int(obs.get["rows"])
    if counts is not None:
        counts[name] = rows
    if paths is not None:
        paths[name] = path
    return spark.read.parquet(path)


class Stages:
    """The stage tables, each built when it is first asked for, after those it is made from.

    A query thus pays for the stages it reads and for no others; ``build`` makes all.
    ``counts`` and ``paths`` (rows written, counted by Observations, and place of each
    stage) are filled as stages are written. ``raw`` may be given in parts, which ``keep``
    then writes one after the other.
    """

    def __init__(self, raw: DataFrame | Sequence[DataFrame], refs: dict | None, settings: PipelineSettings,
                 keep: Callable[..., DataFrame] | None = None,
                 counts: dict | None = None, paths: dict | None = None):
        self._raw, self._refs, self.settings = raw, refs, settings
        self._keep = keep or (lambda df, name, part=(), widen=None: widen(df) if widen else df)
        self.counts, self.paths = counts, paths

    @cached_property
    def landed(self) -> DataFrame:
        """Landed raw requests: every later stage (and the key census of the
        duplicate flag, which reads only the key column) scans this table. The
        landing also stores the parsed creation time, so date-range slices of
        it are filters the Parquet scan applies (row groups skipped by min/max);
        the stages themselves never read that column."""
        parts = [self._raw] if isinstance(self._raw, DataFrame) else self._raw
        parts = [p.withColumn(LANDING_TS, parse_ts(F.col("created_date"))) for p in parts]
        return self._keep(parts[0] if len(parts) == 1 else parts, "raw", ())

    @property
    def raw(self) -> DataFrame:
        return self.landed.drop(LANDING_TS)

    @cached_property
    def value_counts(self) -> DataFrame:
        """Counts of the dimension values; one scan for all three."""
        return self._keep(D.value_counts(self.raw), "dim_value_counts", ())

    @cached_property
    def _dimensions(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return D.split_dimensions(self._keep(D.all_dimensions(self.value_counts, self.settings), "dimensions", ()))

    @property
    def dim_agency(self) -> DataFrame:
        return self._dimensions[0]

    @property
    def dim_complaint_type(self) -> DataFrame:
        return self._dimensions[1]

    @property
    def dim_borough(self) -> DataFrame:
        return self._dimensions[2]

    @property
    def refs(self) -> dict:
        if self._refs is not None:
            return self._refs
        return {"agency": self.dim_agency.select("agency_code"),
                "complaint_type": self.dim_complaint_type.select("complaint_type"),
                "borough": self.dim_borough.select("borough")}

    @cached_property
    def flagged(self) -> DataFrame:
        return self._keep(Q.flag_requests(self.raw, self.refs, self.settings, self._keep), "flagged", ())

    @property
    def valid(self) -> DataFrame:
        return Q.valid_rows(self.flagged)

    @property
    def rejected(self) -> DataFrame:
        return Q.rejected_rows(self.flagged)

    @cached_property
    def curated(self) -> DataFrame:
        dims = (self.dim_agency, self.dim_complaint_type, self.dim_borough)

        def curate(valid: DataFrame) -> DataFrame:
            # the duplicate flag left one valid row of each key
            return T.curate(valid, *dims, self.settings, known_unique=True)

        if not T.dimensions_fit(dims, self.settings):  # their joins deal the rows
            return self._keep(curate(self.valid), "curated", T.PARTITION_COLUMNS)
        return self._keep(T.with_month(self.valid), "curated", T.PARTITION_COLUMNS,
                          lambda df: curate(df.drop(*T.PARTITION_COLUMNS)))

    @cached_property
    def monthly(self) -> DataFrame:
        return self._keep(M.monthly_summary(self.curated), "monthly", ())

    @cached_property
    def daily(self) -> DataFrame:
        return self._keep(M.daily_summary(self.curated), "daily", ())

    def build(self) -> Stages:
        """Make every stage, in run order."""
        for name in HANDOVERS:
            getattr(self, _PROPERTIES.get(name, name))
        return self

    def path_of(self, name: str) -> str:
        """Where the kept stage ``name`` (of ``HANDOVERS``) lies."""
        getattr(self, _PROPERTIES.get(name, name))
        return self.paths[name]


def compose(raw: DataFrame | Sequence[DataFrame], refs: dict | None, settings: PipelineSettings,
            keep: Callable[..., DataFrame] | None = None,
            counts: dict | None = None, paths: dict | None = None) -> Stages:
    """Wire the stages; ``keep`` (optional) materialises a named stage (see ``write_table``).

    ``refs`` are the known agencies / complaint types / boroughs the quality
    rules check against; ``None`` means the dimensions built from this raw
    input, as the batch pipeline validates against its own reference build.
    """
    return Stages(raw, refs, settings, keep, counts, paths)


def run_pipeline(spark: SparkSession, raw_path: str, out_dir: str,
                 settings: PipelineSettings = DEFAULT_SETTINGS, refs: dict | None = None,
                 database: str | None = None, multiline: bool = False) -> Stages:
    """The whole batch pipeline over raw request CSV(s), outputs under ``out_dir``.

    Input files split by size; ``multiline`` is for files whose quoted fields
    hold line breaks, each of which is then read by one task.

    Writes, like the step-by-step batch jobs: the stage tables (Parquet), the
    three dimensions and the valid / rejected requests as CSV (one write, whose
    observed counts are the ingestion report), the reports as JSON, lines that are
    no records as ``quarantine`` (counted in ``counts``), the curated table
    partitioned by (year, month); with ``database`` also the catalog tables and marts.
    """
    from ticketflow.sources import files as FS
    from ticketflow.sources import raw as R

    base = out_dir.rstrip("/")
    counts: dict = {}
    paths: dict = {}

    def keep(df: DataFrame, name: str, part: tuple = (), widen: Callable | None = None) -> DataFrame:
        return write_table(df, name, part, counts, path=f"{base}/tables/{name}", paths=paths, widen=widen)

    raw, bad = R.read_raw_csv_checked(spark, raw_path, na_tokens=settings.na_tokens, multiline=multiline)
    st = compose(raw, refs, settings, keep, counts, paths).build()
    for name, dim in (("dim_agency", st.dim_agency), ("dim_complaint_type", st.dim_complaint_type),
                      ("dim_borough", st.dim_borough)):
        FS.write_csv(dim, f"{base}/reference/{name}", single_file=True)
    totals = FS.write_split(st.flagged, f"{base}/processed/requests")
    FS.write_json_report(Q.frame_of_totals(totals, settings.thresholds), f"{base}/processed/ingestion_report")
    bad_lines = bad.select(F.lit("malformed").alias("problem"), R.BAD_LINE, R.BAD_FILE)
    write_table(bad_lines, "quarantine", counts=counts, path=f"{base}/processed/quarantine", paths=paths)
    FS.write_json_report(dimension_report(st), f"{base}/reference/reference_build_report")
    if database:
        # managed tables live under the output folder, not a local warehouse
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base}/warehouse'")
        FS.register_external_table(spark, database, "service_requests", f"{base}/tables/curated",
                                   T.PARTITION_COLUMNS)
        for name, df in (("borough_category_monthly_summary", st.monthly),
                         ("borough_category_daily_summary", st.daily)):
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
            df.write.mode("overwrite").saveAsTable(f"`{database}`.`{name}`")
    return st


_CACHE: dict[tuple, Stages] = {}


def _fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Sizes, file counts and newest modification times of the inputs (cache key).

    A file rewritten in a subfolder with the same size changes its own time only, so
    folders are listed to the bottom, one path after the other. Without a JVM gateway (e.g. Spark Connect) a fresh value is returned,
    so stages are simply rebuilt instead of reused."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        h = hashlib.sha1()
        for p in paths:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            fs = hp.getFileSystem(conf)
            size, newest = fs.getContentSummary(hp), fs.getFileStatus(hp).getModificationTime()
            files = fs.listFiles(hp, True)
            while files.hasNext():
                newest = max(newest, files.next().getModificationTime())
            h.update(f"{p}|{size.getLength()}|{size.getFileCount()}|{newest};".encode())
        return h.hexdigest()
    except Exception:  # noqa: BLE001 - no gateway: never reuse
        return uuid.uuid4().hex


INPUT_TABLES = ("orders", "lineitem", "customer", "nation", "region", "part")


def testdata_stages(spark: SparkSession, sf_dir: str, materialize: bool = True,
                    settings: PipelineSettings = TD.TESTDATA_SETTINGS) -> Stages:
    """The stages over the driver tables (see ``sources.testdata``), each written when it is first read."""
    if not materialize:
        return compose(TD.raw_requests(spark, sf_dir), TD.reference_sets(spark, sf_dir), settings)
    fp = _fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in INPUT_TABLES])
    key = (id(spark), spark.conf.get("spark.app.id", ""), fp,
           tuple(getattr(settings, f.name) if f.name != "thresholds" else
                 tuple(sorted(settings.thresholds.items())) for f in fields(settings)))
    hit = _CACHE.get(key)
    if hit is not None:
        return hit
    counts: dict = {}
    paths: dict = {}
    tasks = TD.stage_tasks(spark, sf_dir)

    def keep(df: DataFrame | Sequence[DataFrame], name: str, part: tuple = (), widen: Callable | None = None) -> DataFrame:
        with sized_shuffles(spark, tasks):
            return write_table(df, name, part, counts, paths=paths, compression=SCRATCH_CODEC, widen=widen)

    st = compose(TD.raw_slices(spark, sf_dir), TD.reference_sets(spark, sf_dir), settings, keep, counts, paths)
    _CACHE[key] = st
    return st


def clear_cache() -> None:
    _CACHE.clear()


def categories_of(settings: PipelineSettings) -> list[str]:
    """Every category the rules can produce, in rule order, then the default."""
    from ticketflow.settings import DEFAULT_CATEGORY
    return [c for c, _ in settings.category_rules] + [DEFAULT_CATEGORY]


def dimension_report(st: Stages) -> DataFrame:
    return D.build_report(st.value_counts, st.dim_agency, st.dim_complaint_type, st.dim_borough)


def unmatched_keys(enriched: DataFrame) -> DataFrame:
    """Rows whose keys found no dimension row (NULL ids), per dimension."""
    return enriched.agg(F.count_if(F.col("agency_id").isNull()).alias("unmatched_agency"),
                 F.count_if(F.col("complaint_type_id").isNull()).alias("unmatched_complaint_type"),
                 F.count_if(F.col("borough_id").isNull()).alias("unmatched_borough"))


def handover_counts(st: Stages) -> DataFrame:
    """(step, stage, rows) counted in the written stage tables."""
    spark = st.raw.sparkSession
    out = None
    for i, name in enumerate(HANDOVERS):
        one = spark.read.parquet(st.path_of(name)).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i + 1).alias("step"), F.lit(name).alias("stage"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
