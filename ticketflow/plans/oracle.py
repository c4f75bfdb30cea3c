"""Independent SQL (DuckDB dialect) for every registered query.

Written from the semantics, not from the Spark plans: duplicates use a
window ``row_number``, membership uses ``NOT IN``, dimensions use window
ids, averages use integer arithmetic. Tables ``orders lineitem customer
nation region part events`` are the driver's pre-registered views.
"""

from __future__ import annotations

from ticketflow.functions.categories import categorize_sql
from ticketflow.functions.text import WHITESPACE
from ticketflow.settings import CATEGORY_RULES, NA_TOKENS, REJECTION_REASONS
from ticketflow.sources.testdata import (
    PART_CATEGORY_RULES, UNKNOWN_AGENCY, UNKNOWN_COMPLAINT_TYPE,
)
from ticketflow.plans import registry as REG

RAW_TEXT = ["unique_key", "created_date", "closed_date", "agency", "agency_name", "complaint_type",
            "descriptor", "borough", "incident_zip", "status", "city"]
EXTRA = ["l_partkey", "l_suppkey", "l_extendedprice"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NA = ", ".join(_q(t) for t in NA_TOKENS)


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({_NA}) THEN NULL ELSE {c} END"


_WS = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)


def _strip(c: str) -> str:
    return f"trim({c}, {_WS})"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {_strip(c)} = '')"


def _ts(c: str) -> str:
    return f"TRY_CAST({c} AS TIMESTAMP)"


ORDER_SQL = ("created_date ASC NULLS LAST, closed_date ASC NULLS LAST, l_partkey ASC NULLS LAST, "
             "l_suppkey ASC NULLS LAST, l_extendedprice ASC NULLS LAST")

_REST_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in RAW_TEXT if c not in ("created_date", "closed_date"))

_REASONS = ", ".join(f"CASE WHEN {r} THEN {_q(r)} END" for r in REJECTION_REASONS)


def _cents_avg(cents: str) -> str:
    n = f"count({cents})"
    return f"CASE WHEN {n} > 0 THEN ((2 * sum({cents}) + {n}) // (2 * {n})) / 100.0 END"


BASE = f"""
WITH src AS (
  SELECT
    CASE WHEN l.l_orderkey IS NOT NULL THEN CAST(o.o_orderkey * 10 + l.l_linenumber AS VARCHAR) END AS unique_key,
    CASE WHEN o.o_orderkey % 997 = 0 THEN 'not-a-date'
         ELSE strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') END AS created_date,
    CASE WHEN l.l_linestatus = 'F' THEN strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%S.%g') END AS closed_date,
    n.n_name AS agency,
    CASE WHEN o.o_orderkey % 3 = 0 THEN n.n_name || ' Agency' ELSE 'Agency of ' || n.n_name END AS agency_name,
    p.p_name AS complaint_type,
    CASE WHEN l.l_returnflag <> 'N' THEN ' ' || l.l_returnflag || ' ' END AS descriptor,
    CASE WHEN n.n_nationkey % 2 = 0 THEN r.r_name ELSE lower(r.r_name) || ' ' END AS borough,
    CASE WHEN l.l_linenumber = 7 THEN CAST(l.l_partkey AS VARCHAR)
         ELSE lpad(CAST(l.l_partkey AS VARCHAR), 5, '0') END AS incident_zip,
    CASE WHEN l.l_linestatus = 'F' THEN ' closed' WHEN l.l_linestatus = 'O' THEN 'open' END AS status,
    CASE WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_mktsegment END AS city,
    l.l_partkey, l.l_suppkey, l.l_extendedprice
  FROM orders o
  LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
raw AS (
  SELECT {", ".join(f"{_na(c)} AS {c}" for c in RAW_TEXT)}, {", ".join(EXTRA)} FROM src
),
ref_agency AS (SELECT n_name AS agency_code FROM nation WHERE n_name <> {_q(UNKNOWN_AGENCY)}),
ref_type AS (SELECT p_name AS complaint_type FROM part WHERE p_name <> {_q(UNKNOWN_COMPLAINT_TYPE)}),
ref_borough AS (SELECT r_name AS borough FROM region),
f0 AS (
  SELECT *,
    {_blank("unique_key")} AS missing_unique_key,
    {_blank("agency")} AS missing_agency,
    {_blank("complaint_type")} AS missing_complaint_type,
    CASE WHEN unique_key IS NULL THEN false
         ELSE row_number() OVER (PARTITION BY unique_key ORDER BY {ORDER_SQL}) > 1 END
      AS duplicate_unique_key,
    {_ts("created_date")} IS NULL AS invalid_created_date,
    coalesce(NOT {_blank("closed_date")} AND {_ts("closed_date")} IS NOT NULL
             AND {_ts("created_date")} IS NOT NULL AND {_ts("closed_date")} < {_ts("created_date")},
             false) AS closed_before_created,
    coalesce(agency IS NOT NULL AND agency NOT IN (SELECT agency_code FROM ref_agency
                                                   WHERE agency_code IS NOT NULL), false)
      AS unknown_agency,
    coalesce(complaint_type IS NOT NULL AND complaint_type NOT IN (
               SELECT complaint_type FROM ref_type WHERE complaint_type IS NOT NULL), false)
      AS unknown_complaint_type,
    coalesce(borough IS NOT NULL AND borough NOT IN (SELECT borough FROM ref_borough
                                                     WHERE borough IS NOT NULL), false)
      AS unknown_borough,
    NOT (incident_zip IS NULL OR regexp_full_match(
           {_strip("incident_zip")}, '[0-9]{{5}}')) AS invalid_zip_format
  FROM raw
),
flagged AS (SELECT *, concat_ws(';', {_REASONS}) AS _rejection_reasons FROM f0),
valid AS (SELECT {", ".join(RAW_TEXT + EXTRA)} FROM flagged WHERE _rejection_reasons = ''),
rejected AS (SELECT {", ".join(RAW_TEXT + EXTRA)}, _rejection_reasons FROM flagged
             WHERE _rejection_reasons <> ''),
dim_in AS (
  SELECT coalesce(agency, 'UNKNOWN') AS agency, coalesce(agency_name, 'UNKNOWN') AS agency_name,
         coalesce(complaint_type, 'UNKNOWN') AS complaint_type,
         coalesce(borough, 'UNKNOWN') AS borough
  FROM raw
),
agency_names AS (
  SELECT agency AS agency_code, agency_name, count(*) AS record_count FROM dim_in GROUP BY 1, 2
),
dim_agency AS (
  SELECT CAST(row_number() OVER (ORDER BY agency_code) AS BIGINT) AS agency_id, agency_code,
         agency_name, record_count
  FROM (
    SELECT agency_code,
           first(agency_name ORDER BY record_count DESC, agency_name ASC) AS agency_name,
           CAST(sum(record_count) AS BIGINT) AS record_count
    FROM agency_names GROUP BY agency_code
  )
),
dim_complaint_type AS (
  SELECT CAST(row_number() OVER (ORDER BY complaint_type) AS BIGINT) AS complaint_type_id,
         complaint_type, {categorize_sql("complaint_type", PART_CATEGORY_RULES)} AS category,
         record_count
  FROM (SELECT complaint_type, count(*) AS record_count FROM dim_in GROUP BY 1)
),
dim_borough AS (
  SELECT CAST(row_number() OVER (ORDER BY borough) AS BIGINT) AS borough_id, borough, record_count
  FROM (SELECT upper({_strip("borough")}) AS borough, count(*) AS record_count
        FROM dim_in GROUP BY 1)
),
dedup AS (
  SELECT {", ".join(RAW_TEXT + EXTRA)} FROM (
    SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY {ORDER_SQL}) AS rn FROM valid)
  WHERE rn = 1
),
std AS (
  SELECT unique_key, created_date, closed_date, upper(trim(agency)) AS agency, agency_name,
         trim(complaint_type) AS complaint_type, coalesce(trim(descriptor), 'UNKNOWN') AS descriptor,
         upper(trim(borough)) AS borough, incident_zip, upper(trim(status)) AS status,
         coalesce(city, 'UNKNOWN') AS city, l_partkey, l_suppkey, l_extendedprice
  FROM dedup
),
parsed AS (
  SELECT * REPLACE ({_ts("created_date")} AS created_date, {_ts("closed_date")} AS closed_date)
  FROM std
),
derived AS (
  SELECT *,
    CASE WHEN closed_date IS NOT NULL THEN
      ((CAST(floor(epoch(closed_date)) AS BIGINT) - CAST(floor(epoch(created_date)) AS BIGINT)) * 100
        + 1800) // 3600 / 100.0 END AS resolution_hours,
    CASE WHEN closed_date IS NOT NULL THEN
      CAST(date_diff('day', CAST(created_date AS DATE), CAST(closed_date AS DATE)) AS INTEGER)
      END AS resolution_days,
    CAST(year(created_date) AS INTEGER) AS created_year,
    CAST(month(created_date) AS INTEGER) AS created_month,
    CAST(hour(created_date) AS INTEGER) AS created_hour,
    CAST(dayofweek(created_date) + 1 AS INTEGER) AS created_day_of_week
  FROM parsed
),
curated AS (
  SELECT d.*, a.agency_id, a.agency_name AS dim_agency_name, t.complaint_type_id,
         t.category AS complaint_category, b.borough_id
  FROM derived d
  LEFT JOIN dim_agency a ON d.agency = a.agency_code
  LEFT JOIN dim_complaint_type t ON d.complaint_type = t.complaint_type
  LEFT JOIN dim_borough b ON d.borough = b.borough
),
curated_c AS (
  SELECT *, CAST(round(resolution_hours * 100) AS BIGINT) AS cents FROM curated
),
monthly AS (
  SELECT created_year, created_month, borough, complaint_category,
         count(*) AS total_requests,
         {_cents_avg("cents")} AS avg_resolution_hours,
         count(*) FILTER (WHERE status = 'CLOSED') AS closed_requests,
         count(*) FILTER (WHERE resolution_hours IS NULL) AS unresolved_requests
  FROM curated_c GROUP BY 1, 2, 3, 4
),
daily AS (
  SELECT CAST(created_date AS DATE) AS request_date, borough, complaint_category,
         count(*) AS total_requests,
         {_cents_avg("cents")} AS avg_resolution_hours,
         count(*) FILTER (WHERE status = 'CLOSED') AS closed_requests,
         count(*) FILTER (WHERE resolution_hours IS NULL) AS unresolved_requests
  FROM curated_c GROUP BY 1, 2, 3
),
damage AS (
  SELECT unique_key, agency, descriptor, closed_date, resolution_hours, CAST(unique_key AS BIGINT) % 50 AS n FROM curated
),
damaged AS (
  SELECT unique_key, CASE WHEN n = 3 THEN descriptor ELSE agency END AS agency,
         CASE WHEN n = 3 THEN agency ELSE descriptor END AS descriptor, closed_date, resolution_hours
  FROM (SELECT * FROM damage WHERE n <> 1 UNION ALL SELECT * FROM damage WHERE n = 2)
),
in_range AS (
  SELECT * FROM raw
  WHERE {_ts("created_date")} BETWEEN TIMESTAMP '{REG.SLICE_START} 00:00:00'
                                  AND TIMESTAMP '{REG.SLICE_END} 23:59:59'
)
"""

SLICE_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in [
    "TRY_CAST(created_date AS TIMESTAMP)", "unique_key", *EXTRA, *[c for c in RAW_TEXT if c != "unique_key"]])
RAW_COLS = ", ".join(RAW_TEXT)
MONTHLY_COLS = ", ".join(REG.MONTHLY_COLS)
DAILY_COLS = ", ".join(REG.DAILY_COLS)
CURATED_COLS = ", ".join(
    RAW_TEXT + EXTRA + ["resolution_hours", "resolution_days", "created_hour", "created_day_of_week",
                        "agency_id", "dim_agency_name", "complaint_type_id", "complaint_category",
                        "borough_id", "created_year", "created_month"])
CATEGORIES = [c for c, _ in PART_CATEGORY_RULES] + ["Other"]


def _flags(*names: str) -> str:
    return f"SELECT {RAW_COLS}, {', '.join(names)} FROM flagged"


def _reason_rows() -> str:
    parts = [f"SELECT {_q(r)} AS reason, count(*) FILTER (WHERE {r}) AS rows FROM flagged"
             for r in REJECTION_REASONS]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE rows > 0"


def _threshold_rows() -> str:
    from ticketflow.settings import THRESHOLD_CHECKS
    th = REG.TD.TESTDATA_SETTINGS.thresholds
    parts = []
    for check, reason, key in THRESHOLD_CHECKS:
        lim = th.get(key)
        n = f"count(*) FILTER (WHERE {reason})"
        parts.append(
            f"SELECT {_q(check)} AS check_name, "
            f"((2000000 * {n} + count(*)) // (2 * count(*))) / 1000000.0 AS value, "
            f"CAST({'NULL' if lim is None else repr(float(lim))} AS DOUBLE) AS threshold, "
            f"({n} / count(*)) <= {1.0 if lim is None else float(lim)} AS within_threshold "
            f"FROM flagged HAVING count(*) > 0")
    return " UNION ALL ".join(parts)


def _contract() -> str:
    from ticketflow.settings import REQUIRED_COLUMNS
    parts = [f"SELECT {i + 1} AS position, {_q(c)} AS column_name, true AS present, "
             f"count({c}) AS non_null_rows, count(*) FILTER (WHERE {_blank(c)}) AS blank_rows FROM raw"
             for i, c in enumerate(REQUIRED_COLUMNS)]
    return " UNION ALL ".join(parts)


def _mart_rules(mart: str, dates: list[str], key: list[str]) -> str:
    rules = [(f"{d}_not_null", f"{d} IS NOT NULL") for d in dates]
    if "created_month" in dates:
        rules.append(("created_month_between_1_12", "created_month BETWEEN 1 AND 12"))
    rules += [
        ("borough_not_null", "borough IS NOT NULL"),
        ("borough_max_len", "borough IS NULL OR length(borough) <= 20"),
        ("complaint_category_not_null", "complaint_category IS NOT NULL"),
        ("complaint_category_max_len", "complaint_category IS NULL OR length(complaint_category) <= 50"),
        ("total_requests_non_negative", "total_requests >= 0"),
        ("closed_requests_non_negative", "closed_requests >= 0"),
        ("unresolved_requests_non_negative", "unresolved_requests >= 0"),
        ("avg_resolution_hours_fits_numeric_10_2",
         "avg_resolution_hours IS NULL OR abs(avg_resolution_hours) < 1e8"),
    ]
    parts = [f"SELECT {_q(mart)} AS mart, {_q(n)} AS rule, "
             f"count(*) FILTER (WHERE NOT coalesce({p}, false)) AS violations FROM {mart}"
             for n, p in rules]
    k = ", ".join(key)
    parts.append(f"SELECT {_q(mart)} AS mart, {_q('unique_' + '_'.join(key))} AS rule, "
                 f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS violations FROM (SELECT {k}, count(*) AS c FROM {mart} "
                 f"GROUP BY ALL HAVING count(*) > 1)")
    return " UNION ALL ".join(parts)


def _resolution(where: str = "") -> str:
    w = f" AND {where}" if where else ""
    return (f"SELECT complaint_category, {_cents_avg('cents')} AS avg_resolution_hours, "
            f"count(*) AS closed_requests FROM curated_c WHERE resolution_hours IS NOT NULL{w} "
            f"GROUP BY 1")


_INGEST = """SELECT count(*) AS total_rows,
        count(*) FILTER (WHERE _rejection_reasons = '') AS valid_rows,
        count(*) FILTER (WHERE _rejection_reasons <> '') AS rejected_rows,
        CASE WHEN count(*) > 0 THEN ((2000000 * count(*) FILTER (WHERE _rejection_reasons = '')
             + count(*)) // (2 * count(*))) / 10000.0 ELSE 0.0 END AS pass_rate_pct
        FROM flagged"""

BODIES: dict[str, str] = {
    "raw_scan": "SELECT * FROM raw",
    "csv_roundtrip": f"SELECT {RAW_COLS} FROM raw",
    "json_pages_scan": f"SELECT {RAW_COLS} FROM raw",
    "schema_contract": _contract(),
    "keyset_page": f"""SELECT {RAW_COLS} FROM in_range
        WHERE TRY_CAST(created_date AS TIMESTAMP) > TIMESTAMP '{REG.PAGE_CURSOR[0].replace("T", " ")}'
           OR (TRY_CAST(created_date AS TIMESTAMP) = TIMESTAMP '{REG.PAGE_CURSOR[0].replace("T", " ")}'
               AND (unique_key > {_q(REG.PAGE_CURSOR[1])} OR unique_key IS NULL))
        ORDER BY {SLICE_ORDER} LIMIT {REG.PAGE_SIZE}""",
    "resume_cursor": f"""SELECT last(created_date ORDER BY rn) AS last_created_date,
        last(unique_key ORDER BY rn) AS last_unique_key, count(*) AS rows_written
        FROM (SELECT *, row_number() OVER (ORDER BY {SLICE_ORDER}) AS rn FROM in_range)""",
    "incremental_slice": f"SELECT {RAW_COLS} FROM in_range",
    "capped_slice": f"SELECT {RAW_COLS} FROM in_range ORDER BY {SLICE_ORDER} LIMIT {REG.MAX_RECORDS}",
    "csv_two_headers": f"SELECT {', '.join(RAW_TEXT[:-1])}, CASE WHEN coalesce(created_date < '1998', false) THEN city END AS city FROM raw",
    "stream_landing": f"SELECT {RAW_COLS} FROM raw",
    "slice_manifest": f"""SELECT 'landing' AS output_location, '2024-01-01 00:00:00' AS started_at,
        '2024-01-01 00:00:01' AS finished_at, {_q(REG.SLICE_START)} AS query_start_date,
        {_q(REG.SLICE_END)} AS query_end_date, CAST(NULL AS BIGINT) AS max_records_cap,
        count(*) AS total_records_downloaded,
        last(created_date ORDER BY {SLICE_ORDER}) AS last_cursor_created_date,
        last(unique_key ORDER BY {SLICE_ORDER}) AS last_cursor_unique_key,
        true AS completed FROM in_range""",
    "align_union": f"""SELECT unique_key, created_date, closed_date, agency, agency_name, complaint_type,
        CASE WHEN coalesce(created_date < '1998', false) THEN descriptor END AS descriptor, borough, incident_zip,
        status, CASE WHEN coalesce(created_date < '1998', false) THEN NULL ELSE city END AS city FROM raw""",
    "discovered_pages": """SELECT unique_key, created_date, closed_date, agency, agency_name, complaint_type,
        CASE WHEN early THEN descriptor END AS descriptor, borough, incident_zip, status,
        CASE WHEN NOT early THEN city END AS city,
        CASE WHEN NOT early THEN CAST(length(complaint_type) AS VARCHAR) END AS extra_field
        FROM (SELECT *, coalesce(created_date < '1998', false) AS early FROM raw)""",
    "page_keys": " UNION ALL ".join(
        f"SELECT * FROM (SELECT {_q(c)} AS key, {_q('BIGINT' if c == 'extra_field' else 'STRING')} AS value_type, "
        f"count(*) AS records FROM raw WHERE {'complaint_type' if c == 'extra_field' else c} IS NOT NULL AND {w}) WHERE records > 0"
        for c in [*RAW_TEXT, "extra_field"] for w in [
            {"descriptor": "coalesce(created_date < '1998', false)", "city": "NOT coalesce(created_date < '1998', false)",
             "extra_field": "NOT coalesce(created_date < '1998', false)"}.get(c, "true")]),
    "quarantined_lines": f"""SELECT part, count(*) AS rows, CAST(sum(length(line)) AS BIGINT) AS characters FROM (
          SELECT CASE n WHEN 1 THEN 'too_few' WHEN 2 THEN 'too_many' ELSE 'read' END AS part,
            CASE n WHEN 1 THEN concat_ws(',', {', '.join(RAW_TEXT[:3])}) WHEN 2 THEN line || ',x,y' ELSE line END AS line
          FROM (SELECT *, coalesce(CAST(unique_key AS BIGINT) % 50, 0) AS n,
            concat_ws(',', {', '.join(f"coalesce({c}, '')" for c in RAW_TEXT)}) AS line FROM raw)
          UNION ALL
          SELECT 'lines', CASE n WHEN 1 THEN concat_ws(',', {', '.join(RAW_TEXT[:3])}) WHEN 2 THEN line || ',x,y' ELSE line END
          FROM (SELECT *, coalesce(CAST(unique_key AS BIGINT) % 50, 0) AS n,
            concat_ws(',', {', '.join(f"coalesce({c}, '')" for c in RAW_TEXT)}) AS line FROM raw)) GROUP BY 1""",
    "bucketed_key_join": """SELECT complaint_category, count(*) AS raw_rows FROM raw JOIN curated USING (unique_key)
        GROUP BY 1""",
    "partitioned_roundtrip": f"SELECT {CURATED_COLS} FROM curated",
    "external_table_scan": """SELECT created_year, created_month, count(*) AS total_rows,
        count(*) OVER () AS registered_partitions FROM curated GROUP BY 1, 2""",
    "flag_missing_fields": _flags("missing_unique_key", "missing_agency", "missing_complaint_type"),
    "flag_duplicate_keys": _flags("duplicate_unique_key"),
    "flag_bad_dates": _flags("invalid_created_date", "closed_before_created"),
    "flag_unknown_values": _flags("unknown_agency", "unknown_complaint_type", "unknown_borough"),
    "flag_bad_zip": _flags("invalid_zip_format"),
    "unknown_agency_rows": f"""SELECT {RAW_COLS} FROM raw WHERE agency IS NOT NULL
        AND agency NOT IN (SELECT agency_code FROM ref_agency)""",
    "known_agency_rows": f"SELECT {RAW_COLS} FROM raw WHERE agency IN (SELECT agency_code FROM ref_agency)",
    "rejection_reasons": _flags("_rejection_reasons"),
    "valid_requests": f"SELECT {RAW_COLS} FROM valid",
    "rejected_requests": f"SELECT {RAW_COLS}, _rejection_reasons FROM rejected",
    "rejection_reason_counts": _reason_rows(),
    "ingestion_report": _INGEST,
    "threshold_checks": _threshold_rows(),
    "split_invariant": """SELECT (SELECT count(*) FROM raw) AS raw_rows,
        (SELECT count(*) FROM valid) AS valid_rows, (SELECT count(*) FROM rejected) AS rejected_rows,
        (SELECT count(*) FROM raw) = (SELECT count(*) FROM valid) + (SELECT count(*) FROM rejected)
          AS complete""",
    "quality_profile": """SELECT count(*) AS total_rows, count(DISTINCT unique_key) AS distinct_keys,
        count(*) FILTER (WHERE unique_key IS NULL) AS null_keys,
        min(created_month) AS min_month, max(created_month) AS max_month,
        count(DISTINCT created_month) AS distinct_months,
        min(created_year) AS min_year, max(created_year) AS max_year,
        min(resolution_hours) AS min_resolution_hours,
        count(*) FILTER (WHERE complaint_category IS NULL) AS null_categories,
        count(*) FILTER (WHERE borough IS NULL) AS null_boroughs FROM curated""",
    "mart_constraints": _mart_rules("monthly", ["created_year", "created_month"],
                                    ["created_year", "created_month", "borough", "complaint_category"])
    + " UNION ALL " + _mart_rules("daily", ["request_date"],
                                  ["request_date", "borough", "complaint_category"]),
    "categorize": "SELECT complaint_type, category FROM dim_complaint_type",
    "categorize_service_rules": f"""SELECT complaint_type, count(*) AS requests,
        {categorize_sql("complaint_type", CATEGORY_RULES)} AS category FROM raw GROUP BY 1""",
    "dim_agency": "SELECT * FROM dim_agency",
    "dim_complaint_type": "SELECT * FROM dim_complaint_type",
    "dim_borough": "SELECT * FROM dim_borough",
    "agency_name_conflicts": """SELECT agency_code, agency_name, record_count FROM agency_names
        WHERE agency_code IN (SELECT agency_code FROM agency_names GROUP BY 1 HAVING count(*) > 1)""",
    "dim_build_report": """SELECT (SELECT count(*) FROM raw) AS rows_processed,
        (SELECT count(*) FROM dim_agency) AS agency_count,
        (SELECT count(*) FROM (SELECT agency_code FROM agency_names GROUP BY 1 HAVING count(*) > 1))
          AS agency_conflict_count,
        (SELECT count(*) FROM dim_complaint_type) AS complaint_type_count,
        (SELECT CASE WHEN (SELECT count(*) FROM raw) > 0 THEN
           ((20000 * coalesce(sum(record_count) FILTER (WHERE category = 'Other'), 0)
             + (SELECT count(*) FROM raw)) // (2 * (SELECT count(*) FROM raw))) / 100.0
           ELSE 0.0 END FROM dim_complaint_type) AS complaint_type_other_category_pct,
        (SELECT count(*) FROM dim_borough) AS borough_count""",
    "borough_values": "SELECT borough, record_count FROM dim_borough",
    "dedup_requests": f"SELECT {RAW_COLS} FROM dedup",
    "dedup_raw_requests": f"""SELECT {RAW_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY {ORDER_SQL}, {_REST_ORDER}) AS rn FROM raw)
        WHERE rn = 1""",
    "unmatched_dimension_keys": f"""SELECT
        count(*) FILTER (WHERE a IS NULL OR a NOT IN (SELECT agency_code FROM dim_agency
          WHERE agency_code <> {_q(UNKNOWN_AGENCY)})) AS unmatched_agency,
        count(*) FILTER (WHERE t IS NULL OR t NOT IN (SELECT complaint_type FROM dim_complaint_type
          WHERE complaint_type <> {_q(UNKNOWN_COMPLAINT_TYPE)})) AS unmatched_complaint_type,
        count(*) FILTER (WHERE b IS NULL OR b NOT IN (SELECT borough FROM dim_borough
          WHERE borough <> {_q(REG.FILTER_BOROUGH)})) AS unmatched_borough
        FROM (SELECT upper(trim(agency)) AS a, trim(complaint_type) AS t, upper(trim(borough)) AS b FROM raw)""",
    "rejection_reason_text_counts": """SELECT reason, count(*) AS rows
        FROM (SELECT unnest(string_split(_rejection_reasons, ';')) AS reason FROM rejected) GROUP BY 1""",
    "sql_tables": """SELECT 'service_requests' AS table_name, (SELECT count(*) FROM curated) AS rows
        UNION ALL SELECT 'borough_category_monthly_summary', (SELECT count(*) FROM monthly)
        UNION ALL SELECT 'borough_category_daily_summary', (SELECT count(*) FROM daily)""",
    "standardize_fields": f"""SELECT unique_key, created_date, closed_date, upper(trim(agency)) AS agency,
        agency_name, trim(complaint_type) AS complaint_type, trim(descriptor) AS descriptor,
        upper(trim(borough)) AS borough, incident_zip, upper(trim(status)) AS status, city FROM valid""",
    "fill_missing": f"""SELECT unique_key, created_date, closed_date, agency, agency_name, complaint_type,
        descriptor, borough, incident_zip, status, city FROM std""",
    "add_derived": """SELECT unique_key, created_date, closed_date, resolution_hours, resolution_days,
        created_year, created_month, created_hour, created_day_of_week FROM derived""",
    "enrich_requests": """SELECT unique_key, agency, complaint_type, borough, agency_id, dim_agency_name,
        complaint_type_id, complaint_category, borough_id FROM curated""",
    "stage_counts": """SELECT (SELECT count(*) FROM raw) AS raw_rows,
        (SELECT count(unique_key) - count(DISTINCT unique_key) FROM raw) AS raw_repeats, (SELECT count(*) FROM valid) AS valid_rows,
        (SELECT count(DISTINCT unique_key) FROM valid) AS distinct_valid_keys,
        (SELECT count(*) FROM curated) AS curated_rows,
        (SELECT count(*) FROM valid) - (SELECT count(DISTINCT unique_key) FROM valid) AS duplicates_removed""",
    "nan_to_null": """SELECT * REPLACE (CASE WHEN total_requests % 3 <> 0 THEN avg_resolution_hours END
        AS avg_resolution_hours) FROM monthly""",
    "monthly_summary": f"SELECT {MONTHLY_COLS} FROM monthly",
    "monthly_summary_head": f"""SELECT {MONTHLY_COLS} FROM monthly ORDER BY created_month ASC,
        total_requests DESC, created_year ASC, borough ASC NULLS LAST, complaint_category ASC NULLS LAST
        LIMIT {REG.HEAD_N}""",
    "daily_summary": f"SELECT {DAILY_COLS} FROM daily",
    "monthly_volume": f"""SELECT created_year, created_month, count(*) AS total_requests FROM curated
        WHERE created_year = {REG.VOLUME_YEAR} GROUP BY 1, 2 ORDER BY 1, 2""",
    "top_complaint_types": f"""SELECT complaint_type, complaint_category, count(*) AS total FROM curated
        GROUP BY 1, 2 ORDER BY total DESC, complaint_type ASC NULLS LAST,
        complaint_category ASC NULLS LAST LIMIT {REG.TOP_N}""",
    "top_category_per_borough_month": """SELECT created_month, borough, complaint_category, total_requests,
        category_rank FROM (SELECT *, CAST(rank() OVER (PARTITION BY borough, created_month
        ORDER BY total_requests DESC) AS INTEGER) AS category_rank FROM monthly) WHERE category_rank = 1""",
    "top_category_per_borough_year_month": """SELECT created_year, created_month, borough,
        complaint_category, total_requests, category_rank FROM (SELECT *, CAST(rank() OVER (
        PARTITION BY borough, created_month, created_year ORDER BY total_requests DESC) AS INTEGER)
        AS category_rank FROM monthly) WHERE category_rank = 1""",
    "category_totals_ytd": f"""SELECT complaint_category, CAST(sum(total_requests) AS BIGINT) AS total_requests,
        {_cents_avg("CAST(round(avg_resolution_hours * 100) AS BIGINT)")} AS avg_resolution_hours
        FROM monthly GROUP BY 1""",
    "daily_trend": "SELECT request_date, CAST(sum(total_requests) AS BIGINT) AS total_requests FROM daily GROUP BY 1",
    "daily_trend_for_borough": f"""SELECT request_date, CAST(sum(total_requests) AS BIGINT) AS total_requests FROM daily
        WHERE borough = {_q(REG.FILTER_BOROUGH)} GROUP BY 1""",
    "borough_category_totals": """SELECT borough, complaint_category, CAST(sum(total_requests) AS BIGINT) AS total_requests
        FROM monthly GROUP BY 1, 2""",
    "borough_category_pivot": "SELECT borough, " + ", ".join(
        f"CAST(sum(total_requests) FILTER (WHERE complaint_category = {_q(c)}) AS BIGINT) AS \"{c}\"" for c in CATEGORIES)
    + " FROM monthly GROUP BY 1",
    "resolution_by_category": _resolution(),
    "resolution_by_category_for_borough": _resolution(f"borough = {_q(REG.FILTER_BOROUGH)}"),
    "reconcile_monthly": """SELECT (SELECT count(*) FROM curated) AS raw_total,
        (SELECT CAST(coalesce(sum(total_requests), 0) AS BIGINT) FROM monthly) AS summary_total,
        (SELECT count(*) FROM curated) = (SELECT coalesce(sum(total_requests), 0) FROM monthly) AS match""",
    "reconcile_daily": """SELECT (SELECT count(*) FROM curated) AS raw_total,
        (SELECT CAST(coalesce(sum(total_requests), 0) AS BIGINT) FROM daily) AS daily_total,
        (SELECT count(*) FROM curated) = (SELECT coalesce(sum(total_requests), 0) FROM daily) AS match""",
    "fractional_hours_summary": f"""SELECT event_type AS complaint_type, count(*) AS requests,
        {_cents_avg("cents")} AS avg_resolution_hours, min(h) AS min_resolution_hours,
        max(h) AS max_resolution_hours FROM (
          SELECT event_type, h, CAST(round(h * 100) AS BIGINT) AS cents FROM (
            SELECT event_type, ((1706745600 - CAST(floor(epoch(ts)) AS BIGINT)) * 100 + 1800) // 3600 / 100.0
              AS h FROM events)) GROUP BY 1""",
    "serving_load": """SELECT 'borough_category_monthly_summary' AS table_name, count(*) AS source_rows,
        count(*) AS loaded_rows, true AS match FROM monthly
        UNION ALL SELECT 'borough_category_daily_summary', count(*), count(*), true FROM daily""",
    "mirror_reconcile": """SELECT count(*) AS source_rows, count(*) AS copy_rows, CAST(0 AS BIGINT) AS missing_rows,
        CAST(0 AS BIGINT) AS extra_rows, true AS match FROM curated""",
    "mirror_reconcile_damaged": """SELECT *, source_rows = copy_rows AND missing_rows = 0 AND extra_rows = 0 AS match
        FROM (SELECT (SELECT count(*) FROM damage) AS source_rows, (SELECT count(*) FROM damaged) AS copy_rows,
          (SELECT count(*) FROM (SELECT * EXCLUDE n FROM damage EXCEPT ALL SELECT * FROM damaged)) AS missing_rows,
          (SELECT count(*) FROM (SELECT * FROM damaged EXCEPT ALL SELECT * EXCLUDE n FROM damage)) AS extra_rows)""",
    "mart_csv_export": f"SELECT {MONTHLY_COLS} FROM monthly",
    "split_sink": """SELECT 'valid' AS part, count(*) AS rows, count(DISTINCT unique_key) AS distinct_keys,
        0 AS rows_with_reasons FROM valid
        UNION ALL SELECT 'rejected', count(*), count(DISTINCT unique_key), count(_rejection_reasons)
        FROM rejected""",
    "report_roundtrip": f"""SELECT t.total_rows, t.valid_rows, t.rejected_rows, t.pass_rate_pct, c.reason, c.rows
        FROM ({_INGEST}) t, ({_reason_rows()}) c""",
    "handover_counts": """SELECT 1 AS step, 'raw' AS stage, (SELECT count(*) FROM raw) AS rows
        UNION ALL SELECT 2, 'dim_value_counts', (SELECT count(*) FROM agency_names)
          + (SELECT count(*) FROM dim_complaint_type) + (SELECT count(*) FROM dim_borough)
        UNION ALL SELECT 3, 'dimensions', (SELECT count(*) FROM dim_agency)
          + (SELECT count(*) FROM dim_complaint_type) + (SELECT count(*) FROM dim_borough)
        UNION ALL SELECT 4, 'flagged', (SELECT count(*) FROM flagged)
        UNION ALL SELECT 5, 'curated', (SELECT count(*) FROM curated)
        UNION ALL SELECT 6, 'monthly', (SELECT count(*) FROM monthly)
        UNION ALL SELECT 7, 'daily', (SELECT count(*) FROM daily)""",
}

BODIES["bucketed_dedup"] = BODIES["dedup_raw_requests"]
BODIES["split_report"] = BODIES["report_roundtrip"]
BODIES["keyset_page_indexed"] = BODIES["keyset_page"]
BODIES["seen_keys_landings"] = BODIES["flag_duplicate_keys"]
BODIES["monthly_summary_appended"] = BODIES["monthly_summary"]
BODIES["daily_summary_appended"] = BODIES["daily_summary"]

for _k in ("monthly_summary", "daily_summary", "monthly_summary_head", "top_category_per_borough_month",
           "reconcile_monthly", "reconcile_daily", "monthly_volume", "top_complaint_types",
           "category_totals_ytd"):
    BODIES["sql_" + _k] = BODIES[_k]


def oracle_sql() -> dict[str, str]:
    return {k: BASE + v for k, v in BODIES.items()}
