"""Fixed values of the service-request contract and the tunable settings.

The constants marked FIXED VALUES must stay equal to the source system's
contract for results to match; everything else is a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — raw request contract
# ---------------------------------------------------------------------------

# Columns every raw request file must carry, in contract order.
REQUIRED_COLUMNS: tuple[str, ...] = (
    "unique_key", "created_date", "closed_date", "agency", "agency_name",
    "complaint_type", "descriptor", "borough", "incident_zip", "status",
)

# Also read by the cleaning stage.
OPTIONAL_COLUMNS: tuple[str, ...] = ("city",)

# FIXED VALUES. Text tokens a CSV reader of the source system treats as missing.
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# FIXED VALUES. Rejection reasons, in the order they are joined into `_rejection_reasons`.
REJECTION_REASONS: tuple[str, ...] = (
    "missing_unique_key",
    "missing_agency",
    "missing_complaint_type",
    "duplicate_unique_key",
    "invalid_created_date",
    "closed_before_created",
    "unknown_agency",
    "unknown_complaint_type",
    "unknown_borough",
    "invalid_zip_format",
)

REASON_SEPARATOR = ";"
MISSING_FILL = "UNKNOWN"
CLOSED_STATUS = "CLOSED"
DEFAULT_CATEGORY = "Other"

# FIXED VALUES. Keyword categorisation of complaint types: ordered rules, first match wins,
# lower-cased substring containment, default "Other".
CATEGORY_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Noise", ("noise",)),
    ("Housing & Buildings", (
        "unsanitary condition", "plumbing", "paint/plaster", "door/window", "flooring/stairs",
        "electric", "appliance", "maintenance or facility", "lead", "general", "housing",
        "heat/hot water", "heating", "building", "apartment", "elevator", "construction", "mold",
    )),
    ("Sanitation", (
        "missed collection", "illegal dumping", "residential disposal", "dirty condition",
        "sanitation", "trash", "litter", "recycl", "graffiti", "sidewalk condition",
    )),
    ("Parks & Trees", ("tree",)),
    ("Homeless & Social Services", ("homeless", "encampment")),
    ("Public Safety", (
        "non-emergency police", "drug activity", "illegal fireworks", "safety", "obstruction",
        "panhandling",
    )),
    ("Consumer & Business", (
        "consumer complaint", "for hire vehicle", "vendor enforcement", "food establishment",
        "business complaint",
    )),
    ("Environmental & Health", ("air quality", "asbestos", "hazardous")),
    ("Parking & Vehicles", ("parking", "blocked driveway", "derelict vehicle", "abandoned vehicle")),
    ("Water & Sewer", ("water system", "sewer", "leak", "water conservation")),
    ("Street & Sidewalk", ("street condition", "pothole", "curb condition", "street light", "traffic signal")),
    ("Animal", ("animal",)),
    ("Traffic & Safety", ("traffic", "illegal parking", "blocked crosswalk")),
)

# FIXED VALUES. Data-quality thresholds (rate = reason count / total rows).
DEFAULT_THRESHOLDS: dict[str, float] = {
    "max_missing_id_rate": 0.02,
    "max_invalid_date_rate": 0.02,
    "max_duplicate_rate": 0.05,
}

# FIXED VALUES. (check name, reason counted, threshold key), in report order.
THRESHOLD_CHECKS: tuple[tuple[str, str, str], ...] = (
    ("missing_id_rate", "missing_unique_key", "max_missing_id_rate"),
    ("invalid_date_rate", "invalid_created_date", "max_invalid_date_rate"),
    ("duplicate_rate", "duplicate_unique_key", "max_duplicate_rate"),
)

# FIXED VALUES. Serving-table constraints of the marts (VARCHAR lengths).
BOROUGH_MAX_LEN = 20
CATEGORY_MAX_LEN = 50

# ---------------------------------------------------------------------------
# Tunables
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PipelineSettings:
    """Parameters of one pipeline run.

    ``order_columns`` declares the total order that decides which copy of a
    duplicated key counts as the first one; the remaining columns are used
    as further tie-breakers, so the result never depends on partitioning.
    """

    category_rules: tuple[tuple[str, tuple[str, ...]], ...] = CATEGORY_RULES
    na_tokens: tuple[str, ...] = NA_TOKENS
    thresholds: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    order_columns: tuple[str, ...] = ("created_date", "closed_date")
    # Largest side (bytes, from plan statistics) that is broadcast in a join.
    broadcast_max_bytes: int = 64 * 1024 * 1024
    # Rows per key above which the duplicate flag treats a key as hot, and
    # the most hot keys it will broadcast (the threshold rises to keep it).
    hot_key_rows: int = 1_000_000
    max_hot_keys: int = 100_000
    # Most repeated keys broadcast so rows of single keys skip the shuffle,
    # and the largest share of rows under repeated keys for which that pays.
    max_repeated_keys: int = 1_000_000
    max_repeated_share: float = 0.25
    # Copies of one identical row above which regeneration is split in chunks.
    copy_chunk_rows: int = 100_000
    # Largest dimension numbered in one task; bigger ones use range partitions.
    local_id_rows: int = 1_000_000


DEFAULT_SETTINGS = PipelineSettings()
