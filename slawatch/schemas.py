"""Explicit schemas, column lists and fixed values shared by all jobs."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source pipeline's values for the
# results to match; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Raw service-request CSV header -> unified column name.
RAW_COLUMN_MAP = {
    "Unique Key": "issue_id",
    "Created Date": "created_at",
    "Closed Date": "resolved_at",
    "Complaint Type": "raw_category",
    "Descriptor": "raw_subcategory",
    "Borough": "region",
    "Status": "status",
    "City": "city",
    "Open Data Channel Type": "raw_channel",
}
# Raw columns that must be present.
REQUIRED_RAW_COLUMNS = ["Unique Key", "Created Date", "Complaint Type"]
# Unified columns added as null when their raw column is absent.
OPTIONAL_COLUMNS = ["resolved_at", "raw_subcategory", "region", "status", "city", "raw_channel"]

SLA_HOURS_TARGET = 72
SOURCE_SYSTEM = "nyc_311_2019"
DEFAULT_CHANNEL = "311"
UNKNOWN_REGION = "UNKNOWN"
UNKNOWN_TOPIC_ID = -1
UNKNOWN_TOPIC_KEYWORDS = "UNKNOWN_TOPIC"
TEXT_SEPARATOR = " - "

# Spellings pandas' CSV reader treats as missing by default (public pandas
# behaviour); "Unspecified" is deliberately not among them.
NA_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Risk bucket upper bounds (exclusive) and names; a null score is "unknown",
# anything at or above the last bound (and NaN) is "very_high".
RISK_BUCKETS = [(0.2, "very_low"), (0.4, "low"), (0.6, "medium"), (0.8, "high")]
RISK_BUCKET_TOP = "very_high"
RISK_BUCKET_NULL = "unknown"
HIGH_RISK_BUCKETS = ["high", "very_high"]

# Topic model defaults of the source notebook.
TOPIC_COUNT = 15
TOPIC_MAX_DF = 0.95
TOPIC_MIN_DF = 20
TOPIC_VOCAB = 5000
TOPIC_TOP_WORDS = 10
# Tokens whose document frequency is looked up in a broadcast table.
FREQUENT_TOKENS = 100_000
SEED = 42

# Report defaults.
RECENT_ISSUES_ROWS = 500
REGION_SUMMARY_ROWS = 30
TOP_REGIONS_ROWS = 10
DEFAULT_WINDOW_DAYS = 30

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

ISSUES_UNIFIED_SCHEMA = StructType([
    StructField("issue_id", StringType(), True),
    StructField("created_at", TimestampType(), True),
    StructField("resolved_at", TimestampType(), True),
    StructField("raw_category", StringType(), True),
    StructField("raw_subcategory", StringType(), True),
    StructField("region", StringType(), True),
    StructField("status", StringType(), True),
    StructField("city", StringType(), True),
    StructField("raw_channel", StringType(), True),
    StructField("issue_text", StringType(), True),
    StructField("channel", StringType(), True),
    StructField("source_system", StringType(), True),
    StructField("sla_hours_target", IntegerType(), True),
    StructField("resolution_hours", DoubleType(), True),
    StructField("sla_breached", BooleanType(), True),
])
UNIFIED_COLUMNS = [f.name for f in ISSUES_UNIFIED_SCHEMA.fields]

ENRICHED_EXTRA = StructType([
    StructField("date", DateType(), True),
    StructField("hour", IntegerType(), True),
    StructField("dow", IntegerType(), True),
    StructField("topic_id", IntegerType(), True),
    StructField("topic_keywords", StringType(), True),
    StructField("text_len", LongType(), True),
    StructField("word_count", LongType(), True),
    StructField("issue_keyword", StringType(), True),
])
ISSUES_ENRICHED_SCHEMA = StructType(ISSUES_UNIFIED_SCHEMA.fields + ENRICHED_EXTRA.fields)
ENRICHED_COLUMNS = [f.name for f in ISSUES_ENRICHED_SCHEMA.fields]

RISK_SCORE_TYPE = StructType([
    StructField("label", BooleanType(), True),
    StructField("prob", DoubleType(), True),
])

# Fact table: enriched columns, then the two model outputs, then the
# partition column last (positional inserts rely on this order).
FACT_COLUMNS = ENRICHED_COLUMNS + ["predicted_label", "risk_score", "issue_date"]

# A streamed issue event: JSON object of an enriched row. Numbers are read as
# double so that bare NaN / Infinity survive parsing and can be nulled; the
# flag is read as text (a NaN there would void the whole record); timestamps
# arrive as text.
ISSUE_EVENT_SCHEMA = StructType([
    StructField("issue_id", StringType(), True),
    StructField("created_at", StringType(), True),
    StructField("resolved_at", StringType(), True),
    StructField("raw_category", StringType(), True),
    StructField("raw_subcategory", StringType(), True),
    StructField("region", StringType(), True),
    StructField("status", StringType(), True),
    StructField("city", StringType(), True),
    StructField("raw_channel", StringType(), True),
    StructField("issue_text", StringType(), True),
    StructField("channel", StringType(), True),
    StructField("source_system", StringType(), True),
    StructField("sla_hours_target", DoubleType(), True),
    StructField("resolution_hours", DoubleType(), True),
    StructField("sla_breached", StringType(), True),
    StructField("date", StringType(), True),
    StructField("hour", DoubleType(), True),
    StructField("dow", DoubleType(), True),
    StructField("topic_id", DoubleType(), True),
    StructField("topic_keywords", StringType(), True),
    StructField("text_len", DoubleType(), True),
    StructField("word_count", DoubleType(), True),
    StructField("issue_keyword", StringType(), True),
])

MART_COLUMNS = [
    "issue_date", "region", "total_issues", "sla_breach_rate", "avg_risk_score",
    "high_risk_share", "cnt_very_low", "cnt_low", "cnt_medium", "cnt_high", "cnt_very_high",
]
