"""Registered queries: each builds a lazy DataFrame from the tables at
``sf_dir`` and has, where SQL can say it, a twin in ``ORACLE``.

Float outputs are rounded to 6 digits on both sides (summation order
differs between engines); that rounding is applied here, outside the
library operators.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import quality, reports
from ..operators import risk_model as RM
from ..operators import topics as T
from ..functions.scalar import format_count
from ..operators.cleaning import cleaning_report, unify_issues
from ..operators.enrich import enrich
from ..operators.evaluate import classification_metrics
from ..operators.incremental import (
    merge_stream,
    merge_stream_by_day,
    new_issues,
    new_issues_by_day,
    union_issues,
)
from ..operators.keywords import issue_keyword, text_features, with_text_features
from ..operators.mart import mart_issues_by_region_day, stg_issues
from ..schemas import ENRICHED_COLUMNS, UNIFIED_COLUMNS
from ..session import cut_lineage, scratch_path
from ..sinks.tables import append_scored, create_fact_table, replace_table, write_issues
from ..sources import testdata as td
from ..sources.files import load_mart, read_issues, read_raw_issues
from ..streaming import ingest as SI
from ..streaming.codec import good_events, parse_issue_events, to_kafka_records
from . import jobs
from . import oracle as O
from .daily import run_daily

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

ROUND_DIGITS = 6


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; the tables' timestamps carry no zone,
    so every query pins the session zone to UTC before it plans."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    cols = {f.name: F.round(F.col(f.name), digits)
            for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(cols) if cols else df


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_issues(td.scored_issues(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_issues_by_region_day(stg(spark, sf_dir))


# ---------------------------------------------------------------- flagship
@register("mart_region_day", O.with_issues("""
SELECT issue_date, region, total_issues,
       round(sla_breach_rate, 6) AS sla_breach_rate,
       round(avg_risk_score, 6) AS avg_risk_score,
       round(high_risk_share, 6) AS high_risk_share,
       cnt_very_low, cnt_low, cnt_medium, cnt_high, cnt_very_high
FROM mart"""))
def q_mart_region_day(spark, sf_dir):
    return round_doubles(mart(spark, sf_dir))


# ---------------------------------------------------------------- helpers
ENRICHED_SQL = ", ".join(ENRICHED_COLUMNS)
UNIFIED_SQL = ", ".join(UNIFIED_COLUMNS)
STG_SQL = ("issue_id, created_at, issue_date, issue_hour, issue_dow, region, channel, raw_category, "
           "topic_id, topic_keywords, sla_breached, predicted_label, risk_score, resolution_hours, risk_bucket")

# Report parameters (dates of the test tables' single month).
RANGE_START, RANGE_END = "2024-01-08", "2024-01-21"
MONTH_START, MONTH_END = "2024-01-01", "2024-01-31"
CUR_START, CUR_END = "2024-01-16", "2024-01-30"      # previous: 01-01 .. 01-15
SCORED_THROUGH = "2024-01-21"                         # fact holds days before this


def d(s: str) -> str:
    return f"DATE '{s}'"


# ---------------------------------------------------------------- cleaning
@register("issues_unified", O.with_issues(f"SELECT {UNIFIED_SQL} FROM unified"))
def q_issues_unified(spark, sf_dir):
    """Raw rows -> unified issues (rename, parse, drop, text, region, SLA)."""
    return td.unified_issues(spark, sf_dir)


@register("cleaning_report", O.with_issues("""
SELECT CAST(count(*) AS BIGINT) AS raw_rows, CAST(count_if(created_at IS NULL) AS BIGINT) AS dropped_undated,
       CAST(count_if(created_at IS NOT NULL AND trim(category || ' - ' || subcategory) = '') AS BIGINT) AS dropped_blank_text,
       CAST(count_if(created_at IS NOT NULL AND trim(category || ' - ' || subcategory) <> '') AS BIGINT) AS clean_rows
FROM ev"""))
def q_cleaning_report(spark, sf_dir):
    return cleaning_report(td.raw_issues(spark, sf_dir))


@register("cleaning_report_strict", O.with_issues("""
SELECT CAST(count(*) AS BIGINT) AS raw_rows, CAST(count_if(created_at IS NULL) AS BIGINT) AS dropped_undated,
       CAST(count_if(created_at IS NOT NULL AND category || subcategory = '') AS BIGINT) AS dropped_blank_text,
       CAST(count_if(created_at IS NOT NULL AND category || subcategory <> '') AS BIGINT) AS clean_rows
FROM ev"""))
def q_cleaning_report_strict(spark, sf_dir):
    """Rows whose two text parts are both blank are dropped."""
    return cleaning_report(td.raw_issues(spark, sf_dir), strict=True)


@register("issues_enriched", O.with_issues(f"SELECT {ENRICHED_SQL} FROM enriched"))
def q_issues_enriched(spark, sf_dir):
    """Calendar fields, topic join and keyword lookup, defaults."""
    return td.enriched_issues(spark, sf_dir)


@register("scored_fact", O.with_issues("""
SELECT issue_id, issue_text, risk_prob >= 0.5 AS predicted_label, true AS risk_label,
       risk_prob AS risk_prob, CAST(created_at AS DATE) AS issue_date
FROM scored"""))
def q_scored_fact(spark, sf_dir):
    """Predictions joined to their inputs; positive-class struct kept."""
    f = td.scored_issues(spark, sf_dir)
    return f.select("issue_id", "issue_text", "predicted_label",
                    F.col("risk_score.label").alias("risk_label"),
                    F.col("risk_score.prob").alias("risk_prob"), "issue_date")


@register("stg_issues", O.with_issues(f"SELECT {STG_SQL} FROM stg"))
def q_stg_issues(spark, sf_dir):
    return stg(spark, sf_dir)


# ---------------------------------------------------------------- incremental
@register("new_issues", O.with_issues(f"""
SELECT {ENRICHED_SQL} FROM enriched
WHERE issue_id NOT IN (SELECT issue_id FROM scored WHERE CAST(created_at AS DATE) < {d(SCORED_THROUGH)})"""))
def q_new_issues(spark, sf_dir):
    """Anti-join: enriched rows not yet in the fact (fact holds the days
    before SCORED_THROUGH)."""
    fact = td.scored_issues(spark, sf_dir).filter(F.col("issue_date") < F.lit(SCORED_THROUGH).cast("date"))
    return new_issues(td.enriched_issues(spark, sf_dir), fact)


@register("new_issues_by_day", ORACLE["new_issues"])
def q_new_issues_by_day(spark, sf_dir):
    """The same anti-join reading only the fact partitions of the batch's
    days (static partition filter on issue_date)."""
    fact = td.scored_issues(spark, sf_dir).filter(F.col("issue_date") < F.lit(SCORED_THROUGH).cast("date"))
    return new_issues_by_day(td.enriched_issues(spark, sf_dir), fact)


STREAM_SQL = f"""stream AS (
  SELECT issue_id, created_at, created_at + INTERVAL 80 HOUR AS resolved_at, raw_category, raw_subcategory,
         region, 'Closed' AS status, city, raw_channel, issue_text, channel, source_system, sla_hours_target,
         CAST(80 AS DOUBLE) AS resolution_hours, true AS sla_breached, date, hour, dow, topic_id, topic_keywords, text_len, word_count, issue_keyword,
         created_at + INTERVAL 80 HOUR AS ingested_at
  FROM enriched WHERE resolved_at IS NULL
)"""


@register("union_issues", O.with_issues(f""", {STREAM_SQL}
SELECT {ENRICHED_SQL}, CAST(NULL AS TIMESTAMP) AS ingested_at FROM enriched
UNION ALL
SELECT {ENRICHED_SQL}, ingested_at FROM stream"""))
def q_union_issues(spark, sf_dir):
    en = td.enriched_issues(spark, sf_dir)
    return union_issues(en, td.stream_updates(en))


@register("merge_stream", O.with_issues(f""", {STREAM_SQL}
SELECT {ENRICHED_SQL} FROM enriched WHERE issue_id NOT IN (SELECT issue_id FROM stream)
UNION ALL
SELECT {ENRICHED_SQL} FROM stream"""))
def q_merge_stream(spark, sf_dir):
    """Upsert: one row per id, the newest ingest wins."""
    en = td.enriched_issues(spark, sf_dir)
    return merge_stream(en, td.stream_updates(en)).select(ENRICHED_COLUMNS)


@register("merge_stream_by_day", ORACLE["merge_stream"])
def q_merge_stream_by_day(spark, sf_dir):
    """Upsert that aggregates only the days the stream touches."""
    en = td.enriched_issues(spark, sf_dir)
    return merge_stream_by_day(en, td.stream_updates(en)).select(ENRICHED_COLUMNS)


@register("check_unique", O.with_issues(f""", {STREAM_SQL}
SELECT issue_id, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT issue_id FROM enriched UNION ALL SELECT issue_id FROM stream)
WHERE issue_id IS NOT NULL GROUP BY issue_id HAVING count(*) > 1"""))
def q_check_unique(spark, sf_dir):
    en = td.enriched_issues(spark, sf_dir)
    return quality.check_unique(union_issues(en, td.stream_updates(en)), "issue_id")


@register("check_not_null", O.with_issues("""
SELECT issue_id, raw_category, status FROM unified WHERE resolved_at IS NULL"""))
def q_check_not_null(spark, sf_dir):
    return quality.check_not_null(td.unified_issues(spark, sf_dir), "resolved_at") \
        .select("issue_id", "raw_category", "status")


KAFKA_SQL = ENRICHED_SQL.replace("city,", "CASE WHEN event_id % 10 = 3 THEN NULL ELSE city END AS city,").replace(
    "resolution_hours,", "CASE WHEN event_id % 10 = 3 THEN NULL ELSE resolution_hours END AS resolution_hours,")


@register("kafka_roundtrip", O.with_issues(f"SELECT {KAFKA_SQL} FROM enriched"))
def q_kafka_roundtrip(spark, sf_dir):
    """Rows -> keyed JSON records -> decoded, cleaned rows (batch twin of
    the stream codec); every tenth record has a bare NaN in a number and in
    a text, as the source's producer writes missing values, and a broken
    copy of each hundredth is quarantined."""
    recs = to_kafka_records(td.enriched_issues(spark, sf_dir))
    nan = F.regexp_replace(F.regexp_replace("value", r'"resolution_hours":[^,}]+', '"resolution_hours":NaN'),
                           r'"city":"[^"]*"', '"city":NaN')
    sent = recs.withColumn("value", F.when(F.col("key").cast("long") % 10 == 3, nan).otherwise(F.col("value")))
    broken = recs.filter(F.col("key").cast("long") % 100 == 0).withColumn("value", F.lit("{broken"))
    return good_events(parse_issue_events(sent.unionByName(broken)))


# ---------------------------------------------------------------- files
def _through_files(spark, df, fmt, enriched):
    path = scratch_path(spark, f"issues-{fmt}")
    write_issues(df, path, fmt=fmt)
    return read_issues(spark, path, fmt=fmt, enriched=enriched)


@register("raw_csv_unified", O.with_issues(f"SELECT {UNIFIED_SQL} FROM unified"))
def q_raw_csv_unified(spark, sf_dir):
    """Raw rows written as CSV files with a header, scanned with the explicit
    schema and cleaned."""
    path = scratch_path(spark, "raw-csv")
    td.raw_issues(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return unify_issues(read_raw_issues(spark, path), source=td.SOURCE_NAME)


@register("raw_csv_few_columns", O.with_issues("""
SELECT issue_id, created_at, CAST(NULL AS TIMESTAMP) AS resolved_at, raw_category, '' AS raw_subcategory,
       'UNKNOWN' AS region, '311' AS channel, CAST(NULL AS DOUBLE) AS resolution_hours, false AS sla_breached FROM unified"""))
def q_raw_csv_few_columns(spark, sf_dir):
    """Raw files with the required columns only: the others become null."""
    path = scratch_path(spark, "raw-few")
    raw = td.raw_issues(spark, sf_dir).select("Complaint Type", "Unique Key", "Created Date")
    raw.write.option("header", True).option("escape", '"').csv(path)
    return unify_issues(read_raw_issues(spark, path)).select(
        "issue_id", "created_at", "resolved_at", "raw_category", "raw_subcategory", "region", "channel", "resolution_hours", "sla_breached")


CSV_TEXT = 'A "quoted" part, with a comma\nand a second line'
CSV_SQL = UNIFIED_SQL.replace("issue_text,", f"CASE WHEN event_id % 19 = 2 THEN '{CSV_TEXT}' || chr(13) || chr(10) || issue_text ELSE issue_text END AS issue_text,")
for _c in ("raw_category", "raw_subcategory"):
    CSV_SQL = CSV_SQL.replace(f"{_c},", f"nullif({_c}, '') AS {_c},")


@register("issues_csv_roundtrip", O.with_issues(f"SELECT {CSV_SQL} FROM unified"))
def q_issues_csv_roundtrip(spark, sf_dir):
    """Unified issues written as CSV and read with their schema (an empty
    text and a missing one are the same in CSV); some texts have quotes,
    commas and line breaks of both kinds."""
    rows = td.unified_issues(spark, sf_dir)
    text = F.when(F.col("issue_id").cast("long") % 19 == 2, F.concat(F.lit(CSV_TEXT + "\r\n"), "issue_text")).otherwise(F.col("issue_text"))
    return _through_files(spark, rows.withColumn("issue_text", text), "csv", False)


@register("issues_parquet_roundtrip", O.with_issues(f"SELECT {ENRICHED_SQL} FROM enriched"))
def q_issues_parquet_roundtrip(spark, sf_dir):
    return _through_files(spark, td.enriched_issues(spark, sf_dir), "parquet", True)


@register("replace_table_days", O.with_issues("""
SELECT issue_id, date, hour, CASE WHEN date >= DATE '2024-01-21' THEN 'replaced' ELSE status END AS status FROM enriched"""))
def q_replace_table_days(spark, sf_dir):
    """A day-partitioned table whose later days are replaced: the other days
    stay, whatever the session's overwrite mode."""
    name = f"replaced_{uuid.uuid4().hex[:10]}"
    rows = td.enriched_issues(spark, sf_dir).select("issue_id", "hour", "status", "date")
    rows.write.partitionBy("date").option("path", scratch_path(spark, "replaced")).saveAsTable(name)
    replace_table(rows.filter(F.col("date") >= F.lit(SCORED_THROUGH).cast("date")).withColumn("status", F.lit("replaced")), name, "date")
    return spark.table(name)


@register("scoring_features", O.with_issues("""
SELECT issue_id, issue_text, region, channel, raw_category, topic_id, hour, CAST(dayofweek(created_at) + 1 AS INTEGER) AS dow,
       issue_keyword, text_len, word_count FROM enriched"""))
def q_scoring_features(spark, sf_dir):
    """The model's inputs."""
    return RM.scoring_features(td.enriched_issues(spark, sf_dir))


@register("trend_window_csv", O.with_issues("""
SELECT strftime(issue_date, '%Y-%m-%d') || ',' || CAST(sum(total_issues) AS BIGINT) AS csv, regexp_replace(CAST(sum(total_issues) AS BIGINT)::VARCHAR, '([0-9])([0-9]{3})$', '\\1,\\2') AS shown
FROM mart WHERE issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY issue_date"""))
def q_trend_window_csv(spark, sf_dir):
    """The default report window (30 days up to the given end) as CSV lines,
    and its counts as shown."""
    start, end = reports.date_window(CUR_END)
    rows = reports.daily_trend(mart(spark, sf_dir)).filter(F.col("issue_date").between(F.lit(start), F.lit(end)))
    told = rows.select("issue_date", "total_issues", format_count("total_issues").alias("shown"))
    return told.select(F.to_csv(F.struct("issue_date", "total_issues")).alias("csv"), "shown")


@register("dedupe_stream", O.with_issues("SELECT issue_id, status FROM enriched"))
def q_dedupe_stream(spark, sf_dir):
    """Every record sent twice, dropped once in the stream."""
    en = td.enriched_issues(spark, sf_dir)
    src, out = scratch_path(spark, "twice-src"), scratch_path(spark, "twice-out")
    recs = to_kafka_records(en)
    # As many files as tasks made them; a record's copies are in two of them.
    SI.write_issue_records(recs.unionByName(recs), src)
    events = good_events(parse_issue_events(SI.read_issue_stream(spark, source="text", path=src), keep=("ingested_at",)), ("ingested_at",))
    q = (SI.dedupe_stream(events.select("issue_id", "status", "ingested_at")).select("issue_id", "status").writeStream.format("parquet").option("path", out)
           .option("checkpointLocation", scratch_path(spark, "twice-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


# ---------------------------------------------------------------- mart reports
@register("load_mart", O.with_issues(f"""
SELECT issue_date, region, total_issues, round(sla_breach_rate, 6) AS sla_breach_rate,
       round(avg_risk_score, 6) AS avg_risk_score, round(high_risk_share, 6) AS high_risk_share,
       cnt_very_low, cnt_low, cnt_medium, cnt_high, cnt_very_high
FROM mart WHERE issue_date BETWEEN {d(RANGE_START)} AND {d(RANGE_END)}"""))
def q_load_mart(spark, sf_dir):
    return round_doubles(load_mart(spark, mart(spark, sf_dir), RANGE_START, RANGE_END))


@register("overview_kpis", O.with_issues("""
SELECT CAST(coalesce(sum(total_issues), 0) AS BIGINT) AS total_issues,
       round(CASE WHEN sum(total_issues) > 0 THEN sum(sla_breach_rate * total_issues) / sum(total_issues) ELSE 0.0 END, 6) AS sla_breach_rate,
       round(avg(avg_risk_score), 6) AS avg_risk_score,
       round(avg(high_risk_share), 6) AS avg_high_risk_share
FROM mart"""))
def q_overview_kpis(spark, sf_dir):
    return round_doubles(reports.overview_kpis(mart(spark, sf_dir)))


@register("daily_trend", O.with_issues("""
SELECT issue_date, CAST(sum(total_issues) AS BIGINT) AS total_issues,
       round(avg(sla_breach_rate), 6) AS avg_sla_breach_rate
FROM mart GROUP BY issue_date"""))
def q_daily_trend(spark, sf_dir):
    return round_doubles(reports.daily_trend(mart(spark, sf_dir)))


@register("region_breach", O.with_issues("""
SELECT region, CAST(sum(total_issues) AS BIGINT) AS total_issues,
       round(avg(sla_breach_rate), 6) AS avg_sla_breach_rate
FROM mart WHERE region IS NOT NULL GROUP BY region"""))
def q_region_breach(spark, sf_dir):
    return round_doubles(reports.region_breach(mart(spark, sf_dir)))


@register("region_risk_summary", O.with_issues("""
SELECT region, CAST(sum(total_issues) AS BIGINT) AS total_issues,
       round(avg(sla_breach_rate), 6) AS avg_sla_breach_rate,
       round(avg(avg_risk_score), 6) AS avg_risk_score,
       round(avg(high_risk_share), 6) AS avg_high_risk_share
FROM mart GROUP BY region ORDER BY total_issues DESC, region NULLS FIRST LIMIT 30"""))
def q_region_risk_summary(spark, sf_dir):
    return round_doubles(reports.region_risk_summary(mart(spark, sf_dir), n=30))


@register("overall_risk_summary", O.with_issues("""
SELECT CAST(sum(total_issues) AS BIGINT) AS total_issues,
       round(avg(sla_breach_rate), 6) AS avg_sla_breach_rate,
       round(avg(avg_risk_score), 6) AS avg_risk_score,
       round(avg(high_risk_share), 6) AS avg_high_risk_share
FROM mart"""))
def q_overall_risk_summary(spark, sf_dir):
    return round_doubles(reports.region_risk_summary(mart(spark, sf_dir), by=None))


@register("compare_periods", O.with_issues(f"""
SELECT region,
  CAST(coalesce(sum(CASE WHEN issue_date BETWEEN {d(CUR_START)} AND {d(CUR_END)} THEN total_issues END), 0) AS BIGINT) AS cur_issues,
  CAST(coalesce(sum(CASE WHEN issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' THEN total_issues END), 0) AS BIGINT) AS prev_issues,
  round(sum(CASE WHEN issue_date BETWEEN {d(CUR_START)} AND {d(CUR_END)} THEN sla_breach_rate * total_issues END)
        / sum(CASE WHEN issue_date BETWEEN {d(CUR_START)} AND {d(CUR_END)} THEN total_issues END), 6) AS cur_breach_rate,
  round(sum(CASE WHEN issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' THEN sla_breach_rate * total_issues END)
        / sum(CASE WHEN issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' THEN total_issues END), 6) AS prev_breach_rate,
  round(avg(CASE WHEN issue_date BETWEEN {d(CUR_START)} AND {d(CUR_END)} THEN avg_risk_score END), 6) AS cur_avg_risk,
  round(avg(CASE WHEN issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' THEN avg_risk_score END), 6) AS prev_avg_risk,
  CAST(coalesce(sum(CASE WHEN issue_date BETWEEN {d(CUR_START)} AND {d(CUR_END)} THEN total_issues END), 0)
       - coalesce(sum(CASE WHEN issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' THEN total_issues END), 0) AS BIGINT) AS delta_issues,
  round(sum(CASE WHEN issue_date BETWEEN {d(CUR_START)} AND {d(CUR_END)} THEN sla_breach_rate * total_issues END)
        / sum(CASE WHEN issue_date BETWEEN {d(CUR_START)} AND {d(CUR_END)} THEN total_issues END)
        - sum(CASE WHEN issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' THEN sla_breach_rate * total_issues END)
        / sum(CASE WHEN issue_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' THEN total_issues END), 6) AS delta_breach_rate
FROM mart WHERE issue_date BETWEEN DATE '2024-01-01' AND {d(CUR_END)}
GROUP BY region"""))
def q_compare_periods(spark, sf_dir):
    out = reports.compare_periods(mart(spark, sf_dir), CUR_START, CUR_END)
    return round_doubles(out)


# ---------------------------------------------------------------- staging reports
@register("risk_bucket_mix", O.with_issues("""
SELECT region, risk_bucket, CAST(count(*) AS BIGINT) AS issues,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY region), 6) AS pct
FROM stg GROUP BY region, risk_bucket"""))
def q_risk_bucket_mix(spark, sf_dir):
    return round_doubles(reports.risk_bucket_mix(stg(spark, sf_dir)))


@register("recent_issues", O.with_issues(f"""
SELECT issue_id, created_at, region, raw_category, CAST(created_at AS DATE) AS issue_date
FROM scored WHERE CAST(created_at AS DATE) BETWEEN {d(MONTH_START)} AND {d(MONTH_END)}
ORDER BY created_at DESC, issue_id LIMIT 500"""))
def q_recent_issues(spark, sf_dir):
    out = reports.recent_issues(td.scored_issues(spark, sf_dir), MONTH_START, MONTH_END, n=500)
    return out.select("issue_id", "created_at", "region", "raw_category", "issue_date")


@register("recent_high_risk", O.with_issues(f"""
SELECT issue_id, created_at, region, risk_bucket, risk_score
FROM stg WHERE risk_bucket IN ('high', 'very_high')
  AND CAST(created_at AS DATE) BETWEEN {d(MONTH_START)} AND {d(MONTH_END)}
ORDER BY created_at DESC, issue_id LIMIT 100"""))
def q_recent_high_risk(spark, sf_dir):
    out = reports.recent_high_risk(stg(spark, sf_dir), MONTH_START, MONTH_END, n=100)
    return out.select("issue_id", "created_at", "region", "risk_bucket", "risk_score")


@register("risk_drivers", O.with_issues("""
SELECT raw_category, CAST(count(*) AS BIGINT) AS issues,
       CAST(count_if(risk_bucket IN ('high', 'very_high')) AS BIGINT) AS high_risk_issues,
       round(avg(CASE WHEN risk_bucket IN ('high', 'very_high') THEN 1 ELSE 0 END), 6) AS high_risk_share,
       round(avg(risk_score), 6) AS avg_risk_score
FROM stg GROUP BY raw_category"""))
def q_risk_drivers(spark, sf_dir):
    return round_doubles(reports.risk_drivers(stg(spark, sf_dir), "raw_category"))


@register("risk_drivers_topic", O.with_issues("""
SELECT topic_keywords, CAST(count(*) AS BIGINT) AS issues,
       CAST(count_if(risk_bucket IN ('high', 'very_high')) AS BIGINT) AS high_risk_issues,
       round(avg(CASE WHEN risk_bucket IN ('high', 'very_high') THEN 1 ELSE 0 END), 6) AS high_risk_share,
       round(avg(risk_score), 6) AS avg_risk_score
FROM stg GROUP BY topic_keywords"""))
def q_risk_drivers_topic(spark, sf_dir):
    return round_doubles(reports.risk_drivers(stg(spark, sf_dir), "topic_keywords"))


@register("filter_issues", O.with_issues(f"""
SELECT {STG_SQL} FROM stg WHERE lower(topic_keywords) LIKE '%topic 1%' AND region = 'EUROPE'"""))
def q_filter_issues(spark, sf_dir):
    return reports.filter_issues(stg(spark, sf_dir), keyword="Topic 1", region="EUROPE")


@register("model_metrics", O.with_issues("""
, s AS (SELECT sla_breached AS y, predicted_label AS p, risk_score AS prob FROM stg
        WHERE sla_breached IS NOT NULL AND predicted_label IS NOT NULL),
h AS (SELECT prob, count_if(y) AS pos, count_if(NOT y) AS neg FROM s WHERE prob IS NOT NULL GROUP BY prob),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg FROM h),
a AS (SELECT sum(pos * (before_neg + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM c)
SELECT CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN y = p THEN 1 ELSE 0 END), 6) AS accuracy,
       round(count_if(y AND p) / (count_if(y AND p) + count_if(NOT y AND p)), 6) AS precision,
       round(count_if(y AND p) / (count_if(y AND p) + count_if(y AND NOT p)), 6) AS recall,
       round(2 * count_if(y AND p) / (2 * count_if(y AND p) + count_if(NOT y AND p) + count_if(y AND NOT p)), 6) AS f1,
       round((SELECT auc FROM a), 6) AS auc
FROM s"""))
def q_model_metrics(spark, sf_dir):
    return round_doubles(classification_metrics(stg(spark, sf_dir)))


# ---------------------------------------------------------------- issue EDA
@register("value_counts_category", O.with_issues("""
SELECT raw_category, CAST(count(*) AS BIGINT) AS count FROM unified
WHERE raw_category IS NOT NULL GROUP BY raw_category ORDER BY count DESC, raw_category LIMIT 20"""))
def q_value_counts_category(spark, sf_dir):
    return reports.value_counts(td.unified_issues(spark, sf_dir), "raw_category", n=20)


@register("value_counts_breached", O.with_issues("""
SELECT sla_breached, CAST(count(*) AS BIGINT) AS count FROM unified GROUP BY sla_breached"""))
def q_value_counts_breached(spark, sf_dir):
    return reports.value_counts(td.unified_issues(spark, sf_dir), "sla_breached", dropna=False)


@register("value_counts_region", O.with_issues("""
SELECT region, CAST(count(*) AS BIGINT) AS count FROM unified
WHERE region IS NOT NULL GROUP BY region ORDER BY count DESC, region LIMIT 5"""))
def q_value_counts_region(spark, sf_dir):
    return reports.value_counts(td.unified_issues(spark, sf_dir), "region", n=5)


@register("activity_by_hour", O.with_issues("""
SELECT hour, CAST(count(*) AS BIGINT) AS count FROM enriched GROUP BY hour"""))
def q_activity_by_hour(spark, sf_dir):
    return reports.activity_profile(td.enriched_issues(spark, sf_dir), "hour")


@register("activity_by_weekday", O.with_issues("""
SELECT dow, CAST(count(*) AS BIGINT) AS count FROM enriched GROUP BY dow"""))
def q_activity_by_weekday(spark, sf_dir):
    return reports.activity_profile(td.enriched_issues(spark, sf_dir), "dow")


@register("describe_hours", O.with_issues("""
SELECT CAST(count(resolution_hours) AS BIGINT) AS count,
       round(avg(resolution_hours), 6) AS mean, round(stddev_samp(resolution_hours), 6) AS std,
       round(min(resolution_hours), 6) AS min,
       round(quantile_cont(resolution_hours, 0.25), 6) AS p25,
       round(quantile_cont(resolution_hours, 0.5), 6) AS p50,
       round(quantile_cont(resolution_hours, 0.75), 6) AS p75,
       round(max(resolution_hours), 6) AS max
FROM unified"""))
def q_describe_hours(spark, sf_dir):
    return round_doubles(reports.describe_hours(td.unified_issues(spark, sf_dir)))


@register("date_span", O.with_issues("SELECT min(date) AS min_date, max(date) AS max_date FROM enriched"))
def q_date_span(spark, sf_dir):
    return reports.date_span(td.enriched_issues(spark, sf_dir))


@register("issues_by_region", O.with_issues("""
SELECT region, CAST(count(issue_id) AS BIGINT) AS issue_count FROM unified
GROUP BY region ORDER BY issue_count DESC, region NULLS FIRST LIMIT 10"""))
def q_issues_by_region(spark, sf_dir):
    return reports.issues_by_region(td.unified_issues(spark, sf_dir), n=10)


# ---------------------------------------------------------------- text
@register("text_features", f"""WITH {O.text_ctes()}
SELECT d.doc_id, CAST(length(d.text) AS BIGINT) AS text_len,
       CAST(len(w.ws) AS BIGINT) AS word_count,
       array_to_string(list_filter(w.ws, lambda x: length(x) >= 2 AND NOT list_contains([{O.stop_list_sql()}], x)), ' ') AS clean_text
FROM docs d JOIN doc_words w ON d.doc_id = w.doc_id""")
def q_text_features(spark, sf_dir):
    return text_features(td.read(spark, sf_dir, "documents"))


@register("issue_keyword", f"""WITH {O.text_ctes()},
tf AS (SELECT doc_id, token, count(*) AS tf FROM tok GROUP BY doc_id, token),
dfreq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
scored AS (
  SELECT tf.doc_id, tf.token,
         round(tf.tf * ln(((SELECT count(*) FROM documents) + 1.0) / (dfreq.df + 1.0)), 6) AS score
  FROM tf JOIN dfreq ON tf.token = dfreq.token
)
SELECT doc_id, token AS keyword, score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, token) AS rn FROM scored
) WHERE rn = 1""")
def q_issue_keyword(spark, sf_dir):
    return issue_keyword(td.read(spark, sf_dir, "documents"))


@register("issues_text_enriched", f"""WITH {O.ISSUE_CTES},
{O.issue_word_ctes()}
SELECT u.issue_id, u.issue_text, CAST(length(u.issue_text) AS BIGINT) AS text_len, CAST(len(w.ws) AS BIGINT) AS word_count, k.token AS issue_keyword
FROM unified u JOIN issue_words w ON u.issue_id = w.issue_id LEFT JOIN issue_key k ON u.issue_id = k.issue_id""")
def q_issues_text_enriched(spark, sf_dir):
    """Issues with their text's length, words and keyword."""
    return with_text_features(td.unified_issues(spark, sf_dir)).select(
        "issue_id", "issue_text", "text_len", "word_count", "issue_keyword")


@register("risk_drivers_keyword", f"""WITH {O.ISSUE_CTES},
{O.issue_word_ctes()}
SELECT k.token AS issue_keyword, CAST(count(*) AS BIGINT) AS issues,
       CAST(count_if(risk_bucket IN ('high', 'very_high')) AS BIGINT) AS high_risk_issues,
       round(avg(CASE WHEN risk_bucket IN ('high', 'very_high') THEN 1 ELSE 0 END), 6) AS high_risk_share,
       round(avg(risk_score), 6) AS avg_risk_score
FROM stg LEFT JOIN issue_key k ON stg.issue_id = k.issue_id GROUP BY k.token""")
def q_risk_drivers_keyword(spark, sf_dir):
    """High risk by the keyword of the issue's text."""
    words = with_text_features(td.unified_issues(spark, sf_dir)).select("issue_id", "issue_keyword")
    return round_doubles(reports.risk_drivers(stg(spark, sf_dir).join(words, "issue_id", "left"), "issue_keyword"))


@register("filter_issues_keyword", f"""WITH {O.ISSUE_CTES},
{O.issue_word_ctes()}
SELECT u.issue_id, k.token AS issue_keyword FROM unified u JOIN issue_key k ON u.issue_id = k.issue_id
WHERE contains(k.token, 'click') AND region = 'EUROPE'""")
def q_filter_issues_keyword(spark, sf_dir):
    rows = with_text_features(td.unified_issues(spark, sf_dir))
    return reports.filter_issues(rows, keyword="Click", region="EUROPE", text_col="issue_keyword").select("issue_id", "issue_keyword")


# ---------------------------------------------------------------- rows-only
# Models, topics, streams and the hash sample have no SQL twin; the driver
# checks their rows, the tests check their properties.


TOPIC_ITERATIONS = 10


def _fact_through(spark, sf_dir, enriched=None):
    return td.scored_issues(spark, sf_dir, enriched).filter(F.col("issue_date") < F.lit(SCORED_THROUGH).cast("date"))


@register("document_topics")
def q_document_topics(spark, sf_dir):
    """LDA on the documents (vectoriser + 15 topics); dominant topic per text."""
    docs = td.read(spark, sf_dir, "documents")
    m = T.fit_topics(docs, text_col="text", key="doc_id", max_iter=TOPIC_ITERATIONS)
    return T.assign_topics(m, docs, key="doc_id", text_col="text")


@register("topic_terms")
def q_topic_terms(spark, sf_dir):
    """Ten heaviest words of each of the 15 document topics."""
    docs = td.read(spark, sf_dir, "documents")
    m = T.fit_topics(docs, text_col="text", key="doc_id", max_iter=TOPIC_ITERATIONS)
    return T.topic_terms(m)


@register("issues_topic_enriched")
def q_issues_topic_enriched(spark, sf_dir):
    """Unified issues enriched with topics fitted on their own texts."""
    uni = td.unified_issues(spark, sf_dir)
    m = T.fit_topics(uni, max_iter=TOPIC_ITERATIONS)
    return enrich(uni, T.assign_topics(m, uni), T.topic_terms(m), terms_bound=m.stages[-1].getK())


@register("train_evaluate")
def q_train_evaluate(spark, sf_dir):
    """Three classifiers on the enriched issues; holdout metrics per model."""
    return RM.train_models(td.enriched_issues(spark, sf_dir)).metrics


@register("score_new_issues")
def q_score_new_issues(spark, sf_dir):
    """Model fitted on the fact, applied to the issues not yet scored."""
    # Both the fact and the new issues come from the enriched rows.
    enriched = cut_lineage(td.enriched_issues(spark, sf_dir), "enriched")
    # Of every row of the fact, and of the new issues, the columns that are read.
    inputs = ["issue_id", *RM.SOURCES]
    fact = cut_lineage(_fact_through(spark, sf_dir, enriched).select(*inputs, RM.LABEL), "fact")
    model = RM.train_models(fact, names=["logistic_regression"]).models["logistic_regression"]
    scored = RM.score_issues(model, new_issues(enriched.select(inputs), fact))
    return scored.select("issue_id", "predicted_label", F.col("risk_score.label").alias("risk_label"),
                         F.col("risk_score.prob").alias("risk_prob"))


@register("daily_run")
def q_daily_run(spark, sf_dir):
    """Full incremental run on a fact holding the days before SCORED_THROUGH:
    new -> score -> stage -> append -> refresh touched mart days."""
    tag = uuid.uuid4().hex[:10]
    fact_table, mart_table = f"issues_scored_{tag}", f"mart_region_day_{tag}"
    create_fact_table(spark, fact_table, scratch_path(spark, "fact"))
    append_scored(_fact_through(spark, sf_dir), fact_table)
    model = RM.train_models(spark.table(fact_table), names=["logistic_regression"]).models["logistic_regression"]
    run_daily(spark, td.enriched_issues(spark, sf_dir), fact_table, model, mart_table,
              scratch_path(spark, "mart"))
    return spark.table(mart_table)


@register("daily_run_volumes", O.with_issues("""
SELECT issue_date, region, total_issues, round(sla_breach_rate, 6) AS sla_breach_rate FROM mart"""))
def q_daily_run_volumes(spark, sf_dir):
    """The mart after an incremental run, model-independent columns only:
    every issue appended exactly once, breach rates right."""
    return round_doubles(q_daily_run(spark, sf_dir).select(
        "issue_date", "region", "total_issues", "sla_breach_rate"))


def _landed_stream(spark, sf_dir):
    """Stream rows of the tables sent as JSON lines and ingested by the
    Structured Streaming job (file source, availableNow)."""
    en = td.enriched_issues(spark, sf_dir)
    return en, SI.read_landed(spark, _land(spark, en))


def _land(spark, en):
    """Where the stream rows of ``en`` have landed."""
    src = scratch_path(spark, "stream-src")
    SI.write_issue_records(to_kafka_records(td.stream_updates(en).drop("ingested_at")), src)
    land, quarantine = scratch_path(spark, "stream-land"), scratch_path(spark, "stream-bad")
    # About four micro-batches, whatever the number of files.
    files = -(-len(spark.read.text(src).inputFiles()) // 4)
    stream = SI.read_issue_stream(spark, source="text", path=src, max_per_trigger=max(1, files))
    q = SI.start_ingest(stream, land, scratch_path(spark, "stream-ckpt"), quarantine)
    q.awaitTermination()
    return land


@register("stream_ingest", O.with_issues(f""", {STREAM_SQL}
SELECT {ENRICHED_SQL} FROM stream"""))
def q_stream_ingest(spark, sf_dir):
    """Rows landed by the streaming ingest (file source, foreachBatch)."""
    _, landed = _landed_stream(spark, sf_dir)
    return landed.select(ENRICHED_COLUMNS)


@register("stream_merge", ORACLE["merge_stream"])
def q_stream_merge(spark, sf_dir):
    """Upsert of the ingested stream into the enriched issues."""
    en, landed = _landed_stream(spark, sf_dir)
    return merge_stream_by_day(en, landed).select(ENRICHED_COLUMNS)


@register("stream_to_mart", O.with_issues(f""", {STREAM_SQL},
merged AS (
  SELECT {ENRICHED_SQL} FROM enriched WHERE issue_id NOT IN (SELECT issue_id FROM stream)
  UNION ALL
  SELECT {ENRICHED_SQL} FROM stream)
SELECT date AS issue_date, region, CAST(count(*) AS BIGINT) AS total_issues,
       round(avg(CASE WHEN sla_breached THEN 1 ELSE 0 END), 6) AS sla_breach_rate
FROM merged GROUP BY date, region"""))
def q_stream_to_mart(spark, sf_dir):
    """Streamed rows land, are merged into the enriched table, scored by the
    saved best model, appended and put into the mart (model-independent
    columns)."""
    tag = uuid.uuid4().hex[:10]
    en = td.enriched_issues(spark, sf_dir)
    land = _land(spark, en)
    jobs.create_enriched_table(en, f"enriched_{tag}", scratch_path(spark, "enriched"))
    create_fact_table(spark, f"fact_{tag}", scratch_path(spark, "fact"))
    model_path = scratch_path(spark, "models")
    jobs.train_and_save(spark.table(f"enriched_{tag}"), model_path, names=["logistic_regression"])
    jobs.run_stream_to_mart(spark, land, f"enriched_{tag}", f"fact_{tag}", f"mart_{tag}", model_path, scratch_path(spark, "mart"))
    return round_doubles(spark.table(f"mart_{tag}").select("issue_date", "region", "total_issues", "sla_breach_rate"))


@register("sample_rows", O.with_issues(f"""
SELECT {UNIFIED_SQL} FROM unified ORDER BY md5('42:' || issue_id), issue_id LIMIT 1000"""))
def q_sample_rows(spark, sf_dir):
    """Seeded, partition-independent sample of 1,000 issues."""
    return reports.sample_rows(td.unified_issues(spark, sf_dir), 1000)


from . import catalog_state  # noqa: E402, F401  (registers the queries on stored state)
