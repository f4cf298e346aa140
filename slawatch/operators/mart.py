"""Staging view over the scored fact and the region/day mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import dow_sunday1, is_high_risk, risk_bucket, risk_prob

STG_COLUMNS = [
    "issue_id", "created_at", "issue_date", "issue_hour", "issue_dow", "region", "channel",
    "raw_category", "topic_id", "topic_keywords", "sla_breached", "predicted_label",
    "risk_score", "resolution_hours", "risk_bucket",
]


def stg_issues(scored: DataFrame) -> DataFrame:
    """Scored fact -> staging rows: calendar keys, numeric risk score and its
    bucket. Narrow (no shuffle); it is inlined into whatever reads it. On
    the fact, ``issue_date`` is the partition column (equal to the date of
    ``created_at``), so a day-level reader touches no timestamp column."""
    day = F.col("issue_date") if "issue_date" in scored.columns else F.to_date("created_at")
    base = scored.select(day.alias("_day"),
        "issue_id", "created_at", "resolved_at", "region", "channel", "raw_category",
        "topic_id", "topic_keywords", "sla_breached", "predicted_label",
        risk_prob("risk_score").alias("risk_prob"), "resolution_hours",
    )
    return base.select(
        "issue_id",
        "created_at",
        F.col("_day").alias("issue_date"),
        F.hour("created_at").cast("int").alias("issue_hour"),
        dow_sunday1("created_at").alias("issue_dow"),
        "region", "channel", "raw_category", "topic_id", "topic_keywords",
        "sla_breached", "predicted_label",
        F.col("risk_prob").alias("risk_score"),
        "resolution_hours",
        risk_bucket("risk_prob").alias("risk_bucket"),
    )


def _rate(cond) -> F.Column:
    """Mean of a 0/1 flag where null counts as 0."""
    return F.avg(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def mart_aggregates() -> list:
    """The mart's measures, reusable for any grouping."""
    b = F.col("risk_bucket")
    return [
        F.count(F.lit(1)).alias("total_issues"),
        _rate(F.col("sla_breached")).alias("sla_breach_rate"),
        F.avg("risk_score").alias("avg_risk_score"),
        _rate(is_high_risk(b)).alias("high_risk_share"),
        F.count_if(b == "very_low").alias("cnt_very_low"),
        F.count_if(b == "low").alias("cnt_low"),
        F.count_if(b == "medium").alias("cnt_medium"),
        F.count_if(b == "high").alias("cnt_high"),
        F.count_if(b == "very_high").alias("cnt_very_high"),
    ]


def mart_issues_by_region_day(stg: DataFrame) -> DataFrame:
    """One row per (issue_date, region).

    A single hash aggregate: each map task pre-aggregates to at most one row
    per group it has seen, so the shuffle carries (days x regions x tasks)
    rows whatever the input size, and a region holding a third of all rows
    costs no more than any other. Sort on read, not here.
    """
    return stg.groupBy("issue_date", "region").agg(*mart_aggregates())


def create_views(scored: DataFrame, stg_name: str = "stg_issues",
                 mart_name: str | None = "mart_issues_by_region_day") -> DataFrame:
    """Materialise the staging rows (and optionally the mart) as temporary
    views, so SQL readers can query them by name; views are inlined into
    every query that reads them (no copy)."""
    stg = stg_issues(scored)
    stg.createOrReplaceTempView(stg_name)
    if mart_name:
        mart_issues_by_region_day(stg).createOrReplaceTempView(mart_name)
    return stg
