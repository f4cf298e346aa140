"""Batch cleaning of raw service-request rows into unified issues.

All steps are narrow (no shuffle): the whole chain runs inside the scan's
map stage, one whole-stage-codegen span per file split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalar import (
    elapsed_hours,
    issue_text,
    null_if_na,
    parse_timestamp,
    sla_flag,
    strip_ws,
)
from ..schemas import (
    DEFAULT_CHANNEL,
    OPTIONAL_COLUMNS,
    RAW_COLUMN_MAP,
    REQUIRED_RAW_COLUMNS,
    SLA_HOURS_TARGET,
    SOURCE_SYSTEM,
    UNIFIED_COLUMNS,
    UNKNOWN_REGION,
)


class MissingColumnsError(ValueError):
    pass


def standardize_columns(df: DataFrame) -> DataFrame:
    """Check the required raw columns, rename the known ones, add the absent
    optional ones as null, and map missing-value spellings to null.

    Only metadata is inspected (``df.columns``); no job runs.
    """
    missing = [c for c in REQUIRED_RAW_COLUMNS if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"raw input lacks {missing}; it has {df.columns}")
    present = {raw: new for raw, new in RAW_COLUMN_MAP.items() if raw in df.columns}
    out = df.select([null_if_na(F.col(f"`{raw}`").cast("string")).alias(new)
                     for raw, new in present.items()])
    absent = {c: F.lit(None).cast("string") for c in OPTIONAL_COLUMNS if c not in out.columns}
    if absent:
        out = out.withColumns(absent)
    return out


def parse_dates(df: DataFrame) -> DataFrame:
    """Lenient parse of ``created_at`` / ``resolved_at`` (bad text -> null)."""
    return df.withColumns({
        "created_at": parse_timestamp("created_at"),
        "resolved_at": parse_timestamp("resolved_at"),
    })


def drop_undated(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Drop rows without ``created_at``; optionally count them on the side
    (an ``Observation`` is filled by the next action, no extra pass)."""
    if observation is not None:
        df = df.observe(observation,
                        F.count(F.lit(1)).alias("rows_in"),
                        F.count_if(F.col("created_at").isNull()).alias("dropped_undated"))
    return df.filter(F.col("created_at").isNotNull())


def add_issue_text(df: DataFrame) -> DataFrame:
    """``issue_text = strip(category) - strip(subcategory)``; null parts are ''."""
    return df.withColumns({
        "raw_category": F.coalesce(F.col("raw_category"), F.lit("")),
        "raw_subcategory": F.coalesce(F.col("raw_subcategory"), F.lit("")),
    }).withColumn("issue_text", issue_text("raw_category", "raw_subcategory"))


def blank_text_condition(strict: bool = False):
    """Rows to drop as blank. With the separator always present the text is
    never blank, so by default nothing is dropped; ``strict`` drops rows
    whose two parts are both blank."""
    if strict:
        return (strip_ws("raw_category") == F.lit("")) & (strip_ws("raw_subcategory") == F.lit(""))
    return strip_ws("issue_text") == F.lit("")


def drop_blank_text(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.filter(~blank_text_condition(strict))


def resolve_region_channel(df: DataFrame, source: str = SOURCE_SYSTEM) -> DataFrame:
    """Region falls back to city then ``UNKNOWN``; channel to ``311``."""
    return df.withColumns({
        "region": F.coalesce(F.col("region"), F.col("city"), F.lit(UNKNOWN_REGION)),
        "channel": F.coalesce(F.col("raw_channel"), F.lit(DEFAULT_CHANNEL)),
        "source_system": F.lit(source),
    })


def with_sla(df: DataFrame, target: int = SLA_HOURS_TARGET) -> DataFrame:
    """SLA target, elapsed hours (null if unresolved; negative kept) and flag."""
    return (df.withColumn("sla_hours_target", F.lit(target).cast("int"))
              .withColumn("resolution_hours", elapsed_hours("created_at", "resolved_at"))
              .withColumn("sla_breached", sla_flag(F.col("resolution_hours"), F.col("sla_hours_target"))))


def unify_issues(raw: DataFrame, target: int = SLA_HOURS_TARGET, source: str = SOURCE_SYSTEM,
                 strict: bool = False, observation: Observation | None = None) -> DataFrame:
    """Raw rows (raw CSV header names) -> ``issues_unified``."""
    df = standardize_columns(raw)
    df = parse_dates(df)
    df = drop_undated(df, observation)
    df = add_issue_text(df)
    df = drop_blank_text(df, strict)
    df = resolve_region_channel(df, source)
    df = with_sla(df, target)
    return df.select(UNIFIED_COLUMNS)


def cleaning_report(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Row counts before and after each cleaning step, in one pass."""
    df = add_issue_text(parse_dates(standardize_columns(raw)))
    undated = F.col("created_at").isNull()
    blank = blank_text_condition(strict)
    return df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(undated).alias("dropped_undated"),
        F.count_if(~undated & blank).alias("dropped_blank_text"),
        F.count_if(~undated & ~blank).alias("clean_rows"),
    )
