"""Report queries on the mart, the staging rows and the issues.

Every report is a grouped or global aggregate (map-side partial
aggregation, one small shuffle) or a top-k (``TakeOrderedAndProject``: each
task keeps its best k, the driver merges k x tasks rows). Every ordering
ends in a key so ties come out the same way on every run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import is_high_risk
from ..schemas import (
    DEFAULT_WINDOW_DAYS,
    RECENT_ISSUES_ROWS,
    REGION_SUMMARY_ROWS,
    SEED,
    TOP_REGIONS_ROWS,
)
from .stats import exact_quantiles

DateLike = dt.date | str


def _date(d: DateLike) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


# ------------------------------------------------------------ date ranges
def date_window(end: DateLike, days: int = DEFAULT_WINDOW_DAYS,
                start: DateLike | None = None) -> tuple[dt.date, dt.date]:
    """The report window: ``[end - days, end]`` unless ``start`` is given;
    rejects ``start > end``."""
    e = _date(end)
    s = _date(start) if start is not None else e - dt.timedelta(days=days)
    if s > e:
        raise ValueError(f"start {s} is after end {e}")
    return s, e


def between_dates(df: DataFrame, start: DateLike, end: DateLike, col: str = "issue_date") -> DataFrame:
    """Inclusive date range on a date column (a partition column prunes)."""
    s, e = date_window(end, start=start)
    return df.filter(F.col(col).between(F.lit(s), F.lit(e)))


# ------------------------------------------------------------ mart reports
def _weighted_rate(rate: str = "sla_breach_rate", n: str = "total_issues") -> Column:
    total = F.sum(n)
    return F.when(total > 0, F.sum(F.col(rate) * F.col(n)) / total).otherwise(F.lit(0.0))


def overview_kpis(mart: DataFrame) -> DataFrame:
    """Total issues, volume-weighted breach rate (0 without issues), and the
    plain means of the daily risk score and high-risk share."""
    return mart.agg(
        F.coalesce(F.sum("total_issues"), F.lit(0)).cast("long").alias("total_issues"),
        F.coalesce(_weighted_rate(), F.lit(0.0)).alias("sla_breach_rate"),
        F.avg("avg_risk_score").alias("avg_risk_score"),
        F.avg("high_risk_share").alias("avg_high_risk_share"),
    )


def daily_trend(mart: DataFrame, weighted: bool = False) -> DataFrame:
    """Issues per day and the day's breach rate (mean of the regions'
    rates, or volume-weighted), in date order."""
    rate = _weighted_rate() if weighted else F.avg("sla_breach_rate")
    return (mart.groupBy("issue_date")
                .agg(F.sum("total_issues").cast("long").alias("total_issues"),
                     rate.alias("avg_sla_breach_rate"))
                .orderBy("issue_date"))


def region_breach(mart: DataFrame, weighted: bool = False) -> DataFrame:
    """Breach rate per region, highest first; a null region is left out."""
    rate = _weighted_rate() if weighted else F.avg("sla_breach_rate")
    return (mart.filter(F.col("region").isNotNull())
                .groupBy("region")
                .agg(F.sum("total_issues").cast("long").alias("total_issues"),
                     rate.alias("avg_sla_breach_rate"))
                .orderBy(F.desc("avg_sla_breach_rate"), F.asc("region")))


def _summary_aggs() -> list[Column]:
    return [
        F.sum("total_issues").cast("long").alias("total_issues"),
        F.avg("sla_breach_rate").alias("avg_sla_breach_rate"),
        F.avg("avg_risk_score").alias("avg_risk_score"),
        F.avg("high_risk_share").alias("avg_high_risk_share"),
    ]


def region_risk_summary(mart: DataFrame, n: int | None = REGION_SUMMARY_ROWS,
                        by: str | None = "region", dropna: bool = False) -> DataFrame:
    """Per region (null region kept unless ``dropna``): volume and three
    means; the ``n`` busiest regions. ``by=None`` gives one overall row."""
    if by is None or by not in mart.columns:
        return mart.agg(*_summary_aggs())
    src = mart.filter(F.col(by).isNotNull()) if dropna else mart
    out = src.groupBy(by).agg(*_summary_aggs()).orderBy(F.desc("total_issues"), F.asc_nulls_first(by))
    return out.limit(n) if n else out


def as_csv_rows(df: DataFrame) -> DataFrame:
    """Each row as one CSV line (for a small summary handed to a reader)."""
    return df.select(F.to_csv(F.struct(*[F.col(c) for c in df.columns])).alias("csv"))


def compare_periods(mart: DataFrame, start: DateLike, end: DateLike,
                    by: str = "region") -> DataFrame:
    """Each region's current period ``[start, end]`` against the period of
    equal length just before it, in one pass over both periods."""
    s, e = date_window(end, start=start)
    length = (e - s).days + 1
    ps, pe = s - dt.timedelta(days=length), s - dt.timedelta(days=1)
    cur = F.col("issue_date").between(F.lit(s), F.lit(e))
    prev = F.col("issue_date").between(F.lit(ps), F.lit(pe))

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("total_issues"))), F.lit(0)).cast("long")

    def rate(cond):
        n = F.sum(F.when(cond, F.col("total_issues")))
        b = F.sum(F.when(cond, F.col("sla_breach_rate") * F.col("total_issues")))
        return F.when(n > 0, b / n)

    out = (mart.filter(F.col("issue_date").between(F.lit(ps), F.lit(e)))
               .groupBy(by)
               .agg(total(cur).alias("cur_issues"), total(prev).alias("prev_issues"),
                    rate(cur).alias("cur_breach_rate"), rate(prev).alias("prev_breach_rate"),
                    F.avg(F.when(cur, F.col("avg_risk_score"))).alias("cur_avg_risk"),
                    F.avg(F.when(prev, F.col("avg_risk_score"))).alias("prev_avg_risk")))
    return out.withColumns({
        "delta_issues": F.col("cur_issues") - F.col("prev_issues"),
        "delta_breach_rate": F.col("cur_breach_rate") - F.col("prev_breach_rate"),
    })


# ------------------------------------------------------------ staging reports
def risk_bucket_mix(stg: DataFrame, by: str = "region") -> DataFrame:
    """Share (in %) of each risk bucket within each region.

    The window runs on the aggregated rows (regions x 6 buckets), never on
    the issues themselves.
    """
    counts = stg.groupBy(by, "risk_bucket").agg(F.count(F.lit(1)).alias("issues"))
    per = Window.partitionBy(by)
    return counts.withColumn("pct", F.col("issues") * 100.0 / F.sum("issues").over(per))


def recent_issues(scored: DataFrame, start: DateLike, end: DateLike,
                  n: int = RECENT_ISSUES_ROWS, ts: str = "created_at") -> DataFrame:
    """The newest ``n`` issues created within ``[start, end]``: a top-k that
    keeps ``n`` rows per task. If the input carries the ``issue_date``
    partition column the range prunes its partitions."""
    s, e = date_window(end, start=start)
    df = scored.filter(F.to_date(F.col(ts)).between(F.lit(s), F.lit(e)))
    if "issue_date" in scored.columns:
        df = df.filter(F.col("issue_date").between(F.lit(s), F.lit(e)))
    return df.orderBy(F.desc(ts), F.asc("issue_id")).limit(n)


def recent_high_risk(stg: DataFrame, start: DateLike, end: DateLike,
                     n: int = RECENT_ISSUES_ROWS) -> DataFrame:
    """The newest ``n`` high or very-high risk issues in the range."""
    return recent_issues(stg.filter(is_high_risk("risk_bucket")), start, end, n)


def risk_drivers(stg: DataFrame, by: str = "raw_category") -> DataFrame:
    """What drives high risk: per value of ``by``, issues, high-risk issues,
    their share and the mean score; most high-risk first."""
    hr = is_high_risk("risk_bucket")
    return (stg.groupBy(by)
               .agg(F.count(F.lit(1)).alias("issues"),
                    F.count_if(hr).alias("high_risk_issues"),
                    F.avg(F.when(hr, F.lit(1)).otherwise(F.lit(0))).alias("high_risk_share"),
                    F.avg("risk_score").alias("avg_risk_score"))
               .orderBy(F.desc("high_risk_issues"), F.asc(by)))


def filter_issues(stg: DataFrame, keyword: str | None = None, region: str | None = None,
                  text_col: str = "topic_keywords") -> DataFrame:
    """Issues whose text contains ``keyword`` (case-insensitive) and/or of
    one region."""
    df = stg
    if keyword:
        df = df.filter(F.lower(F.col(text_col)).contains(keyword.lower()))
    if region is not None:
        df = df.filter(F.col("region") == F.lit(region))
    return df


# ------------------------------------------------------------ issue EDA
def value_counts(df: DataFrame, col: str, dropna: bool = True, n: int | None = None) -> DataFrame:
    """Frequency of each value, most frequent first (ties by value)."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    out = (src.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc_nulls_first(col)))
    return out.limit(n) if n else out


def activity_profile(df: DataFrame, by: str = "hour") -> DataFrame:
    """Issues per hour (or per weekday), in key order."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("count")).orderBy(by)


def describe_hours(df: DataFrame, col: str = "resolution_hours", exact: bool = True,
                   accuracy: int = 10_000) -> DataFrame:
    """count, mean, std (sample), min, interpolated quartiles, max.

    ``exact=False`` takes the quartiles from ``percentile_approx`` (one
    bounded sketch per task, rank error about 1/``accuracy``, one pass)
    instead of the exact distributed rank lookup."""
    basic = df.agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"))
    if exact:
        q = exact_quantiles(df, col, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    else:
        qs = F.percentile_approx(col, [0.25, 0.5, 0.75], accuracy)
        q = df.agg(qs.getItem(0).alias("p25"), qs.getItem(1).alias("p50"), qs.getItem(2).alias("p75"))
    # One subquery for all three.
    quartiles = q.select(F.struct("p25", "p50", "p75")).scalar()
    return (basic.withColumn("_q", quartiles)
                 .select("count", "mean", "std", "min", "_q.p25", "_q.p50", "_q.p75", "max"))


def date_span(df: DataFrame, col: str = "date") -> DataFrame:
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def issues_by_region(df: DataFrame, n: int | None = TOP_REGIONS_ROWS) -> DataFrame:
    """Issues (non-null ids) per region, the ``n`` busiest."""
    out = (df.groupBy("region").agg(F.count("issue_id").alias("issue_count"))
             .orderBy(F.desc("issue_count"), F.asc_nulls_first("region")))
    return out.limit(n) if n else out


def sample_rows(df: DataFrame, n: int, seed: int = SEED, key: str = "issue_id") -> DataFrame:
    """A reproducible pseudo-random sample of at most ``n`` rows: the ``n``
    rows with the smallest seeded md5 of the key (ties by key), so the same
    rows come back whatever the partitioning, task order or engine
    (``DataFrame.sample`` depends on the first two). A top-k in one pass:
    ``n`` rows per task reach the final merge."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
