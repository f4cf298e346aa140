"""The region/day mart as mergeable partial aggregates.

Counts and sums per (day, region) can be added up; rates and means cannot.
So what is stored is the former: every batch appends its own partial rows,
and the mart's rates are derived from their sums. A batch reads no fact row
that is already counted; a mart of any window, or with regions rolled up, is
a sum over a table of (days x regions x batches) small rows.

The state table is partitioned by ``issue_date``. ``entry`` names the batch a
row came from, so that a batch is never added twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import is_high_risk
from ..schemas import MART_COLUMNS

BANDS = ["very_low", "low", "medium", "high", "very_high"]
#: Additive measures; every one of them is summed when rows are merged.
MEASURES = ["total_issues", "breached", "score_sum", "scored", "high_risk", *[f"cnt_{b}" for b in BANDS]]
STATE_COLUMNS = ["entry", "region", *MEASURES, "issue_date"]


def partial_aggregates() -> list[Column]:
    """The additive measures over staging rows. A null flag counts as not
    breached, a null score neither in the sum nor in the count of scores."""
    b = F.col("risk_bucket")
    return [
        F.count(F.lit(1)).alias("total_issues"),
        F.count_if(F.coalesce(F.col("sla_breached"), F.lit(False))).alias("breached"),
        F.sum("risk_score").alias("score_sum"),
        F.count("risk_score").alias("scored"),
        F.count_if(F.coalesce(is_high_risk(b), F.lit(False))).alias("high_risk"),
        *[F.count_if(F.coalesce(b == band, F.lit(False))).alias(f"cnt_{band}") for band in BANDS],
    ]


def partial_mart(stg: DataFrame, entry: str = "") -> DataFrame:
    """Partial rows of one batch of staging rows (one hash aggregate,
    combined inside the map tasks)."""
    rows = stg.groupBy("issue_date", "region").agg(*partial_aggregates())
    return rows.withColumn("entry", F.lit(entry)).select(STATE_COLUMNS)


def merge_partials(state: DataFrame, *by: str) -> DataFrame:
    """Partial rows added up per ``by`` (default: day and region)."""
    return state.groupBy(*(by or ("issue_date", "region"))).agg(*[F.sum(m).alias(m) for m in MEASURES])


def rates() -> list[Column]:
    """The mart's rates over added-up measures."""
    total = F.col("total_issues")
    return [(F.col("breached") / total).alias("sla_breach_rate"),
            F.when(F.col("scored") > 0, F.col("score_sum") / F.col("scored")).alias("avg_risk_score"),
            (F.col("high_risk") / total).alias("high_risk_share")]


def mart_from_state(state: DataFrame) -> DataFrame:
    """The mart, one row per (issue_date, region), from partial rows."""
    merged = merge_partials(state)
    bands = [F.col(f"cnt_{b}") for b in BANDS]
    return merged.select("issue_date", "region", "total_issues", *rates(), *bands).select(MART_COLUMNS)


def rollup_from_state(state: DataFrame, *by: str) -> DataFrame:
    """The same measures and rates, weighted by issues, per any of the
    state's columns (none: one row over all)."""
    merged = state.groupBy(*by).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return merged.select(*by, "total_issues", *rates())
