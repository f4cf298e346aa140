"""Data checks: each returns the failing rows (empty = pass), lazily."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` that occur more than once (nulls ignored), with
    their number of rows. A hash aggregate: a hot value is counted map-side."""
    return (df.filter(F.col(col).isNotNull())
              .groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())
