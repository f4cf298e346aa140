"""The stored mart state of a fact: appended per batch, compacted, read by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import on_days
from ..operators.mart import stg_issues
from ..operators.mart_state import STATE_COLUMNS, mart_from_state, merge_partials, partial_mart
from ..schemas import MART_COLUMNS
from ..session import cut_lineage
from .tables import overwrite_partitions


def state_name(fact_table: str) -> str:
    return f"{fact_table}_state"


def build_state(spark: SparkSession, fact_table: str) -> str:
    """The state of a fact that has none yet: one entry over all its rows."""
    name = state_name(fact_table)
    rows = partial_mart(stg_issues(spark.table(fact_table)), "base")
    rows.write.format("parquet").partitionBy("issue_date").saveAsTable(name)
    return name


def add_batch(rows: DataFrame, fact_table: str, entry: str) -> None:
    """Add the partial rows of a scored batch; not twice under one entry."""
    spark = rows.sparkSession
    name = state_name(fact_table)
    if spark.table(name).filter(F.col("entry") == entry).isEmpty():
        partial_mart(stg_issues(rows), entry).write.insertInto(name)


def compact(spark: SparkSession, fact_table: str, days: list | None = None) -> None:
    """One row per (day, region) on the given days (default: all). The rows
    keep no batch names, so compact between runs, not during one."""
    name = state_name(fact_table)
    state = spark.table(name)
    if days is not None:
        state = state.filter(on_days("issue_date", days))
    merged = merge_partials(state).withColumn("entry", F.lit("compacted")).select(STATE_COLUMNS)
    overwrite_partitions(cut_lineage(merged, "state-compact"), name)


def recount_days(spark: SparkSession, fact_table: str, days: list) -> None:
    """Count the given days anew from the fact."""
    fact = spark.table(fact_table).filter(on_days("issue_date", days))
    rows = partial_mart(stg_issues(fact), "recount")
    overwrite_partitions(cut_lineage(rows, "state-recount"), state_name(fact_table))


def mart_rows(spark: SparkSession, fact_table: str, days: list | None = None) -> DataFrame:
    """Mart rows of some days (default: all) from the state, in the mart
    table's column order (partition column last)."""
    state = spark.table(state_name(fact_table))
    if days is not None:
        state = state.filter(on_days("issue_date", days))
    return mart_from_state(state).select(*[c for c in MART_COLUMNS if c != "issue_date"], "issue_date")
