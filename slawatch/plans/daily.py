"""The daily job: score what is new, append it, keep the mart.

1. ``not_indexed``: anti-join of the enriched issues against the fact's id
   index, which lies bucketed by id: only the batch is shuffled, and history
   is looked up once per run;
2. one row per id (``latest_per_key``, a map-side-combined aggregate), then
   ``score_issues``: model transform (map-only);
3. the scored batch is staged under the fact's journal and entered there:
   from then on it counts, and a run that is lost later is finished by the
   next one (a lost executor re-reads the stage, it does not re-run the
   anti-join and the model);
4. append of the staged rows to the fact, of their ids to the index, of
   their partial aggregates to the mart state; no old fact row is read;
5. mart refresh of every day on which the mart's totals differ from the
   state's (two small tables): the days of this batch, and those that an
   earlier run left stale. Only those partitions are overwritten.

A run that finishes an earlier one repeats step 4 for its stage, and skips
what is there: fact rows by id on the stage's own days, ids by the index,
the state by its entry. Rows that something else has appended to the
fact are not seen by these steps; ``repair`` finds and counts them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import batch_days, latest_per_key, new_issues, on_days, to_fact
from ..operators.mart import mart_issues_by_region_day, stg_issues
from ..operators.risk_model import score_issues
from ..schemas import MART_COLUMNS
from ..sinks import idindex, martstate
from ..sinks.journal import TableJournal
from ..sinks.tables import overwrite_partitions

APPEND = "append"


@dataclass
class DailyResult:
    """Rows appended; the days refreshed in the mart (those of this run and
    any left stale before; a mart built anew counts this run's); mart rows."""

    new_rows: int
    days: list
    mart_rows: int


def stale_days(counted: DataFrame, mart: DataFrame) -> DataFrame:
    """(``issue_date``): days whose mart total is not the number of issues in
    ``counted``: the mart state (``total_issues``), or a fact (its rows; no
    column but the partition column is read)."""
    total = F.sum("total_issues") if "total_issues" in counted.columns else F.count(F.lit(1))
    have = counted.groupBy("issue_date").agg(total.alias("rows"))
    told = mart.groupBy(F.col("issue_date").alias("_day")).agg(F.sum("total_issues").alias("total"))
    both = have.join(told, F.col("issue_date").eqNullSafe(F.col("_day")), "left")
    return both.filter(~F.col("rows").eqNullSafe(F.col("total"))).select("issue_date")


def refresh_mart(spark: SparkSession, fact_table: str, mart_table: str, days: DataFrame | None = None,
                 mart_path: str | None = None) -> list:
    """Overwrite the mart's partitions of ``days`` (default: those on which
    its totals are not the state's: two tables of a few rows per day) with
    rows derived from the mart state; a mart that does not exist is written
    whole. Without a state the fact itself is counted. Returns the days."""
    exists = spark.catalog.tableExists(mart_table)
    name = martstate.state_name(fact_table)
    state = spark.table(name) if spark.catalog.tableExists(name) else None
    source = spark.table(fact_table) if state is None else state
    if exists and days is None:
        days = stale_days(source, spark.table(mart_table))
    wanted = batch_days(days if exists else source, "issue_date")
    if not wanted and exists:
        return []
    if state is not None:
        rows = martstate.mart_rows(spark, fact_table, wanted if exists else None)
    else:
        touched = source.filter(on_days("issue_date", wanted)) if exists else source
        # Mart partition column goes last for the positional insert.
        rows = mart_issues_by_region_day(stg_issues(touched)).select(
            *[c for c in MART_COLUMNS if c != "issue_date"], "issue_date")
    if exists:
        overwrite_partitions(rows, mart_table)
    else:
        w = rows.write.format("parquet").partitionBy("issue_date")
        if mart_path:
            w = w.option("path", mart_path)
        w.saveAsTable(mart_table)
    return wanted


def repair(spark: SparkSession, fact_table: str, mart_table: str, mart_path: str | None = None) -> list:
    """Bring the index, the state and the mart to what the fact holds, after
    rows were appended by other means; the days that were refreshed. Reads
    the fact's row counts by day and, if they differ from the state's, its id
    column and those days."""
    fact = spark.table(fact_table)
    index = idindex.ensure_index(spark, fact_table)
    if not spark.catalog.tableExists(martstate.state_name(fact_table)):
        martstate.build_state(spark, fact_table)
    days = batch_days(stale_days(fact, spark.table(martstate.state_name(fact_table))), "issue_date")
    if days:
        idindex.add_ids(idindex.not_indexed(fact.select(idindex.KEY), spark.table(index)), fact_table)
        martstate.recount_days(spark, fact_table, days)
    return refresh_mart(spark, fact_table, mart_table, mart_path=mart_path)


def run_daily(spark: SparkSession, enriched: DataFrame, fact_table: str,
              model: PipelineModel, mart_table: str, mart_path: str | None = None) -> DailyResult:
    """One incremental run; a second run on the same input adds nothing, and
    a run after a crash completes what was left."""
    journal = TableJournal(spark, fact_table, "issue_date")

    def carry_out(row: Row, again: bool) -> None:
        """A staged batch into the fact, the index and the state. ``again``:
        some of it may have happened."""
        staged = journal.staged(row["entry"])
        rows = staged
        if again:
            rows = new_issues(staged, spark.table(fact_table).filter(on_days("issue_date", row["days"])))
        rows.write.insertInto(fact_table)
        idindex.add_ids(staged, fact_table, once=again)
        martstate.add_batch(staged, fact_table, row["entry"])

    if not spark.catalog.tableExists(martstate.state_name(fact_table)):
        # An entry left open before the first state: the fact first.
        journal.recover(lambda row: new_issues(
            journal.staged(row["entry"]), spark.table(fact_table).filter(on_days("issue_date", row["days"]))).write.insertInto(fact_table))
        martstate.build_state(spark, fact_table)
    index = idindex.ensure_index(spark, fact_table)
    journal.recover(lambda row: carry_out(row, True))
    # One row per id before scoring (duplicates would be scored, then dropped);
    # the kept row is chosen by a row hash, the same on every run.
    known = enriched.filter(F.col("issue_id").isNotNull())
    fresh = latest_per_key(idindex.not_indexed(known, spark.table(index)), "issue_id", ())
    entry = journal.write_stage(to_fact(score_issues(model, fresh)))
    staged = journal.staged(entry)
    n_new = staged.count()
    own_days = batch_days(staged, "issue_date")
    if n_new:
        journal.enter(entry, own_days, kind=APPEND)
        journal.recover(lambda row: carry_out(row, False))
    existed = spark.catalog.tableExists(mart_table)
    refreshed = refresh_mart(spark, fact_table, mart_table, mart_path=mart_path)
    # A mart built from the whole state: the run's own days.
    return DailyResult(n_new, refreshed if existed else own_days, spark.table(mart_table).count())
