"""The region/day mart kept up to date by a streaming aggregation.

A watermarked aggregation counts issues per (creation day, region) and, in
update mode, emits the running totals of the groups that a micro-batch
touched. ``foreachBatch`` merges them into a mart state table (the same
partial rows as the daily job's, ``operators.mart_state``): the rows of this
query for those groups are replaced, so a batch that is replayed changes
nothing, and totals go on from the checkpoint after a restart. The mart is
derived from the state like the daily one.

The watermark is on the creation time and bounds the state kept: a group is
dropped once its day is ``delay`` behind the newest issue, and an issue older
than that is not counted here (the batch path counts every issue whatever
its age). Rows without a creation time are not counted. An issue sent twice
counts twice: put ``dedupe_stream`` into the ingest before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import batch_days, on_days
from ..operators.mart_state import STATE_COLUMNS, mart_from_state, partial_aggregates
from ..schemas import RISK_BUCKET_NULL
from ..sinks.journal import TableJournal
from .ingest import query_id

STATE_SCHEMA = ("entry string, region string, total_issues long, breached long, score_sum double, scored long, high_risk long, "
                "cnt_very_low long, cnt_low long, cnt_medium long, cnt_high long, cnt_very_high long, issue_date date")


def create_live_state(spark: SparkSession, table: str, path: str | None = None) -> None:
    """An empty state table, if there is none."""
    if not spark.catalog.tableExists(table):
        w = spark.createDataFrame([], STATE_SCHEMA).select(STATE_COLUMNS).write.format("parquet").partitionBy("issue_date")
        (w.option("path", path) if path else w).saveAsTable(table)


def live_counts(events: DataFrame, delay: str = "30 days") -> DataFrame:
    """Additive mart measures per (``issue_date``, ``region``) of a stream of
    enriched issues (not scored yet, so without scores and bands)."""
    rows = events.withColumns({"risk_score": F.lit(None).cast("double"), "risk_bucket": F.lit(RISK_BUCKET_NULL)})
    by_day = rows.withWatermark("created_at", delay).groupBy(F.window("created_at", "1 day").alias("w"), "region")
    return by_day.agg(*partial_aggregates()).withColumn("issue_date", F.to_date("w.start")).drop("w")


def merge_counts(batch: DataFrame, batch_id: int, table: str, query: str) -> None:
    """Replace this query's rows of the groups in ``batch`` by its totals.
    A batch that the table's journal holds is not merged again."""
    spark = batch.sparkSession
    journal = TableJournal(spark, table, "issue_date")
    journal.recover()
    if not journal.merged_batches().filter((F.col("query") == query) & (F.col("batch_id") == batch_id)).isEmpty():
        return
    entry = f"live:{query}"
    batch = batch.withColumn("entry", F.lit(entry)).select(STATE_COLUMNS).persist()
    try:
        days = batch_days(batch, "issue_date")
        if not days:
            journal.note_batches([(query, batch_id)])
            return
        old = spark.table(table).filter(on_days("issue_date", days))
        same = [old[c].eqNullSafe(batch[c]) for c in ("entry", "issue_date", "region")]
        kept = old.join(batch.select("entry", "issue_date", "region"), same, "left_anti")
        journal.stage(kept.unionByName(batch), days, [(query, batch_id)])
    finally:
        batch.unpersist()
    journal.recover()


def start_live_mart(events: DataFrame, table: str, checkpoint: str, delay: str = "30 days",
                    processing_time: str | None = None) -> StreamingQuery:
    """Start the aggregation over a stream of decoded events; drains what is
    there and stops unless a ``processing_time`` is given."""
    writer = (live_counts(events, delay).writeStream.outputMode("update")
              .foreachBatch(lambda df, bid: merge_counts(df, bid, table, query_id(df.sparkSession, checkpoint)))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def live_mart(spark: SparkSession, table: str) -> DataFrame:
    """The mart as of the last merged batch."""
    return mart_from_state(TableJournal(spark, table, "issue_date").snapshot())
