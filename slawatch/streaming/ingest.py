"""Structured Streaming ingest of keyed JSON issue events.

Source: Kafka (one task per topic partition, offsets in the checkpoint) or,
where no broker is at hand, a directory of JSON-lines files. Sink:
``foreachBatch`` writing each micro-batch to its own ``query=``/``batch_id=``
folder with overwrite, so a batch replayed after a failure replaces its own
output instead of appending twice, and a query with a fresh checkpoint (a new
query id, batch ids from 0) never replaces another query's rows; rows that do not decode go to a quarantine
folder. Offsets / file lists and the batch ids live in the checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .codec import CORRUPT, bad_events, good_events, parse_issue_events

DEFAULT_TOPIC = "issues_raw"


def kafka_source_options(options: dict | None = None, max_per_trigger: int | None = None,
                         min_partitions: int | None = None) -> dict:
    """Options for Spark's Kafka source: the issues topic from the earliest
    offset unless given, offsets per micro-batch capped, large topic
    partitions split over several tasks."""
    opts = dict(options or {})
    if "subscribe" not in opts and "subscribePattern" not in opts and "assign" not in opts:
        opts["subscribe"] = DEFAULT_TOPIC
    opts.setdefault("startingOffsets", "earliest")
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_issue_stream(spark: SparkSession, source: str = "kafka", options: dict | None = None,
                      path: str | None = None, max_per_trigger: int | None = None,
                      min_partitions: int | None = None) -> DataFrame:
    """(key, value) text records of issue events.

    ``source="kafka"``: ``options`` must hold ``kafka.bootstrap.servers`` and
    ``subscribe``; reading starts at the earliest offset; ``max_per_trigger``
    caps offsets per micro-batch; ``min_partitions`` splits large topic
    partitions over several tasks (a hot partition is not one task).
    ``source="text"``: every line of the files
    under ``path`` is one JSON value (no key); ``max_per_trigger`` caps files.
    """
    opts = dict(options or {})
    if source == "kafka":
        opts = kafka_source_options(opts, max_per_trigger, min_partitions)
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"),
                          F.col("timestamp").alias("ingested_at"))
    if max_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_per_trigger)
    raw = spark.readStream.format("text").options(**opts).load(path)
    return raw.select(F.lit(None).cast("string").alias("key"), F.col("value"),
                      F.current_timestamp().alias("ingested_at"))


def write_issue_records(records: DataFrame, path: str, options: dict | None = None,
                        fmt: str = "text") -> None:
    """Publish (key, value) records: to Kafka (``fmt="kafka"``, ``options``
    with servers and ``topic``) or as JSON-lines text files."""
    if fmt == "kafka":
        records.select("key", "value").write.format("kafka").options(**(options or {})).save()
    else:
        records.select("value").write.mode("overwrite").text(path)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def batch_metrics(parsed: DataFrame) -> DataFrame:
    """One row about a decoded batch: rows read, landed and quarantined, and
    the data checks on what landed (ids that occur more than once, rows
    without a creation time), with the span of ingest times if there is one."""
    good = F.col(CORRUPT).isNull() & F.col("issue_id").isNotNull()
    n_good = F.count_if(good)
    aggs = [
        F.count(F.lit(1)).alias("rows_in"), n_good.alias("rows_landed"), F.count_if(~good).alias("rows_quarantined"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("undecodable"),
        F.count_if(F.col(CORRUPT).isNull() & F.col("issue_id").isNull()).alias("without_id"),
        F.count_if(good & F.col("created_at").isNull()).alias("undated"),
        (n_good - F.count_distinct(F.when(good, F.col("issue_id")))).alias("repeated_ids"),
    ]
    if "ingested_at" in parsed.columns:
        aggs += [F.min("ingested_at").alias("first_ingested"), F.max("ingested_at").alias("last_ingested")]
    return parsed.agg(*aggs)


def _batch_folder(path: str, query: str, batch_id: int) -> str:
    return f"{path}/query={query}/batch_id={batch_id}"


def ingest_batch(batch: DataFrame, batch_id: int, table_path: str,
                 quarantine_path: str | None, query: str, metrics_path: str | None = None) -> None:
    """One micro-batch: decode, split good / bad, write both idempotently
    (overwrite of this batch's own folder), and what ``batch_metrics`` says
    of it. The decoded batch is persisted so the split reads it once; the
    quarantine folder is written only when the batch has bad rows (no empty
    folders per micro-batch), with the record as it came."""
    keep = ("ingested_at",) if "ingested_at" in batch.columns else ()
    raw = batch.withColumn("_value", F.col("value").cast("string"))
    parsed = parse_issue_events(raw, key_col="key", keep=(*keep, "_value")).persist()
    try:
        good_events(parsed, keep).write.mode("overwrite").parquet(_batch_folder(table_path, query, batch_id))
        if quarantine_path:
            bad = bad_events(parsed).select("issue_id", CORRUPT, *keep, F.col("_value").alias("value"))
            if not bad.isEmpty():
                bad.write.mode("overwrite").parquet(_batch_folder(quarantine_path, query, batch_id))
        if metrics_path:
            batch_metrics(parsed).write.mode("overwrite").parquet(_batch_folder(metrics_path, query, batch_id))
    finally:
        parsed.unpersist()


def start_ingest(stream: DataFrame, table_path: str, checkpoint: str,
                 quarantine_path: str | None = None, available_now: bool = True,
                 processing_time: str | None = None, metrics_path: str | None = None) -> StreamingQuery:
    """Start the ingest query. ``available_now`` drains what is there in
    batches and stops (restartable from the checkpoint); otherwise a
    ``processing_time`` trigger runs continuously. ``metrics_path``: where
    to keep one row of counts and data checks per batch."""
    writer = (stream.writeStream
                    .foreachBatch(lambda df, bid: ingest_batch(df, bid, table_path, quarantine_path,
                                                               query_id(df.sparkSession, checkpoint), metrics_path))
                    .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now or not processing_time \
        else writer.trigger(processingTime=processing_time)
    return writer.start()


def replay_quarantine(spark: SparkSession, quarantine_path: str, table_path: str, mend: Callable[[Column], Column],
                      attempt: int = 1) -> dict:
    """Mend quarantined records and land those that decode then.

    ``mend`` turns the record's text into a repaired one. A batch's mended
    rows land in a folder of their own (``query=replay<attempt>-<query>``)
    with overwrite, so replaying again replaces them: a row lands once
    however often it is replayed. Rows that still do not decode stay in
    quarantine only; for those a later, better ``mend`` takes the next
    ``attempt`` (rows that an earlier attempt landed come again then, and
    the upsert by id merges them). Returns the number of quarantined and of
    landed rows."""
    bad = spark.read.parquet(quarantine_path)
    keep = ("ingested_at",) if "ingested_at" in bad.columns else ()
    records = bad.select(F.col("issue_id").alias("key"), mend(F.col("value")).alias("value"), *keep, "query", "batch_id")
    parsed = parse_issue_events(records, key_col="key", keep=(*keep, "query", "batch_id"))
    good = good_events(parsed, (*keep, "query", "batch_id"))
    named = good.withColumn("query", F.concat(F.lit(f"replay{attempt}-"), "query"))
    # Only the partitions with mended rows are replaced.
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query", "batch_id").parquet(table_path)
    landed = read_landed(spark, table_path).filter(F.col("query").startswith(f"replay{attempt}-"))
    return {"quarantined": bad.count(), "landed": landed.count()}


def dedupe_stream(events: DataFrame, key: str = "issue_id", delay: str = "1 hour",
                  time_col: str = "ingested_at") -> DataFrame:
    """In-stream duplicate drop within the watermark (bounded state). The
    watermark is on ingest time: replays carry old event times."""
    return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def read_landed(spark: SparkSession, table_path: str) -> DataFrame:
    """The landing table (all batches of all queries; ``query`` and
    ``batch_id`` as columns)."""
    return spark.read.parquet(table_path)


def pending_batches(landed: DataFrame, merged: DataFrame) -> list[tuple[str, int]]:
    """(query, batch_id) of the landed batches that are not in ``merged``, in
    order; only the landing table's partition columns are looked at."""
    pair = [F.col("query").cast("string").alias("query"), F.col("batch_id").cast("long").alias("batch_id")]
    left = landed.select(*pair).distinct().join(merged, ["query", "batch_id"], "left_anti")
    return sorted((r["query"], r["batch_id"]) for r in left.collect())


def of_batches(landed: DataFrame, batches: list[tuple[str, int]]) -> DataFrame:
    """The rows of the given batches; a filter on partition columns only, so
    no other folder is read."""
    wanted = F.lit(False)
    for query in sorted({q for q, _ in batches}):
        wanted = wanted | ((F.col("query") == query) & F.col("batch_id").isin([b for q, b in batches if q == query]))
    return landed.filter(wanted)
