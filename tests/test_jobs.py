"""Batch jobs end to end and the in-place upsert."""

import os

from pyspark.sql import functions as F

from slawatch.plans.jobs import run_enrich, run_prep, topic_enrich
from slawatch.sinks.tables import upsert_by_day
from slawatch.sources import testdata as td
from slawatch.operators.incremental import merge_stream

SF = "/root/testdata/sf0.001"


def test_prep_and_enrich_jobs(spark, tmp_dir):
    raw = td.raw_issues(spark, SF)
    raw_path = os.path.join(tmp_dir, "raw")
    raw.write.option("header", True).csv(raw_path)
    counts = run_prep(spark, raw_path, os.path.join(tmp_dir, "unified"), source="events")
    undated = raw.filter("`Created Date` = 'not a date'").count()
    assert undated > 0 and counts["rows_in"] == raw.count() and counts["dropped_undated"] == undated
    run_enrich(spark, os.path.join(tmp_dir, "unified"), os.path.join(tmp_dir, "enriched"),
               k=3, max_iter=5)
    en = spark.read.parquet(os.path.join(tmp_dir, "enriched"))
    assert en.count() == raw.count() - undated
    assert en.filter((F.col("topic_id") < 0) | (F.col("topic_id") > 2)).count() == 0


def test_topic_score_sample_leaves_rest_unknown(spark):
    uni = td.unified_issues(spark, SF)
    en = topic_enrich(uni, k=3, sample_n=100, score="sample", max_iter=5)
    assert en.filter(F.col("topic_id") >= 0).count() == 100
    assert en.filter(F.col("topic_keywords") == "UNKNOWN_TOPIC").count() == uni.count() - 100


def test_upsert_by_day_replaces_touched_days_only(spark, tmp_dir):
    en = td.enriched_issues(spark, SF)
    path = os.path.join(tmp_dir, "enriched_tbl")
    en.withColumn("ingested_at", F.lit(None).cast("timestamp")).write.partitionBy("date").parquet(path)
    spark.sql(f"CREATE TABLE enriched_upsert USING parquet LOCATION '{path}'")
    spark.sql("MSCK REPAIR TABLE enriched_upsert")
    table_cols = spark.table("enriched_upsert").columns
    stream = td.stream_updates(en)
    days = upsert_by_day(stream, "enriched_upsert")
    assert days > 0
    got = spark.table("enriched_upsert").select(table_cols)
    want = merge_stream(en, stream).select(table_cols)
    assert got.count() == en.count()
    assert got.filter("ingested_at IS NOT NULL").count() == stream.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
