"""Stream codec edge cases, file-source ingest, restart, batch == stream."""

import json
import os

from pyspark.sql import functions as F

from slawatch.session import scratch_path
from slawatch.sources import testdata as td
from slawatch.streaming import ingest as SI
from slawatch.streaming.codec import bad_events, good_events, parse_issue_events, to_kafka_records

SF = "/root/testdata/sf0.001"


def _lines(spark, lines):
    return spark.createDataFrame([(None, s) for s in lines], "key string, value string")


def test_nan_infinity_malformed_and_numeric_id(spark):
    lines = [
        '{"issue_id": 17, "created_at": "2024-01-01 00:00:00", "resolution_hours": NaN, '
        '"region": NaN, "topic_id": NaN, "topic_keywords": "x"}',
        '{"issue_id": "a", "created_at": "2024-01-01 00:00:00", "resolution_hours": Infinity, '
        '"region": "NaN", "hour": 3}',
        '{"issue_id": "b", "created_at": "2024-01-01 00:00:00"}',     # missing fields
        '{not json',
    ]
    parsed = parse_issue_events(_lines(spark, lines))
    good = {r.issue_id: r for r in good_events(parsed).collect()}
    assert set(good) == {"17", "a", "b"}
    assert good["17"].resolution_hours is None and good["17"].topic_id is None
    assert good["17"].region is None
    assert good["a"].resolution_hours is None and good["a"].region is None and good["a"].hour == 3
    assert good["b"].region is None
    assert bad_events(parsed).count() == 1


def test_key_fills_missing_id(spark):
    df = spark.createDataFrame([("k1", '{"created_at": "2024-01-01 00:00:00"}')], "key string, value string")
    assert good_events(parse_issue_events(df)).first().issue_id == "k1"


def test_roundtrip_equals_batch(spark):
    en = td.enriched_issues(spark, SF)
    back = good_events(parse_issue_events(to_kafka_records(en)))
    assert back.exceptAll(en).count() == 0 and en.exceptAll(back).count() == 0


def test_file_stream_ingest_restart_and_equality(spark):
    en = td.enriched_issues(spark, SF)
    src = scratch_path(spark, "t-src")
    os.makedirs(src.replace("file:", ""), exist_ok=True)
    recs = to_kafka_records(en).collect()
    half = len(recs) // 2
    for i, chunk in enumerate([recs[:half], recs[half:]]):
        with open(os.path.join(src.replace("file:", ""), f"part-{i}.json"), "w") as fh:
            fh.write("\n".join(r.value for r in chunk) + "\n")
    land, ck, bad = scratch_path(spark, "t-land"), scratch_path(spark, "t-ck"), scratch_path(spark, "t-bad")
    q = SI.start_ingest(SI.read_issue_stream(spark, "text", path=src, max_per_trigger=1), land, ck, bad)
    q.awaitTermination()
    first = SI.read_landed(spark, land).count()
    # new file + a malformed line; restart from the checkpoint picks up only the new file
    with open(os.path.join(src.replace("file:", ""), "part-2.json"), "w") as fh:
        fh.write(json.dumps({"issue_id": "extra", "created_at": "2024-02-01 00:00:00"}) + "\n{broken\n")
    q = SI.start_ingest(SI.read_issue_stream(spark, "text", path=src, max_per_trigger=1), land, ck, bad)
    q.awaitTermination()
    landed = SI.read_landed(spark, land)
    assert first == len(recs)
    assert landed.count() == len(recs) + 1
    assert spark.read.parquet(bad).count() == 1
    cols = [c for c in en.columns]
    assert landed.select(cols).filter(F.col("issue_id") != "extra").exceptAll(en).count() == 0


def test_kafka_source_options():
    o = SI.kafka_source_options({"kafka.bootstrap.servers": "b:9092"}, max_per_trigger=100, min_partitions=64)
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "issues_raw", "startingOffsets": "earliest",
                 "maxOffsetsPerTrigger": "100", "minPartitions": "64"}
    assert "subscribe" not in SI.kafka_source_options({"subscribePattern": "issues_.*"})
    assert SI.kafka_source_options({"startingOffsets": "latest"})["startingOffsets"] == "latest"


def test_nan_or_text_in_flag_keeps_the_record(spark):
    lines = ['{"issue_id": "x", "created_at": "2024-01-01 00:00:00", "sla_breached": NaN}',
             '{"issue_id": "y", "created_at": "2024-01-01 00:00:00", "sla_breached": "TRUE"}',
             '{"issue_id": "z", "created_at": "2024-01-01 00:00:00", "sla_breached": false}']
    got = {r.issue_id: r.sla_breached for r in good_events(parse_issue_events(_lines(spark, lines))).collect()}
    assert got == {"x": None, "y": True, "z": False}
