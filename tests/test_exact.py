"""Writes that must not lose, duplicate or regress rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from slawatch.operators.incremental import latest_per_key, merge_stream, merge_stream_by_day, new_issues, new_issues_by_day
from slawatch.operators.risk_model import train_models
from slawatch.plans import daily
from slawatch.plans.daily import refresh_mart, run_daily
from slawatch.session import scratch_path
from slawatch.sinks.tables import OVERWRITE_MODE, append_scored, create_fact_table, upsert_by_day
from slawatch.sources import testdata as td
from slawatch.streaming import ingest as SI
from slawatch.streaming.codec import to_kafka_records

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static_mode(spark):
    """As in a session that the library did not build."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "static")
    yield
    spark.conf.set(OVERWRITE_MODE, before)


def totals(spark, fact, mart):
    return spark.table(fact).count(), spark.table(mart).agg(F.sum("total_issues")).first()[0]


def test_runs_keep_other_days_and_recover(spark, static_mode, monkeypatch):
    fact, mart = "exact_fact", "exact_mart"
    create_fact_table(spark, fact, scratch_path(spark, "fact"))
    en = td.enriched_issues(spark, SF).cache()
    model = train_models(td.scored_issues(spark, SF), names=["logistic_regression"]).models["logistic_regression"]
    day = lambda a, b: en.filter(F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    run_daily(spark, day("2024-01-01", "2024-01-02"), fact, model, mart, scratch_path(spark, "mart"))
    run_daily(spark, day("2024-01-03", "2024-01-03"), fact, model, mart)
    rows, told = totals(spark, fact, mart)
    assert rows == told == day("2024-01-01", "2024-01-03").count()
    assert spark.table(mart).select("issue_date").distinct().count() == 3
    # Lost between append and refresh: the next run has nothing new, and mends.
    with monkeypatch.context() as m:
        m.setattr(daily, "refresh_mart", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_daily(spark, day("2024-01-01", "2024-01-05"), fact, model, mart)
    assert totals(spark, fact, mart)[0] > told
    again = run_daily(spark, day("2024-01-01", "2024-01-05"), fact, model, mart)
    rows, told = totals(spark, fact, mart)
    assert again.new_rows == 0 and again.days == [dt.date(2024, 1, 4), dt.date(2024, 1, 5)] and rows == told
    # An absent mart is built though nothing is new.
    run_daily(spark, day("2024-01-01", "2024-01-05"), fact, model, "exact_mart_late", scratch_path(spark, "mart"))
    assert totals(spark, fact, "exact_mart_late") == (rows, rows)
    assert refresh_mart(spark, fact, mart) == []


def test_corrected_and_missing_days_are_not_appended_again(spark):
    name = "exact_append"
    create_fact_table(spark, name, scratch_path(spark, "fact"))
    scored = td.scored_issues(spark, SF).limit(20).cache()
    moved = scored.withColumns({"created_at": F.col("created_at") + F.expr("INTERVAL 3 DAYS"),
                                "issue_date": F.date_add("issue_date", 3)})
    undated = scored.withColumns({"issue_id": F.concat(F.lit("u"), "issue_id"), "created_at": F.lit(None).cast("timestamp"),
                                  "issue_date": F.lit(None).cast("date")})
    for df in (scored, moved, undated, undated, undated.unionByName(undated)):
        append_scored(df, name)
    assert spark.table(name).count() == 40
    assert new_issues(moved, spark.table(name)).count() == 0
    assert new_issues_by_day(undated, spark.table(name), day_col="issue_date").count() == 0


def table_of(spark, rows, name, path):
    df = spark.createDataFrame(rows, "issue_id string, status string, ingested_at timestamp, date date")
    df.write.partitionBy("date").option("path", path).saveAsTable(name)
    return df


def upserted(spark, name):
    return sorted((r.issue_id, r.status, str(r.date)) for r in spark.table(name).collect())


def test_upsert_keeps_undated_rows_and_order(spark, static_mode):
    d1, d2, t = dt.date(2024, 1, 1), dt.date(2024, 1, 2), lambda h: dt.datetime(2024, 3, 1, h)
    name = "exact_upsert"
    table_of(spark, [("a", "open", None, d1), ("b", "open", None, d2), ("x", "undated", None, None), ("y", "undated", None, None)],
             name, scratch_path(spark, "t"))
    stream = lambda *rows: spark.createDataFrame(rows, "issue_id string, status string, ingested_at timestamp, date date")
    # Only undated rows: the batch is not dropped.
    assert upsert_by_day(stream(("n", "new", t(1), None)), name) == 1
    # Dated and undated rows together: undated rows of the table stay.
    upsert_by_day(stream(("a", "closed", t(5), d1), ("x", "seen", t(5), None)), name)
    assert upserted(spark, name) == [("a", "closed", "2024-01-01"), ("b", "open", "2024-01-02"), ("n", "new", "None"),
                                     ("x", "seen", "None"), ("y", "undated", "None")]
    # A replayed older event loses; a row that moves leaves its old day empty.
    upsert_by_day(stream(("a", "older", t(2), d1), ("b", "moved", t(6), d1)), name)
    assert upserted(spark, name)[:2] == [("a", "closed", "2024-01-01"), ("b", "moved", "2024-01-01")]
    assert len(upserted(spark, name)) == 5
    # All undated rows leave.
    upsert_by_day(stream(*[(i, "dated", t(9), d2) for i in "nxy"]), name)
    assert [r[2] for r in upserted(spark, name)] == ["2024-01-01"] * 2 + ["2024-01-02"] * 3
    with pytest.raises(ValueError):
        table_of(spark, [("a", "open", None, d1)], "exact_no_time", scratch_path(spark, "t")).drop("ingested_at") \
            .write.mode("overwrite").saveAsTable("exact_no_time2")
        upsert_by_day(stream(("a", "x", t(1), d1)), "exact_no_time2")


def test_merge_by_day_equals_merge_when_days_change(spark):
    d1, d2, t = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.datetime(2024, 3, 1)
    schema = "issue_id string, status string, ingested_at timestamp, date date"
    table = spark.createDataFrame([("a", "1", None, d1), ("b", "1", None, d2), ("c", "1", None, None), (None, "1", None, d1)], schema)
    stream = spark.createDataFrame([("a", "2", t, d2), ("c", "2", t, d1), ("d", "2", t, None)], schema)
    rows = lambda df: sorted(map(str, df.select("issue_id", "status", "date").collect()))
    assert rows(merge_stream_by_day(table, stream)) == rows(merge_stream(table, stream))
    assert rows(latest_per_key(spark.createDataFrame([(None, "1", None, d1)] * 2, schema))) == rows(table.limit(0).union(
        spark.createDataFrame([(None, "1", None, d1)] * 2, schema)))


def test_fresh_checkpoint_keeps_landed_rows(spark):
    en = td.enriched_issues(spark, SF)
    src, land = scratch_path(spark, "src"), scratch_path(spark, "land")
    SI.write_issue_records(to_kafka_records(en).repartition(1), src)
    for _ in range(2):
        q = SI.start_ingest(SI.read_issue_stream(spark, "text", path=src), land, scratch_path(spark, "ckpt"))
        q.awaitTermination()
    landed = SI.read_landed(spark, land)
    assert landed.count() == 2 * en.count() and landed.select("query").distinct().count() == 2


def test_inputs_are_planned_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "en")
    td.enriched_issues(spark, SF).write.parquet(path)
    en, fact = spark.read.parquet(path), td.scored_issues(spark, SF).select("issue_id")

    def scans(df):
        return df._jdf.queryExecution().sparkPlan().toString().count(path)

    assert scans(new_issues(en, fact)) == 1
    assert scans(latest_per_key(en, "issue_id", ("created_at",))) == 1
