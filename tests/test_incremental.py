"""Anti-join, merge, idempotent append and the daily run."""

import datetime as dt

from pyspark.sql import functions as F

from slawatch.operators.incremental import latest_per_key, merge_stream, new_issues
from slawatch.operators.quality import check_not_null, check_unique
from slawatch.plans.daily import run_daily
from slawatch.operators.risk_model import train_models
from slawatch.session import scratch_path
from slawatch.sinks.tables import append_scored, create_fact_table
from slawatch.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_new_issues_keeps_null_ids_and_skips_scored(spark):
    en = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c"), ("3", "d")], ["issue_id", "x"])
    sc = spark.createDataFrame([("2",), ("3",), (None,)], ["issue_id"])
    got = sorted((r.issue_id or "-", r.x) for r in new_issues(en, sc).collect())
    assert got == [("-", "c"), ("1", "a")]


def test_latest_per_key_and_merge(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    batch = spark.createDataFrame([("1", "open"), ("2", "open"), (None, "x")], ["issue_id", "status"])
    stream = spark.createDataFrame([("1", "closed", t(2)), ("1", "reopened", t(1)), ("3", "new", t(1))],
                                   ["issue_id", "status", "ingested_at"])
    got = sorted((r.issue_id or "-", r.status) for r in merge_stream(batch, stream).collect())
    assert got == [("-", "x"), ("1", "closed"), ("2", "open"), ("3", "new")]
    # ties on the order column resolve the same way whatever the row order
    dup = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a")], ["issue_id", "ingested_at", "v"])
    assert latest_per_key(dup).first().v == latest_per_key(dup.orderBy("v")).first().v


def test_checks(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,), (None,), ("2",)], ["id"])
    assert [(r.id, r.n_rows) for r in check_unique(df, "id").collect()] == [("1", 2)]
    assert check_not_null(df, "id").count() == 2


def test_append_is_idempotent(spark):
    name = "fact_idem_test"
    create_fact_table(spark, name, scratch_path(spark, "fact-idem"))
    scored = td.scored_issues(spark, SF)
    n = scored.count()
    append_scored(scored, name)
    append_scored(scored, name)                  # rerun of the same batch
    append_scored(scored.unionByName(scored), name)  # duplicate ids in a batch
    fact = spark.table(name)
    assert fact.count() == n
    assert check_unique(fact, "issue_id").count() == 0


def test_daily_run_rerun_adds_nothing(spark):
    fact, mart = "fact_daily_test", "mart_daily_test"
    create_fact_table(spark, fact, scratch_path(spark, "fact-daily"))
    seedrows = td.scored_issues(spark, SF).filter(F.col("issue_date") < F.lit("2024-01-21").cast("date"))
    append_scored(seedrows, fact)
    model = train_models(seedrows, names=["logistic_regression"]).models["logistic_regression"]
    en = td.enriched_issues(spark, SF)
    r1 = run_daily(spark, en, fact, model, mart, scratch_path(spark, "mart-daily"))
    assert r1.new_rows == en.count() - seedrows.count()
    assert all(d >= dt.date(2024, 1, 21) for d in r1.days)
    total = spark.table(fact).count()
    r2 = run_daily(spark, en, fact, model, mart)
    assert r2.new_rows == 0 and spark.table(fact).count() == total
    m = spark.table(mart)
    assert m.agg(F.sum("total_issues")).first()[0] == total


def test_mart_null_breach_and_unknown_bucket(spark):
    from slawatch.operators.mart import mart_issues_by_region_day, stg_issues

    t = dt.datetime(2024, 1, 1, 10)
    rows = [("1", t, "A", True, 0.9), ("2", t, "A", None, None), ("3", t, "A", False, 0.1)]
    df = spark.createDataFrame(rows, "issue_id string, created_at timestamp, region string, "
                                     "sla_breached boolean, p double")
    scored = (df.withColumn("risk_score", F.struct(F.lit(True).alias("label"), F.col("p").alias("prob")))
                .withColumns({"resolved_at": F.lit(None).cast("timestamp"), "channel": F.lit("x"),
                              "raw_category": F.lit("c"), "topic_id": F.lit(-1), "topic_keywords": F.lit("k"),
                              "predicted_label": F.lit(None).cast("boolean"),
                              "resolution_hours": F.lit(None).cast("double")}))
    m = mart_issues_by_region_day(stg_issues(scored)).first()
    assert m.total_issues == 3
    assert abs(m.sla_breach_rate - 1 / 3) < 1e-12          # null breach counts as 0
    assert abs(m.avg_risk_score - 0.5) < 1e-12             # null score skipped by the mean
    assert abs(m.high_risk_share - 1 / 3) < 1e-12          # unknown is in the denominator
    assert m.cnt_very_high + m.cnt_very_low == 2           # unknown in no band


def test_daily_run_first_run_on_empty_fact(spark):
    fact, mart = "fact_empty_first", "mart_empty_first"
    create_fact_table(spark, fact, scratch_path(spark, "fact-empty"))
    en = td.enriched_issues(spark, SF)
    seedrows = td.scored_issues(spark, SF)
    model = train_models(seedrows, names=["logistic_regression"]).models["logistic_regression"]
    r = run_daily(spark, en, fact, model, mart, scratch_path(spark, "mart-empty"))
    assert r.new_rows == en.count() == spark.table(fact).count()
    assert spark.table(mart).agg(F.sum("total_issues")).first()[0] == en.count()
