"""Benchmark of the headline jobs.

Setup (untimed): the enriched issues, a scored fact holding the days
before the cut, and a fitted model are written as the pipeline would leave
them. Timed, each to completion (Parquet write, or the ``noop`` sink for
reports):

  prep_unify        raw rows -> unified issues (cleaning job)       -> Parquet
  new_issues        anti-join enriched vs fact ids                  -> Parquet
  score             model transform of the new issues               -> Parquet
  append            idempotent append of the scored batch to the fact
  mart              staging + region/day mart from the whole fact   -> Parquet
  reports           KPIs, trend, region summary, top-500 recent     -> noop
  issue_keyword     tf-idf keyword of every document (whole texts)  -> noop
  flagship_e2e      raw tables -> mart in one plan                  -> noop
  daily_run         whole incremental run on a second fact copy: new (day-pruned
                    anti-join) -> score -> stage -> append -> refresh touched mart days
  stream_ingest     every enriched issue as a JSON line (8 files), ingested by the
                    Structured Streaming job (2 files per micro-batch, foreachBatch)

Each idempotent query runs twice and reports the faster run (steady
state, JIT warm); its first run is kept under ``cold``. ``append`` runs
once (a second append adds nothing, by design). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from slawatch.operators import reports  # noqa: E402
from slawatch.operators.incremental import new_issues, to_fact  # noqa: E402
from slawatch.operators.keywords import issue_keyword  # noqa: E402
from slawatch.operators.mart import mart_issues_by_region_day, stg_issues  # noqa: E402
from slawatch.operators.risk_model import score_issues, train_models  # noqa: E402
from slawatch.plans.daily import run_daily  # noqa: E402
from slawatch.plans.catalog import SCORED_THROUGH  # noqa: E402
from slawatch.session import build_session, checkpoint_dir  # noqa: E402
from slawatch.sinks.tables import append_scored, create_fact_table  # noqa: E402
from slawatch.sources import testdata as td  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="slawatch-bench-")
    spark = build_session(
        f"local[{cpus}]", app_name="slawatch-bench", shuffle_partitions=max(2 * cpus, 8),
        extra={"spark.ui.showConsoleProgress": "false",
               "spark.driver.memory": "16g",
               "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    checkpoint_dir(spark)   # the session's spark.checkpoint.dir; a scratch one only if unset
    p = lambda name: f"{scratch}/{name}"

    # ---------------- setup (untimed)
    enriched = td.enriched_issues(spark, sf_dir)
    enriched.write.mode("overwrite").partitionBy("date").parquet(p("enriched"))
    enriched = spark.read.parquet(p("enriched"))
    create_fact_table(spark, "issues_scored", p("fact"))
    seed = td.scored_issues(spark, sf_dir).filter(F.col("issue_date") < F.lit(SCORED_THROUGH).cast("date"))
    append_scored(seed, "issues_scored")
    model = train_models(spark.table("issues_scored"), names=["logistic_regression"]).models["logistic_regression"]
    create_fact_table(spark, "issues_scored_daily", p("fact_daily"))
    append_scored(seed, "issues_scored_daily")
    from slawatch.streaming import ingest as SI
    from slawatch.streaming.codec import to_kafka_records

    SI.write_issue_records(to_kafka_records(enriched).repartition(8), p("stream_src"))
    raw = td.raw_issues(spark, sf_dir)
    raw.write.mode("overwrite").parquet(p("raw"))
    docs = td.read(spark, sf_dir, "documents")

    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    def timed(name, fn, runs=2):
        best = None
        for i in range(runs):
            t0 = time.perf_counter()
            fn()
            dt = round(time.perf_counter() - t0, 3)
            if i == 0:
                cold[name] = dt
            best = dt if best is None else min(best, dt)
        times[name] = best

    from slawatch.operators.cleaning import unify_issues

    timed("prep_unify", lambda: unify_issues(spark.read.parquet(p("raw")), source="events")
          .write.mode("overwrite").parquet(p("unified")))
    timed("new_issues", lambda: new_issues(enriched, spark.table("issues_scored"))
          .write.mode("overwrite").parquet(p("new")))
    timed("score", lambda: to_fact(score_issues(model, spark.read.parquet(p("new"))))
          .write.mode("overwrite").parquet(p("new_scored")))
    timed("append", lambda: append_scored(spark.read.parquet(p("new_scored")), "issues_scored"), runs=1)
    timed("mart", lambda: mart_issues_by_region_day(stg_issues(spark.table("issues_scored")))
          .write.mode("overwrite").partitionBy("issue_date").parquet(p("mart")))

    def run_reports():
        mart = spark.read.parquet(p("mart"))
        for df in (reports.overview_kpis(mart), reports.daily_trend(mart),
                   reports.region_risk_summary(mart),
                   reports.recent_issues(spark.table("issues_scored"), "2024-01-01", "2024-01-31")):
            df.write.format("noop").mode("overwrite").save()

    timed("reports", run_reports)
    timed("issue_keyword", lambda: issue_keyword(docs).write.format("noop").mode("overwrite").save())
    timed("flagship_e2e", lambda: mart_issues_by_region_day(stg_issues(td.scored_issues(spark, sf_dir)))
          .write.format("noop").mode("overwrite").save())

    timed("daily_run", lambda: run_daily(spark, enriched, "issues_scored_daily", model,
                                         "mart_daily", p("mart_daily")), runs=1)

    def run_stream():
        q = SI.start_ingest(SI.read_issue_stream(spark, "text", path=p("stream_src"), max_per_trigger=2),
                            p("stream_land"), p("stream_ckpt"), p("stream_bad"))
        q.awaitTermination()

    timed("stream_ingest", run_stream, runs=1)

    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "cold": cold,
                      "cold_total": round(sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
