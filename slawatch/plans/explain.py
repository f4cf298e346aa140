"""Write the executed (AQE final) physical plans of the headline operators,
run over materialised tables as the pipeline leaves them.

    python -m slawatch.plans.explain /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import datetime as dt
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reports
from ..operators.incremental import merge_stream_by_day, new_issues
from ..operators.keywords import issue_keyword
from ..operators.mart import mart_issues_by_region_day, stg_issues
from ..operators.quality import check_unique
from ..session import build_session, scratch_path
from ..sinks import idindex, martstate
from ..sinks.tables import append_scored, create_fact_table
from ..sources import testdata as td
from ..sources.files import load_mart


def final_plan(df: DataFrame) -> str:
    """Run the query, then return the final (post-AQE) part of its physical
    plan, whole."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    if "+- == Initial Plan ==" in lines:       # top level only, not a subquery's
        lines = lines[:lines.index("+- == Initial Plan ==")]
    return "\n".join(lines) + "\n"


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    scratch = scratch_path(spark, "plans")
    td.enriched_issues(spark, sf_dir).write.partitionBy("date").parquet(f"{scratch}/enriched")
    enriched = spark.read.parquet(f"{scratch}/enriched")
    create_fact_table(spark, "issues_scored", f"{scratch}/fact")
    append_scored(td.scored_issues(spark, sf_dir)
                  .filter(F.col("issue_date") < F.lit("2024-01-21").cast("date")), "issues_scored")
    fact = spark.table("issues_scored")
    mart = mart_issues_by_region_day(stg_issues(fact))
    mart.write.partitionBy("issue_date").parquet(f"{scratch}/mart")
    mart_t = spark.read.parquet(f"{scratch}/mart")
    batch = enriched.filter(F.col("date") >= F.lit("2024-01-21").cast("date"))
    stream = td.stream_updates(enriched).filter(F.col("date") >= F.lit("2024-01-25").cast("date"))
    martstate.build_state(spark, "issues_scored")
    index = spark.table(idindex.build_index(spark, "issues_scored"))
    # As at scale: the ids of all history are no broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    indexed = idindex.not_indexed(batch, index)
    final_plan(indexed)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    cases = {
        "mart_issues_by_region_day (fact -> mart)": mart,
        "new_issues (batch vs fact)": new_issues(batch, fact),
        "not_indexed (batch vs ids bucketed by id, no broadcast)": indexed,
        "mart rows of three days from the mart state": martstate.mart_rows(
            spark, "issues_scored", [dt.date(2024, 1, d) for d in (3, 4, 5)]),
        "merge_stream_by_day (enriched + stream)": merge_stream_by_day(enriched, stream),
        "load_mart (date range on the partitioned mart)": load_mart(spark, mart_t, "2024-01-08", "2024-01-14"),
        "recent_issues (top 500 of a range of the fact)": reports.recent_issues(fact, "2024-01-08", "2024-01-14"),
        "check_unique (fact ids)": check_unique(fact, "issue_id"),
        "issue_keyword (documents, whole texts)": issue_keyword(td.read(spark, sf_dir, "documents")),
        "describe_hours (exact quartiles)": reports.describe_hours(enriched),
    }
    print("# Executed physical plans\n")
    print(f"Generated by `python -m slawatch.plans.explain {sf_dir}` on local[8];"
          " tables materialised as the pipeline leaves them (fact and mart partitioned by issue_date).\n")
    for title, df in cases.items():
        print(f"## {title}\n\n```\n{final_plan(df)}```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
