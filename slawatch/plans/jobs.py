"""Batch jobs as callables: raw files -> unified issues -> enriched issues.

Each job is one lazy plan ending in a write; the only boundaries are the
topic fit (a distributed MLlib fit over the texts, optionally a seeded hash
sample) and the writes themselves.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import unify_issues
from ..operators.enrich import enrich
from ..operators.keywords import issue_keyword
from ..operators.risk_model import evaluate_models, train_models
from ..operators.topics import assign_topics, fit_topics, topic_terms
from ..schemas import SEED, SLA_HOURS_TARGET, SOURCE_SYSTEM, TOPIC_COUNT
from ..sinks.journal import TableJournal
from ..sinks.tables import upsert_by_day, write_issues
from ..sources.files import read_issues, read_raw_issues
from ..streaming.ingest import of_batches, pending_batches, read_landed
from .daily import DailyResult, run_daily


def run_prep(spark: SparkSession, raw_path: str, out_path: str, fmt: str = "parquet",
             limit: int | None = None, target: int = SLA_HOURS_TARGET,
             source: str = SOURCE_SYSTEM, strict: bool = False) -> dict:
    """Raw CSV -> unified issues, written to ``out_path``. Returns the row
    counts observed while writing (no extra pass)."""
    obs = Observation("prep")
    unified = unify_issues(read_raw_issues(spark, raw_path, limit=limit), target, source, strict, obs)
    write_issues(unified, out_path, fmt=fmt)
    return dict(obs.get)


def topic_enrich(unified: DataFrame, k: int = TOPIC_COUNT, seed: int = SEED,
                 sample_n: int | None = None, score: str = "all", max_iter: int = 10,
                 keywords: bool = True) -> DataFrame:
    """Fit topics (on a seeded sample of ``sample_n`` texts if given) and
    enrich, with the keyword of each text unless ``keywords=False``.
    ``score="all"`` assigns a topic to every row with text;
    ``score="sample"`` only to the fitted sample, the rest get -1 /
    UNKNOWN_TOPIC (as the source notebook did)."""
    model = fit_topics(unified, k=k, seed=seed, sample_n=sample_n, max_iter=max_iter)
    scored_rows = unified
    if score == "sample" and sample_n:
        from ..operators.reports import sample_rows
        scored_rows = sample_rows(unified.filter(unified.issue_text.isNotNull()), sample_n, seed)
    words = None
    if keywords:
        known = unified.filter(unified.issue_id.isNotNull())
        words = issue_keyword(known, "issue_id", "issue_text").withColumnRenamed("keyword", "issue_keyword")
    return enrich(unified, assign_topics(model, scored_rows), topic_terms(model), terms_bound=k, keywords=words)


def run_enrich(spark: SparkSession, unified_path: str, out_path: str, fmt: str = "parquet",
               **topic_args) -> None:
    """Unified issues -> enriched issues, written partitioned by ``date``."""
    unified = read_issues(spark, unified_path, fmt=fmt, enriched=False)
    enriched = topic_enrich(unified, **topic_args)
    enriched.write.mode("overwrite").partitionBy("date").format("parquet").save(out_path)


def create_enriched_table(enriched: DataFrame, name: str, path: str | None = None) -> None:
    """The enriched issues as a table by day that streamed rows can be merged
    into: it keeps the ingest time of each row (null for batch rows)."""
    rows = enriched if "ingested_at" in enriched.columns else enriched.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    w = rows.select(*[c for c in rows.columns if c != "date"], "date").write.format("parquet").partitionBy("date")
    (w.option("path", path) if path else w).saveAsTable(name)


def run_upsert(spark: SparkSession, landed_path: str, table: str) -> int:
    """Merge the batches that the stream has landed since the last run into
    the enriched table (newest ingest wins); days rewritten.

    The table's journal holds the batches merged so far: folders in it are
    not read again, and a run without new ones rewrites nothing. What a lost
    run left half done is finished first."""
    journal = TableJournal(spark, table)
    journal.recover()
    landed = read_landed(spark, landed_path)
    batches = pending_batches(landed, journal.merged_batches())
    if not batches:
        return 0
    rows = of_batches(landed, batches).select(spark.table(table).columns)
    return upsert_by_day(rows, table, batches=batches)


BEST = "best"


def train_and_save(enriched: DataFrame, path: str, by: str = "auc", **options) -> str:
    """Train the classifiers, compare them on the holdout, and save the best
    under ``path`` for the daily runs; its name."""
    trained = evaluate_models(train_models(enriched, **options), by)
    trained.models[trained.best].write().overwrite().save(f"{path}/{BEST}")
    trained.metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    return trained.best


def load_best(path: str) -> PipelineModel:
    """The model that ``train_and_save`` chose."""
    return PipelineModel.load(f"{path}/{BEST}")


def run_stream_to_mart(spark: SparkSession, landed_path: str, enriched_table: str, fact_table: str,
                       mart_table: str, model_path: str, mart_path: str | None = None) -> DailyResult:
    """Landed rows -> enriched table -> scored fact -> mart."""
    run_upsert(spark, landed_path, enriched_table)
    return run_daily(spark, spark.table(enriched_table), fact_table, load_best(model_path), mart_table, mart_path)
