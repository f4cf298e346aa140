"""Service-request SLA risk on Spark: cleaning, enrichment, streaming
ingest, scoring, the region/day mart and the reports on top of it.

The main entry points, importable from the package root::

    from slawatch import unify_issues, enrich, stg_issues, mart_issues_by_region_day
"""

__version__ = "0.1.0"

from .operators.cleaning import cleaning_report, unify_issues
from .operators.enrich import attach_topics, enrich
from .operators.evaluate import classification_metrics
from .operators.incremental import (
    attach_predictions,
    merge_stream,
    merge_stream_by_day,
    new_issues,
    new_issues_by_day,
    union_issues,
)
from .operators.keywords import issue_keyword, text_features
from .operators.mart import create_views, mart_issues_by_region_day, stg_issues
from .operators.quality import check_not_null, check_unique
from .operators.reports import (
    compare_periods,
    daily_trend,
    describe_hours,
    overview_kpis,
    recent_high_risk,
    recent_issues,
    region_breach,
    region_risk_summary,
    risk_bucket_mix,
    risk_drivers,
    sample_rows,
    value_counts,
)
from .operators.risk_model import evaluate_models, score_issues, train_models
from .operators.topics import assign_topics, fit_topics, topic_terms
from .plans.daily import run_daily
from .plans.jobs import run_enrich, run_prep, topic_enrich
from .session import build_session
from .sinks.tables import append_scored, upsert_by_day, write_issues
from .sources.files import load_mart, read_issues, read_raw_issues
from .streaming.codec import parse_issue_events, to_kafka_records
from .streaming.ingest import read_issue_stream, start_ingest

__all__ = [
    "append_scored", "assign_topics", "attach_predictions", "attach_topics", "build_session",
    "check_not_null", "check_unique", "classification_metrics", "cleaning_report", "compare_periods",
    "create_views", "daily_trend", "describe_hours", "enrich", "evaluate_models", "fit_topics",
    "issue_keyword", "load_mart", "mart_issues_by_region_day", "merge_stream", "merge_stream_by_day",
    "new_issues", "new_issues_by_day", "overview_kpis", "parse_issue_events", "read_issue_stream",
    "read_issues", "read_raw_issues", "recent_high_risk", "recent_issues", "region_breach",
    "region_risk_summary", "risk_bucket_mix", "risk_drivers", "run_daily", "run_enrich", "run_prep",
    "sample_rows", "score_issues", "start_ingest", "stg_issues", "text_features", "to_kafka_records",
    "topic_enrich", "topic_terms", "train_models", "union_issues", "upsert_by_day", "value_counts",
    "write_issues",
]
