"""Calendar fields, text features and topic attachment (unified -> enriched issues)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import dow_monday0
from ..functions.text import text_len, word_count
from ..schemas import ENRICHED_COLUMNS, UNKNOWN_TOPIC_ID, UNKNOWN_TOPIC_KEYWORDS
from .incremental import keyed, spread_null_key

# A lookup with a proven bound of at most this many rows is broadcast.
MAX_BROADCAST_ROWS = 100_000


def add_calendar(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """``date``, ``hour`` and ``dow`` (Monday = 0) of the creation time."""
    return df.withColumns({
        "date": F.to_date(F.col(ts)),
        "hour": F.hour(F.col(ts)).cast("int"),
        "dow": dow_monday0(F.col(ts)),
    })


def attach_topics(issues: DataFrame, assignments: DataFrame, terms: DataFrame,
                  terms_bound: int | None = None) -> DataFrame:
    """Left-join each issue's topic id, look up the topic keywords, default
    the missing to ``-1`` / ``UNKNOWN_TOPIC``.

    ``assignments`` (issue_id, topic_id) has at most one row per issue; it is
    as large as the issues, so the planner shuffles or broadcasts it by size.
    Issues without an id cannot match and are spread over many join keys (no
    single hot null-key task, no second pass). ``terms`` (topic_id,
    topic_keywords) has one row per topic: broadcast if the caller states a
    proven bound (``terms_bound``, e.g. k of a topic model), otherwise left
    to the planner.
    """
    base = spread_null_key(issues.drop("topic_id", "topic_keywords"), "issue_id")
    return _with_terms(_with_assigned(base, assignments).drop("_k", "_none"), terms, terms_bound)


def _with_assigned(spread: DataFrame, assignments: DataFrame) -> DataFrame:
    """Rows with the spread key and the topic id that is assigned to them."""
    a = keyed(assignments, "issue_id", F.col("topic_id").cast("int").alias("topic_id"))
    return spread.join(a, ["_k", "_none"], "left")


def _with_terms(rows: DataFrame, terms: DataFrame, terms_bound: int | None = None) -> DataFrame:
    t = terms.select(F.col("topic_id").cast("int").alias("topic_id"), "topic_keywords")
    out = rows.join(F.broadcast(t) if terms_bound is not None and terms_bound <= MAX_BROADCAST_ROWS else t, "topic_id", "left")
    return out.withColumns({
        "topic_id": F.coalesce(F.col("topic_id"), F.lit(UNKNOWN_TOPIC_ID)).cast("int"),
        "topic_keywords": F.coalesce(F.col("topic_keywords"), F.lit(UNKNOWN_TOPIC_KEYWORDS)),
    })


def add_text_features(issues: DataFrame, keywords: DataFrame | None = None, text_col: str = "issue_text") -> DataFrame:
    """``text_len`` and ``word_count`` of the text, and ``issue_keyword``
    from ``keywords`` (issue_id, issue_keyword; one row per issue at most);
    null where it has none, or if none are given."""
    rows = issues.drop("text_len", "word_count", "issue_keyword").withColumns(
        {"text_len": text_len(text_col), "word_count": word_count(text_col)})
    if keywords is None:
        return rows.withColumn("issue_keyword", F.lit(None).cast("string"))
    words = keyed(keywords, "issue_id", "issue_keyword")
    return spread_null_key(rows, "issue_id").join(words, ["_k", "_none"], "left").drop("_k", "_none")


def enrich(unified: DataFrame, assignments: DataFrame | None = None,
           terms: DataFrame | None = None, terms_bound: int | None = None,
           keywords: DataFrame | None = None) -> DataFrame:
    """``issues_unified`` -> ``issues_enriched`` (calendar + topic + text
    features)."""
    topics = assignments is not None and terms is not None
    # Both lookups go by the spread key, so the issues are shuffled once; the
    # columns that follow from a row alone are added after that.
    df = unified.drop("topic_id", "topic_keywords", "issue_keyword")
    if topics or keywords is not None:
        df = spread_null_key(df, "issue_id")
        if keywords is not None:
            df = df.join(keyed(keywords, "issue_id", "issue_keyword"), ["_k", "_none"], "left")
        if topics:
            df = _with_assigned(df, assignments)
        df = df.drop("_k", "_none")
    if keywords is None:
        df = df.withColumn("issue_keyword", F.lit(None).cast("string"))
    if topics:
        df = _with_terms(df, terms, terms_bound)
    else:
        df = df.withColumns({"topic_id": F.lit(UNKNOWN_TOPIC_ID).cast("int"),
                             "topic_keywords": F.lit(UNKNOWN_TOPIC_KEYWORDS)})
    df = add_calendar(df).withColumns({"text_len": text_len("issue_text"), "word_count": word_count("issue_text")})
    return df.select(ENRICHED_COLUMNS)
