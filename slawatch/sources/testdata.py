"""Adapter from the provided parquet tables to the issue data model.

``events`` plays the raw service requests: each event is a ticket opened at
``ts`` and (unless it is a signup) closed ``value`` hours later. The location
comes from the customer's nation and region. The rows are rendered in the
raw CSV shape (text columns under the raw header names) and then go through
the same cleaning job as real raw files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import MICROS_PER_HOUR
from ..operators.cleaning import unify_issues
from ..operators.enrich import enrich
from ..operators.incremental import attach_predictions, to_fact

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SOURCE_NAME = "events"
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Fixed values of the mapping: which events never close, which views lose
# their borough, and the closed-form stand-in for a model score.
OPEN_EVENT_TYPE = "signup"
NO_BOROUGH_EVENT_TYPE = "view"
NO_BOROUGH_USER_MOD = 10
TOPIC_MOD = 15
KEYWORD_MOD = 5
# Dirt that real files have, by (event_id modulus, remainder): unreadable
# creation dates, dates in the other layout (whole seconds), unreadable
# closing dates, missing-value spellings in the text parts and the location.
BAD_DATE, OTHER_LAYOUT, BAD_CLOSE = (97, 1), (7, 3), (89, 5)
NA_DESCRIPTOR, NA_BOTH, NA_PLACE = (13, 4), (101, 7), (17, 5)
OTHER_TEXT = "MM/dd/yyyy hh:mm:ss a"
SCORE_NULL_MOD = 11
# Scores are multiples of 1/1024: exact in binary, so sums and means are
# exact in any summation order and equal across engines.
SCORE_STEPS = 1024


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (c_custkey, c_mktsegment, n_name, r_name).

    All joins are left to the planner, which broadcasts the small dimensions
    by their measured size.
    """
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
                .select("c_custkey", "c_mktsegment", "n_name", "r_name"))


def _hit(case: tuple[int, int]) -> F.Column:
    return F.col("event_id") % case[0] == case[1]


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw service-request rows (all text, raw header names)."""
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    rows = ev.join(customer_geo(spark, sf_dir), ev.user_id == F.col("c_custkey"), "left")
    created = F.col("ts").cast("timestamp")
    closed = F.when(F.col("event_type") == OPEN_EVENT_TYPE, F.lit(None)).otherwise(
        F.timestamp_micros(F.unix_micros(created)
                           + F.round(F.col("value") * F.lit(MICROS_PER_HOUR)).cast("bigint")))
    borough = F.when((F.col("event_type") == NO_BOROUGH_EVENT_TYPE)
                     & (F.col("user_id") % NO_BOROUGH_USER_MOD == 0), F.lit(None)).otherwise(F.col("r_name"))
    created_text = (F.when(_hit(BAD_DATE), F.lit("not a date"))
                     .when(_hit(OTHER_LAYOUT), F.date_format(created, OTHER_TEXT))
                     .otherwise(F.date_format(created, TS_TEXT)))
    closed_text = F.when(_hit(BAD_CLOSE) & closed.isNotNull(), F.lit("n/a")).otherwise(F.date_format(closed, TS_TEXT))
    return rows.select(
        F.col("event_id").cast("string").alias("Unique Key"),
        created_text.alias("Created Date"),
        closed_text.alias("Closed Date"),
        F.when(_hit(NA_BOTH), F.lit("null")).otherwise(F.col("event_type")).alias("Complaint Type"),
        F.when(_hit(NA_DESCRIPTOR) | _hit(NA_BOTH), F.lit("N/A")).otherwise(F.get_json_object("props", "$.k")).alias("Descriptor"),
        F.when(_hit(NA_PLACE), F.lit("NA")).otherwise(borough).alias("Borough"),
        F.when(closed.isNull(), F.lit("Open")).otherwise(F.lit("Closed")).alias("Status"),
        F.when(_hit(NA_PLACE), F.lit("NaN")).otherwise(F.col("n_name")).alias("City"),
        F.col("c_mktsegment").alias("Open Data Channel Type"),
    )


def unified_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify_issues(raw_issues(spark, sf_dir), source=SOURCE_NAME)


def topic_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given topic table (issue_id, topic_id), as an upstream topic job
    would deliver it: closed tickets only, topic from the descriptor; open
    tickets stay without a topic. Read straight from ``events``."""
    ev = read(spark, sf_dir, "events").select("event_id", "event_type", "props")
    topic = (F.get_json_object("props", "$.k").try_cast("int") % TOPIC_MOD).cast("int")
    return (ev.filter(F.col("event_type") != OPEN_EVENT_TYPE)
              .select(F.col("event_id").cast("string").alias("issue_id"), topic.alias("topic_id"))
              .filter(F.col("topic_id").isNotNull()))


def keyword_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given keyword table (issue_id, issue_keyword), as an upstream
    keyword job would deliver it (``operators.keywords``, ``TermStore``):
    the event type, none for every fifth ticket."""
    ev = read(spark, sf_dir, "events").select("event_id", "event_type").filter(F.col("event_id") % KEYWORD_MOD != 0)
    return ev.select(F.col("event_id").cast("string").alias("issue_id"), F.lower("event_type").alias("issue_keyword"))


def topic_terms(assignments: DataFrame) -> DataFrame:
    """(topic_id, topic_keywords) for the topics in use (at most TOPIC_MOD rows)."""
    return (assignments.select("topic_id").distinct()
                       .select("topic_id", F.concat(F.lit("topic "), F.col("topic_id").cast("string"))
                               .alias("topic_keywords")))


def enriched_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = topic_assignments(spark, sf_dir)
    # topic ids are taken modulo TOPIC_MOD, so the terms table has at most that many rows
    return enrich(unified_issues(spark, sf_dir), a, topic_terms(a), terms_bound=TOPIC_MOD,
                  keywords=keyword_assignments(spark, sf_dir))


def score_prob(event_id: F.Column, user_id: F.Column) -> F.Column:
    """Closed-form stand-in for a model probability (null for some rows)."""
    return F.when(event_id % SCORE_NULL_MOD == 0, F.lit(None).cast("double")).otherwise(
        ((user_id * 37 + event_id * 11) % SCORE_STEPS) / F.lit(float(SCORE_STEPS)))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(issue_id, predicted_label, probs) as a classifier would return them:
    one ``struct<label, prob>`` per class, negative class first."""
    ev = read(spark, sf_dir, "events").select("event_id", "user_id")
    p = score_prob(F.col("event_id"), F.col("user_id"))
    probs = F.array(
        F.struct(F.lit(False).alias("label"), (F.lit(1.0) - p).alias("prob")),
        F.struct(F.lit(True).alias("label"), p.alias("prob")),
    )
    return ev.select(F.col("event_id").cast("string").alias("issue_id"),
                     (p >= 0.5).alias("predicted_label"), probs.alias("probs"))


def scored_issues(spark: SparkSession, sf_dir: str, enriched: DataFrame | None = None) -> DataFrame:
    """The scored fact built from the tables (enriched + predictions), or
    from enriched issues that are at hand."""
    enriched = enriched_issues(spark, sf_dir) if enriched is None else enriched
    return to_fact(attach_predictions(enriched, predictions(spark, sf_dir)))


# Open tickets are closed later: the stream re-sends them this many hours
# after creation, with the new status and times.
STREAM_CLOSE_HOURS = 80


def stream_updates(enriched: DataFrame) -> DataFrame:
    """Stream rows derived from the tables: every open ticket re-sent as
    closed, ``ingested_at`` = its closing time."""
    from ..operators.cleaning import with_sla
    from ..schemas import ENRICHED_COLUMNS

    closed_at = F.timestamp_micros(F.unix_micros("created_at")
                                   + F.lit(STREAM_CLOSE_HOURS * 3_600_000_000))
    rows = (enriched.filter(F.col("resolved_at").isNull())
                    .withColumns({"resolved_at": closed_at, "status": F.lit("Closed")}))
    rows = with_sla(rows)
    return rows.select(*ENRICHED_COLUMNS, F.col("resolved_at").alias("ingested_at"))
