"""Registered queries on stored state: journal, id index, mart state, live
mart, sketches, term store, weights, topic mixtures, stream metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import risk_model as RM
from ..operators import sketches, topics
from ..operators.incremental import merge_stream, on_days, touched_days
from ..operators.mart import stg_issues
from ..operators.mart_state import mart_from_state, partial_mart, rollup_from_state
from ..operators.scorecard import fit_scorecard, score_with_weights
from ..schemas import ENRICHED_COLUMNS
from ..session import scratch_path
from ..sinks import idindex
from ..sinks.journal import TableJournal
from ..sinks.tables import append_scored, create_fact_table
from ..sinks.termstore import TermStore
from ..sources import testdata as td
from ..streaming import ingest as SI
from ..streaming import live_mart as LM
from ..streaming.codec import good_events, parse_issue_events, to_kafka_records
from . import jobs
from . import oracle as O
from .catalog import ENRICHED_SQL, ORACLE, SCORED_THROUGH, STREAM_SQL, _fact_through, _land, d, register, round_doubles, stg


def _tag() -> str:
    return uuid.uuid4().hex[:10]


# ---------------------------------------------------------------- upsert
@register("upsert_twice", O.with_issues(f""", {STREAM_SQL}
SELECT {ENRICHED_SQL}, CAST(0 AS INTEGER) AS days_again FROM enriched WHERE issue_id NOT IN (SELECT issue_id FROM stream)
UNION ALL
SELECT {ENRICHED_SQL}, CAST(0 AS INTEGER) AS days_again FROM stream"""))
def q_upsert_twice(spark, sf_dir):
    """The landed stream merged into the enriched table, and a second run of
    the job, which finds all batches in the ledger and rewrites no day."""
    name = f"enriched_{_tag()}"
    en = td.enriched_issues(spark, sf_dir)
    land = _land(spark, en)
    jobs.create_enriched_table(en, name, scratch_path(spark, "enriched"))
    jobs.run_upsert(spark, land, name)
    again = jobs.run_upsert(spark, land, name)
    return spark.table(name).select(*ENRICHED_COLUMNS, F.lit(again).cast("int").alias("days_again"))


@register("upsert_snapshot", ORACLE["merge_stream"])
def q_upsert_snapshot(spark, sf_dir):
    """The enriched table as a reader sees it while an upsert is staged and
    none of its partitions has been replaced yet."""
    name = f"enriched_{_tag()}"
    en = td.enriched_issues(spark, sf_dir)
    jobs.create_enriched_table(en, name, scratch_path(spark, "enriched"))
    table, stream = spark.table(name), td.stream_updates(en)
    days = touched_days(table, stream, "issue_id", "date")
    journal = TableJournal(spark, name)
    journal.stage(merge_stream(table.filter(on_days("date", days)), stream).select(table.columns), days)
    return journal.snapshot().select(ENRICHED_COLUMNS)


@register("new_issues_indexed", ORACLE["new_issues"])
def q_new_issues_indexed(spark, sf_dir):
    """The anti-join against the fact's id index, which lies bucketed by id:
    only the batch is shuffled."""
    name = f"fact_{_tag()}"
    create_fact_table(spark, name, scratch_path(spark, "fact"))
    append_scored(_fact_through(spark, sf_dir), name)
    index = idindex.build_index(spark, name)
    return idindex.not_indexed(td.enriched_issues(spark, sf_dir), spark.table(index))


# ---------------------------------------------------------------- mart state
@register("mart_from_state", ORACLE["mart_region_day"])
def q_mart_from_state(spark, sf_dir):
    """The mart from partial rows of three batches that share days and
    regions."""
    rows = stg(spark, sf_dir).withColumn("_b", F.col("issue_id").cast("long") % 3)
    parts = [partial_mart(rows.filter(F.col("_b") == b), f"batch{b}") for b in range(3)]
    return round_doubles(mart_from_state(parts[0].unionByName(parts[1]).unionByName(parts[2])))


@register("region_rollup_from_state", O.with_issues("""
SELECT region, CAST(count(*) AS BIGINT) AS total_issues, round(avg(CASE WHEN sla_breached THEN 1 ELSE 0 END), 6) AS sla_breach_rate,
       round(avg(risk_score), 6) AS avg_risk_score,
       round(avg(CASE WHEN risk_bucket IN ('high', 'very_high') THEN 1 ELSE 0 END), 6) AS high_risk_share
FROM stg GROUP BY region"""))
def q_region_rollup_from_state(spark, sf_dir):
    """Rates per region over all days, weighted by issues, from the state."""
    return round_doubles(rollup_from_state(partial_mart(stg(spark, sf_dir)), "region"))


@register("live_mart", O.with_issues("""
SELECT date AS issue_date, region, CAST(count(*) AS BIGINT) AS total_issues,
       round(avg(CASE WHEN sla_breached THEN 1 ELSE 0 END), 6) AS sla_breach_rate FROM enriched GROUP BY date, region"""))
def q_live_mart(spark, sf_dir):
    """Every enriched issue as a JSON stream through the watermarked
    aggregation into the live mart state, in two runs of the query."""
    table, src, ckpt = f"live_{_tag()}", scratch_path(spark, "live-src"), scratch_path(spark, "live-ckpt")
    LM.create_live_state(spark, table, scratch_path(spark, "live"))
    recs = to_kafka_records(td.enriched_issues(spark, sf_dir))
    early = F.get_json_object("value", "$.date") < F.lit(SCORED_THROUGH)
    for mode, rows in (("overwrite", recs.filter(early)), ("append", recs.filter(~early))):
        rows.select("value").write.mode(mode).text(src)
        raw = SI.read_issue_stream(spark, source="text", path=src)
        events = good_events(parse_issue_events(raw))
        LM.start_live_mart(events, table, ckpt, delay="60 days").awaitTermination()
    return round_doubles(LM.live_mart(spark, table).select("issue_date", "region", "total_issues", "sla_breach_rate"))


# ---------------------------------------------------------------- sketches
PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
WINDOWS = [("first_half", "2024-01-01", "2024-01-15"), ("second_half", "2024-01-16", "2024-01-31"), ("month", "2024-01-01", "2024-01-31")]


@register("hours_quantile_sketch", O.with_issues(f"""
, w AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {d(a)}, {d(b)})" for n, a, b in WINDOWS)}) AS t(win, a, b))
SELECT win, p, CAST(count(*) AS BIGINT) AS n, true AS within
FROM enriched JOIN w ON date BETWEEN a AND b, (SELECT unnest([{', '.join(f'{p}::DOUBLE' for p in PROBS)}]) AS p)
WHERE resolution_hours IS NOT NULL GROUP BY win, p"""))
def q_hours_quantile_sketch(spark, sf_dir):
    """Quantiles of resolution hours over windows from merged per-day
    sketches, and whether their true ranks are within the stated bound."""
    en = td.enriched_issues(spark, sf_dir).select("date", "resolution_hours")
    win = F.explode(F.array(*[F.struct(F.lit(n).alias("win"), F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b")) for n, a, b in WINDOWS]))

    def windowed(df):
        return df.withColumn("_w", win).filter(F.col("date").between(F.col("_w.a"), F.col("_w.b"))).withColumn("win", F.col("_w.win"))

    merged = sketches.merge_sketches(windowed(sketches.sketch_days(en)), ("win",))
    told = sketches.quantiles(merged, PROBS, ("win",))
    errors = sketches.rank_errors(windowed(en), "resolution_hours", told, ("win",))
    return errors.select("win", "p", F.col("rows").alias("n"), (F.col("error") <= sketches.rank_error()).alias("within"))


# ---------------------------------------------------------------- keywords
@register("keyword_from_store", ORACLE["issue_keyword"])
def q_keyword_from_store(spark, sf_dir):
    """Keywords of all documents from stored term statistics that were added
    to in two batches."""
    docs = td.read(spark, sf_dir, "documents").select("doc_id", "text")
    store = TermStore(spark, scratch_path(spark, "terms"))
    for b in (0, 1):
        store.add_batch(docs.filter(F.col("doc_id") % 2 == b), f"b{b}", "doc_id", "text")
    return store.keywords().withColumnRenamed("id", "doc_id")


# ---------------------------------------------------------------- weights
_VALUES = {"region": "region", "channel": "channel", "raw_category": "raw_category", "topic_id": "CAST(topic_id AS VARCHAR)",
           "hour": "CAST(hour AS VARCHAR)", "dow": "CAST(dayofweek(created_at) + 1 AS VARCHAR)"}


def _value_sql(feature: str) -> str:
    return f"coalesce(nullif({_VALUES[feature]}, ''), '(other)')"


WEIGHTS_SQL = f"""
, train AS (SELECT * FROM enriched WHERE date < {d(SCORED_THROUGH)} AND sla_breached IS NOT NULL),
long AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, {_value_sql(f)} AS value, sla_breached AS y FROM train" for f in RM.CATEGORICAL)}),
total AS (SELECT count_if(y) + 0.5 AS p, count_if(NOT y) + 0.5 AS n FROM (SELECT sla_breached AS y FROM train)),
card AS (
  SELECT feature, value, ln((count_if(y) + any_value(p / (p + n))) / (count_if(NOT y) + any_value(1.0 - p / (p + n)))) - ln(any_value(p / n)) AS weight
  FROM long, total GROUP BY feature, value)"""


@register("scorecard_weights", O.with_issues(f"""{WEIGHTS_SQL}
SELECT feature, value, round(weight, 6) AS weight FROM card
UNION ALL SELECT '(intercept)', '', round(ln(p / n), 6) FROM total"""))
def q_scorecard_weights(spark, sf_dir):
    """Log-odds weights per feature value, fitted by aggregates on the fact."""
    return round_doubles(fit_scorecard(_fact_through(spark, sf_dir)))


@register("score_new_issues_card", O.with_issues(f"""{WEIGHTS_SQL},
fresh AS (SELECT * FROM enriched WHERE date >= {d(SCORED_THROUGH)}),
s AS (
  SELECT issue_id, 1.0 / (1.0 + exp(-((SELECT ln(p / n) FROM total) + {' + '.join(f'coalesce(c_{f}.weight, 0.0)' for f in RM.CATEGORICAL)}))) AS prob
  FROM fresh {' '.join(f"LEFT JOIN card c_{f} ON c_{f}.feature = '{f}' AND c_{f}.value = {_value_sql(f).replace(_VALUES[f], _VALUES[f].replace('topic_id', 'fresh.topic_id'))}" for f in RM.CATEGORICAL)})
SELECT issue_id, prob >= 0.5 AS predicted_label, true AS risk_label, round(prob, 6) AS risk_prob FROM s"""))
def q_score_new_issues_card(spark, sf_dir):
    """The new issues scored by the stored weights, compiled into one column
    expression."""
    fresh = td.enriched_issues(spark, sf_dir).filter(F.col("date") >= F.lit(SCORED_THROUGH).cast("date"))
    scored = score_with_weights(fresh, fit_scorecard(_fact_through(spark, sf_dir)))
    return round_doubles(scored.select("issue_id", "predicted_label", F.col("risk_score.label").alias("risk_label"),
                                       F.col("risk_score.prob").alias("risk_prob")))


# ---------------------------------------------------------------- topics
MIX_TOPICS = 7


@register("dominant_topics", f"""
SELECT doc_id, CAST(list_position(mix, list_max(mix)) - 1 AS INTEGER) AS topic_id
FROM (SELECT doc_id, list_transform(range({MIX_TOPICS}), lambda t: ((doc_id * 37 + n_chars * (t + 1)) % 17) / 16.0) AS mix FROM documents)""")
def q_dominant_topics(spark, sf_dir):
    """The dominant topic of each document over a given table of mixtures
    (a closed formula of stored columns; ties are frequent)."""
    docs = td.read(spark, sf_dir, "documents")
    mix = F.transform(F.sequence(F.lit(1), F.lit(MIX_TOPICS)), lambda t: ((F.col("doc_id") * 37 + F.col("n_chars") * t) % 17) / F.lit(16.0))
    return topics.dominant_topics(docs.select("doc_id", mix.alias("topic_mix")), "doc_id")


#: The topics of the coherence query: the most frequent long words of each source.
COHERENCE_WORDS, COHERENCE_LETTERS = 6, 5


@register("topic_coherence", f"""
WITH w AS (SELECT doc_id, source, list_distinct(string_split(regexp_replace(lower(text), '[^\\p{{L}}]+', ' ', 'g'), ' ')) AS ws FROM documents),
each AS (SELECT doc_id, source, unnest(ws) AS token FROM w),
ranked AS (
  SELECT CAST(replace(source, 'src', '') AS INTEGER) AS topic_id, token,
         row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, token) AS r
  FROM each WHERE length(token) >= {COHERENCE_LETTERS} GROUP BY source, token),
t AS (SELECT topic_id, token FROM ranked WHERE r <= {COHERENCE_WORDS}),
p AS (SELECT x.topic_id, x.token AS a, y.token AS b FROM t x JOIN t y ON x.topic_id = y.topic_id AND x.token < y.token),
f AS (SELECT token, count(*) AS n FROM each WHERE token IN (SELECT token FROM t) GROUP BY token),
pd AS (SELECT DISTINCT a, b FROM p),
g AS (SELECT pd.a, pd.b, count(*) AS n FROM pd JOIN w ON list_contains(ws, pd.a) AND list_contains(ws, pd.b) GROUP BY pd.a, pd.b),
v AS (
  SELECT p.topic_id, coalesce(g.n, 0) AS nb, fa.n AS na, fb.n AS nc, (SELECT count(*) FROM documents) AS n
  FROM p LEFT JOIN g ON p.a = g.a AND p.b = g.b JOIN f fa ON fa.token = p.a JOIN f fb ON fb.token = p.b)
SELECT topic_id, count(*) AS pairs,
       round(avg(CASE WHEN nb = 0 THEN -1.0 WHEN nb = n THEN 1.0 ELSE ln((nb / n) / ((na / n) * (nc / n))) / -ln(nb / n) END), 6) AS coherence
FROM v GROUP BY topic_id""")
def q_topic_coherence(spark, sf_dir):
    """Coherence of topics given by the most frequent longer words of each
    source, over all documents."""
    from pyspark.sql import Window

    from ..functions.text import NON_LETTERS

    docs = td.read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    words = docs.select("source", F.explode(F.array_distinct(F.split(F.lower("text"), NON_LETTERS))).alias("token"))
    counted = words.filter(F.length("token") >= COHERENCE_LETTERS).groupBy("source", "token").count()
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("count"), "token"))
    terms = counted.withColumn("r", rank).filter(F.col("r") <= COHERENCE_WORDS).select(
        F.regexp_replace("source", "src", "").cast("int").alias("topic_id"), "token")
    return round_doubles(topics.topic_coherence(docs, terms))


# ---------------------------------------------------------------- stream checks
def _dirty_records(spark, sf_dir):
    """Enriched issues as records: every tenth is cut short of its closing
    brace (a writer that was stopped), every 50th comes twice, every 70th
    lacks its id."""
    recs = to_kafka_records(td.enriched_issues(spark, sf_dir))
    n = F.col("key").cast("long")
    cut = F.when(n % 10 == 3, F.regexp_replace("value", r"\}$", "")).otherwise(F.col("value"))
    cut = F.when(n % 70 == 5, F.regexp_replace(cut, r'"issue_id":"[0-9]+",', "")).otherwise(cut)
    rows = recs.withColumn("value", cut)
    return rows.unionByName(rows.filter(n % 50 == 0))


def _land_dirty(spark, sf_dir):
    src, land, bad, told = (scratch_path(spark, f"dirty-{k}") for k in ("src", "land", "bad", "metrics"))
    _dirty_records(spark, sf_dir).select("value").write.text(src)
    stream = SI.read_issue_stream(spark, source="text", path=src)
    SI.start_ingest(stream, land, scratch_path(spark, "dirty-ckpt"), bad, metrics_path=told).awaitTermination()
    return land, bad, told


DIRTY_SQL = """
, sent AS (SELECT *, event_id % 10 = 3 AS cut, event_id % 70 = 5 AS no_id FROM enriched
           UNION ALL SELECT *, event_id % 10 = 3 AS cut, event_id % 70 = 5 AS no_id FROM enriched WHERE event_id % 50 = 0)"""


@register("stream_metrics", O.with_issues(f"""{DIRTY_SQL}
SELECT CAST(count(*) AS BIGINT) AS rows_in, CAST(count_if(NOT cut AND NOT no_id) AS BIGINT) AS rows_landed,
       CAST(count_if(cut OR no_id) AS BIGINT) AS rows_quarantined, CAST(count_if(cut) AS BIGINT) AS undecodable,
       CAST(count_if(no_id AND NOT cut) AS BIGINT) AS without_id, CAST(0 AS BIGINT) AS undated,
       CAST(count_if(NOT cut AND NOT no_id) - count(DISTINCT CASE WHEN NOT cut AND NOT no_id THEN issue_id END) AS BIGINT) AS repeated_ids
FROM sent"""))
def q_stream_metrics(spark, sf_dir):
    """What the ingest notes about its batch: rows read, landed and
    quarantined, and the data checks on the landed rows."""
    _, _, told = _land_dirty(spark, sf_dir)
    return spark.read.parquet(told).select("rows_in", "rows_landed", "rows_quarantined", "undecodable", "without_id", "undated", "repeated_ids")


@register("quarantine_replay", O.with_issues(f"""{DIRTY_SQL}
SELECT issue_id, status, region, CAST(count(*) AS BIGINT) AS n_rows FROM sent WHERE NOT no_id GROUP BY issue_id, status, region"""))
def q_quarantine_replay(spark, sf_dir):
    """Quarantined records mended (the missing brace put back) and replayed,
    twice: each lands once. Records without an id stay in quarantine."""
    land, bad, _ = _land_dirty(spark, sf_dir)
    for _ in range(2):
        SI.replay_quarantine(spark, bad, land, lambda v: F.when(v.endswith("}"), v).otherwise(F.concat(v, F.lit("}"))))
    return SI.read_landed(spark, land).groupBy("issue_id", "status", "region").agg(F.count(F.lit(1)).alias("n_rows"))
