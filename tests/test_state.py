"""Mart state, live mart, sketches, term store, weights, coherence, stream checks."""

import datetime as dt
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from slawatch.operators import scorecard as SC
from slawatch.operators import sketches, topics
from slawatch.operators.keywords import issue_keyword
from slawatch.operators.mart import mart_issues_by_region_day, stg_issues
from slawatch.operators.mart_state import mart_from_state, partial_mart
from slawatch.operators.risk_model import score_issues, train_models
from slawatch.plans import daily
from slawatch.plans.daily import repair, run_daily
from slawatch.session import scratch_path
from slawatch.sinks import idindex, martstate
from slawatch.sinks.journal import TableJournal
from slawatch.sinks.tables import append_scored, create_fact_table
from slawatch.sinks.termstore import TermStore
from slawatch.sources import testdata as td
from slawatch.streaming import ingest as SI
from slawatch.streaming import live_mart as LM
from slawatch.streaming.codec import good_events, parse_issue_events, to_kafka_records

SF = "/root/testdata/sf0.001"


def rounded(df):
    cols = sorted(df.columns)
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)]) for r in df.collect())


# ---------------------------------------------------------------- mart state
def test_state_of_any_split_gives_the_mart(spark):
    stg = stg_issues(td.scored_issues(spark, SF))
    want = rounded(mart_issues_by_region_day(stg))
    for n in (1, 4):
        parts = [partial_mart(stg.filter(F.pmod(F.xxhash64("issue_id"), F.lit(n)) == b), str(b)) for b in range(n)]
        state = parts[0]
        for p in parts[1:]:
            state = state.unionByName(p)
        assert rounded(mart_from_state(state)) == want


def test_daily_run_reads_no_old_fact_rows(spark, monkeypatch):
    """Every read of the fact's rows, once there is state, fails the run."""
    fact, mart = "state_fact", "state_mart"
    create_fact_table(spark, fact, scratch_path(spark, "fact"))
    en = td.enriched_issues(spark, SF).cache()
    model = train_models(td.scored_issues(spark, SF), names=["logistic_regression"]).models["logistic_regression"]
    day = lambda a, b: en.filter(F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    run_daily(spark, day("2024-01-01", "2024-01-04"), fact, model, mart, scratch_path(spark, "mart"))
    real = spark.table

    def table(name):
        df = real(name)
        return df.filter(F.raise_error(F.lit("fact was read")).isNull()) if name == fact else df

    with monkeypatch.context() as m:
        m.setattr(type(spark), "table", lambda self, name: table(name))
        again = run_daily(spark, day("2024-01-03", "2024-01-06"), fact, model, mart)
    assert again.new_rows == day("2024-01-05", "2024-01-06").count() and again.days == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
    want = mart_issues_by_region_day(stg_issues(spark.table(fact)))
    assert rounded(spark.table(mart)) == rounded(want)
    # Compacted, the state has a row per day and region, and says the same.
    martstate.compact(spark, fact)
    state = spark.table(martstate.state_name(fact))
    assert state.count() == want.count() and rounded(mart_from_state(state)) == rounded(want)


@pytest.mark.parametrize("step", ["add_ids", "add_batch", "insert", "done"])
def test_a_daily_run_lost_at_any_step_is_finished(spark, monkeypatch, step):
    fact, mart = f"lost_fact_{step}", f"lost_mart_{step}"
    create_fact_table(spark, fact, scratch_path(spark, "fact"))
    en = td.enriched_issues(spark, SF).cache()
    model = train_models(td.scored_issues(spark, SF), names=["logistic_regression"]).models["logistic_regression"]
    early = en.filter("date <= DATE '2024-01-05'")
    run_daily(spark, early, fact, model, mart, scratch_path(spark, "mart"))

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "add_ids":
            m.setattr(idindex, "add_ids", lost)
        elif step == "add_batch":
            m.setattr(martstate, "add_batch", lost)
        elif step == "insert":
            m.setattr(TableJournal, "apply", lost)
        else:
            record = TableJournal._record
            m.setattr(TableJournal, "_record", lambda self, entry, state, *a: lost() if state == "done" else record(self, entry, state, *a))
        with pytest.raises(RuntimeError):
            run_daily(spark, en, fact, model, mart)
    again = run_daily(spark, en, fact, model, mart)
    assert again.new_rows == 0
    assert spark.table(fact).count() == en.count() == spark.table(fact).select("issue_id").distinct().count()
    assert spark.table(idindex.index_name(fact)).count() == en.count()
    assert rounded(spark.table(mart)) == rounded(mart_issues_by_region_day(stg_issues(spark.table(fact))))


def test_repair_counts_rows_appended_by_other_means(spark):
    fact, mart = "repair_fact", "repair_mart"
    create_fact_table(spark, fact, scratch_path(spark, "fact"))
    scored = td.scored_issues(spark, SF)
    append_scored(scored.filter("issue_date <= DATE '2024-01-05'"), fact)
    repair(spark, fact, mart, scratch_path(spark, "mart"))
    append_scored(scored, fact)
    days = repair(spark, fact, mart)
    assert min(days) == dt.date(2024, 1, 6) and repair(spark, fact, mart) == []
    assert rounded(spark.table(mart)) == rounded(mart_issues_by_region_day(stg_issues(spark.table(fact))))
    assert idindex.not_indexed(spark.table(fact), spark.table(idindex.index_name(fact))).count() == 0
    assert daily.stale_days(spark.table(fact), spark.table(mart)).count() == 0


# ---------------------------------------------------------------- live mart
def _write(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows) + "\n")


def _live(spark, src, table, ckpt, delay="10 days"):
    events = good_events(parse_issue_events(SI.read_issue_stream(spark, source="text", path=src, max_per_trigger=1)))
    LM.start_live_mart(events, table, ckpt, delay).awaitTermination()
    return {(str(r.issue_date), r.region): (r.total_issues, round(r.sla_breach_rate, 6)) for r in LM.live_mart(spark, table).collect()}


def event(i, day, region, breached):
    return {"issue_id": str(i), "created_at": f"2024-01-{day:02d} 10:00:00", "region": region, "sla_breached": breached}


def test_live_mart_goes_on_after_a_restart_and_drops_late_rows(spark, tmp_dir):
    src, table, ckpt = os.path.join(tmp_dir, "src"), "live_restart", scratch_path(spark, "live-ckpt")
    LM.create_live_state(spark, table, scratch_path(spark, "live"))
    _write(src, "a.json", [event(1, 1, "X", True), event(2, 1, "X", False), event(3, 2, None, True)])
    assert _live(spark, src, table, ckpt) == {("2024-01-01", "X"): (2, 0.5), ("2024-01-02", None): (1, 1.0)}
    # Restarted: totals go on from the checkpoint; another region of a day stays.
    _write(src, "b.json", [event(4, 1, "X", False), event(5, 1, "Y", True)])
    assert _live(spark, src, table, ckpt) == {
        ("2024-01-01", "X"): (3, round(1 / 3, 6)), ("2024-01-01", "Y"): (1, 1.0), ("2024-01-02", None): (1, 1.0)}
    # Nothing new changes nothing.
    before = TableJournal(spark, table, "issue_date").log().count()
    _live(spark, src, table, ckpt)
    assert TableJournal(spark, table, "issue_date").log().count() <= before + 1
    # Past the watermark: a row of a day that is over is not counted any more.
    _write(src, "c.json", [event(6, 25, "X", False)])
    _live(spark, src, table, ckpt)
    _write(src, "d.json", [event(7, 1, "X", True)])
    got = _live(spark, src, table, ckpt)
    assert got[("2024-01-01", "X")] == (3, round(1 / 3, 6)) and got[("2024-01-25", "X")] == (1, 0.0)


def test_a_replayed_batch_of_totals_is_merged_once(spark):
    table = "live_replay"
    LM.create_live_state(spark, table, scratch_path(spark, "live"))
    totals = partial_mart(stg_issues(td.scored_issues(spark, SF))).drop("entry")
    for _ in range(2):
        LM.merge_counts(totals, 0, table, "q")
    assert rounded(LM.live_mart(spark, table)) == rounded(mart_issues_by_region_day(stg_issues(td.scored_issues(spark, SF))))
    assert TableJournal(spark, table, "issue_date").merged_batches().count() == 1


# ---------------------------------------------------------------- sketches
@pytest.mark.parametrize("k", [200, 800])
def test_sketch_ranks_are_within_the_bound(spark, k):
    rows = spark.range(0, 60_000, 1, 6).select(
        (F.col("id") % 12).alias("day"), F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.xxhash64("id") % 100_000) / 10.0).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(1, None), (2, float("nan")), (99, None)], "day long, v double"))
    days = sketches.sketch_days(rows, "v", ("day",), k)
    assert days.count() == 12 and days.agg(F.sum("n")).first()[0] == 60_000
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    told = sketches.quantiles(sketches.merge_sketches(days, (), k), probs)
    errors = sketches.rank_errors(rows, "v", told).collect()
    assert len(errors) == len(probs) and max(r.error for r in errors) <= sketches.rank_error(k)
    ends = {r.p: r.value for r in told.collect()}
    exact = rows.filter(~F.isnan("v")).agg(F.min("v"), F.max("v")).first()
    assert ends[0.0] == exact[0] and ends[1.0] == exact[1]
    assert abs(sketches.rank_error(200) - 0.0133) < 1e-4


# ---------------------------------------------------------------- term store
def test_term_store_equals_one_pass(spark):
    docs = td.read(spark, SF, "documents").select("doc_id", "text")
    store = TermStore(spark, scratch_path(spark, "terms"))
    halves = [docs.filter(F.col("doc_id") % 2 == b) for b in (0, 1)]
    store.add_batch(halves[0], "a", "doc_id", "text")
    want = lambda df: sorted(map(tuple, issue_keyword(df).collect()))
    got = lambda df: sorted(map(tuple, df.collect()))
    assert got(store.keywords()) == want(halves[0])
    store.add_batch(halves[1], "b", "doc_id", "text")
    store.add_batch(halves[1], "b", "doc_id", "text")  # the same batch again
    everything = want(docs)
    assert got(store.keywords()) == everything and store.documents() == docs.count()
    ids = {r.doc_id for r in halves[1].select("doc_id").collect()}
    assert got(store.keywords("b")) == [r for r in everything if r[0] in ids]
    store.compact()
    assert got(store.keywords()) == everything and store.documents() == docs.count()


# ---------------------------------------------------------------- weights
def test_compiled_logistic_regression_equals_mllib(spark):
    rows = td.enriched_issues(spark, SF).withColumn("channel", F.when(F.col("issue_id").cast("int") % 9 == 0, F.lit("")).otherwise(F.col("channel")))
    model = train_models(rows.filter("date < DATE '2024-01-10'"), names=["logistic_regression"], text=False).models["logistic_regression"]
    odd = rows.withColumn("region", F.when(F.col("issue_id").cast("int") % 7 == 0, F.lit("never seen"))
                          .when(F.col("issue_id").cast("int") % 7 == 1, F.lit(None)).otherwise(F.col("region")))
    want = {r.issue_id: (r.risk_score.prob, r.predicted_label) for r in score_issues(model, odd).collect()}
    weights = SC.logistic_weights(model)
    got = SC.score_with_weights(odd, weights, value=SC.encoded).collect()
    assert len(got) == len(want) > 100
    for r in got:
        assert r.risk_score.prob == pytest.approx(want[r.issue_id][0], abs=1e-12) and r.predicted_label == want[r.issue_id][1]


def test_scorecard_learns_a_planted_signal_and_unseen_values_weigh_nothing(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [(str(i), "A" if i % 2 else "B", i % 2 == 0 and i % 10 != 0, t) for i in range(200)]
    df = spark.createDataFrame(rows, "issue_id string, region string, sla_breached boolean, created_at timestamp")
    df = df.withColumns({c: F.lit("same") for c in ("channel", "raw_category", "issue_text")}).withColumn("topic_id", F.lit(1))
    card = SC.fit_scorecard(df)
    w = {(r.feature, r.value): r.weight for r in card.collect()}
    assert w["region", "B"] > 0 > w["region", "A"]
    new = spark.createDataFrame([("x", "Z", t), ("y", None, t), ("z", "B", t)], "issue_id string, region string, created_at timestamp")
    new = new.withColumns({c: F.lit(None).cast("string") for c in ("channel", "raw_category", "issue_text")}).withColumn("topic_id", F.lit(None).cast("int"))
    got = {r.issue_id: r.risk_score.prob for r in SC.score_with_weights(new, card).collect()}
    base = w["(intercept)", ""] + w["hour", "10"] + w["dow", "2"]
    assert got["x"] == got["y"] == pytest.approx(1 / (1 + math.exp(-base))) and got["z"] > 0.5
    plan = SC.score_with_weights(new, card)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


# ---------------------------------------------------------------- topics
def test_coherence_bounds(spark):
    docs = spark.createDataFrame([("cat dog",), ("cat dog bird",), ("fish",), ("", ), (None,), ("Cat; DOG",)], "text string")
    terms = spark.createDataFrame([(0, "cat"), (0, "dog"), (1, "cat"), (1, "fish"), (2, "fish"), (2, "unheard"), (3, "alone")], "topic_id int, token string")
    got = {r.topic_id: (r.pairs, r.coherence) for r in topics.topic_coherence(docs, terms).collect()}
    assert got[0] == (1, pytest.approx(1.0)) and got[1] == (1, -1.0) and got[2] == (1, -1.0) and 3 not in got
    assert topics.topic_coherence(docs, terms.limit(0)).count() == 0


def test_dominant_topic_of_stored_mixtures(spark):
    mixes = spark.createDataFrame([(1, [0.2, 0.5, 0.3]), (2, [0.4, 0.4, 0.2]), (3, []), (4, None)], "doc_id int, topic_mix array<double>")
    assert {r.doc_id: r.topic_id for r in topics.dominant_topics(mixes, "doc_id").collect()} == {1: 1, 2: 0}


# ---------------------------------------------------------------- stream checks
def test_metrics_equal_a_recount_and_replay_lands_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    recs = [r.value for r in to_kafka_records(td.enriched_issues(spark, SF).limit(60)).collect()]
    batches = [recs[:30] + ["{broken"], recs[30:] + recs[30:32] + ['{"status": "no id"}', recs[0][:-1]]]
    for i, lines in enumerate(batches):
        with open(os.path.join(src, f"{i}.json"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(os.path.join(src, f"{i}.json"), (i + 1, i + 1))
    land, bad, told = (scratch_path(spark, k) for k in ("land", "bad", "told"))
    stream = SI.read_issue_stream(spark, source="text", path=src, max_per_trigger=1)
    SI.start_ingest(stream, land, scratch_path(spark, "ck"), bad, metrics_path=told).awaitTermination()
    got = {r.batch_id: r for r in spark.read.parquet(told).collect()}
    assert [(got[b].rows_in, got[b].rows_landed, got[b].rows_quarantined, got[b].undecodable, got[b].without_id, got[b].repeated_ids)
            for b in (0, 1)] == [(31, 30, 1, 1, 0, 0), (34, 32, 2, 1, 1, 2)]
    counted = {r.batch_id: r["count"] for r in SI.read_landed(spark, land).groupBy("batch_id").count().collect()}
    assert counted == {0: 30, 1: 32} and got[0].first_ingested is not None

    def mend(v):
        return F.when(v.endswith("}"), v).otherwise(F.concat(v, F.lit("}")))

    for _ in range(3):
        assert SI.replay_quarantine(spark, bad, land, mend) == {"quarantined": 3, "landed": 1}
    assert SI.read_landed(spark, land).count() == 63
    assert spark.read.parquet(bad).filter("value = '{broken'").count() == 1
