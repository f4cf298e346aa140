"""Journal, ledger and id index: lost runs, second runs, plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from slawatch.operators.incremental import new_issues
from slawatch.plans import jobs
from slawatch.session import scratch_path
from slawatch.sinks import idindex, journal, tables
from slawatch.sinks.journal import TableJournal
from slawatch.sinks.tables import upsert_by_day
from slawatch.streaming import ingest as SI

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
SCHEMA = "issue_id string, status string, ingested_at timestamp, date date"


def at(h):
    return dt.datetime(2024, 3, 1, h)


def make(spark, name, rows):
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("date").option("path", scratch_path(spark, name)).saveAsTable(name)


def rows(df):
    return sorted((r.issue_id, r.status, str(r.date)) for r in df.select("issue_id", "status", "date").collect())


def lost(*_, **__):
    raise RuntimeError("lost")


@pytest.mark.parametrize("step", ["overwrite_partitions", "empty_partitions"])
def test_a_run_lost_between_its_steps_is_finished_by_the_next(spark, monkeypatch, step):
    """``a`` moves from a day that it leaves empty: after the overwrite, and
    before the emptying, it is on two days."""
    name = f"lost_{step}"
    make(spark, name, [("a", "open", None, D1), ("b", "open", None, D2), ("c", "open", None, D3), (None, "x", None, D3), ("u", "open", None, None)])
    moved = spark.createDataFrame([("a", "closed", at(1), D2), ("u", "dated", at(1), D3)], SCHEMA)
    want = [("a", "closed", "2024-01-02"), ("b", "open", "2024-01-02"), ("c", "open", "2024-01-03"), ("u", "dated", "2024-01-03")]
    with monkeypatch.context() as m:
        m.setattr(journal, step, lost)
        with pytest.raises(RuntimeError):
            upsert_by_day(moved, name)
    told = TableJournal(spark, name)
    assert len(told.open_entries()) == 1
    known = lambda df: rows(df.filter("issue_id IS NOT NULL"))
    # A reader of the journal never sees the half-done state.
    assert known(told.snapshot()) == want
    if step == "empty_partitions":
        assert spark.table(name).filter("issue_id = 'a'").count() == 2
    # The next run, with other rows, finishes it first.
    upsert_by_day(spark.createDataFrame([("c", "closed", at(2), D3)], SCHEMA), name)
    assert known(spark.table(name)) == [*want[:2], ("c", "closed", "2024-01-03"), want[3]]
    assert told.open_entries() == [] and known(told.snapshot()) == known(spark.table(name))
    assert spark.table(name).filter("issue_id IS NULL").count() == 1


def test_a_stage_without_an_entry_does_not_count(spark, monkeypatch):
    make(spark, "stage_only", [("a", "open", None, D1)])
    with monkeypatch.context() as m:
        m.setattr(TableJournal, "enter", lost)
        with pytest.raises(RuntimeError):
            upsert_by_day(spark.createDataFrame([("a", "closed", at(1), D1)], SCHEMA), "stage_only")
    assert rows(TableJournal(spark, "stage_only").snapshot()) == [("a", "open", "2024-01-01")]
    assert TableJournal(spark, "stage_only").recover() == 0


def test_applying_twice_is_once(spark):
    make(spark, "twice_applied", [("a", "open", None, D1), ("b", "open", None, D2)])
    upsert_by_day(spark.createDataFrame([("a", "closed", at(1), D2)], SCHEMA), "twice_applied")
    told = TableJournal(spark, "twice_applied")
    once = rows(spark.table("twice_applied"))
    entry = told.log().filter("state = 'staged'").first()
    told.replace_days(entry)
    assert rows(spark.table("twice_applied")) == once == [("a", "closed", "2024-01-02"), ("b", "open", "2024-01-02")]


def land(spark, path, batch_id, rows, query="q"):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{path}/query={query}/batch_id={batch_id}")


def test_batches_are_merged_once(spark, monkeypatch):
    name, path = "ledger", scratch_path(spark, "landed")
    make(spark, name, [("a", "open", None, D1), ("b", "open", None, D2), ("c", "open", None, D3)])
    land(spark, path, 0, [("a", "closed", at(1), D1)])
    land(spark, path, 1, [("b", "closed", at(2), D2)])
    assert jobs.run_upsert(spark, path, name) == 2
    assert jobs.run_upsert(spark, path, name) == 0
    before = TableJournal(spark, name).log().count()
    assert jobs.run_upsert(spark, path, name) == 0 and TableJournal(spark, name).log().count() == before
    # A new batch, and one of another query with the same number.
    land(spark, path, 2, [("c", "closed", at(3), D3)])
    land(spark, path, 0, [("d", "new", at(3), D3)], query="other")
    landed = SI.read_landed(spark, path)
    pending = SI.pending_batches(landed, TableJournal(spark, name).merged_batches())
    assert pending == [("other", 0), ("q", 2)]
    only = SI.of_batches(landed, pending)
    assert len(only.inputFiles()) >= 2 and all("batch_id=1" not in f for f in _files(only))
    # Lost while applying: the batches count already, and are not merged again.
    with monkeypatch.context() as m:
        m.setattr(journal, "empty_partitions", lost)
        with pytest.raises(RuntimeError):
            jobs.run_upsert(spark, path, name)
    assert jobs.run_upsert(spark, path, name) == 0
    assert rows(spark.table(name)) == [("a", "closed", "2024-01-01"), ("b", "closed", "2024-01-02"), ("c", "closed", "2024-01-03"), ("d", "new", "2024-01-03")]


def _files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_batch_without_rows_is_noted(spark):
    make(spark, "noted", [("a", "open", None, D1)])
    path = scratch_path(spark, "landed")
    land(spark, path, 0, [("a", "closed", at(1), D1)])
    land(spark, path, 1, [])
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{path}/query=q/batch_id=1")
    assert jobs.run_upsert(spark, path, "noted") == 1
    assert jobs.run_upsert(spark, path, "noted") == 0


# ---------------------------------------------------------------- id index
def fact_of(spark, name, ids):
    spark.createDataFrame([(i, D1) for i in ids], "issue_id string, issue_date date").write.partitionBy("issue_date") \
        .option("path", scratch_path(spark, name)).saveAsTable(name)


def test_index_equals_the_anti_join(spark):
    fact_of(spark, "indexed", [str(i) for i in range(0, 3000, 3)] + [None, None])
    index = spark.table(idindex.build_index(spark, "indexed"))
    en = spark.range(3000).select(F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("issue_id"), F.col("id").alias("v"))
    got = idindex.not_indexed(en, index)
    want = new_issues(en, spark.table("indexed"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == en.columns
    # Appended ids are known; adding them again, as a lost run would, changes nothing.
    more = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "issue_id string")
    idindex.add_ids(more, "indexed")
    n = spark.table(idindex.index_name("indexed")).count()
    idindex.add_ids(more, "indexed", once=True)
    assert spark.table(idindex.index_name("indexed")).count() == n == 1002
    assert idindex.not_indexed(more, spark.table(idindex.index_name("indexed"))).count() == 1


def test_no_exchange_on_the_index_side(spark):
    fact_of(spark, "index_plan", [str(i) for i in range(100)])
    index = spark.table(idindex.build_index(spark, "index_plan"))
    batch = spark.range(50).select(F.col("id").cast("string").alias("issue_id"), F.lit(1).alias("x"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = idindex.not_indexed(batch, index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One exchange: the batch, to the index's buckets.
    buckets = idindex.buckets_of(spark, idindex.index_name("index_plan"))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert re.findall(r"Exchange hashpartitioning\([^)]*, (\d+)\)", plan) == [str(buckets)]


def test_empty_partitions_leaves_other_days(spark):
    make(spark, "emptied", [("a", "x", None, D1), ("b", "x", None, D2), ("c", "x", None, None)])
    tables.empty_partitions(spark, "emptied", "date", [D1, None])
    assert rows(spark.table("emptied")) == [("b", "x", "2024-01-02")]
    tables.empty_partitions(spark, "emptied", "date", [])
    assert spark.table("emptied").count() == 1
