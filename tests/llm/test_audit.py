import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from slawatch.llm.audit import MEASURES, audit, cells, word_filters


def slow(docs, labels):
    """docs: (doc_id, text, part); labels: (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    rows = []
    for i, t, p in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
        rows.append((p or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        told = []
        for order in map("".join, permutations("ABCDE")):
            alive = list(own)
            for step, x in enumerate(order, 1):
                gone = [r for r in alive if x in r[1]]
                alive = [r for r in alive if x not in r[1]]
                told.append((order, step, len(alive), len(gone), sum(x in r[1] for r in own) - len(gone),
                             sum(r[1] == {x} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        by = {x: sum(t[3] for t in told if t[0][t[1] - 1] == x) for x in "ABCDE"}
        out += [(part, *t, by[t[0][t[1] - 1]]) for t in told]
    return sorted(out)


def told(df):
    return sorted(tuple(r[c] for c in ("part", "filter_order", "step", *MEASURES, "shapley")) for r in df.collect())


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_edges_against_brute_force(spark, edges, none):
    labels = [(1, 1, 0), (1, 0, 1), (5, None, 1), (7, 1, None), (8, 1, 1), (11, 0, 0), (12, 1, 0), (None, 1, 1), (999, 1, 1)]
    docs = [(r.doc_id, r.text, r.source) for r in edges.collect()]
    assert told(audit(edges, label_rows(spark, labels), part="source")) == slow(docs, labels)
    assert audit(none, label_rows(spark, labels)).count() == 0
    assert told(audit(edges, label_rows(spark, []), part="source")) == slow(docs, [])


def test_copies(spark):
    rows = [(5, "same", "a"), (3, "same", "b"), (3, "same", "a"), (None, "same", "a"), (9, "same", None), (7, None, "a"), (6, "", "b"), (2, "other", "a"), (2, "other", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = [(3, 1, 1), (5, 1, 0)]
    assert told(audit(docs, label_rows(spark, labels))) == slow(rows, labels)


def test_every_part_has_all_600_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = audit(docs, labels)
    assert {r["count"] for r in got.groupBy("part").count().collect()} == {600}
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert told(got) == slow(rows, [(r.doc_id, r.quality, r.toxic) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "aaa", "x"), (2, "b", "x"), (3, "b", "x")], "doc_id long, text string, lang string")
    got = audit(docs, label_rows(spark, []), filters={"S": F.length("text") < 2}, copies="K").orderBy("filter_order", "step").collect()
    assert [(r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got] == [
        ("KS", 1, 2, 1, 0, 0, 1), ("KS", 2, 1, 1, 1, 1, 3), ("SK", 1, 1, 2, 0, 1, 3), ("SK", 2, 1, 0, 1, 0, 1)]


def test_native_and_reduced_before_the_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plan = audit(docs, labels)._jdf.queryExecution().executedPlan().toString()
    for name in ("Python", "InArrow", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert name not in plan
    assert sorted(word_filters(F.col("text"))) == list("ABCD") and "n" in cells(
        spark.createDataFrame([], "doc_id long, digest binary, part string, mask int, good boolean, toxic boolean"), 16).columns
