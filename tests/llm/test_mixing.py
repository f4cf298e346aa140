import random

import pytest
from pyspark.sql import functions as F

from slawatch.llm import mixing


def slow_targets(sizes, weights=(5, 2, 1)):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=str) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    cap = {s: 3.0 * sizes[s] for s in names}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = cap[s]
            rest -= cap[s]
        free -= over
    return target


def slow_seats(weights, seats):
    got = {k: 0 for k in weights}
    for _ in range(seats):
        best = max(weights, key=lambda k: (weights[k] / (2 * got[k] + 1), -k))
        got[best] += 1
    return got


def corpus(spark, sizes, seed=0):
    rng = random.Random(seed)
    rows, i = [], 0
    for source, words in sizes.items():
        while words > 0:
            n = min(words, rng.randint(0, 60))
            rows.append((i, " \n".join("w%d" % rng.randint(0, 99) for _ in range(n)) or None, source, 7))
            words, i = words - n, i + 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target int")


@pytest.mark.parametrize("seats", [0, 1, 7, 100])
def test_apportionment_against_the_greedy_rule(spark, seats):
    weights = {i: float(w) for i, w in enumerate([100, 53, 53, 11, 3, 1, 0.5, 0])}
    df = spark.createDataFrame([(0, k, w, seats) for k, w in weights.items()], "g int, k int, w double, seats long")
    got = {r.k: r.quota for r in mixing.sainte_lague(df, "w", "seats", ["g"], ["k"]).collect()}
    assert got == slow_seats(weights, seats)


def test_targets_and_totals(spark):
    sizes = {"a": 40, "b": 6000, "c": 900, "d": 2500, "": 300, None: 1200}
    docs = corpus(spark, sizes)
    rows = mixing.mix(docs, shard_words=700).collect()
    want = slow_targets(sizes)
    by_id = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    taken = {s: sum(r.taken for r in rows if by_id[r.doc_id] == s) for s in sizes}
    for s in sizes:
        some = next(r for r in rows if by_id[r.doc_id] == s)
        assert some.source_size == sizes[s] and some.target == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 2
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mixing.mix(docs.repartition(7), shard_words=700).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mixed_documents_hold_the_taken_words(spark):
    docs = corpus(spark, {"a": 300, "b": 4000, "c": 500}, seed=2).withColumn("n_chars", F.length("text").cast("long"))
    taken = {r.doc_id: r.taken for r in mixing.mix(docs, shard_words=400).collect()}
    out = mixing.mixed_documents(docs, shard_words=400)
    assert out.columns == docs.columns
    got, whole = {}, {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
        assert r.text in whole[r.doc_id] and r.n_chars == len(r.text) and r.target == 7
    assert got == {k: v for k, v in taken.items() if v}


def test_hot_source_is_many_shards(spark):
    docs = corpus(spark, {"hot": 20_000, "b": 500, "c": 500}, seed=3)
    rows = mixing.mix(docs, shard_words=1000).collect()
    hot = [r for r in rows if r.source_size == 20_000]
    assert 0 < sum(r.taken > 0 for r in hot) and max(r.taken for r in hot) <= 3 * max(r.size for r in hot)


def test_edges(edges, none):
    rows = mixing.mix(edges).collect()
    assert len(rows) == edges.count() and all(r.taken == 0 for r in rows if r.size == 0)
    out = mixing.mixed_documents(edges)
    assert out.columns == edges.columns and out.filter("text IS NULL OR trim(text) = ''").count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_no_python_on_the_main_path(edges):
    plan = mixing.mixed_documents(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def mixed_rows(docs):
    return sorted(map(str, mixing.mixed_documents(docs, shard_words=700).collect()))


def test_tables_of_any_columns(spark, tmp_dir):
    """Three columns only, from memory and from files; and columns whose
    names clash with internal ones."""
    docs = corpus(spark, {"a": 400, "b": 3000, None: 90}).select("doc_id", "text", "source")
    docs.write.parquet(tmp_dir + "/three")
    both = [mixed_rows(d) for d in (docs, spark.read.parquet(tmp_dir + "/three"))]
    assert both[0] == both[1] and len(both[0]) > 0
    odd = docs.withColumns({"_row": F.lit(1), "_text": F.lit("t"), "size": F.lit("s"), "_digest": F.lit(2), "_in0": F.lit(3)})
    got = mixing.mixed_documents(odd, shard_words=700)
    assert got.columns == odd.columns and sorted(map(str, got.select("doc_id", "text", "source").collect())) == both[0]


def test_null_and_repeated_ids_in_any_input_order(spark):
    docs = corpus(spark, {"a": 4000, "b": 3000}, 5).withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("doc_id") % 20))
    rows = docs.collect()
    orders = [spark.createDataFrame(some, docs.schema).repartition(n) for some, n in ((rows, 2), (rows[::-1], 5))]
    assert mixed_rows(orders[0]) == mixed_rows(orders[1])


def test_rows_without_an_id_fall_into_many_shards(spark):
    """A third of all rows without an id is dealt by its texts."""
    docs = corpus(spark, {"a": 60_000}, 6).withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("doc_id")))
    digest = mixing.seeded(42, F.col("doc_id"), F.md5(mixing.whole().cast("binary")))
    held = docs.filter("text IS NOT NULL").groupBy(mixing.bucket(digest, F.lit(16)).alias("shard")).count().collect()
    sizes = [r["count"] for r in held]
    assert len(sizes) == 16 and max(sizes) < 1.5 * sum(sizes) / 16
