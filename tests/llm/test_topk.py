import numpy as np
import pytest
from pyspark.sql import functions as F

from slawatch.llm import topk


def slow(rows, queries, k):
    out = []
    for qi, q in sorted(queries.items()):
        scored = sorted((-int(np.dot(q, v)), i) for i, v in rows if i != qi)[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def run(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score double").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=k, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def whole(v, width):
    x = np.floor(np.array(v, dtype=np.float32).astype(np.float64) * 256).astype(np.int64)
    return np.pad(x, (0, width - len(x)))


@pytest.mark.parametrize("options", [{}, {"chunk": 64, "block": 3, "head": 4}])
def test_against_all_products(spark, options):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(700, 24)) * rng.lognormal(0, 1, size=(700, 1)) * (np.arange(24) < 6) + rng.normal(size=(700, 24)) * 0.05
    v[100:350] = v[100]  # one very common vector, ties go to the smaller id
    rows = [(i, x.tolist(), 1, 0.5) for i, x in enumerate(v)]
    vectors = [(i, whole(x, 24)) for i, x, _, _ in rows]
    assert run(spark, rows, **options) == slow(vectors, {i: x for i, x in vectors if i % 50 == 0}, 5)


def test_edges(spark):
    rows = [(0, [1.0, 2.0], 1, 0.0), (50, [0.5], 1, 0.0), (1, None, 1, 0.0), (2, [1.0, None], 1, 0.0), (3, [float("nan"), 1.0], 1, 0.0),
            (4, [float("inf"), 1.0], 1, 0.0), (None, [1.0, 1.0], 1, 0.0), (5, [], 1, 0.0), (6, [-1.0, -1.0, 7.0], 1, 0.0), (6, [-1.0, -1.0, 7.0], 1, 0.0)]
    fine = [(i, whole(v, 3)) for i, v, _, _ in rows if i in (0, 50, 5, 6)]
    assert run(spark, rows) == slow(fine, {0: fine[0][1], 50: fine[1][1]}, 5)
    assert run(spark, rows[:1]) == []
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1, 0.0)]) == []


def test_pruning_skips_short_vectors():
    rng = np.random.default_rng(2)
    v = (rng.normal(size=(4096, 8)) * 100).astype(np.int64)
    v[1:] //= 50
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    q = v[:1].copy()
    least = np.array([float(v[0] @ q[0])])
    topk.best_in_chunk(np.arange(4096), v, np.array([-1]), q, least, np.eye(8), 1, head=4)
    got = topk.best_in_chunk(np.arange(4096), v.view(Counted), np.array([-1]), q, least, np.eye(8), 1, head=4)
    assert got == [(-1, 0, int(least[0]))]


def test_short_chunks_get_no_rows(spark):
    """A few long vectors answer all queries; chunks of short ones meet no
    block, and the answer is that of brute force."""
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * (50.0 if i % 40 == 0 else 0.01)).tolist()) for i in range(1600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.integer_vectors(table)
    asked = vectors.filter("vec_id % 40 = 0").selectExpr("vec_id AS query_id", "v AS q", "1e6D AS least")
    armed = topk.blocked(asked, 3)
    tops = spark.createDataFrame([(0, 1e12), (1, 4.0), (2, 0.0)], "chunk int, top double")
    assert {r.chunk for r in topk.surviving_pairs(tops, armed).collect()} == {0}
    # Thresholds that say nothing let every pair through.
    loose = topk.blocked(asked.selectExpr("query_id", "q", "CAST(NULL AS DOUBLE) AS least"), 3)
    assert topk.surviving_pairs(tops, loose).count() == 3 * loose.select("block").distinct().count()
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(table, F.col("vec_id") % 40 == 0, chunk=100, block=16).collect()}
    ids, v = np.array([r[0] for r in rows]), np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    for i in range(0, 1600, 40):
        score = v @ v[i]
        best = sorted((-int(s), int(j)) for s, j in zip(score, ids) if j != i)[:5]
        assert [got[i, r] for r in range(1, 6)] == [(j, -s) for s, j in best]
