import random

import numpy as np
from pyspark.sql import functions as F

from slawatch.llm import quality
from slawatch.llm.base import remainder


def planted(spark, n=900, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("aeiourstn") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(5, 150))]
        good = rng.random() < 0.8
        if not good:
            kind = rng.randint(0, 2)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [f"{w} |" for w in words] if kind == 1 else [words[0]] * (20 + len(words))
        rows.append((i, " ".join(words) + ".", int(good), 0.5))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id long, text string, truth int, words double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held():
    return remainder("doc_id", 5) == 0


def test_planted_junk_is_found(spark):
    docs, labels = planted(spark)
    truth = {r.doc_id: r.truth for r in docs.collect()}
    got = quality.classify(docs, labels, held()).filter("held_out").collect()
    assert len(got) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.97
    kept = quality.keep_good(docs, labels, held())
    assert kept.columns == docs.columns and kept.filter("truth = 1").count() >= 0.99 * sum(truth.values())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_are_sparse_and_compiled(spark):
    docs, labels = planted(spark)
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    names = [c for c in stats.columns if c != "doc_id"]
    train = stats.join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id")
    rules = quality.fit_rules(train, names)
    every = quality.fit_rules(train, names, lasso=0.0)
    assert 0 < len(rules.rules) < len(every.rules)
    for conditions, _ in rules.rules:
        assert conditions and len({(n, a) for n, a, _ in conditions}) == len(conditions) <= 2 * quality.DEPTH
    # The compiled column equals the weights applied by hand.
    for r in train.withColumn("score", rules.score()).limit(50).collect():
        total = rules.intercept + sum(w for c, w in rules.rules if all((r[n] > t) == above for n, above, t in c))
        assert abs(r.score - 1 / (1 + np.exp(-total))) < 1e-9


def test_bounded_training(spark):
    docs, labels = planted(spark)
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    n = quality.labelled(stats, labels, "quality", F.lit(False), max_train=300).count()
    assert 200 < n < 400 and quality.labelled(stats, labels, "quality", F.lit(False)).count() == 900


def test_edges(spark, edges, none):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.classify(edges, nothing, held()).collect()
    assert len(got) == edges.count() and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    one = spark.createDataFrame([(i, 0) for i in range(14)], "doc_id long, quality int")
    assert quality.keep_good(edges, one, held()).count() == 0
    both = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(None, 1), (2, None)], "doc_id long, quality int")
    got = quality.classify(edges, both, held()).collect()
    assert len(got) == edges.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(edges, both, held()).columns == edges.columns
    assert quality.classify(none, both, held()).count() == 0


def slow_statistics(text):
    """The statistics of a text by plain Python."""
    import regex

    n = max(len(text), 1)
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    k = max(len(words), 1)
    letters = len(regex.findall(r"\p{L}", text))
    return {
        "words": len(words), "word_length": (n - len(regex.sub(r"[^\x20\x09-\x0D]+", "", text))) / k,
        "letters": letters / n, "capitals": len(regex.findall(r"\p{Lu}", text)) / max(letters, 1),
        "digits": len(regex.findall("[0-9]", text)) / n,
        "symbols": len(regex.sub(r"[\p{L}\p{N}\x20\x09-\x0D.,;:'\"()-]+", "", text)) / n,
        "stops": len(regex.findall("[.,]", text)) / k, "distinct_words": len(set(words)) / k,
        "distinct_lines": len(set(lines)) / len(lines), "line_words": k / len(lines),
    }


def slow_lasso(x, y, penalty, rounds=20_000):
    """Logistic regression with an L1 penalty on standardised weights, by
    accelerated proximal gradient steps."""
    x, y = np.array(x, dtype=float), np.array(y, dtype=float)
    spread = x.std(axis=0, ddof=1)
    z = np.hstack([np.ones((len(x), 1)), np.where(spread > 0, x / np.where(spread > 0, spread, 1), 0)])
    step = 4 * len(y) / np.linalg.norm(z, 2) ** 2
    w = v = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = v - step * z.T @ (1 / (1 + np.exp(-z @ v)) - y) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / u * (new - w), new, u
    return 1 / (1 + np.exp(-z @ w))


def test_statistics_rules_and_scores_against_brute_force(spark, monkeypatch):
    """Statistics, truth of each rule, lasso weights and the final score of
    every row, from the rules that the forest gave."""
    docs, labels = planted(spark, 500, 4)
    odd = spark.createDataFrame([(9001, None, 1, 0.5), (9002, "", 1, 0.5), (9003, "É \n\n 12,5 中文!", 1, 0.5)], docs.schema)
    docs = docs.unionByName(odd)
    kept = {}
    fit, paths = quality.fit_rules, quality.tree_rules
    monkeypatch.setattr(quality, "fit_rules", lambda *a, **k: kept.setdefault("rules", fit(*a, **k)))
    monkeypatch.setattr(quality, "tree_rules", lambda *a: kept.setdefault("paths", paths(*a)))
    got = {r.doc_id: r for r in quality.classify(docs, labels, held()).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    stats = {i: slow_statistics(t) for i, t in texts.items()}
    true = lambda rule, s: all(s[n] > t if above else s[n] <= t for n, above, t in rule)
    for i, s in stats.items():
        assert all(np.isclose(got[i][k], v) for k, v in s.items()), (i, s, got[i])
        total = kept["rules"].intercept + sum(w for rule, w in kept["rules"].rules if true(rule, s))
        assert np.isclose(got[i].score, 1 / (1 + np.exp(-total))) and got[i].predicted == int(got[i].score >= quality.THRESHOLD)
    known = {r.doc_id: r.quality for r in labels.collect()}
    train = [i for i in sorted(texts) if i in known and not got[i].held_out]
    want = slow_lasso([[float(true(rule, stats[i])) for rule in kept["paths"]] for i in train], [known[i] for i in train], quality.LASSO)
    assert np.abs(want - [got[i].score for i in train]).max() < 0.05


def test_labels_are_not_broadcast_by_their_stored_size(spark, monkeypatch):
    """Stored, a label takes two or three bytes: a plan that goes by them
    would send millions of rows to the driver."""
    plans, cut = [], quality.cut_lineage
    monkeypatch.setattr(quality, "cut_lineage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, name))
    stats = spark.range(20).select(F.col("id").alias("doc_id"), F.rand(1).alias("words"))
    marks = spark.range(0, 20, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 4 / 2).cast("int").alias("quality"))
    got = quality.labelled(stats, marks, "quality", F.col("doc_id") >= 10)
    assert sorted((r.doc_id, r.label) for r in got.collect()) == [(0, 0), (2, 1), (4, 0), (6, 1), (8, 0)]
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
