"""Properties of the topic model and the classifiers (planted signal)."""

import random

from pyspark.sql import functions as F

from slawatch.operators import risk_model as RM
from slawatch.operators import topics as T


def test_topics_properties(spark):
    rnd = random.Random(1)
    a = ["water", "leak", "pipe", "flood", "drain"]
    b = ["noise", "music", "party", "loud", "night"]
    rows = []
    for i in range(300):
        words = a if i % 2 == 0 else b
        rows.append((str(i), " ".join(rnd.choice(words) for _ in range(12))))
    df = spark.createDataFrame(rows, ["issue_id", "issue_text"])
    m = T.fit_topics(df, k=2, min_df=5, max_iter=30)
    assign = {r.issue_id: r.topic_id for r in T.assign_topics(m, df).collect()}
    assert set(assign.values()) <= {0, 1}
    ta = {assign[str(i)] for i in range(0, 300, 2)}
    tb = {assign[str(i)] for i in range(1, 300, 2)}
    assert len(ta) == 1 and len(tb) == 1 and ta != tb         # planted vocabularies separate
    mix = T.topic_mixture(m, df).select(F.aggregate("topic_mix", F.lit(0.0), lambda s, x: s + x).alias("s"))
    assert mix.filter(F.abs(F.col("s") - 1.0) > 1e-6).count() == 0
    terms = T.topic_terms(m, n=3).collect()
    assert len(terms) == 2 and all(len(t.topic_keywords.split(", ")) == 3 for t in terms)


def test_models_learn_planted_signal(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(1500):
        region = rnd.choice(["NORTH", "SOUTH"])
        hour = rnd.randrange(24)
        breach = (region == "NORTH" and hour >= 12) if rnd.random() > 0.1 else rnd.random() < 0.5
        ts = f"2024-01-{1 + i % 28:02d} {hour:02d}:00:00"
        rows.append((str(i), ts, "noise - loud", region, "PHONE", "Noise", -1, breach))
    df = spark.createDataFrame(rows, "issue_id string, created_at string, issue_text string, region string, "
                                     "channel string, raw_category string, topic_id int, sla_breached boolean") \
              .withColumn("created_at", F.to_timestamp("created_at"))
    tm = RM.evaluate_models(RM.train_models(df, names=["logistic_regression", "boosted_trees", "neural_net"]))
    metrics = {r.model: r for r in tm.metrics.collect()}
    assert set(metrics) == {"logistic_regression", "boosted_trees", "neural_net"}
    assert metrics["boosted_trees"].auc > 0.8
    assert tm.best in metrics
    scored = RM.score_issues(tm.models[tm.best], df)
    probs = scored.select(F.col("risk_score.prob").alias("p"))
    assert probs.filter((F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    assert "resolution_hours" not in RM.scoring_features(df.withColumn("resolution_hours", F.lit(1.0))).columns
