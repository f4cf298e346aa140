"""No step is held to a fixed number of tasks, and none is done twice."""

import pytest

from slawatch.operators import keywords, risk_model
from slawatch.operators.enrich import enrich
from slawatch.plans import catalog
from slawatch.sources import testdata as td

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_stream_sends_in_as_many_tasks_as_there_are(spark, monkeypatch):
    plans, write = [], catalog.SI.write_issue_records

    def spy(records, path):
        plans.append(_plan(records))
        write(records, path)

    monkeypatch.setattr(catalog.SI, "write_issue_records", spy)
    out = catalog.QUERIES["dedupe_stream"](spark, SF)
    assert out.count() == catalog.QUERIES["issues_enriched"](spark, SF).count()
    assert plans and "REPARTITION_BY_NUM" not in plans[0]


def _exchanges(df, word):
    """Lines of the plan with an exchange whose rows hold ``word``."""
    return [x for x in _plan(df).splitlines() if "Exchange hashpartitioning" in x and word in x]


def test_enrich_shuffles_the_issues_once(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        uni = td.unified_issues(spark, SF)
        topics = td.topic_assignments(spark, SF)
        out = enrich(uni, topics, td.topic_terms(topics), terms_bound=td.TOPIC_MOD, keywords=td.keyword_assignments(spark, SF))
        # The issues, the topics and the keywords.
        assert len(_exchanges(out, "_k")) == 3
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_training_reads_its_rows_once(spark, monkeypatch):
    stages, cut = [], risk_model.cut_lineage
    monkeypatch.setattr(risk_model, "cut_lineage", lambda df, name: stages.append(name) or cut(df, name))
    got = risk_model.train_models(td.enriched_issues(spark, SF), names=["logistic_regression"])
    assert stages == ["labelled", "scored-logistic_regression"]
    assert "events" not in got.metrics.inputFiles()[0]


def test_dense_training_rows_are_dealt_by_their_dense_size(spark, monkeypatch):
    """Few bytes as stored, so one task when read; the trees get them in tasks
    whose dense copies stay under the bound."""
    class Fitted(Exception):
        pass

    class Spy:
        def fit(self, rows):
            raise Fitted(rows.rdd.getNumPartitions(), rows.rdd.mapPartitions(lambda p: [sum(8 * r[0].size for r in p)]).max())

    bound = 1 << 19
    monkeypatch.setattr(risk_model, "DENSE_TASK_BYTES", bound, raising=False)
    monkeypatch.setattr(risk_model, "_classifiers", lambda width, seed: {"boosted_trees": Spy()})
    with pytest.raises(Fitted) as got:
        risk_model.train_models(td.enriched_issues(spark, SF), names=["boosted_trees"])
    tasks, largest = got.value.args
    assert tasks > spark.sparkContext.defaultParallelism and largest <= 1.1 * bound


def test_keywords_shuffle_texts_and_rare_tokens_only(spark, monkeypatch):
    """Words are counted where their text is, and the join by token shuffles
    the rows of the rarer tokens alone; same keywords as from one join."""
    docs = td.read(spark, SF, "documents")
    want = sorted(map(tuple, keywords.issue_keyword(docs).collect()))
    plans, cut = {}, keywords.cut_lineage
    monkeypatch.setattr(keywords, "cut_lineage", lambda df, name: plans.update({name: _plan(df)}) or cut(df, name))
    monkeypatch.setattr(keywords, "FREQUENT_TOKENS", 50, raising=False)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "20k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = keywords.issue_keyword(docs)
        assert sorted(map(tuple, out.collect())) == want
        tf = plans["keyword-tf"].split("Initial Plan")[-1]
        assert tf.count("Exchange hashpartitioning") == 1 and "token" not in tf.split("Exchange hashpartitioning")[1].splitlines()[0]
        assert "BroadcastHashJoin [token" in _plan(out) and "LeftAnti" in _plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_score_new_issues_enriches_once(spark, monkeypatch):
    calls, enriched = [], td.enriched_issues
    monkeypatch.setattr(td, "enriched_issues", lambda *a: calls.append(a) or enriched(*a))
    out = catalog.QUERIES["score_new_issues"](spark, SF)
    assert len(calls) == 1 and not any("events.parquet" in f for f in out.inputFiles())
    assert out.count() == catalog.QUERIES["new_issues"](spark, SF).count()


def test_score_new_issues_moves_the_columns_it_reads_only(spark, monkeypatch):
    """The fact is stored, and the new issues are joined, without the columns
    that neither the features nor the label are made of."""
    stored, cut = {}, catalog.cut_lineage
    monkeypatch.setattr(catalog, "cut_lineage", lambda df, name: stored.update({name: df}) or cut(df, name))
    seen, new = [], catalog.new_issues
    monkeypatch.setattr(catalog, "new_issues", lambda rows, fact: seen.append(rows.columns) or new(rows, fact))
    out = catalog.QUERIES["score_new_issues"](spark, SF)
    read = {"issue_id", *risk_model.SOURCES}
    assert set(stored["fact"].columns) == read | {risk_model.LABEL} and set(seen[0]) == read
    assert stored["fact"].count() + out.count() == stored["enriched"].count()


def test_topics_do_not_depend_on_partitions_and_texts_are_split_once(spark, monkeypatch):
    from slawatch.operators import topics

    docs = td.read(spark, SF, "documents")
    stages, cut = [], topics.cut_lineage if hasattr(topics, "cut_lineage") else None
    monkeypatch.setattr(topics, "cut_lineage", lambda df, name: stages.append(name) or cut(df, name), raising=False)
    fitted = [topics.fit_topics(docs.repartition(n), k=5, text_col="text", key="doc_id", max_iter=3, min_df=2) for n in (2, 5)]
    assert stages == ["topic-terms"] * 2
    a, b = (dict(map(tuple, topics.assign_topics(m, docs, "doc_id", "text").collect())) for m in fitted)
    assert a == b and len(a) == docs.filter("text is not null").count()


def test_stacked_texts_equal_one_after_the_other():
    import numpy as np

    from slawatch.operators import variational as V

    # Texts of 0 to 40 words, every ninth over the bound of single precision.
    rnd, k, n_words = np.random.default_rng(5), 4, 60
    lengths = np.arange(400) % 41
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    words = np.concatenate([np.sort(rnd.choice(n_words, n, replace=False)) for n in lengths]).astype(np.int32)
    counts = rnd.integers(1, 4, offsets[-1]) * np.repeat(np.where(np.arange(400) % 9 == 0, 400.0, 1.0), lengths)
    beta = np.exp(V.expectation(rnd.gamma(0.3, 50.0, (k, n_words)) + 0.1)).T.copy()
    alpha = np.array([0.2, 0.3, 0.1, 0.4])
    got, sums = V.infer(offsets, words, counts, beta, alpha, totals=True)
    want = np.zeros_like(beta)
    for i, (x, y) in enumerate(zip(offsets[:-1], offsets[1:])):
        b, c, now, change = beta[words[x:y]], counts[x:y], np.ones(k), 1.0
        if x == y:
            assert (got[i] == alpha).all()
            continue
        while change > V.TOLERANCE:
            exp = np.exp(V.expectation(now[None, :])[0])
            new = exp * (b.T @ (c / (b @ exp + 1e-100))) + alpha
            change, now = np.abs(new - now).mean(), new
        exp = np.exp(V.expectation(now[None, :])[0])
        want[words[x:y]] += np.outer(c / (b @ exp + 1e-100), exp)
        # One step more or less, where rounding meets the tolerance.
        assert np.abs(got[i] - now).mean() <= 2 * V.TOLERANCE
        assert abs(got[i].sum() - c.sum() - alpha.sum()) < 1e-3
    assert np.abs((sums - want) * beta).sum() < 1e-3 * counts.sum()
