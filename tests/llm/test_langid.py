import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from slawatch.llm import langid
from slawatch.llm.langid import MIX, ORDERS, grams, identify, learn_model, letter_words, predict


def slow_model(rows, min_count, gram_bound):
    """Figures of words and n-grams by plain counting; rows: (text, lang, learned)."""
    n = defaultdict(lambda: defaultdict(Counter))
    for text, lang, learned in rows:
        if learned and lang is not None and text is not None:
            for w in letter_words(text):
                n[0][lang][w] += 1
                for order in ORDERS:
                    n[order][lang].update(grams(w, order))
    langs = sorted({lang for kind in n.values() for lang in kind})

    def figures(kind, keep):
        totals = {lang: sum(n[kind][lang].values()) or 1 for lang in langs}
        out = {}
        for key in {k for lang in langs for k in n[kind][lang]}:
            if keep(sum(n[kind][lang][key] for lang in langs)):
                f = [n[kind][lang][key] / totals[lang] for lang in langs]
                out[key] = [math.log((1 - MIX) * x / (sum(f) / len(f)) + MIX) for x in f]
        return out

    known = figures(0, lambda c: c >= min_count)
    parts = {o: figures(o, lambda c, o=o: c >= sum(sum(n[o][lang].values()) for lang in langs) / gram_bound) for o in ORDERS}
    return langs, known, parts


def slow_answer(model, text):
    langs, known, parts = model
    sums = [0.0] * len(langs)
    words = letter_words(text)
    for w in words:
        v = known.get(w)
        for order in ORDERS:
            if v is None:
                some = [parts[order][g] for g in grams(w, order) if g in parts[order]]
                v = [sum(c) / len(some) for c in zip(*some)] if some else None
        for i, x in enumerate(v or []):
            sums[i] += x
    if not words or not langs:
        return "und", 0.0
    best = max(range(len(langs)), key=lambda i: round(sums[i], 6))
    return langs[best], 1 / sum(math.exp(s - sums[best]) for s in sums)


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.mark.parametrize("bound", [None, 30])
def test_brute_force(spark, bound):
    """All words by broadcast, and all but 30 by joins."""
    docs = documents(spark)
    learn = F.col("doc_id") % 4 != 2
    model = learn_model(docs, learn)
    keep = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    got = predict(docs, model, keep=keep, bound=bound).collect()
    rows = [(r.text, r.lang, r.doc_id % 4 != 2) for r in docs.collect()]
    twin = slow_model(rows, langid.MIN_COUNT, langid.GRAMS)
    assert model.langs == twin[0] and model.words.count() == len(twin[1]) and len(model.grams) == sum(map(len, twin[2].values()))
    assert len(got) == len(rows)
    for r in got:
        lang, score = slow_answer(twin, r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=2e-3), r.doc_id


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = F.col("doc_id") % 4 != 2
    got = identify(docs, learn, keep={"lang": F.col("lang"), "held": ~learn}).filter("held").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.97


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = documents(spark)
    learn = F.col("doc_id") % 4 != 2
    turned = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise(F.lit("xx"))).withColumn("source", F.lit("?"))
    both = [sorted(map(tuple, identify(d, learn).collect())) for d in (docs, turned)]
    assert both[0] == both[1]


def test_edges(spark, edges, none):
    got = identify(edges, F.lit(True), keep={"text": F.col("text"), "lang": F.col("lang"), "score2": F.col("score")}).collect()
    assert len(got) == edges.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == ("en" if letters else "und") and r.score == (1.0 if letters else 0.0) and r.score2 == 0.5
    assert identify(none, F.lit(True)).count() == 0
    unlearned = identify(edges, F.lit(False)).collect()
    assert {r.lang_pred for r in unlearned} == {"und"} and len(unlearned) == len(got)


def test_backoff_goes_from_words_to_shorter_grams(spark):
    rows = [("alpha beta gamma delta " * 10, "aa")] * 3 + [("omega sigma kappa " * 10, "bb")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = learn_model(docs, F.lit(True))
    asked = spark.createDataFrame([("alphabet",), ("kappas",), ("xxmexx",), ("ß",), ("½ ² 12",), ("omega alpha",)], "text string")
    got = {r.text: (r.lang_pred, r.score) for r in predict(asked, model, keep={"text": F.col("text")}).collect()}
    assert got["alphabet"][0] == "aa" and got["kappas"][0] == "bb" and got["ß"] == ("aa", 0.5) and got["½ ² 12"] == ("und", 0.0)
    assert got["omega alpha"] == ("aa", 0.5) or abs(got["omega alpha"][1] - 0.5) < 0.3


def test_many_copies_of_an_unseen_word_are_joined_by_broadcast(spark):
    rows = [("known words here " * 9, "aa", 0)] * 2 + [("andere worte dort " * 9, "bb", 0)] * 2 + [("unseenly " * 3, None, 1)] * 300
    docs = spark.createDataFrame(rows, "text string, lang string, k int").repartition(3)
    model = learn_model(docs, F.lit(True))
    a, b = (sorted(map(tuple, predict(docs, model, keep={"k": F.col("k")}, bound=n).collect())) for n in (None, 1))
    assert a == b and len(a) == 304
