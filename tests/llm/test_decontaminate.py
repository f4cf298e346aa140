import random

import pytest

from slawatch.llm import decontaminate as D


def slow(text, items):
    words = D.normal(text)
    hit, names = set(), set()
    for name, item in items:
        w = D.normal(item)
        n = min(13, len(w))
        for i in range(max(1, len(w) - 12) if w else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == w[i:i + n]:
                    hit.update(range(j, j + n))
                    names.add(None if name is None else str(name))
    return len(words), len(hit), sorted(names, key=lambda x: (x is None, x or "")), bool(hit) and 20 * len(hit) >= len(words)


def corpus(spark, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 2)))
    line = lambda n: rng.choice([" ", ", ", "\n-"]).join(word() for _ in range(n))
    items = [(i, line(rng.choice([1, 3, 12, 13, 14, 30]))) for i in range(25)] + [(25, "..."), (26, None), (27, ""), (3, "Éa b 中"), (None, "a b c")]
    docs = []
    for i in range(150):
        t = line(rng.randint(0, 200))
        if rng.random() < 0.5:
            t += " " + (rng.choice(items[:25])[1]).upper() + " " + line(rng.randint(0, 20))
        docs.append((i, t, "x", 1))
    docs += [(150, None, "x", 1), (151, "", "x", 1), (152, "x éA! b中", "x", 1), (153, "x Éa-B 中 y", "x", 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, items string, n_hit int"), spark.createDataFrame(items, "item_id long, text string"), docs, items)


@pytest.mark.parametrize("chunk_mb", [64, 0])
def test_against_brute_force(spark, chunk_mb):
    docs, benchmark, rows, items = corpus(spark)
    if not chunk_mb:  # an automaton for each window
        rows, docs = rows[:6], docs.filter("doc_id < 6")
        items = items[:2]
        benchmark = benchmark.filter("item_id < 2")
    got = {r.doc_id: r for r in D.hits(docs.select("doc_id", "text"), benchmark, chunk_mb=chunk_mb).collect()}
    text = {r[0]: r[1] for r in rows}
    for i in text:
        r = got[i]
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == slow(text[i], items)
        for run, span in zip(r.hit_words, r.spans):
            assert D.normal(text[i][span.start:span.end]) == D.normal(text[i])[run.first:run.last]


def test_filter_keeps_clean_rows_whole(spark, edges, none):
    docs, benchmark, rows, items = corpus(spark, 2)
    clean = D.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows if not slow(r[1], items)[3]}
    out = D.decontaminate(edges, benchmark.filter("item_id = 25"))
    assert out.columns == edges.columns and out.count() == edges.count()
    assert D.decontaminate(edges, benchmark.limit(0)).count() == edges.count()
    assert D.decontaminate(none, benchmark).count() == 0
    assert D.decontaminate(docs.select("doc_id", "text"), benchmark).columns == ["doc_id", "text"]


def test_items_without_an_id_count(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(None, passage), ("x", "w3 w4 w5"), (None, "other words here")], "item_id string, text string")
    docs = spark.createDataFrame([(1, passage), (2, "nothing of it"), (3, "Other words HERE")], "doc_id long, text string")
    got = {r.doc_id: r for r in D.hits(docs, items).collect()}
    assert got[1].n_hit == 20 and got[1]["items"] == ["x", None] and got[1].contaminated
    assert got[2].n_hit == 0 and got[2]["items"] == [] and not got[2].contaminated
    assert got[3].n_hit == 3 and got[3]["items"] == [None] and got[3].contaminated
