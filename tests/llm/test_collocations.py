import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slawatch.llm import collocations
from slawatch.llm.collocations import beginnings, bit_map, collocations as mine, frequent_phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_counts(rows, max_words):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    return f, n


def slow(rows, min_count, max_words=5, cover=100, top=2000):
    f, n = slow_counts(rows, max_words)
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= cover * f[lang, w[i:i + m]]:
                    gone.add((lang, w[i:i + m]))
    out = {}
    for (lang, w), a in found.items():
        if (lang, w) not in gone:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)}


def told(df):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


def made(seed=3, docs=250):
    rng = random.Random(seed)
    words = ["the", "The", "a", "New", "york", "city", "é", "x\x01y", "z\x00", "#", "of", "in"]
    out = []
    for _ in range(docs):
        parts = [rng.choice(words) + rng.choice([" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\x0b", "! "]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            parts.append("one fixed phrase of words ")
        out.append((rng.choice(["en", "en", "de", None, ""]), "".join(parts)))
    return out + [("en", None), (None, None), ("fr", ""), ("fr", " \t\n")]


@pytest.mark.parametrize("min_count,max_words,cover,top", [(5, 5, 100, 2000), (20, 4, 80, 7), (3, 2, 100, 50), (400, 5, 100, 9)])
def test_brute_force(spark, min_count, max_words, cover, top):
    rows = made()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert told(mine(docs, min_count, max_words, cover, top)) == slow(rows, min_count, max_words, cover, top)


def test_edges(spark, edges, none):
    rows = [(r.lang, r.text) for r in edges.select("lang", "text").collect()]
    assert told(mine(edges, 40, 3)) == slow(rows, 40, 3)
    assert mine(none).count() == 0
    assert mine(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_ranges_lack_only_beginnings_of_their_first_row(spark):
    """Any cut into ranges gives the same left counts."""
    rows = [("en", ["the", *[f"w{i:03d}"] * k], 1000 - i - k) for i in range(200) for k in (1, 2, 3)] + [("en", ["the"], 99_999), ("fr", ["the"], 7)]
    f = {(lang, tuple(w)): n for lang, w, n in rows}
    counts = spark.createDataFrame(rows, "lang string, words array<string>, n long").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = beginnings(counts, 5, "test").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(rows)
    for r in got:
        assert r.parts == [f.get((r.lang, tuple(r.words[:k]))) for k in range(1, len(r.words))]


def test_full_maps_change_nothing(spark, monkeypatch):
    """Maps so small that they let everything through."""
    rows = made(9, 80)
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = told(mine(docs, 8))
    monkeypatch.setattr(collocations, "bit_map", lambda keys: np.full(1 << (collocations.MAP_BITS - 3), 255, dtype=np.uint8))
    assert told(mine(docs, 8)) == want == slow(rows, 8)


def test_bit_map_holds_every_key(spark):
    keys = [random.Random(i).randrange(-(1 << 63), 1 << 63) for i in range(500)] + [0, -1, (1 << 63) - 1]
    bits = bit_map(spark.createDataFrame([(k,) for k in keys], "key long"))
    found = collocations._in_map(bits, np.array(keys, dtype=np.int64).view(np.uint64))
    assert found.all() and bits.nbytes == 1 << (collocations.MAP_BITS - 3)
    assert np.unpackbits(bits).sum() <= len(keys)


def test_scores_beyond_64_bits(spark):
    """1000 * a * n and l * r pass 64 bits; the quotient is exact."""
    big = 3_037_000_499_123
    row = spark.createDataFrame([(big, big + 7, big - 5, big - 3)], "a long, n long, l long, r long")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    got = row.select(F.call_function("div", F.lit(1000).cast("decimal(4,0)") * whole("a") * whole("n"), whole("l") * whole("r"))).first()[0]
    assert got == 1000 * big * (big + 7) // ((big - 5) * (big - 3))


def test_frequent_phrases_are_exact(spark):
    rows = made(5, 120)
    f, n = slow_counts(rows, 4)
    counts, totals = frequent_phrases(spark.createDataFrame(rows, "lang string, text string"), 6, 4)
    assert {(r.lang, tuple(r.words)): r.n for r in counts.collect()} == {k: v for k, v in f.items() if v >= 6}
    assert {r.lang: r.total for r in totals.collect()} == {k: v for k, v in n.items() if v}
