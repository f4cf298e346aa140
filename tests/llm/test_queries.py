import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from oracle_harness import compare, duck
from slawatch.llm import decontaminate, quality
from slawatch.llm.base import remainder
from slawatch.llm.queries import ORACLE, QUERIES
from test_dedup import slow as slow_dedup
from test_mixing import slow_targets
from test_pii import slow_spans
from test_simhash import slow_fingerprint, slow_groups
from test_tokens import reference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    got = compare(spark, name, SF, QUERIES[name], ORACLE[name], con)
    assert got["match"], got


def rows(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}


def test_token_ids(spark, documents):
    got, at = rows(spark, "op1_token_ids"), 0
    for (d, _), ids in zip(documents, reference([t or "" for _, t in documents])):
        ids = np.array([*ids, 2], dtype="<u4")
        assert tuple(got[d]) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_personal_data(spark, documents):
    import hashlib

    got = rows(spark, "op2_personal_data")
    for d, t in documents:
        spans = slow_spans(t or "")
        base = ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in spans[k])
        r = got[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)


@pytest.mark.parametrize("name,label,good", [("op4_toxicity", "toxic", 0.75), ("op10_quality", "quality", 0.95)])
def test_classifiers_on_held_out_rows(spark, name, label, good):
    got = {r.doc_id: r for r in QUERIES[name](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql(f"SELECT doc_id, {label} FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(got[d].predicted, y) for d, y in labels if got[d].held_out]
    mod, rest = {"op4_toxicity": (3, 1), "op10_quality": (5, 0)}[name]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % mod == rest) for d, r in got.items())
    assert len(got) == 1000 and np.mean([p == y for p, y in held]) >= good


def test_simhash(spark, documents):
    fps = [slow_fingerprint(t) for _, t in documents]
    root = slow_groups(fps)
    got = rows(spark, "op6_simhash")
    for i, (d, _) in enumerate(documents):
        assert tuple(got[d]) == (d, format(fps[i], "016x"), documents[root[i]][0])


def test_repeated_strings(spark, documents):
    import hashlib

    want = slow_dedup([(d, (t or "").encode()) for d, t in documents])
    got = rows(spark, "op7_repeated_strings")
    for d, t in documents:
        b = (t or "").encode()
        spans, kept = want[d, b]
        assert tuple(got[d]) == (d, len(b), sum(y - x for x, y in spans), len(spans), hashlib.sha256(kept).hexdigest())


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.classify(docs, labels, remainder("doc_id", 5) == 0).collect()
    good = {r.doc_id for r in judged if r.predicted}
    kept = sorted(((r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good))
    root = slow_groups([slow_fingerprint(t) for _, t, _ in kept])
    kept = [r for i, r in enumerate(kept) if root[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    automaton = decontaminate._automaton([(w, [str(i)]) for i, t in items for w in decontaminate.windows(decontaminate.normal(t))])
    kept = [r for r in kept if not decontaminate._row(automaton, r[1], [], [])[5]]
    out = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    whole, source = {d: t for d, t, _ in kept}, {d: s for d, _, s in kept}
    assert {r.doc_id for r in out} <= set(whole)
    # The tokens of a copy or part are those of words of its document; per source they come to its target.
    size = lambda t: len([w for w in t.split() if w])
    sizes = {}
    for d, t, s in kept:
        sizes[s] = sizes.get(s, 0) + size(t)
    target, ids = slow_targets(sizes), dict(zip(whole, reference(list(whole.values()))))
    ratio, at, got = {}, 0, {}
    for r in out:
        assert r.start == at and r.n_tokens == len(r.tokens)
        assert r.ids_crc32 == zlib.crc32(np.array(r.tokens, dtype="<u4").tobytes())
        at += r.n_tokens
        if r.tokens[:-1] == ids[r.doc_id]:
            ratio[r.doc_id] = ratio.get(r.doc_id, 0) + 1
        got[source[r.doc_id]] = got.get(source[r.doc_id], 0) + r.n_tokens - 1
    assert max(ratio.values()) <= 3
    per_word = sum(len(ids[d]) for d in whole) / sum(map(size, whole.values()))
    for s in sizes:
        assert got.get(s, 0) == pytest.approx(target[s] * per_word, rel=0.25, abs=60)


def test_stages_keep_the_columns(spark, edges):
    docs = edges.drop("_row")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and last.count() == docs.count()
