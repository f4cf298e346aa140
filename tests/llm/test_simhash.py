import numpy as np
import xxhash

from slawatch.llm import graph, simhash


def slow_fingerprint(text, k=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + k]), 42) for i in range(max(1, len(ws) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_groups(fps):
    left, root = dict(enumerate(fps)), {}
    while left:
        first = min(left)
        todo = [first]
        del left[first]
        while todo:
            i = todo.pop()
            root[i] = first
            for j in [j for j, f in left.items() if bin(f ^ fps[i]).count("1") <= 3]:
                del left[j]
                todo.append(j)
    return root


def test_golay_code_is_perfect():
    leader, table = simhash.golay_tables()
    assert len(set(leader.tolist())) == 2048 and max(int(x).bit_count() for x in leader) == 3
    assert {len(set(t)) for t in table.tolist()} == {1, 6}


def test_no_link_is_missed():
    rng = np.random.default_rng(3)
    u = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    v = u.copy()
    for i in range(len(v)):
        for b in rng.choice(64, i % 4, replace=False):
            v[i] ^= np.uint64(1) << np.uint64(b)
    home, near = simhash.golay_keys(u)[0], simhash.golay_keys(v)[1]
    assert (near == home[:, :, None]).any(axis=(1, 2)).all()


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**64, 30, dtype=np.uint64)
    fps = {0}
    for c in centres:
        for _ in range(20):
            f = c
            for b in rng.choice(64, rng.integers(0, 4), replace=False):
                f ^= np.uint64(1) << np.uint64(b)
            fps.add(int(f))
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    got = {(r.u, r.v) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3}
    assert got == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_edge_rows_against_brute_force(edges):
    rows = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    fps = [slow_fingerprint(t) for _, t in rows]
    root = slow_groups(fps)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    want = sorted((str(d), format(fps[i], "016x"), str(least.get(root[i]))) for i, (d, _) in enumerate(rows))
    got = simhash.near_duplicates(edges).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    assert sorted((str(r.doc_id), r.f, str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns and kept.count() == len(set(root.values()))


def test_empty(none):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


def test_components_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(graph, "BROADCAST_EDGES", 0, raising=False)
    test_components(spark)


def test_keys_and_groups_are_not_broadcast(spark, edges, monkeypatch):
    """A plan takes the keys of a fingerprint for one row: at a few hundred
    thousand fingerprints it would send ten million to the driver."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    plans = {"links": plan(simhash.links(spark.createDataFrame([(1,), (3,)], "fp long")))}
    for module in (simhash, graph):
        cut = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, name, cut=cut: plans.update({name: plan(df)}) or cut(df, name))
    monkeypatch.setattr(graph, "BROADCAST_EDGES", 0, raising=False)
    plans["rows"] = plan(simhash.near_duplicates(edges))
    plans["one"] = plan(simhash.keep_one(edges))
    assert "Join" in plans["links"] and "Join" in plans["components"] and "Join" in plans["simhash-groups"]
    assert not [name for name, p in plans.items() if "Broadcast" in p]
