import random

import numpy as np
import pytest

from slawatch.llm import dedup
from slawatch.llm.runindex import LENGTH, RunLengthIndex


def slow(rows):
    """(removed spans, kept bytes) by a set of all strings, in corpus order."""
    first, out = {}, {}
    docs = sorted({(d is not None, d or 0, t) for d, t in rows})
    import xxhash
    docs.sort(key=lambda r: (r[0], r[1], np.uint64(xxhash.xxh64_intdigest(r[2], 42)).view(np.int64)))
    for n, (_, _, b) in enumerate(docs):
        for i in range(len(b) - LENGTH + 1):
            first.setdefault(b[i:i + LENGTH], (n, i))
    for n, (real, d, b) in enumerate(docs):
        spans = dedup.merged([(i, i + LENGTH) for i in range(len(b) - LENGTH + 1) if first[b[i:i + LENGTH]] != (n, i)])
        at = [0, *[e for s in spans for e in s], len(b)]
        out[d if real else None, b] = spans, b"".join(b[x:y] for x, y in zip(at[::2], at[1::2]))
    return out


def check(docs, limit=dedup.LIMIT):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    want = slow(rows)
    got = dedup.remove_repeats(docs, limit).collect()
    told = sorted((str(r.doc_id), r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in got)
    assert told == sorted((str(d), len(b), want[d, b][0], want[d, b][1]) for d, b in rows)


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh \xc3\xa9", b"a"])
def test_index_marks_earlier_matches(alphabet):
    rng = random.Random(1)
    base = bytes(rng.choice(alphabet) for _ in range(400))
    strings = []
    for _ in range(80):
        a = rng.randint(0, 230)
        s = bytearray(base[a:a + rng.randint(40, 169)])
        for _ in range(rng.randint(0, 2)):
            s[rng.randrange(len(s))] = rng.choice(alphabet)
        if bytes(s) not in strings:
            strings.append(bytes(s))
    index, seen = RunLengthIndex(strings), set()
    for s, flags in zip(strings, index.earlier_matches()):
        want = []
        for i in range(len(s) - LENGTH + 1):
            want.append(s[i:i + LENGTH] in seen)
            seen.add(s[i:i + LENGTH])
        assert list(flags) == want
    assert index.runs < len(index.order)
    assert (index.order[index.run_first] == index.sample_first).all()


def test_slices_depend_on_content_alone():
    rng = random.Random(2)
    core = bytes(rng.choice(b"abcdef ") for _ in range(700))
    a, b = b"xyz" * 40 + core, bytes(rng.choice(b"ghij") for _ in range(333)) + core + b"tail" * 40
    got = dedup.slice_table([a, b])
    inner = lambda d: {(x, y) for k, x, y in zip(got["doc"], got["anchor"].tolist(), got["digest"].tolist()) if k == d}
    assert len(inner(0) & inner(1)) > 10
    for d, t in enumerate((a, b)):
        some = [(lo, n) for k, lo, n in zip(got["doc"], got["lo"], got["n"]) if k == d]
        assert sorted(x for lo, n in some for x in range(lo, lo + n)) == list(range(len(t) - LENGTH + 1))


def test_long_texts_in_parts(monkeypatch):
    text = bytes(random.Random(4).choice(b"abcdefgh") for _ in range(5000))
    monkeypatch.setattr(dedup, "PART", 700)
    got = dedup.slice_table([b"short", text])
    assert sorted(x for lo, n in zip(got["lo"], got["n"]) for x in range(lo, lo + n)) == list(range(len(text) - LENGTH + 1))
    assert set(got["doc"]) == {1}


@pytest.mark.parametrize("limit", [dedup.LIMIT, 2])
def test_corpus_against_brute_force(spark, limit):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("aeiounrst é") for _ in range(rng.randint(2, 9))) for _ in range(n))
    shared, base = [text(30) for _ in range(3)], [text(80) for _ in range(12)]
    rows = [(i, b) for i, b in enumerate(base)]
    rows += [(100 + i, base[i % 12]) for i in range(12)]  # copies
    rows += [(200 + i, base[i][:150] + "X" + base[i][150:]) for i in range(12)]  # edits
    rows += [(300 + i, text(10) + " " + rng.choice(shared) + " " + text(10)) for i in range(40)]  # passages
    rows += [(400, "From " * 300), (401, "From " * 100 + "end"), (402, "a" * 500), (403, "a" * 99), (404, "a" * 100), (5, base[7])]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), limit)


def test_edges(edges, none):
    check(edges)
    assert dedup.remove_repeats(none).count() == 0


def test_repeated_rows_are_marked_once(spark, monkeypatch):
    """Marks do not grow with the rows that repeat an id and a text."""
    monkeypatch.setattr(dedup, "COPIES", 7)
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    part, other = text(400), text(300)
    one = [(None, part + text(50) + part + text(60) + part), (1, other + part), (2, other)]

    def marks(rows):
        staged = dedup.staged_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
        return staged.count(), sorted(map(tuple, dedup.marked_windows(staged).collect()))

    many = one[:1] * 40 + one[1:2] * 3 + one[2:] + [(None, None)] * 9
    assert marks(many) == (4, marks(one)[1])
    check(spark.createDataFrame(many, "doc_id long, text string").repartition(4))


def test_only_ids_with_several_texts_carry_a_hash(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "c"), (None, "a"), (4, None)]
    staged = dedup.staged_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = {(r.doc_id, bytes(r.text)): (r.hash != 0, r.copies) for r in staged.collect()}
    assert got == {(1, b"a"): (True, 1), (1, b"b"): (True, 1), (2, b"a"): (False, 2), (3, b"c"): (False, 1), (None, b"a"): (True, 1), (4, b""): (False, 1)}
