import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slawatch.llm import tokens

PATH = tokens.default_tokenizer()


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aBt_s'lé ÉÖß\n\t.,-1½²|<>İΣ中😀\u0301\x1c\x85")) | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=4))
def test_pieces_equal_whole_texts(texts):
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in tokens.encode_texts(PATH, texts, end_id=None)]
    assert got == reference(texts)


def test_special_strings_and_memo_limits(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    monkeypatch.setattr(tokens, "MEMO_PIECES", 3)
    texts = ["<|endoftext|>", "a<|endoftext|>b c", "one two three four five", "one two three four five six"]
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in tokens.encode_texts(PATH, texts, end_id=None)] == reference(texts)


def test_round_trip(spark, edges, tmp_dir):
    rows = sorted(((r.doc_id, r.text or "") for r in edges.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    tokens.write_tokens(edges, tmp_dir + "/t", partitions=3, keep=("source",))
    got = tokens.digests(tokens.read_tokens(spark, tmp_dir + "/t"), keep=("tokens",)).collect()
    assert len(got) == len(rows)
    want = sorted(((i is not None, i or 0, zlib.crc32(np.array(e + [2], dtype="<u4").tobytes()), len(e) + 1) for (i, _), e in zip(rows, reference([t for _, t in rows]))))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32, r.n_tokens) for r in got) == want
    # The stream is gapless, in ascending id order.
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and len(r.tokens) == r.n_tokens and r.tokens[-1] == 2
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_file_format(spark, tmp_dir, encoding):
    from fixtures import words

    docs = spark.createDataFrame([(i, words(2000, i)) for i in range(1500)], "doc_id long, text string")
    tokens.write_tokens(docs, tmp_dir + "/f", encoding=encoding, row_group_mb=1, partitions=1)
    (file,) = glob.glob(tmp_dir + "/f/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 2
    for g in range(meta.num_row_groups):
        cols = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
        ids = next(c for p, c in cols.items() if p.startswith("tokens"))
        want = "DELTA_BINARY_PACKED" if encoding == "delta" else "RLE_DICTIONARY"
        assert want in ids.encodings and ids.has_offset_index
        assert cols["doc_id"].has_column_index and cols["doc_id"].statistics.has_min_max
    some = tokens.read_tokens(spark, tmp_dir + "/f", first=700, last=702)
    assert [r.doc_id for r in some.orderBy("doc_id").collect()] == [700, 701, 702]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,700)" in plan
    light = tokens.read_tokens(spark, tmp_dir + "/f", columns=())
    assert "tokens:array" not in light._jdf.queryExecution().executedPlan().toString()


def test_empty(spark, none):
    assert tokens.digests(tokens.store(none)).count() == 0
    with pytest.raises(ValueError):
        tokens.write_tokens(none, "x", encoding="other")


def test_pieces_met_again_are_not_encoded_again(monkeypatch):
    calls, piece = [], tokens._Encoder.piece
    monkeypatch.setattr(tokens._Encoder, "piece", lambda self, p: calls.append(p) or piece(self, p))
    monkeypatch.setattr(tokens, "_loaded", {})
    letters = "abcdefghijklmnop"
    names = ["".join(letters[i >> s & 15] for s in (16, 12, 8, 4, 0)) for i in range(200_000)]
    for blank in (" ", ". "):
        for i in range(0, len(names), 5000):
            tokens.encode_texts(PATH, [blank.join(names[i:i + 5000])])
    assert len([p for p in calls if p not in " ."]) == 200_000


def test_rows_go_together_by_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "TOGETHER", 100)
    texts = ["a" * n for n in (10, 20, 30, 0, 250, 5, 60, 40, 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 2], pa.string())], names=["text"]) for i in range(0, 9, 2)]
    groups = [b.column("text").to_pylist() for b in tokens._together(batches)]
    assert [t for g in groups for t in g] == texts and len(groups) < len(texts)
    assert all(len(g) == 1 or sum(map(len, g)) <= 100 for g in groups)
