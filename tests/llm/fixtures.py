"""Rows that every operator must take: nulls, empty and very long texts,
repeated rows, and columns whose names clash with internal ones."""

import random

EXTRA = "size int, score double, label string, key string, hash string, n int, _row string, part int, tokens string, words int, mark int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def words(n, seed=0, alphabet="abcdefghij"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 8))) for _ in range(n))


def edge_rows():
    long = words(40_000, 5)
    texts = [
        (1, "Plain words here, and some more of them.", "src0"), (2, None, "src0"), (3, "", None), (4, "   \n\t ", "src1"),
        (5, long, "src1"), (6, "a" * 200_000, "src1"), (7, words(120, 1), None), (8, words(120, 1), "src0"),
        (9, words(119, 1) + " x", "src2"), (None, words(60, 2), "src2"), (None, None, None), (None, words(60, 3), ""),
        (10, "É中😀 mixed \u00a0 blanks\x0b\x0c end", ""), (11, "same row twice", "src0"), (11, "same row twice", "src0"),
        (12, "same id, first text", "src1"), (12, "same id, other text", "src1"), (13, "0 " * 5000, "src2"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), 1, 0.5, "x", "k", "h", 2, "r", 3, "t", 4, 5) for i, t, s in texts]


def edge_documents(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
