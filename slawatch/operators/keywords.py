"""Most informative word per text (tf-idf), over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MIN_TOKEN_LETTERS, NON_LETTERS, clean_text, stop_words, text_len, word_count
from ..schemas import FREQUENT_TOKENS
from ..session import cut_lineage
from .incremental import keyed, spread_null_key


def text_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Length in characters, number of words, and the cleaned text."""
    return df.select(id_col,
                     text_len(text_col).alias("text_len"),
                     word_count(text_col).alias("word_count"),
                     clean_text(text_col).alias("clean_text"))


def term_frequencies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token, tf). Each text is split once and exploded, then
    filtered by plain predicates (the stop list becomes a hash-set lookup
    inside whole-stage codegen). The explode and the partial count run in
    the scan's map stage, so a text's repeated words are combined before
    the shuffle."""
    # One regex pass: split the lower-cased text on runs of non-letters (the
    # same words as normalising first; empty edge pieces fail the length test).
    tokens = df.select(id_col, F.explode(F.split(F.lower(F.col(text_col)), NON_LETTERS)).alias("token"))
    keep = (F.length("token") >= MIN_TOKEN_LETTERS) & ~F.col("token").isin(list(stop_words()))
    return tokens.filter(keep).groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("tf"))


def issue_keyword(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  digits: int = 6) -> DataFrame:
    """Per text: the token with the highest ``tf * ln((n + 1) / (df + 1))``
    (rounded to ``digits``), ties to the alphabetically first token.

    The texts are dealt by id before they are split, so the shuffle carries
    them instead of their words, and the words of an id are counted where
    they are split. The (id, token, tf) rows are written once under the shared checkpoint
    folder, so the texts are split once, and so are the document
    frequencies: the joins then read stored tables, which the planner can
    broadcast by measured size or, for a very common token, AQE can split (it
    does not split a side that is an aggregate above its own exchange). The
    ``FREQUENT_TOKENS`` most frequent tokens, most of all rows, are stored
    apart: a table of bounded size that is broadcast, so only the rows of
    rarer tokens are shuffled by token. ``n`` is a scalar subquery, not a
    cross join. Texts without any token get no row.
    """
    # A given number of tasks: texts are small beside their words, and AQE
    # would coalesce them by their own bytes.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(id_col, text_col).repartition(tasks, id_col)
    tf = cut_lineage(term_frequencies(texts, id_col, text_col), "keyword-tf")
    dfreq = cut_lineage(tf.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "keyword-df")
    n = df.select(F.count(F.lit(1))).scalar()
    if dfreq.count() <= FREQUENT_TOKENS:
        return best_keywords(tf, dfreq, n, id_col, digits)
    frequent = cut_lineage(dfreq.orderBy(F.desc("df"), "token").limit(FREQUENT_TOKENS), "keyword-frequent")
    rare = tf.join(frequent, "token", "left_anti")
    return _best(_scored(tf, frequent, n, digits).unionByName(_scored(rare, dfreq, n, digits)), id_col)


def best_keywords(tf: DataFrame, dfreq: DataFrame, n: Column, id_col: str = "doc_id", digits: int = 6) -> DataFrame:
    """(id, keyword, score) from (id, token, tf) rows, (token, df) rows and
    the number of texts."""
    return _best(_scored(tf, dfreq, n, digits), id_col)


def _scored(tf: DataFrame, dfreq: DataFrame, n: Column, digits: int) -> DataFrame:
    idf = F.log((n + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return tf.join(dfreq, "token").withColumn("score", F.round(F.col("tf") * idf, digits))


def _best(scored: DataFrame, id_col: str) -> DataFrame:
    best = scored.groupBy(id_col).agg(
        F.min(F.struct((-F.col("score")).alias("neg_score"), F.col("token"))).alias("b"))
    return best.select(id_col, F.col("b.token").alias("keyword"), (-F.col("b.neg_score")).alias("score"))


def with_text_features(issues: DataFrame, key: str = "issue_id", text_col: str = "issue_text") -> DataFrame:
    """Issues with ``text_len``, ``word_count`` and ``issue_keyword`` (null
    where the text has no token, or the row no key)."""
    words = keyed(issue_keyword(issues.filter(F.col(key).isNotNull()), key, text_col), key,
                  F.col("keyword").alias("issue_keyword"))
    wide = issues.drop("text_len", "word_count", "issue_keyword").withColumns({"text_len": text_len(text_col), "word_count": word_count(text_col)})
    return spread_null_key(wide, key).join(words, ["_k", "_none"], "left").drop("_k", "_none")
