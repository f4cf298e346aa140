"""From raw documents to a token corpus.

Five stages, each an operator of ``slawatch.llm`` applied to all that the
stage before it kept: documents of poor quality go; of near-duplicates one
stays; documents that hold benchmark passages go; sources are mixed to their
target weights (documents repeated or cut as the mix takes them); the mix is
encoded to token ids. Every stage is written to the shared folder and read
again, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slawatch.llm import decontaminate, mixing, quality, simhash, tokens
from slawatch.llm.base import remainder, table, workers_import
from slawatch.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps (rule ensemble, learned
    from the labels whose crc32 is not in the held-out fifth)."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) == 0)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    workers_import(spark)
    return simhash.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    workers_import(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at the target weights: whole documents as often as they are
    taken, and the parts that complete a source's quota."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids, in files by ``doc_id``, read back."""
    workers_import(spark)
    return tokens.digests(tokens.store(docs), keep=("tokens",))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", clean_of_benchmarks),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

#: Learned rules and 64-bit fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: ``doc_id``, ``start``, ``n_tokens``,
    ``ids_crc32`` and ``tokens`` of every document of the mix."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
