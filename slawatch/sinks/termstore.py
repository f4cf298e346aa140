"""Stored term and document frequencies, added to per batch.

The keyword of a text needs to know in how many texts each word is. Instead
of a pass over all texts for every run, a batch's texts are split once and
their (id, token, tf) rows, document frequencies and number of texts are
stored, each in a folder of the batch's name, which a repeated run of the
batch overwrites. Document frequencies of everything so far are the sum of
the stored ones; keywords of a batch, or of all texts, come from the stored
rows. An id is expected in one batch only (the daily run's new issues are).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keywords import best_keywords, term_frequencies

TF, DF, DOCS = "tf", "df", "docs"


class TermStore:
    """Term statistics under ``path``; one writer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, kind: str, batch: str) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def add_batch(self, df: DataFrame, batch: str, id_col: str = "issue_id", text_col: str = "issue_text") -> None:
        """Store the terms of a batch of texts. ``batch`` names its folder
        (letters, digits, ``-`` and ``_``)."""
        rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        term_frequencies(rows, "id", "text").write.mode("overwrite").parquet(self._folder(TF, batch))
        tf = self.spark.read.parquet(self._folder(TF, batch))
        tf.groupBy("token").agg(F.count(F.lit(1)).alias("df")).write.mode("overwrite").parquet(self._folder(DF, batch))
        # Last: a batch counts once its number of texts is there.
        rows.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(self._folder(DOCS, batch))

    def _read(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{kind}").withColumn("batch", F.col("batch").cast("string"))

    def document_frequencies(self) -> DataFrame:
        """(``token``, ``df``) over all batches."""
        return self._read(DF).groupBy("token").agg(F.sum("df").alias("df"))

    def documents(self) -> int:
        return self._read(DOCS).agg(F.sum("n")).first()[0] or 0

    def keywords(self, batch: str | None = None, digits: int = 6) -> DataFrame:
        """(``id``, ``keyword``, ``score``) of one batch's texts (default: of
        all), by the document frequencies of all batches so far. No text is
        read."""
        tf = self._read(TF)
        if batch is not None:
            tf = tf.filter(F.col("batch") == batch)
        return best_keywords(tf.select("id", "token", "tf"), self.document_frequencies(), F.lit(self.documents()), "id", digits)

    def compact(self, batch: str = "compacted") -> None:
        """Document frequencies of all batches as one; the terms of single
        texts stay where they are. Run it while nothing else writes."""
        old = [r[0] for r in self._read(DF).select("batch").distinct().collect() if r[0] != batch]
        merged = self.document_frequencies()
        n = self.documents()
        stage = f"{self.path}/_compact"
        merged.write.mode("overwrite").parquet(stage)
        self.spark.read.parquet(stage).write.mode("overwrite").parquet(self._folder(DF, batch))
        self.spark.range(1).select(F.lit(n).cast("long").alias("n")).write.mode("overwrite").parquet(self._folder(DOCS, batch))
        for name in old:
            for kind, schema in ((DF, "token string, df long"), (DOCS, "n long")):
                self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(self._folder(kind, name))
