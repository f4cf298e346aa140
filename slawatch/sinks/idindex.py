"""The ids of a fact table, bucketed by id, beside the fact.

The fact is laid out by day, but "is this id there already" is asked by id.
The index holds one row per id in buckets of the id's hash, so the anti-join
of a batch shuffles the batch to the buckets and reads the index as it lies:
no exchange on the side that grows. There are as many buckets as
``spark.sql.shuffle.partitions`` says when the index is built, unless given;
with fewer the planner may shuffle both sides.

An append adds up to one file per bucket; ``build_index`` on the index's own
ids rewrites it with one file each now and then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import spread_null_key

KEY = "issue_id"


def index_name(fact_table: str) -> str:
    return f"{fact_table}_ids"


def _write(ids: DataFrame, name: str, buckets: int, mode: str, path: str | None = None) -> None:
    # Dealt by the bucket hash, so a bucket's rows are one file.
    w = (ids.repartition(buckets, KEY).write.format("parquet").mode(mode)
            .bucketBy(buckets, KEY).sortBy(KEY))
    (w.option("path", path) if path else w).saveAsTable(name)


def buckets_of(spark: SparkSession, name: str) -> int:
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    return int(told["data_type"])


def build_index(spark: SparkSession, fact_table: str, buckets: int | None = None) -> str:
    """(Re)build the index from the fact's id column; its name."""
    name = index_name(fact_table)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = spark.table(fact_table).select(F.col(KEY).cast("string").alias(KEY)).filter(F.col(KEY).isNotNull()).distinct()
    _write(ids, name, n, "overwrite")
    return name


def ensure_index(spark: SparkSession, fact_table: str) -> str:
    """The index, built from the fact if there is none yet."""
    name = index_name(fact_table)
    return name if spark.catalog.tableExists(name) else build_index(spark, fact_table)


def not_indexed(rows: DataFrame, index: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is not in the index. Rows without a key never match
    and are spread over many join keys."""
    left = spread_null_key(rows, key)
    right = index.select(F.col(KEY).alias("_id"))
    return left.join(right, (F.col("_k") == F.col("_id")) & ~F.col("_none"), "left_anti").select(*rows.columns)


def add_ids(rows: DataFrame, fact_table: str, once: bool = False) -> None:
    """Add the ids of appended rows. ``once``: only those not there yet (for
    a run that may have added some before it was lost)."""
    spark = rows.sparkSession
    name = index_name(fact_table)
    ids = rows.select(F.col(KEY).cast("string").alias(KEY)).filter(F.col(KEY).isNotNull()).distinct()
    if once:
        ids = not_indexed(ids, spark.table(name))
    _write(ids, name, buckets_of(spark, name), "append")
