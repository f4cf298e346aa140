"""File scans: raw CSV, unified / enriched issues, named tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import (
    ISSUES_ENRICHED_SCHEMA,
    ISSUES_UNIFIED_SCHEMA,
    MART_COLUMNS,
    RAW_COLUMN_MAP,
)

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_raw_issues(spark: SparkSession, path: str, limit: int | None = None,
                    multi_line: bool = True) -> DataFrame:
    """Raw CSV with a header, every column as text, only the nine known
    columns kept (column pruning reaches the CSV reader).

    The schema is the header's names, all text (nothing is inferred from
    values); each file's own header is held against it, so a file with other
    or reordered columns is an error, never misread. ``multi_line`` (on by
    default) keeps quoted line breaks, as pandas does, at one task per file;
    switch it off for large splittable files that are known to have none.
    ``limit`` keeps the first ``limit`` rows (off by default).
    """
    reader = (spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
              .option("mode", "PERMISSIVE").option("enforceSchema", False))
    header = reader.csv(path).columns
    schema = StructType([StructField(c, StringType(), True) for c in header])
    df = reader.schema(schema).csv(path)
    df = df.select([F.col(f"`{c}`") for c in RAW_COLUMN_MAP if c in header])
    return df.limit(limit) if limit else df


def read_issues(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: StructType | None = None, enriched: bool = True, multi_line: bool = True) -> DataFrame:
    """Unified or enriched issues written by ``write_issues``. CSV texts may
    hold quoted line breaks (``multi_line``, one task per file; the writer
    makes a file per task); switch it off where there are none."""
    schema = schema or (ISSUES_ENRICHED_SCHEMA if enriched else ISSUES_UNIFIED_SCHEMA)
    if fmt == "csv":
        # Without a separator given, any of \\r, \\n and \\r\\n ends a record, and
        # a lone one inside quotes is kept as it is.
        return (spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
                .option("timestampFormat", CSV_TIMESTAMP).csv(path))
    return spark.read.schema(schema).format(fmt).load(path)


def load_mart(spark: SparkSession, mart: DataFrame, start: dt.date | str,
              end: dt.date | str, all_buckets: bool = True) -> DataFrame:
    """Mart rows with ``start <= issue_date <= end`` through a parameterised
    query (bound parameters, no string splicing). On a table partitioned by
    ``issue_date`` the range prunes partitions."""
    cols = MART_COLUMNS if all_buckets else MART_COLUMNS[:9]
    q = (f"SELECT {', '.join(cols)} FROM {{mart}} "
         "WHERE issue_date BETWEEN CAST(:start AS DATE) AND CAST(:end AS DATE)")
    return spark.sql(q, args={"start": str(start), "end": str(end)}, mart=mart)
