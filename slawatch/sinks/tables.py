"""Sinks: files and tables, with idempotent appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.incremental import latest_per_key, merge_stream, new_issues, on_days, to_fact, touched_days

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_issues(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: str | None = None) -> None:
    """Overwrite ``path`` with the rows (CSV with header, no index)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        # Microseconds and outer blanks kept (Spark's CSV defaults drop both).
        w.option("header", True).option("escape", '"') \
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
         .option("timestampFormat", CSV_TIMESTAMP).csv(path)
    else:
        w.format(fmt).save(path)


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions of ``table`` that ``df`` has rows for,
    whatever overwrite mode the session is in."""
    spark = df.sparkSession
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def replace_table(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    """Create or replace a catalog table from the rows. With a partition
    column only the partitions present in ``df`` are replaced. Never point this at a table ``df`` reads from."""
    spark = df.sparkSession
    if partition_by and spark.catalog.tableExists(name):
        overwrite_partitions(df, name)
        return
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.saveAsTable(name)


def create_fact_table(spark, name: str, path: str | None = None) -> None:
    """An empty scored-fact table partitioned by ``issue_date``."""
    from ..schemas import FACT_COLUMNS, ISSUES_ENRICHED_SCHEMA, RISK_SCORE_TYPE
    from pyspark.sql.types import BooleanType, DateType, StructField, StructType

    if spark.catalog.tableExists(name):
        return
    schema = StructType(ISSUES_ENRICHED_SCHEMA.fields + [
        StructField("predicted_label", BooleanType(), True),
        StructField("risk_score", RISK_SCORE_TYPE, True),
        StructField("issue_date", DateType(), True),
    ])
    empty = spark.createDataFrame([], schema).select(FACT_COLUMNS)
    w = empty.write.format("parquet").partitionBy("issue_date")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def append_scored(df: DataFrame, table: str) -> None:
    """Append scored rows to the fact, skipping ids already there (on any
    day) and duplicate ids within the batch, so a rerun appends nothing.

    The insert is by position, so columns are put in fact order first (the
    ``issue_date`` partition column last). Only the fact's id column is read
    for the check; of duplicates the row with the greatest hash stays.
    """
    rows = to_fact(df).filter(F.col("issue_id").isNotNull())
    fresh = new_issues(rows, df.sparkSession.table(table))
    latest_per_key(fresh, "issue_id", ()).write.insertInto(table)


def empty_partitions(spark, table: str, day_col: str, days: list) -> None:
    """Leave no rows on the given days (None: rows without a day)."""
    if not days:
        return
    schema = spark.table(table).schema
    rest = ", ".join(f"`{c}`" for c in schema.names if c != day_col)
    spark.createDataFrame([], schema).createOrReplaceTempView("_emptied")
    for day in days:
        value = "NULL" if day is None else f"DATE '{day}'"
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({day_col} = {value}) SELECT {rest} FROM _emptied")


def upsert_by_day(stream: DataFrame, table: str, key: str = "issue_id", day_col: str = "date",
                  ingested_col: str = "ingested_at", batches: list | None = None) -> int:
    """Merge streamed rows into a table partitioned by day, in place.

    ``table`` holds ``ingested_col``, so replayed older events lose. Touched
    are the days of the streamed rows and the days that hold their ids now
    (rows without a day included). Their merged rows are staged and entered
    in the table's journal first (a table is never overwritten while it is
    being read), then written back partition by partition; a partition that
    all rows have left is emptied. A run that is lost in between is finished
    by the next one (``sinks.journal``). ``batches``: the (query, batch_id)
    pairs that ``stream`` holds, for the ledger. Returns the number of days
    rewritten. Single writer per table.
    """
    from .journal import TableJournal

    spark = stream.sparkSession
    current = spark.table(table)
    if ingested_col not in current.columns:
        raise ValueError(f"{table} must hold {ingested_col!r} to order events")
    journal = TableJournal(spark, table, day_col)
    journal.recover()
    current = spark.table(table)
    days = touched_days(current, stream, key, day_col)
    if not days:
        if batches:
            journal.note_batches(batches)
        return 0
    merged = merge_stream(current.filter(on_days(day_col, days)), stream, key, ingested_col)
    journal.stage(merged.select(current.columns), days, batches)
    journal.recover()
    return len(days)
