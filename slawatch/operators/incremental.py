"""Incremental operators: what is new, attach predictions, merge streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import positive_score
from ..schemas import FACT_COLUMNS


#: Rows without a key are spread over this many join keys.
NULL_SALTS = 1024


def spread_null_key(df: DataFrame, key: str) -> DataFrame:
    """Add ``_k`` (the key as text, or a salt where it is null) and ``_none``
    (whether it is null): a join on both never matches a null key, and a
    flood of null keys is spread over many tasks in the same single pass."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(NULL_SALTS)).cast("string")
    return df.withColumns({"_k": F.coalesce(F.col(key).cast("string"), salt), "_none": F.col(key).isNull()})


def keyed(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """The other side of such a join: rows with a key, and ``cols``."""
    return df.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("_k"), F.lit(False).alias("_none"), *cols)


def new_issues(enriched: DataFrame, scored: DataFrame, key: str = "issue_id") -> DataFrame:
    """Enriched rows whose key is not in the scored fact (anti-join over all
    history, so exact whatever else changed in a row).

    Rows with a null key can never match and are kept. Each input is read
    once; only the key column of the fact is read, and the planner picks
    broadcast or sort-merge anti-join from the runtime size.
    """
    left = spread_null_key(enriched, key)
    return left.join(keyed(scored, key), ["_k", "_none"], "left_anti").select(*enriched.columns)


def batch_days(batch: DataFrame, day_col: str) -> list:
    """The distinct days of a batch (bounded by the calendar, not by the
    data: a daily batch spans a few days); None stands for rows without."""
    days = [r[0] for r in batch.select(day_col).distinct().collect()]
    return sorted(d for d in days if d is not None) + [None] * (None in days)


def on_days(day_col: str, days: list) -> F.Column:
    """Rows of the given days (None: rows without a day)."""
    some = F.col(day_col).isin([d for d in days if d is not None])
    return F.coalesce(some, F.lit(False)) | F.col(day_col).isNull() if None in days else F.coalesce(some, F.lit(False))


def new_issues_by_day(enriched: DataFrame, scored: DataFrame, key: str = "issue_id",
                      day_col: str = "date", fact_day_col: str = "issue_date") -> DataFrame:
    """Opt-in: ``new_issues`` reading only the fact partitions of the batch's
    days. Exact only where an issue's day never changes (a corrected creation
    time would hide its scored copy); a batch with undated rows is checked
    against all history. The jobs use ``new_issues``.
    """
    days = batch_days(enriched, day_col)
    recent = scored if None in days else scored.filter(on_days(fact_day_col, days))
    return new_issues(enriched, recent, key)


def attach_predictions(issues: DataFrame, preds: DataFrame, key: str = "issue_id") -> DataFrame:
    """Inner equi-join of an external prediction table to its inputs.

    ``preds`` carries ``predicted_label`` and ``probs`` (array of
    ``struct<label, prob>``); the kept ``risk_score`` is the element of the
    positive label, picked by label rather than by position.
    """
    p = preds.select(key, "predicted_label",
                     positive_score(F.col("probs")).alias("risk_score"))
    return issues.filter(F.col(key).isNotNull()).join(p, key, "inner")


def to_fact(scored: DataFrame) -> DataFrame:
    """Fact column order with the ``issue_date`` partition column last."""
    if "issue_date" not in scored.columns:
        scored = scored.withColumn("issue_date", F.to_date("created_at"))
    return scored.select(FACT_COLUMNS)


def union_issues(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Batch rows and streamed rows as one frame (columns by name; a column
    missing on one side is null there)."""
    return batch.unionByName(stream, allowMissingColumns=True)


def latest_per_key(df: DataFrame, key: str = "issue_id",
                   order_cols: tuple[str, ...] = ("ingested_at",)) -> DataFrame:
    """Keep one row per key: the greatest by ``order_cols`` (then by a hash
    of the whole row, so ties resolve the same way on every run).

    Written as an aggregate (``max_by``), not a window: the partial
    aggregate runs map-side, so a key repeated a billion times is reduced in
    the map tasks before the shuffle instead of being sorted in one task.
    Rows without a key are not merged with each other: each gets a key of
    its own, in the same single pass.
    """
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    order = F.struct(*[F.col(c) for c in order_cols], F.xxhash64(*[F.col(c) for c in cols]))
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return (df.withColumn("_own", own).groupBy(F.col(key).alias("_k"), "_own")
              .agg(F.max_by(row, order).alias("_r"))
              .select([F.col("_r").getField(c).alias(c) for c in cols]))


def merge_stream_by_day(enriched: DataFrame, stream: DataFrame, key: str = "issue_id",
                        ingested_col: str = "ingested_at", day_col: str = "date") -> DataFrame:
    """``merge_stream`` that only aggregates the days the stream touches: the
    days of its rows and the days on which the table holds its ids (found by
    a semi-join on the id column), so a row whose day changed is replaced.
    Rows of other days pass through untouched (no shuffle, no sort)."""
    days = touched_days(enriched, stream, key, day_col)
    rest = enriched.filter(~on_days(day_col, days))
    merged = merge_stream(enriched.filter(on_days(day_col, days)), stream, key, ingested_col)
    return rest.unionByName(merged, allowMissingColumns=True)


def touched_days(table: DataFrame, stream: DataFrame, key: str, day_col: str) -> list:
    """Days of ``table`` that an upsert of ``stream`` changes."""
    held = table.select(key, day_col).join(stream.select(key).distinct(), key, "left_semi")
    return batch_days(stream.select(day_col).unionByName(held.select(day_col)), day_col)


def merge_stream(enriched: DataFrame, stream: DataFrame, key: str = "issue_id",
                 ingested_col: str = "ingested_at") -> DataFrame:
    """Upsert streamed rows into the enriched table: one row per key, the
    newest ingest wins. The ingest time is part of the result, so a later
    replay of an older event loses against it; rows without one (batch rows)
    count as ingested before any stream row."""
    b = enriched.withColumn(ingested_col, F.lit(None).cast("timestamp")) \
        if ingested_col not in enriched.columns else enriched
    cols = b.columns
    return latest_per_key(b.unionByName(stream.select(*cols)), key, (ingested_col,)).select(cols)
