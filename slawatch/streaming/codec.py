"""Keyed JSON records of issues: encode (publish) and decode (ingest).

The same column expressions run on a batch DataFrame and on a streaming
one, so a batch round trip checks exactly what the stream does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalar import nan_text_to_null, non_finite_to_null, parse_timestamp
from ..schemas import ENRICHED_COLUMNS, ISSUE_EVENT_SCHEMA

TS_JSON = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CORRUPT = "_corrupt_record"


def to_kafka_records(df: DataFrame, key: str = "issue_id") -> DataFrame:
    """(key, value): the id as text and the row as one JSON object.

    Timestamps keep microseconds; null fields are omitted (the reader
    restores them as null)."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                      {"timestampFormat": TS_JSON, "ignoreNullFields": "true"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def _string_fields():
    return [f.name for f in ISSUE_EVENT_SCHEMA.fields
            if f.dataType.simpleString() == "string" and f.name != "sla_breached"]


def text_to_flag(c) -> F.Column:
    """A JSON flag read as text: true / false, bare or quoted, any case;
    anything else (NaN, missing) is null."""
    v = F.lower(F.regexp_replace(c, '"', ""))
    return F.when(v == "true", F.lit(True)).when(v == "false", F.lit(False)).otherwise(F.lit(None))


def parse_issue_events(records: DataFrame, value_col: str = "value",
                       key_col: str | None = "key", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode JSON values into typed enriched-issue columns.

    Numbers are parsed as double so bare ``NaN`` / ``Infinity`` survive and
    become null; a ``NaN`` that landed in a text field is nulled too; the id
    is text whatever its JSON type, and falls back to the record key.
    Undecodable lines keep their text in ``_corrupt_record``; columns in
    ``keep`` (e.g. the ingest time) pass through.
    """
    schema = StructType(ISSUE_EVENT_SCHEMA.fields + [StructField(CORRUPT, StringType(), True)])
    opts = {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.select(*([F.col(key_col).cast("string").alias("_key")] if key_col else []),
                            *[F.col(c) for c in keep],
                            F.from_json(F.col(value_col).cast("string"), schema, opts).alias("j"))
    j = F.col("j")
    cols = {}
    for name in _string_fields():
        cols[name] = nan_text_to_null(j.getField(name))
    if key_col:
        cols["issue_id"] = F.coalesce(cols["issue_id"], F.col("_key"))
    num = {name: non_finite_to_null(j.getField(name))
           for name in ["sla_hours_target", "resolution_hours", "hour", "dow", "topic_id", "text_len", "word_count"]}
    out = parsed.select(
        cols["issue_id"].alias("issue_id"),
        parse_timestamp(cols["created_at"]).alias("created_at"),
        parse_timestamp(cols["resolved_at"]).alias("resolved_at"),
        *[cols[c].alias(c) for c in ["raw_category", "raw_subcategory", "region", "status", "city",
                                     "raw_channel", "issue_text", "channel", "source_system"]],
        num["sla_hours_target"].cast("int").alias("sla_hours_target"),
        num["resolution_hours"].alias("resolution_hours"),
        text_to_flag(j.getField("sla_breached")).alias("sla_breached"),
        F.to_date(cols["date"]).alias("date"),
        num["hour"].cast("int").alias("hour"),
        num["dow"].cast("int").alias("dow"),
        num["topic_id"].cast("int").alias("topic_id"),
        cols["topic_keywords"].alias("topic_keywords"),
        num["text_len"].cast("long").alias("text_len"),
        num["word_count"].cast("long").alias("word_count"),
        cols["issue_keyword"].alias("issue_keyword"),
        j.getField(CORRUPT).alias(CORRUPT),
        *[F.col(c) for c in keep],
    )
    return out


def good_events(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decoded rows (an id present, the line parsed): enriched columns and
    the pass-through ones."""
    ok = F.col(CORRUPT).isNull() & F.col("issue_id").isNotNull()
    return parsed.filter(ok).select(*ENRICHED_COLUMNS, *keep)


def bad_events(parsed: DataFrame) -> DataFrame:
    """Quarantine: undecodable lines or rows without an id."""
    return parsed.filter(F.col(CORRUPT).isNotNull() | F.col("issue_id").isNull())
