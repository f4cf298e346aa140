"""Column-level functions (built-in expressions only, so they stay inside
whole-stage codegen). Each returns a ``Column``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..schemas import (
    HIGH_RISK_BUCKETS,
    NA_SPELLINGS,
    RISK_BUCKET_NULL,
    RISK_BUCKET_TOP,
    RISK_BUCKETS,
    SLA_HOURS_TARGET,
    TEXT_SEPARATOR,
)

# Timestamp layouts accepted by ``parse_timestamp`` besides ISO text (which
# the plain cast reads, with or without fractional seconds).
TIMESTAMP_FORMATS = [
    "MM/dd/yyyy hh:mm:ss a",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy",
]

MICROS_PER_HOUR = 3_600_000_000.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Trim all leading/trailing whitespace (tabs, newlines, unicode spaces),
    like Python's ``str.strip``; Spark's ``trim`` removes spaces only."""
    return F.regexp_replace(_c(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def null_if_na(c: Column | str, spellings: Iterable[str] = NA_SPELLINGS) -> Column:
    """Map the usual missing-value spellings to null (``Unspecified`` stays)."""
    c = _c(c)
    return F.when(c.isin(list(spellings)), F.lit(None)).otherwise(c)


def parse_timestamp(c: Column | str, formats: Iterable[str] = TIMESTAMP_FORMATS) -> Column:
    """Lenient timestamp parse: the first layout that fits wins, bad text is
    null (never an error, also under ANSI mode)."""
    c = _c(c)
    tries = [F.try_to_timestamp(c)] + [F.try_to_timestamp(c, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    """Hours from ``start`` to ``end`` (negative if end is earlier, null if
    either is null), exact to the microsecond."""
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / F.lit(MICROS_PER_HOUR)


def sla_flag(hours: Column | str, target: Column | int = SLA_HOURS_TARGET) -> Column:
    """Breached only if resolved and strictly over target; unresolved -> false."""
    t = target if isinstance(target, Column) else F.lit(target)
    return F.coalesce(_c(hours) > t, F.lit(False))


def issue_text(category: Column | str, subcategory: Column | str,
               sep: str = TEXT_SEPARATOR) -> Column:
    """``strip(category) + " - " + strip(subcategory)`` with nulls as ''."""
    a = strip_ws(F.coalesce(_c(category), F.lit("")))
    b = strip_ws(F.coalesce(_c(subcategory), F.lit("")))
    return F.concat(a, F.lit(sep), b)


def dow_monday0(c: Column | str) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(c)).cast("int")


def dow_sunday1(c: Column | str) -> Column:
    """Day of week with Sunday = 1 .. Saturday = 7."""
    return F.dayofweek(_c(c)).cast("int")


def risk_bucket(p: Column | str) -> Column:
    """Five risk bands plus ``unknown`` for a null score (NaN is very_high)."""
    p = _c(p)
    expr = F.when(p.isNull(), F.lit(RISK_BUCKET_NULL))
    for bound, name in RISK_BUCKETS:
        expr = expr.when(p < F.lit(bound), F.lit(name))
    return expr.otherwise(F.lit(RISK_BUCKET_TOP))


def is_high_risk(bucket: Column | str) -> Column:
    return _c(bucket).isin(HIGH_RISK_BUCKETS)


def risk_prob(score: Column | str) -> Column:
    """Probability field of a ``struct<label, prob>`` as double, or null."""
    return _c(score).getField("prob").try_cast("double")


def positive_prob(probs: Column | str) -> Column:
    """Probability of the positive label from an ``array<struct<label, prob>>``,
    chosen by label rather than by position; null if absent."""
    hit = F.get(F.filter(_c(probs), lambda s: s.getField("label") == F.lit(True)), 0)
    return hit.getField("prob")


def positive_score(probs: Column | str) -> Column:
    """The ``struct<label, prob>`` element of the positive label."""
    return F.get(F.filter(_c(probs), lambda s: s.getField("label") == F.lit(True)), 0)


def non_finite_to_null(c: Column | str) -> Column:
    c = _c(c)
    return F.when(F.isnan(c) | c.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(c)


def null_non_finite(df: DataFrame) -> DataFrame:
    """NaN / +-Infinity -> null in every float and double column."""
    cols = {f.name: non_finite_to_null(F.col(f.name)).cast(f.dataType)
            for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(cols) if cols else df


def nan_text_to_null(c: Column | str) -> Column:
    """A bare ``NaN`` parsed into a string field arrives as ``"NaN"`` text
    (quotes kept) or ``NaN``; both mean missing."""
    c = _c(c)
    return F.when(c.isin("NaN", '"NaN"'), F.lit(None)).otherwise(c)


def argmax_index(arr: Column | str) -> Column:
    """0-based index of the largest element; the first wins on ties."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def join_words(words: Column | str, sep: str = ", ") -> Column:
    return F.array_join(_c(words), sep)


def format_count(c: Column | str) -> Column:
    """``1,234`` style."""
    return F.format_number(_c(c), 0)


def format_pct(c: Column | str, digits: int = 1) -> Column:
    """``12.3%`` style."""
    return F.concat(F.format_number(_c(c) * 100, digits), F.lit("%"))


def format_fixed(c: Column | str, digits: int = 2) -> Column:
    return F.format_number(_c(c), digits)
