"""Hand-made edge rows for the cleaning chain and the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from slawatch.functions import scalar as S
from slawatch.operators.cleaning import (
    MissingColumnsError,
    cleaning_report,
    standardize_columns,
    unify_issues,
)
from slawatch.schemas import RAW_COLUMN_MAP, UNIFIED_COLUMNS

RAW_COLS = list(RAW_COLUMN_MAP)


def raw_frame(spark, rows):
    schema = StructType([StructField(c, StringType(), True) for c in RAW_COLS])
    return spark.createDataFrame(rows, schema)


def row(key="1", created="2019-01-02 03:04:05", closed=None, cat="Noise", desc="Loud",
        borough="BROOKLYN", status="Closed", city="NYC", channel="PHONE"):
    return (key, created, closed, cat, desc, borough, status, city, channel)


def test_date_formats_parse_or_null(spark):
    df = spark.createDataFrame([("01/02/2019 03:04:05 PM",), ("2019-01-02",), ("bad",), (None,),
                                ("2019-01-02 03:04:05.123456",)], ["s"])
    got = [r[0] for r in df.select(S.parse_timestamp("s")).collect()]
    assert got[0] == dt.datetime(2019, 1, 2, 15, 4, 5)
    assert got[1] == dt.datetime(2019, 1, 2)
    assert got[2] is None and got[3] is None
    assert got[4] == dt.datetime(2019, 1, 2, 3, 4, 5, 123456)


def test_na_spellings_become_null_but_unspecified_stays(spark):
    vals = ["", "NA", "N/A", "null", "None", "nan", "Unspecified", "x"]
    df = spark.createDataFrame([(v,) for v in vals], ["s"])
    got = [r[0] for r in df.select(S.null_if_na("s")).collect()]
    assert got == [None] * 6 + ["Unspecified", "x"]


def test_missing_spelling_triggers_region_fallback(spark):
    out = unify_issues(raw_frame(spark, [row(borough="N/A", city="QUEENS"),
                                         row(key="2", borough=None, city=None),
                                         row(key="3", borough="Unspecified")])).orderBy("issue_id")
    assert [r.region for r in out.collect()] == ["QUEENS", "UNKNOWN", "Unspecified"]


def test_required_columns_error_and_optional_added(spark):
    df = spark.createDataFrame([("1", "2019-01-01", "Noise")], ["Unique Key", "Created Date", "Complaint Type"])
    out = standardize_columns(df)
    for c in ["resolved_at", "raw_subcategory", "region", "status", "city", "raw_channel"]:
        assert c in out.columns
    with pytest.raises(MissingColumnsError):
        standardize_columns(df.drop("Complaint Type"))


def test_text_trim_tabs_and_blank_parts(spark):
    out = unify_issues(raw_frame(spark, [row(cat="\tNoise  ", desc=" Loud  Music\t"),
                                         row(key="2", cat="  ", desc=None)]))
    texts = {r.issue_id: r.issue_text for r in out.collect()}
    assert texts["1"] == "Noise - Loud  Music"   # inner spaces kept
    assert texts["2"] == " - "                    # never blank: not dropped by default
    strict = unify_issues(raw_frame(spark, [row(cat="  ", desc=None)]), strict=True)
    assert strict.count() == 0


def test_sla_hours_and_flag(spark):
    rows = [row(key="neg", created="2019-01-02 00:00:00", closed="2019-01-01 00:00:00"),
            row(key="72h", created="2019-01-01 00:00:00", closed="2019-01-04 00:00:00"),
            row(key="73h", created="2019-01-01 00:00:00", closed="2019-01-04 01:00:00"),
            row(key="open", created="2019-01-01 00:00:00", closed=None),
            row(key="undated", created="bad")]
    out = {r.issue_id: r for r in unify_issues(raw_frame(spark, rows)).collect()}
    assert "undated" not in out
    assert out["neg"].resolution_hours == -24.0 and out["neg"].sla_breached is False
    assert out["72h"].resolution_hours == 72.0 and out["72h"].sla_breached is False
    assert out["73h"].sla_breached is True
    assert out["open"].resolution_hours is None and out["open"].sla_breached is False
    assert out["open"].channel == "PHONE"
    assert list(unify_issues(raw_frame(spark, rows)).columns) == UNIFIED_COLUMNS


def test_channel_default_and_source(spark):
    out = unify_issues(raw_frame(spark, [row(channel=None)])).first()
    assert out.channel == "311" and out.source_system == "nyc_311_2019" and out.sla_hours_target == 72


def test_cleaning_report_counts(spark):
    rows = [row(), row(key="2", created="bad"), row(key="3", cat=" ", desc=None)]
    r = cleaning_report(raw_frame(spark, rows)).first()
    assert (r.raw_rows, r.dropped_undated, r.dropped_blank_text, r.clean_rows) == (3, 1, 0, 2)
    r2 = cleaning_report(raw_frame(spark, rows), strict=True).first()
    assert (r2.dropped_blank_text, r2.clean_rows) == (1, 1)


def test_risk_buckets(spark):
    vals = [None, 0.0, 0.2, 0.4, 0.6, 0.8, 1.0, float("nan"), 0.19999]
    df = spark.createDataFrame([(v,) for v in vals], StructType([StructField("p", DoubleType())]))
    got = [r[0] for r in df.select(S.risk_bucket("p")).collect()]
    assert got == ["unknown", "very_low", "low", "medium", "high", "very_high", "very_high",
                   "very_high", "very_low"]


def test_positive_prob_by_label_not_position(spark):
    df = spark.sql("""SELECT array(named_struct('label', true, 'prob', 0.7D),
                                   named_struct('label', false, 'prob', 0.3D)) AS a,
                             array(named_struct('label', false, 'prob', 0.3D),
                                   named_struct('label', true, 'prob', 0.7D)) AS b,
                             array(named_struct('label', false, 'prob', 1.0D)) AS c""")
    r = df.select(S.positive_prob("a"), S.positive_prob("b"), S.positive_prob("c")).first()
    assert r[0] == 0.7 and r[1] == 0.7 and r[2] is None


def test_risk_prob_safe_cast(spark):
    df = spark.sql("SELECT named_struct('label', true, 'prob', '0.25') AS s, "
                   "named_struct('label', true, 'prob', 'x') AS t")
    r = df.select(S.risk_prob("s"), S.risk_prob("t")).first()
    assert r[0] == 0.25 and r[1] is None


def test_calendar_bases(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 0, 0),), (dt.datetime(2024, 1, 8, 23, 59),)], ["t"])
    got = df.select(S.dow_monday0("t"), S.dow_sunday1("t"), F.hour("t")).collect()
    assert tuple(got[0]) == (6, 1, 0)     # Sunday, midnight
    assert tuple(got[1]) == (0, 2, 23)    # Monday


def test_null_non_finite_all_float_columns(spark):
    df = spark.createDataFrame([(float("nan"), float("inf"), 1.0, "NaN")], ["a", "b", "c", "s"])
    r = S.null_non_finite(df).first()
    assert r.a is None and r.b is None and r.c == 1.0 and r.s == "NaN"


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],), ([0.9, 0.0],)], ["v"])
    assert [r[0] for r in df.select(S.argmax_index("v")).collect()] == [1, 0]


def test_strip_like_python(spark):
    s = "\t  a b \n"
    df = spark.createDataFrame([(s,)], ["s"])
    assert df.select(S.strip_ws("s")).first()[0] == s.strip()
