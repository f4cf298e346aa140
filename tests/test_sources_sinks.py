"""File sources and sinks, observation counts, formats, stream dedupe."""

import datetime as dt
import os

from pyspark.sql import Observation

from slawatch.functions import scalar as S
from slawatch.operators.cleaning import unify_issues
from slawatch.operators.reports import as_csv_rows
from slawatch.session import scratch_path
from slawatch.sinks.tables import replace_table, write_issues
from slawatch.sources.files import load_mart, read_issues, read_raw_issues
from slawatch.sources import testdata as td
from slawatch.streaming.ingest import dedupe_stream

CSV = """Unique Key,Created Date,Closed Date,Agency,Complaint Type,Descriptor,Borough,Status,City,Open Data Channel Type,Extra
1,01/02/2019 03:04:05 PM,01/05/2019 03:04:05 PM,NYPD,Noise,"Loud, music",BROOKLYN,Closed,NYC,PHONE,x
2,bad,,NYPD,Noise,Loud,N/A,Open,QUEENS,,y
3,2019-01-03 00:00:00,,DOT,Street,"",Unspecified,Open,,ONLINE,z
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_raw_csv_scan_subset_and_limit(spark, tmp_dir):
    p = os.path.join(tmp_dir, "raw", "a.csv")
    _write(p, CSV)
    raw = read_raw_issues(spark, p)
    assert "Agency" not in raw.columns and "Extra" not in raw.columns and len(raw.columns) == 9
    assert raw.count() == 3
    assert read_raw_issues(spark, p, limit=2).count() == 2
    obs = Observation("clean")
    out = {r.issue_id: r for r in unify_issues(raw, observation=obs).collect()}
    assert set(out) == {"1", "3"}
    assert obs.get["dropped_undated"] == 1 and obs.get["rows_in"] == 3
    assert out["1"].raw_subcategory == "Loud, music" and out["1"].resolution_hours == 72.0
    assert out["3"].region == "Unspecified" and out["3"].raw_subcategory == ""


def test_write_and_read_issues_csv_and_parquet(spark, tmp_dir):
    en = td.enriched_issues(spark, "/root/testdata/sf0.001")
    for fmt in ("csv", "parquet"):
        path = os.path.join(tmp_dir, f"en_{fmt}")
        write_issues(en, path, fmt=fmt)
        back = read_issues(spark, path, fmt=fmt)
        assert back.count() == en.count()
        assert back.select("issue_id", "created_at", "sla_breached").exceptAll(
            en.select("issue_id", "created_at", "sla_breached")).count() == 0


def test_replace_table_dynamic_partitions(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    name = "replace_test_tbl"
    first = spark.createDataFrame([("a", 1, d1), ("b", 2, d2)], "k string, v int, day date")
    replace_table(first, name, partition_by="day")
    replace_table(spark.createDataFrame([("c", 3, d2)], "k string, v int, day date"), name, partition_by="day")
    got = sorted((r.k, r.day) for r in spark.table(name).collect())
    assert got == [("a", d1), ("c", d2)]          # only day 2 was replaced


def test_load_mart_bound_parameters(spark):
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    mart = spark.createDataFrame([(x, "A", 1, 0.0, 0.1, 0.0, 1, 0, 0, 0, 0) for x in d],
                                 "issue_date date, region string, total_issues long, sla_breach_rate double, "
                                 "avg_risk_score double, high_risk_share double, cnt_very_low long, "
                                 "cnt_low long, cnt_medium long, cnt_high long, cnt_very_high long")
    assert load_mart(spark, mart, "2024-01-02", "2024-01-03").count() == 2
    assert load_mart(spark, mart, "2024-01-02", "2024-01-03", all_buckets=False).columns[-1] == "cnt_medium"
    assert load_mart(spark, mart, "2030-01-01", "2030-01-02").count() == 0


def test_csv_rows_and_formats(spark):
    df = spark.createDataFrame([("A", 1234, 0.1234)], ["region", "n", "rate"])
    assert as_csv_rows(df).first().csv == "A,1234,0.1234"
    r = df.select(S.format_count("n"), S.format_pct("rate"), S.format_fixed("rate")).first()
    assert tuple(r) == ("1,234", "12.3%", "0.12")


def test_stream_dedupe_within_watermark(spark):
    src = scratch_path(spark, "dedupe-src")
    rows = spark.createDataFrame([("1", dt.datetime(2024, 1, 1, 0, 0)), ("1", dt.datetime(2024, 1, 1, 0, 5)),
                                  ("2", dt.datetime(2024, 1, 1, 0, 6))], "issue_id string, ingested_at timestamp")
    rows.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    q = (dedupe_stream(stream, delay="1 hour").writeStream.format("memory").queryName("dedupe_out")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.issue_id for r in spark.table("dedupe_out").collect())
    assert got == ["1", "2"]


def test_views_for_sql_readers(spark):
    from slawatch.operators.mart import create_views

    create_views(td.scored_issues(spark, "/root/testdata/sf0.001"), "stg_v", "mart_v")
    n = spark.sql("SELECT count(*) FROM stg_v").first()[0]
    assert spark.sql("SELECT sum(total_issues) FROM mart_v").first()[0] == n


def test_raw_files_with_other_columns_are_an_error(spark, tmp_dir):
    import pytest

    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('Unique Key,Created Date,Complaint Type\n1,2024-01-01 00:00:00,"two\nlines"\n')
    one = read_raw_issues(spark, tmp_dir).collect()
    assert len(one) == 1 and one[0]["Complaint Type"] == "two\nlines"
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("Created Date,Unique Key,Complaint Type\n2024-01-01 00:00:00,2,x\n")
    with pytest.raises(Exception, match="[Hh]eader"):
        read_raw_issues(spark, tmp_dir).collect()
