import datetime as dt

import pytest
from pyspark.sql import functions as F

from tandem.functions import dates as D


@pytest.mark.parametrize("as_of,cutoff,floor,start,end", [
    # week start of (as_of - 1 year) equal to the cut-off -> floor branch
    (dt.date(2023, 3, 22), dt.date(2022, 3, 20), dt.date(2022, 3, 21), dt.date(2022, 3, 21), dt.date(2023, 3, 21)),
    # one week later the Sunday is after the cut-off -> 3 months back
    (dt.date(2023, 3, 29), dt.date(2022, 3, 20), dt.date(2022, 3, 21), dt.date(2022, 12, 29), dt.date(2023, 3, 28)),
    # the two cut-offs of the reference differ for the same run date
    (dt.date(2023, 6, 1), dt.date(2022, 3, 21), dt.date(2022, 3, 21), dt.date(2023, 3, 1), dt.date(2023, 5, 31)),
    (dt.date(2023, 6, 1), dt.date(2022, 8, 21), dt.date(2022, 3, 21), dt.date(2022, 3, 21), dt.date(2023, 5, 31)),
    # month-end clamp: May 31 - 3 months = Feb 29 in a leap year
    (dt.date(2024, 5, 31), dt.date(2020, 1, 1), dt.date(2019, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 5, 30)),
    # leap day run date: one year back is Feb 28
    (dt.date(2024, 2, 29), dt.date(2023, 2, 26), dt.date(2022, 3, 21), dt.date(2022, 3, 21), dt.date(2024, 2, 28)),
])
def test_date_window(spark, as_of, cutoff, floor, start, end):
    s, e = D.date_window(F.lit(as_of), cutoff, floor)
    row = spark.range(1).select(s.alias("s"), e.alias("e")).first()
    assert (row.s, row.e) == (start, end)
    assert D.date_window_values(as_of, cutoff, floor) == (start, end)


def test_sunday_week_start(spark):
    days = [dt.date(2024, 3, 17) + dt.timedelta(days=i) for i in range(8)]  # Sun .. next Sun
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w for r in df.select(D.sunday_week_start("d").alias("w")).collect()]
    assert got == [dt.date(2024, 3, 17)] * 7 + [dt.date(2024, 3, 24)]


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_boundary_diff_counts_crossed_seconds(spark):
    rows = [(_ts("2024-01-01 00:00:00.900"), _ts("2024-01-01 00:00:01.100")),   # 1 boundary, 0.2 s
            (_ts("2024-01-01 00:00:01.100"), _ts("2024-01-01 00:00:00.900")),   # negative
            (_ts("2024-01-01 00:00:00.000"), _ts("2024-01-01 00:00:00.999")),   # none crossed
            (None, _ts("2024-01-01 00:00:00"))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [tuple(r) for r in df.select(D.boundary_diff("b", "a").alias("s"),
                                       D.truncated_ms_sec("b", "a").alias("ms")).collect()]
    assert got == [(1, 0.0), (-1, -0.0), (0, 0.0), (None, None)]


def test_dst_gap_and_overlap_dublin(spark):
    rows = [(_ts("2024-03-31 01:30:00"),),   # does not exist locally (clocks go 01:00 -> 02:00)
            (_ts("2024-10-27 01:30:00"),),   # exists twice; the earlier offset (+1) is used
            (_ts("2024-07-01 12:00:00"),),
            (_ts("2024-01-01 12:00:00"),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r.u for r in df.select(D.local_to_utc("t", F.lit("Europe/Dublin")).alias("u")).collect()]
    assert got == [_ts("2024-03-31 01:30:00"), _ts("2024-10-27 00:30:00"),
                   _ts("2024-07-01 11:00:00"), _ts("2024-01-01 12:00:00")]
    back = [r.b for r in df.select(D.utc_to_local(D.local_to_utc("t", F.lit("Europe/Dublin")),
                                                  F.lit("Europe/Dublin")).alias("b")).collect()]
    assert back[2:] == [_ts("2024-07-01 12:00:00"), _ts("2024-01-01 12:00:00")]


def test_elapsed_with_and_without_zone_shift_differ_across_clock_change(spark):
    df = spark.createDataFrame([(_ts("2024-03-31 00:30:00"), _ts("2024-03-31 02:30:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(D.elapsed_sec("b", "a", F.lit("Europe/Dublin")).alias("z"),
                  D.elapsed_sec("b", "a").alias("plain")).first()
    assert (r.z, r.plain) == (3600, 7200)


def test_session_time_zone_does_not_matter(spark):
    df = spark.createDataFrame([(_ts("2024-06-01 10:00:00.5"), _ts("2024-06-01 10:00:02.25"))],
                               "a timestamp_ntz, b timestamp_ntz")
    exprs = [D.elapsed_sec("b", "a", F.lit("Europe/London")).alias("s"),
             D.trunc_to_second("b").alias("t"), D.add_minutes("a", F.lit(90)).alias("m")]
    base = tuple(df.select(*exprs).first())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert tuple(df.select(*exprs).first()) == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
