import pytest
from pyspark.sql import functions as F

from tandem.functions import buckets as B


def _apply(spark, values, expr_fn, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r.b for r in df.select(expr_fn(F.col("x")).alias("b")).collect()]


def test_slack_ladder_edges(spark):
    vals = [None, -0.5, 0.0, 10.0, 10.5, 11.0, 30.0, 30.5, 40.0, 40.5]
    assert _apply(spark, vals, B.slack_bin) == [
        " N/A", "Early", "0 to 10 Mins", "0 to 10 Mins", " N/A", "11 to 15 Mins", "26 to 30 Mins",
        "30 to 40 Mins", "30 to 40 Mins", ">40 Mins"]
    assert _apply(spark, vals, B.on_time_flag) == [0, 0, 1, 1, 0, 0, 0, 0, 0, 0]


def test_ctod_ladder_gap_at_26(spark):
    secs = [25 * 60, 26 * 60, 27 * 60, -1, None, 0]
    assert _apply(spark, secs, B.ctod_bin, "bigint") == [
        "21 to 25 Mins", " N/A", "> 25 Mins", " N/A", " N/A", "0 to 5 Mins"]


def test_ptov_ladder_gap_at_22_and_asap_guard(spark):
    df = spark.createDataFrame([(21 * 60, 1), (22 * 60, 1), (23 * 60, 1), (60, 0), (None, 1)],
                               "s bigint, a int")
    got = [r.b for r in df.select(B.ptov_bin(F.col("s"), F.col("a")).alias("b")).collect()]
    assert got == ["18 to 21 Mins", " N/A", "> 21 Mins", " N/A", " N/A"]


def test_distance_and_drive_have_no_default(spark):
    assert _apply(spark, [None, -10.0, 2999.0, 3000.0, 21000.0], B.km_bin) == [
        None, None, "0 to 2 KMs", "3 to 5 KMs", "21+ KMs"]
    assert _apply(spark, [None, 20.75, 21.0], B.drive_bin) == [None, "18 to 20 Mins", "21+ Mins"]


def test_ctod_text(spark):
    assert _apply(spark, [-1, 0, 29 * 60 + 59, 30 * 60, None], B.ctod_text, "bigint") == [
        "0", "0", "29", "+30", None]


def test_daypart_complete(spark):
    import datetime as dt
    hours = [dt.datetime(2024, 1, 1, h) for h in range(24)]
    got = _apply(spark, hours, B.daypart, "timestamp_ntz")
    assert None not in got
    assert got[7] == "Breakfast" and got[11] == "Lunch" and got[16] == "Dinner"
    assert got[20] == "After-Dinner" and got[0] == "Overnight" and got[6] == "Overnight"


@pytest.mark.parametrize("rules", [B.SLACK_RULES, B.CTOD_RULES, B.KM_RULES, B.DRIVE_RULES, B.PTOV_RULES])
def test_every_value_gets_one_label(spark, rules):
    labels = {r[2] for r in rules} | {B.NA, None}
    vals = [x / 2 for x in range(-10, 120)]
    got = _apply(spark, vals, lambda c: B.ladder(c, rules, B.NA))
    assert set(got) <= labels
