"""NULL groups and sort keys in the ordered operators, LIKE without an escape, session zones, station id strips."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import calendar
from tessera.operators import expectations as E
from tessera.operators.ordered import group_quantile, previous_in_order
from tessera.sources.normalize import normalize_station_id


def test_null_group_carries_over_ranges(spark):
    df = spark.createDataFrame([(None, i, 1000 - i) for i in range(300)], "g string, o int, v int")
    assert E.column_values_to_be_increasing(df, "v", "o", group_by=["g"]).count() == 299
    out = previous_in_order(df, "v", ["o"], ["g"], "p", num_ranges=5)
    assert out.where("p = v + 1").count() == 299


def test_null_sort_key_sorts_last(spark):
    df = spark.createDataFrame([(None, 5), (1, 10), (2, 20)], "o int, v int")
    assert E.column_values_to_be_increasing(df, "v", "o").count() == 1


def test_quantile_of_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r["g"]: r["quantile"] for r in group_quantile(df, "v", 0.5, ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_like_backslash_stands_for_itself(spark):
    df = spark.createDataFrame([("a\\b",), ("ab",)], "s string")
    assert E.column_values_to_match_like_pattern(df, "s", "a\\b").count() == 1


def test_now_is_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = spark.range(1).select(F.date_format(calendar.now(), "yyyy-MM-dd HH:mm:ss").alias("t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    real = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs(dt.datetime.fromisoformat(got) - real) < dt.timedelta(minutes=2)


def test_station_id_strips_line_ends(spark):
    df = spark.createDataFrame([("\t72503014732\r\n",)], "s string")
    assert df.select(normalize_station_id("s")).first()[0] == "WBAN:14732"
