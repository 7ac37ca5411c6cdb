import datetime as dt

from pyspark.sql import functions as F

from snapmetrics.functions.clean import (
    epoch_seconds,
    epoch_to_ts,
    null_to_zero_int,
    scale_tokens,
    strip_suffix,
    to_date,
)


def test_strip_suffix_x4(spark):
    df = spark.createDataFrame([("x-0",), ("x-10",), ("ab",), ("a",), ("",), (None,)], "v string")
    got = [r.s for r in df.select(strip_suffix("v").alias("s")).collect()]
    assert got == ["x", "x-", "", "", None, None]


def test_epoch_to_date_is_zone_free_x13(spark):
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        r = spark.range(1).select(
            epoch_to_ts(F.lit(1626839999)).alias("t"), to_date(epoch_to_ts(F.lit(1626839999))).alias("d")
        ).first()
        assert r.t == dt.datetime(2021, 7, 21, 3, 59, 59)
        assert r.d == dt.date(2021, 7, 21)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_seconds_round_trip(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    df = spark.createDataFrame([(dt.datetime(2021, 7, 21, 3, 59, 59, 999999),)], "ts timestamp_ntz")
    assert df.select(epoch_seconds("ts").alias("s")).first().s == 1626839999
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scale_and_zero_fill(spark):
    df = spark.createDataFrame([("1500000000000000000", None), ("-2000000000000000000", 7)], "a string, c bigint")
    got = df.select(scale_tokens("a").alias("a"), null_to_zero_int("c").alias("c")).collect()
    assert [(r.a, r.c) for r in got] == [(1.5, 0), (-2.0, 7)]
