import datetime as dt

from pyspark.sql import functions as F

from snapmetrics.operators.relations import (
    attach_names,
    attach_time,
    fee_split,
    latest_active,
    rollup,
    within_own_range,
)


def test_rollup_drops_null_keys_x1(spark):
    rows = [
        (None, 1, dt.date(2024, 1, 1), 1.0),
        ("s", None, dt.date(2024, 1, 1), 1.0),
        ("s", 1, None, 1.0),
        ("s", 1, dt.date(2024, 1, 1), 2.0),
    ]
    df = spark.createDataFrame(rows, "k string, b int, d date, x double")
    got = rollup(df, ["k", "b", "d"], ["x"], []).collect()
    assert [(r.k, r.x) for r in got] == [("s", 2.0)]


def test_rollup_all_null_measures_x2(spark):
    df = spark.createDataFrame([("s", None, None), ("s", None, True)], "k string, x double, a boolean")
    r = rollup(df, ["k"], ["x"], ["a"]).first()
    assert r.x == 0.0 and r.a is True
    r2 = rollup(spark.createDataFrame([("s", None, None)], "k string, x double, a boolean"), ["k"], ["x"], ["a"]).first()
    assert r2.x == 0.0 and r2.a is None


def test_names_modes_x3(spark):
    versions = spark.createDataFrame([("s", 1, "old"), ("s", 2, "new"), ("t", 1, "t")],
                                     "subgraph_id string, block int, display_name string")
    rolled = spark.createDataFrame([("s", 1), ("s", 2), ("t", 1)], "subgraph_id string, block int")
    assert attach_names(rolled, versions, "all").count() == 5
    latest = attach_names(rolled, versions, "latest").collect()
    assert len(latest) == 3 and {r.display_name for r in latest if r.subgraph_id == "s"} == {"new"}


def test_shared_block_x10(spark):
    blocktimes = spark.createDataFrame(
        [(7, dt.datetime(2024, 1, 1, 10)), (7, dt.datetime(2024, 1, 1, 20))], "block bigint, stamp timestamp_ntz"
    )
    rows = spark.createDataFrame([("s", 7, 30.0)], "subgraph_id string, block bigint, x double")
    timed = attach_time(rows, blocktimes)
    assert timed.count() == 2
    with_stamp = rollup(timed, ["subgraph_id", "block", "stamp", "date"], ["x"], []).collect()
    assert sorted(r.x for r in with_stamp) == [30.0, 30.0]
    without = rollup(timed, ["subgraph_id", "block", "date"], ["x"], []).first()
    assert without.x == 60.0  # the source's doubling (trap T18)


def test_within_own_range_and_latest_active(spark):
    df = spark.createDataFrame([(10, 0), (20, 15), (30, 31), (30, 25)], "block int, closed int")
    assert sorted(r.closed for r in within_own_range(df, "closed", "block").collect()) == [15, 25]
    d = spark.createDataFrame(
        [(dt.date(2024, 1, 2), True), (dt.date(2024, 1, 2), None), (dt.date(2024, 1, 1), True)],
        "date date, active boolean",
    )
    assert latest_active(d).count() == 1


def test_fee_split_scalar(spark):
    a = spark.createDataFrame([(1.0, 10.0), (None, 10.0), (3.0, None)], "delegation_fees double, QF_collected double")
    assert spark.range(1).select(fee_split(a).alias("f")).first().f == 4.0 / 20.0
    z = spark.createDataFrame([(1.0, 0.0)], "delegation_fees double, QF_collected double")
    assert spark.range(1).select(fee_split(z).alias("f")).first().f is None
