import datetime as dt
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapmetrics.sources import fixtures as fx
from snapmetrics.sources.grid import BROADCAST_STAMPS, Grid, resolve_blocks, snapshot_grid


def test_daily_grid_has_days_points_ending_before_end():
    g = snapshot_grid(dt.date(2024, 1, 31), days=30, step=24)
    assert g.count == 30
    assert g.start == dt.datetime(2024, 1, 1, 23, 59, 59)
    assert g.last == dt.datetime(2024, 1, 30, 23, 59, 59)


def test_fixture_grid_sizes():
    assert fx.G2_SIX_HOURLY.count == 120
    assert fx.G3_TWENTY_MINUTES.count == 2143
    assert fx.G4_EARLY_START.count == 8
    assert fx.G5_ORDERS.count == 5


def test_only_small_grids_are_hinted_as_broadcast(spark):
    def hinted(count):
        df = Grid(dt.datetime(2024, 1, 1), 1, count).small(spark.range(3))
        return "broadcast" in df._jdf.queryExecution().logical().toString()

    assert hinted(BROADCAST_STAMPS) and not hinted(BROADCAST_STAMPS + 1)
    with pytest.raises(ValueError):
        Grid(dt.datetime(2024, 1, 1), 1, -1)


def test_grid_frame_matches_stamps(spark):
    g = fx.G2_SIX_HOURLY
    rows = g.to_df(spark).orderBy("idx").collect()
    assert [r.stamp for r in rows] == [g.stamp(i) for i in range(g.count)]


def test_index_of_is_first_stamp_at_or_after(spark):
    g = snapshot_grid(dt.date(2024, 1, 10), days=5, step=24)
    times = [
        g.start - dt.timedelta(days=2),
        g.start,
        g.start + dt.timedelta(microseconds=1),
        g.stamp(2),
        g.stamp(2) + dt.timedelta(seconds=1),
        g.last,
    ]
    df = spark.createDataFrame(pd.DataFrame({"ts": times})).select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    got = [r.i for r in df.select(g.index_of("ts").alias("i")).collect()]

    def brute(t):
        return next(i for i in range(g.count) if g.stamp(i) >= t)

    assert got == [brute(t) for t in times]


def _blocks(spark, rows):
    return spark.createDataFrame(rows, "block string, block_time timestamp_ntz")


def test_resolve_drops_stamps_before_first_block_and_bad_text(spark):
    g = snapshot_grid(dt.date(2024, 1, 6), days=5, step=24)  # stamps Jan 1..5 23:59:59
    rows = [
        ("12", dt.datetime(2024, 1, 3, 10)),
        ("abc", dt.datetime(2024, 1, 2, 10)),
        ("", dt.datetime(2024, 1, 2, 11)),
        (None, dt.datetime(2024, 1, 2, 12)),
        ("15", dt.datetime(2024, 1, 5, 10)),
    ]
    got = {r.stamp.day: r.block for r in resolve_blocks(_blocks(spark, rows), g).collect()}
    assert got == {3: 12, 4: 12, 5: 15}


def test_resolve_marks_first_stamp_of_shared_blocks(spark):
    g = Grid.between(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 3, 0), 3600)
    rows = [("1", dt.datetime(2024, 1, 1, 0, 0)), ("2", dt.datetime(2024, 1, 1, 1, 30))]
    got = sorted((r.idx, r.block, r.first_of_block) for r in resolve_blocks(_blocks(spark, rows), g).collect())
    assert got == [(0, 1, True), (1, 1, False), (2, 2, True), (3, 2, False)]


def test_resolve_is_zone_independent(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = resolve_blocks(fx.event_blocks(fx.Tables(spark, "/root/testdata/sf0.001")), fx.G1_DAILY)
        ny = sorted((r.stamp, r.block) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    utc = sorted((r.stamp, r.block) for r in got.collect())
    assert ny == utc and len(utc) == 30


def test_long_grid_is_resolved_in_chunks(spark, monkeypatch):
    """The same table as in one window, from chunks of 2^3 stamps, with shared
    blocks, unresolved first chunks and chunks without any block."""
    from snapmetrics.sources import grid as G

    g = Grid(dt.datetime(2024, 1, 1), 60, 203)
    minutes = [30, 30, 31, 33, 40, 41, 42, 90, 91, 150, 151, 190]
    rows = [(str(5 * i + 3), g.start + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    # A block that is smaller than those before it in time.
    rows.append(("4", g.start + dt.timedelta(minutes=100)))
    want = sorted(map(tuple, resolve_blocks(_blocks(spark, rows), g).collect()))
    assert len(want) == 203 - 30
    monkeypatch.setattr(G, "BROADCAST_STAMPS", 50)
    monkeypatch.setattr(G, "CHUNK_BITS", 3)
    got = resolve_blocks(_blocks(spark, rows), g)
    assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Only the tables of chunk ends meet in one task.
    at = [m.start() for m in re.finditer("Exchange SinglePartition", plan)]
    assert at and all("HashAggregate(keys=[_chunk#" in plan[i : i + 400] for i in at)


def test_only_small_tables_are_pinned(spark, monkeypatch):
    from snapmetrics.sources import grid as G

    g = Grid.between(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), 3600)
    snaps = resolve_blocks(_blocks(spark, [("7", g.start), ("9", g.stamp(5))]), g)
    local = G.pinned(snaps, g)
    assert "LocalTableScan" in local._jdf.queryExecution().executedPlan().toString()
    assert sorted(local.collect()) == sorted(snaps.collect()) and local.schema == snaps.schema
    assert G.pinned(snaps.where("false"), g).count() == 0
    monkeypatch.setattr(G, "BROADCAST_STAMPS", 3)
    assert G.pinned(snaps, g) is snaps
