"""as_of against a brute-force pandas state at every block, on seeded random
logs and grids with shared blocks and stamps before the first block."""

import bisect
import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapmetrics.operators.snapshots import (
    CAP_LEVELS,
    COUNT,
    LATEST,
    MAX,
    MIN,
    SUM,
    _cut_range,
    _magnitude,
    as_of,
    cap_per_snapshot,
    latest_state,
    place,
)
from snapmetrics.sources.grid import Grid, pinned, resolve_blocks


def _log(seed, n=400):
    rng = np.random.default_rng(seed)
    t0 = dt.datetime(2024, 1, 1)
    secs = np.sort(rng.choice(5 * 86400, size=n, replace=False))
    return pd.DataFrame(
        {
            "block": np.arange(1, n + 1, dtype="int64") * 3,
            "ts": [t0 + dt.timedelta(seconds=int(s), microseconds=int(rng.integers(0, 10**6))) for s in secs],
            "key": rng.integers(0, 7, size=n),
            "v": rng.integers(-50, 100, size=n),
        }
    )


def aggs():
    return {
        "n": (COUNT, F.col("block")),
        "total": (SUM, F.col("v")),
        "top": (MAX, F.col("v")),
        "low": (MIN, F.col("v")),
        "last_v": (LATEST, F.col("v")),
    }


def _brute(pdf, blocks):
    out = []
    for b in sorted(set(blocks)):
        seen = pdf[pdf.block <= b]
        for k, g in seen.groupby("key"):
            g = g.sort_values("block")
            out.append((int(k), int(b), len(g), int(g.v.sum()), int(g.v.max()), int(g.v.min()), int(g.v.iloc[-1])))
    return sorted(out)


@pytest.mark.parametrize(
    "seed,grid",
    [
        (1, Grid(dt.datetime(2024, 1, 1, 23, 59, 59), 86400, 5)),
        (2, Grid(dt.datetime(2023, 12, 30, 6, 0), 6 * 3600, 30)),  # early stamps unresolved
        (3, Grid(dt.datetime(2024, 1, 1, 0, 0), 300, 600)),  # many shared blocks
    ],
)
def test_as_of_matches_brute_force(spark, seed, grid):
    pdf = _log(seed)
    log = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    blocks = log.select("block", F.col("ts").alias("block_time"))
    snaps = resolve_blocks(blocks, grid)
    got = as_of(log, ["key"], grid, snaps, aggs(), order="block")
    got = sorted(tuple(int(x) for x in (r.key, r.block, r.n, r.total, r.top, r.low, r.last_v)) for r in got.collect())
    resolved = [r.block for r in snaps.collect()]
    assert got == _brute(pdf, resolved)


def test_latest_state_is_state_at_last_block(spark):
    pdf = _log(4)
    log = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = latest_state(log, ["key"], aggs(), "block", order="block")
    got = sorted(tuple(int(x) for x in (r.key, r.block, r.n, r.total, r.top, r.low, r.last_v)) for r in got.collect())
    assert got == _brute(pdf, [int(pdf.block.max())])


def test_cap_per_snapshot_keeps_lowest_ids_and_whole_entities(spark):
    rows = [(b, f"{i:03d}", v) for b in (1, 2) for i in range(10) for v in ("a", "b")]
    df = spark.createDataFrame(rows, "block int, id string, v string")
    got = cap_per_snapshot(df, 3, "block", "id")
    assert got.count() == 2 * 3 * 2
    assert sorted({r.id for r in got.collect()}) == ["000", "001", "002"]


@pytest.mark.parametrize("seed", [5, 6])
def test_as_of_follows_blocks_when_times_are_shuffled(spark, seed):
    pdf = _log(seed)
    rng = np.random.default_rng(seed)
    pdf["block"] = rng.permutation(pdf.block.to_numpy())
    log = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    grid = Grid(dt.datetime(2024, 1, 1, 12, 0), 2 * 3600, 60)
    snaps = resolve_blocks(log.select("block", F.col("ts").alias("block_time")), grid)
    got = as_of(log, ["key"], grid, snaps, aggs(), order="block")
    got = sorted(tuple(int(x) for x in (r.key, r.block, r.n, r.total, r.top, r.low, r.last_v)) for r in got.collect())
    assert got == _brute(pdf, [r.block for r in snaps.collect()])


def test_three_rows_out_of_order(spark):
    """Block 3 comes after block 5 in time; the state at block 9 has it."""
    day = dt.datetime(2024, 1, 1)
    rows = [(5, day, "a", 1), (3, day + dt.timedelta(1), "b", 1), (9, day + dt.timedelta(2), "a", 1)]
    log = spark.createDataFrame(rows, "block long, ts timestamp_ntz, key string, v int")
    grid = Grid(day + dt.timedelta(hours=1), 86400, 3)
    snaps = resolve_blocks(log.select("block", F.col("ts").alias("block_time")), grid)
    got = as_of(log, ["key"], grid, snaps, {"n": (COUNT, F.col("v"))}, order="block")
    assert sorted((r.block, r.key, r.n) for r in got.collect()) == [(5, "a", 1), (5, "b", 1), (9, "a", 2), (9, "b", 1)]


def test_cap_ranks_no_whole_snapshot_in_one_task(spark):
    """Only the keys of the last cut range are ranked: a handful of 20,000."""
    rows = spark.range(40_000).selectExpr("id % 2 AS block", "format_string('%06d', id) AS id")
    got = cap_per_snapshot(rows, 1500, "block", "id")
    assert sorted(r.id for r in got.collect()) == [f"{i:06d}" for i in range(3000)]
    keys = rows.withColumns({"_v": _magnitude(rows, "id"), "_left": F.lit(1500).cast("bigint")})
    for _ in range(CAP_LEVELS):
        keys = _cut_range(keys, "block")
    assert keys.groupBy("block").count().agg(F.max("count")).first()[0] <= 10
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Rank windows stand above the joins with the cut ranges.
    ranks = [m.start() for m in re.finditer(r"row_number\(\) windowspecdefinition", plan)]
    assert ranks and all("_part" in plan[i:] for i in ranks)


@pytest.mark.parametrize("n", [1, 3, 49, 50, 51, 400])
def test_cap_matches_a_dense_rank(spark, n):
    """Skewed keys, snapshots of different sizes, entities of several rows,
    ids that are prefixes of each other, and ids beyond ASCII."""
    rng = np.random.default_rng(3)
    ids = [f"user-{'0' * int(rng.integers(0, 3))}{int(rng.zipf(1.3)) % 10**9}" for _ in range(50)] + ["user-", "user-é", "user-漢", "user-é1", "user-\x01"]
    rows = [(b, i, v) for b in range(3) for i in sorted(set(ids))[: 20 * (b + 1)] for v in range(1 + len(i) % 2)]
    df = spark.createDataFrame([*rows, (None, "user-1", 0), (1, None, 0)], "block int, id string, v int")
    want = []
    for b in range(3):
        keep = sorted({i for x, i, _ in rows if x == b}, key=str.encode)[:n]
        want += [r for r in rows if r[0] == b and r[1] in keep]
    assert sorted(map(tuple, cap_per_snapshot(df, n, "block", "id").collect())) == sorted(want)


def test_cap_by_numbers_and_by_nothing_else(spark):
    df = spark.range(500).selectExpr("id % 3 AS block", "id * id * id - 1000 AS id", "DATE '2024-01-01' AS d")
    got = cap_per_snapshot(df, 7, "block", "id")
    assert got.count() == 21 and got.agg(F.max("id")).first()[0] == 20**3 - 1000
    assert cap_per_snapshot(df, 0, "block", "id").count() == 0
    with pytest.raises(TypeError):
        cap_per_snapshot(df, 7, "block", "d")


def test_placement_is_one_compiled_join(spark):
    """Each row meets only its bin's intervals, once; nothing is interpreted."""
    grid = Grid(dt.datetime(2024, 1, 1, 0, 0), 300, 600)
    log = spark.createDataFrame(_log(8)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    snaps = pinned(resolve_blocks(log.select("block", F.col("ts").alias("block_time")), grid), grid)
    placed = place(log, grid, snaps, F.col("block"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "NestedLoop" not in plan and "lambda" not in plan
    assert "Subquery" not in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_place_against_bisect(spark, how):
    """Clustered blocks (most intervals in one bin), shared blocks, rows before
    the first, after the last and without a block; pinned or not."""
    grid = Grid(dt.datetime(2024, 1, 1), 60, 40)
    blocks = [1, 2, 3, 4, 5, 9, 10, 11, 500_000, 10**12]
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=4 * i) for i in range(len(blocks))]
    snaps = resolve_blocks(spark.createDataFrame(list(zip(blocks, times)), "block long, block_time timestamp_ntz"), grid)
    first = {r.block: r.idx for r in snaps.where("first_of_block").collect()}
    values = [None, -(10**15), 0, 1, 2, 6, 10, 11, 12, 499_999, 500_000, 500_001, 10**12, 10**12 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    want = []
    for v in values:
        p = None if v is None else bisect.bisect_left(blocks, v)
        hit = p is not None and p < len(blocks)
        if hit or how == "left":
            want.append((v, first[blocks[p]] if hit else None, p if hit else None))
    for table in (snaps, pinned(snaps, grid)):
        got = place(df, grid, table, F.col("v"), how).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_few_snapshots_are_no_few_tasks_of_the_cap(spark):
    """Rows meet the one row per snapshot by broadcast, also where Spark by
    itself would shuffle them by snapshot."""
    key, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        df = spark.range(3000).select((F.col("id") % 2).alias("block"), F.col("id").cast("string").alias("id"))
        got = cap_per_snapshot(df, 5, "block", "id")
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 10
    finally:
        spark.conf.set(key, was)


def test_capped_allocations_drop_lines_before_they_are_dealt(spark, tables):
    from pyspark.sql import Window

    from snapmetrics.sources import fixtures as fx
    from snapmetrics.sources import scans

    snaps = pinned(resolve_blocks(fx.order_blocks(tables), fx.G5_ORDERS), fx.G5_ORDERS)
    got = scans.allocation_rows(tables, fx.G5_ORDERS, snaps, cap=30)
    rank = F.dense_rank().over(Window.partitionBy("block").orderBy("id"))
    want = scans.allocation_rows(tables, fx.G5_ORDERS, snaps).withColumn("rk", rank).where("rk <= 30").drop("rk")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_lines_of_a_task_do_not_grow_with_the_tables(spark, monkeypatch, sf_dir):
    """Ten times the lines are ten times the parts, not ten times the rows in
    each, whatever the session's shuffle partitions are."""
    from snapmetrics.sources import fixtures as fx
    from snapmetrics.sources import scans

    monkeypatch.setattr(scans, "ORDER_ROWS", 2000, raising=False)
    t = fx.Tables(spark, sf_dir)
    dealt = scans._versions(t).groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in dealt) == t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber").distinct().count()
    assert max(r["count"] for r in dealt) <= 2500


def test_nested_allocations_of_a_task_are_bounded_beyond_few_parts(spark, monkeypatch):
    """Past ``FEW_PARTS`` a part has at most about ``MOST_ORDER_ROWS`` rows, and
    the records are those of one part."""
    from snapmetrics.sources import fixtures as fx
    from snapmetrics.sources import scans
    from snapmetrics.sources.grid import pinned, resolve_blocks

    def scan():
        t = fx.Tables(spark, "/root/testdata/sf0.01")
        snaps = pinned(resolve_blocks(fx.order_blocks(t), fx.G5_ORDERS), fx.G5_ORDERS)
        df = scans.scan_allocations(t, fx.G5_ORDERS, snaps, page=3)
        return df.withColumn("subgraphDeployment", F.to_json("subgraphDeployment")).withColumn("part", F.spark_partition_id())

    def digest(df):
        h = F.xxhash64(*[c for c in df.columns if c != "part"])
        return df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(10**9 + 7)))).first()

    want = digest(scan())
    for name, value in (("ORDER_ROWS", 100), ("MOST_ORDER_ROWS", 2000), ("FEW_PARTS", 10)):
        monkeypatch.setattr(scans, name, value, raising=False)
    key, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")  # the lists of large tables are no broadcast
    try:
        got = scan()
        assert digest(got) == want
        # 15,000 orders and 60,000 lines: 38 parts of some 395 orders.
        assert got.groupBy("part").agg(F.count_distinct("id").alias("n")).agg(F.max("n")).first()[0] <= 550
    finally:
        spark.conf.set(key, was)
