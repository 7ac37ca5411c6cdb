import datetime as dt
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from snapmetrics.operators.windows import MEAN, SUM, diff_n, roll_avg, roll_sum, rolling, series


def test_x5_gaps(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 3.0, None, 10.0, 11.0])], "i int, x double")
    w = series(["i"])
    assert [r.d for r in df.select(diff_n("x", 1, w).alias("d")).orderBy("i").collect()] == [0, 2, 0, 0, 1]
    df2 = spark.createDataFrame(
        [(i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0])], "i int, x double"
    )
    got = [r.s for r in df2.select("i", roll_sum("x", 3, w).alias("s")).orderBy("i").collect()]
    assert got == [None, None, None, None, None, 15.0, 18.0]


def test_against_pandas_keyed(spark):
    rng = np.random.default_rng(7)
    n = 300
    pdf = pd.DataFrame({"k": rng.integers(0, 4, n), "t": np.arange(n), "x": rng.normal(size=n).round(3)})
    pdf.loc[rng.choice(n, 20, replace=False), "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.isnan("x"), None).otherwise(F.col("x")))
    w = series(["t"], "k")
    got = (
        df.select("k", "t", diff_n("x", 1, w).alias("d1"), diff_n("x", 3, w).alias("d3"),
                  roll_sum("x", 5, w).alias("s5"), roll_avg("x", 4, w).alias("a4"))
        .toPandas().sort_values("t").reset_index(drop=True)
    )
    g = pdf.sort_values(["k", "t"]).groupby("k")["x"]
    exp = pdf.sort_values(["k", "t"]).assign(
        d1=g.diff().fillna(0),
        d3=g.diff(periods=3).fillna(0),
        s5=g.rolling(5).sum().reset_index(level=0, drop=True),
        a4=g.rolling(4).mean().reset_index(level=0, drop=True),
    ).sort_values("t").reset_index(drop=True)
    for c in ("d1", "d3", "s5", "a4"):
        np.testing.assert_allclose(got[c].astype(float), exp[c].astype(float), rtol=1e-9, atol=1e-12, equal_nan=True)


def test_prefix_sums_against_resummed_frames(spark):
    """Every window of every length, with and without nulls, also after values
    that are far larger than the rest."""
    rng = np.random.default_rng(11)
    n = 240
    pdf = pd.DataFrame({"k": rng.integers(0, 3, n), "t": np.arange(n), "x": rng.normal(size=n).round(6), "y": rng.normal(size=n) * 100})
    pdf.loc[[20, 21], "x"] = [4e15, -3e15]
    pdf.loc[rng.choice(n, 25, replace=False), "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("y", F.when(F.isnan("y"), None).otherwise(F.col("y")))
    w = series(["t"], "k")
    wanted = {f"{kind}_{c}_{m}": (kind, c, m) for kind in (SUM, MEAN) for c in ("x", "y") for m in (1, 4, 30)}
    got = rolling(df, w, wanted, frozenset(["x"]))
    assert got.columns == [*df.columns, *wanted]
    got = got.toPandas().sort_values("t").reset_index(drop=True)
    g = pdf.sort_values(["k", "t"]).groupby("k")
    for name, (kind, c, m) in wanted.items():
        # Each frame summed on its own, so large values leave no trace.
        exp = g[c].rolling(m).apply(lambda v: np.float64(sum(map(float, v))), raw=True).reset_index(level=0, drop=True).sort_index()
        exp = exp / (m if kind == MEAN else 1)
        np.testing.assert_allclose(got[name].astype(float), exp.astype(float), rtol=1e-12, atol=1e-9, equal_nan=True)


def test_rolling_keeps_one_exchange_and_no_sliding_frame(spark):
    df = spark.range(100).selectExpr("id % 5 AS k", "id AS t", "CAST(id AS DOUBLE) AS x")
    w = series(["t"], "k")
    plan = rolling(df, w, {f"s{m}": (SUM, "x", m) for m in (7, 14, 30)}, frozenset(["x"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    assert "unboundedpreceding" in plan.lower() and "RowFrame, -6" not in plan


def test_long_series_is_windowed_in_chunks(spark, tables, monkeypatch):
    """State and windows of the network over a grid in chunks of 2^4 stamps,
    fewer than the windows reach back, are those of one window."""
    from snapmetrics.plans import catalog as K
    from snapmetrics.plans import jobs as J
    from snapmetrics.sources import fixtures as fx
    from snapmetrics.sources import grid as G
    from snapmetrics.sources import scans

    def frame(grid):
        snaps = G.resolve_blocks(fx.event_blocks(tables), grid)
        return J.global_windows(J.global_clean_from(scans.scan_network(tables, grid, snaps), snaps, grid=grid), grid)

    grid = G.Grid(dt.datetime(2024, 1, 1, 3), 3 * 3600, 170)
    one = frame(grid)
    want = sorted(map(tuple, one.select(*sorted(one.columns)).collect()), key=str)
    assert len(want) > 160
    monkeypatch.setattr(G, "BROADCAST_STAMPS", 50)
    monkeypatch.setattr(G, "CHUNK_BITS", 4)
    got = frame(grid)
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect()), key=str) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    # One task sees chunk ends and the snapshots' block range only.
    at = [m.start() for m in re.finditer("Exchange SinglePartition", plan)]
    tails = ("HashAggregate(keys=[_chunk#", "partial_min(block", "partial_max(block")
    assert at and all(any(x in plan[i : i + 600] for x in tails) for i in at)
    assert K.fx.G7_LONG.count > 100_000
    # A grid that starts before the first block, and an empty log.
    early = G.Grid(dt.datetime(2023, 12, 20), 3 * 3600, 170)
    assert frame(early).count() < 170


def test_state_without_keys_in_chunks(spark, monkeypatch):
    """Every kind of state of a log without keys, with nulls and chunks that
    have no change, as from one window."""
    from snapmetrics.operators import snapshots as S
    from snapmetrics.sources import grid as G

    grid = G.Grid(dt.datetime(2024, 1, 1), 60, 90)
    log = spark.createDataFrame(
        [(3, None), (4, 7), (20, None), (21, -5), (60, 2), (61, 9), (88, None)], "block long, x long"
    )
    blocks = spark.range(90).selectExpr("id AS block", "timestampadd(MINUTE, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS block_time")
    x = F.col("x")
    aggs = {"n": (S.COUNT, x), "s": (S.SUM, x), "hi": (S.MAX, x), "lo": (S.MIN, x), "last": (S.LATEST, x)}
    state = lambda: sorted(map(tuple, S.as_of(log, [], grid, G.resolve_blocks(blocks, grid), aggs, order="block").collect()), key=str)
    want = state()
    assert len(want) == 87
    monkeypatch.setattr(G, "BROADCAST_STAMPS", 50)
    monkeypatch.setattr(G, "CHUNK_BITS", 3)
    assert state() == want
