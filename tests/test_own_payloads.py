"""The three jobs on a caller's own payload frames, without the test tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmetrics.plans import columns as C
from snapmetrics.plans import jobs as J

E18 = "0" * 18


@pytest.fixture(scope="module")
def times(spark):
    rows = [(10, dt.datetime(2024, 1, 1)), (20, dt.datetime(2024, 1, 2)), (30, dt.datetime(2024, 1, 3))]
    return spark.createDataFrame(rows, "block long, stamp timestamp_ntz")


def test_subgraphs(spark, times):
    rows = []
    for b in (10, 20, 30):
        for v in range(2):
            body = {"id": f"s-{v}", "block": b}
            sub = ("s", 1_700_000_000, "old" if b < 20 else "new", ("o",), True)
            dep = (f"d{v}", f"{b * 100}{E18}", f"1{E18}", f"2{E18}", f"{b}{E18}", f"3{E18}", f"5{E18}", f"7{E18}", "1.5", ("n0",))
            rows.append((body["block"], body["id"], sub, dep))
    schema = (
        "block long, id string, subgraph struct<id: string, createdAt: long, displayName: string, owner: struct<id: string>, active: boolean>, "
        "subgraphDeployment struct<id: string, stakedTokens: string, indexingIndexerRewardAmount: string, "
        "indexingDelegatorRewardAmount: string, queryFeesAmount: string, curatorFeeRewards: string, signalledTokens: string, "
        "signalAmount: string, pricePerShare: string, network: struct<id: string>>"
    )
    payload = spark.createDataFrame(rows, schema)
    got = J.subgraphs_from(payload, times, F.lit(0.1)).orderBy("block").collect()
    assert [r.QF_total for r in got] == [20.0, 40.0, 60.0] and [r.QF for r in got] == [0.0, 20.0, 20.0]
    assert {r.display_name for r in got} == {"new"} and [r.stake for r in got] == [2000.0, 4000.0, 6000.0]
    assert set(C.OUT_SUBGRAPHS) <= set(got[0].asDict())
    assert J.subgraphs_from(payload, times, F.lit(0.1), names="all").count() == 6


def test_global(spark, times):
    schema = (
        "block long, graphNetwork struct<id: string, curationPercentage: string, delegationRatio: string, totalTokensStaked: string, "
        "totalTokensAllocated: string, totalDelegatedTokens: string, totalQueryFees: string, totalCuratorQueryFees: string, "
        "totalIndexingIndexerRewards: string, totalIndexingDelegatorRewards: string, totalTokensSignalled: string>"
    )
    rows = [(b, ("1", "10000", "16", *[f"{b * k}{E18}" for k in range(1, 9)])) for b in (10, 20, 30)]
    got = J.global_from(spark.createDataFrame(rows, schema), times, F.lit(0.1)).orderBy("block").collect()
    assert [r.stake for r in got] == [10.0, 20.0, 30.0] and [r.QF for r in got] == [0.0, 40.0, 40.0]
    assert set(C.OUT_GLOBAL) <= set(got[0].asDict())


def test_allocations(spark):
    schema = (
        "block long, id string, queryFeesCollected string, delegationFees string, "
        "subgraphDeployment struct<id: string, versions: array<struct<id: string>>>, allocatedTokens string, status string, closedAtBlockNumber long"
    )
    one = lambda b, i, v, c: (b, i, f"10{E18}", f"1{E18}", ("d", [(x,) for x in v]), f"9{E18}", "Active", c)
    rows = [one(10, "a", ["s-0", "s-1"], 10), one(20, "a", ["s-0", "s-1"], None), one(20, "b", [], 15), one(30, "c", ["t-0"], 31)]
    got = J.allocations_from(spark.createDataFrame(rows, schema))
    kept = sorted((r.block, r.id, r.version_id or "", r.subgraph_id or "") for r in got.collect())
    assert kept == [(10, "a", "s-0", "s"), (10, "a", "s-1", "s"), (20, "b", "", "")]
    assert spark.range(1).select(J.fee_split(J.allocations_output(got)).alias("f")).first().f == pytest.approx(0.1)
