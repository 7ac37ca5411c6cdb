"""Time-travel entity scans: nested payloads per snapshot block (survey A4–A7,
C1, D3, D4).

Each scan returns the shape the source's three queries return - one row per
entity and distinct snapshot block, with nested ``struct`` (and, for
allocations, ``array<struct>``) columns - so the generic ``flatten`` /
``explode_child`` / ``rename_map`` steps apply unchanged.  Parents are
attached with many-to-one joins (D3) before the rows are spread over the
snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmetrics.functions.clean import epoch_seconds
from snapmetrics.operators.snapshots import (
    COUNT,
    LATEST,
    MAX,
    MIN,
    SUM,
    as_of,
    assign_snapshot,
    cap_per_snapshot,
    carry_forward,
    interval_partials,
    latest_state,
    place,
    spread,
)
from snapmetrics.sources import fixtures as fx
from snapmetrics.sources.grid import BROADCAST_STAMPS, Grid


def _k_mod(r: int):
    return F.col("k") % 3 == r


def version_state() -> dict:
    """State of one version (user x event type): running totals, running
    max, latest value."""
    return {
        "n_events": (COUNT, F.col("event_id")),
        "qf_cents": (SUM, F.col("cents")),
        "curator_cents": (SUM, F.when(_k_mod(0), F.col("cents"))),
        "indexer_cents": (SUM, F.when(_k_mod(1), F.col("cents"))),
        "delegator_cents": (SUM, F.when(_k_mod(2), F.col("cents"))),
        "signal_k": (SUM, F.col("signed_k")),
        "max_cents": (MAX, F.col("cents")),
        "last_k": (LATEST, F.col("k")),
    }


def subgraph_state() -> dict:
    """State of one subgraph (user): creation time and latest value."""
    return {
        "first_ts": (MIN, F.col("ts")),
        "user_last_k": (LATEST, F.col("k")),
    }


def network_state() -> dict:
    """Network totals over every event."""
    return {
        "n_events": (COUNT, F.col("event_id")),
        "alloc_k": (SUM, F.col("k")),
        "deleg_k": (SUM, F.lit(100) - F.col("k")),
        "qf_cents": (SUM, F.col("cents")),
        "curator_cents": (SUM, F.when(_k_mod(0), F.col("cents"))),
        "indexer_cents": (SUM, F.when(_k_mod(1), F.col("cents"))),
        "delegator_cents": (SUM, F.when(_k_mod(2), F.col("cents"))),
        "signal_k": (SUM, F.col("signed_k")),
    }


VERSION_STATE_COLS = [
    "n_events", "qf_cents", "curator_cents", "indexer_cents", "delegator_cents", "signal_k", "max_cents", "last_k",
]
SUBGRAPH_STATE_COLS = ["first_ts", "user_last_k"]


def _z(c: str):
    return F.coalesce(F.col(c), F.lit(0).cast("bigint"))


def _price_text(k):
    # 1 + k / 10 as plain decimal text ("7.9").
    return F.format_string("%d.%d", F.lit(1) + F.floor(k / F.lit(10)).cast("int"), (k % 10).cast("int"))


def _version_record(v: DataFrame, *more: Column) -> DataFrame:
    vid = F.concat(F.col("user_id").cast("string"), F.lit("-"), fx.type_ordinal("event_type").cast("string"))
    return v.select(
        "block",
        vid.alias("id"),
        F.struct(
            F.col("user_id").cast("string").alias("id"),
            epoch_seconds("first_ts").alias("createdAt"),
            F.col("c_name").alias("displayName"),
            F.struct(F.col("c_nationkey").cast("string").alias("id")).alias("owner"),
            (F.col("user_last_k") % 2 == 0).alias("active"),
        ).alias("subgraph"),
        F.struct(
            F.concat(F.lit("d"), vid).alias("id"),
            fx.int_text(F.lit(100) * F.col("n_events")).alias("stakedTokens"),
            fx.cents_text(_z("indexer_cents")).alias("indexingIndexerRewardAmount"),
            fx.cents_text(_z("delegator_cents")).alias("indexingDelegatorRewardAmount"),
            fx.cents_text(_z("qf_cents")).alias("queryFeesAmount"),
            fx.cents_text(_z("curator_cents")).alias("curatorFeeRewards"),
            fx.int_text(_z("signal_k")).alias("signalledTokens"),
            fx.cents_text(F.col("max_cents")).alias("signalAmount"),
            _price_text(F.col("last_k")).alias("pricePerShare"),
            F.struct(F.lit(fx.NETWORK_ID).alias("id")).alias("network"),
        ).alias("subgraphDeployment"),
        *more,
    )


def version_rows(t: fx.Tables, grid: Grid, snapshots: DataFrame) -> DataFrame:
    """State of every version at every distinct snapshot block, one pass over
    the log.  Each row carries its version's own creation time and latest
    value (with that value's order) and its owner, joined before the spread.
    """
    log = fx.event_log(t)
    vstate, sstate = version_state(), subgraph_state()
    partials = interval_partials(
        log, ["user_id", "event_type"], grid, snapshots, {**vstate, **sstate}, "event_id", order="event_id"
    )
    owners = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    owned = partials.join(owners, "user_id", "left")
    kinds = {n: k for n, (k, _) in {**vstate, **sstate}.items()}
    return carry_forward(
        owned, ["user_id", "event_type"], grid, snapshots, kinds, keep_order=True, carry=("c_name", "c_nationkey")
    )


def scan_versions(t: fx.Tables, grid: Grid, snapshots: DataFrame) -> DataFrame:
    """A5 (``main``): versions with their subgraph, owner, deployment and
    network, one row per version and distinct snapshot block.

    The subgraph's state at a block is the min / latest over its versions
    present there, taken by a window over (subgraph, block).  The job path
    (``subgraph_rows``) takes it by an aggregate that combines before its
    shuffle instead.
    """
    versions = version_rows(t, grid, snapshots)
    per_subgraph = Window.partitionBy("user_id", "block")
    own = {"first_ts", "user_last_k", "_ord_user_last_k", "_ord_last_k"}
    with_parent = versions.select(
        *[c for c in versions.columns if c not in own],
        F.min("first_ts").over(per_subgraph).alias("first_ts"),
        F.max_by("user_last_k", "_ord_user_last_k").over(per_subgraph).alias("user_last_k"),
    )
    return _version_record(with_parent)


def subgraph_rows(t: fx.Tables, grid: Grid, snapshots: DataFrame) -> DataFrame:
    """A5 + B1 + E1's inputs without the window: version rows as
    ``scan_versions`` gives them, flat, but with each version's own
    ``createdAt`` and activity and the order of the latter (``_active_at``)
    for a rollup to combine."""
    versions = version_rows(t, grid, snapshots)
    record = _version_record(versions, versions["_ord_user_last_k"].alias("_active_at"))
    return record


def scan_versions_latest(t: fx.Tables) -> DataFrame:
    """A10: the versions at the latest block of the log (no block argument)."""
    log = fx.event_log(t)
    versions = latest_state(log, ["user_id", "event_type"], version_state(), "event_id", order="event_id")
    subgraphs = latest_state(log, ["user_id"], subgraph_state(), "event_id", order="event_id").drop("block")
    owners = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    joined = versions.join(subgraphs, ["user_id"], "inner").join(owners, "user_id", "left")
    return _version_record(joined)


def _network_record(state: DataFrame, network_id: str, factor: int) -> DataFrame:
    m = F.lit(factor).cast("bigint")
    return state.select(
        "block",
        F.struct(
            F.lit(network_id).alias("id"),
            F.lit(fx.CURATION_PERCENTAGE).alias("curationPercentage"),
            F.lit(fx.DELEGATION_RATIO).alias("delegationRatio"),
            fx.int_text(F.lit(1000) * F.col("n_events") * m).alias("totalTokensStaked"),
            fx.int_text(_z("alloc_k") * m).alias("totalTokensAllocated"),
            fx.int_text(_z("deleg_k") * m).alias("totalDelegatedTokens"),
            fx.cents_text(_z("qf_cents") * m).alias("totalQueryFees"),
            fx.cents_text(_z("curator_cents") * m).alias("totalCuratorQueryFees"),
            fx.cents_text(_z("indexer_cents") * m).alias("totalIndexingIndexerRewards"),
            fx.cents_text(_z("delegator_cents") * m).alias("totalIndexingDelegatorRewards"),
            fx.int_text(_z("signal_k") * m).alias("totalTokensSignalled"),
        ).alias("graphNetwork"),
    )


def network_records(t: fx.Tables, grid: Grid, snapshots: DataFrame) -> DataFrame:
    """Network records per distinct block: id ``1`` and a decoy ``2`` (values
    doubled) that the point lookup must skip."""
    state = as_of(fx.event_log(t), [], grid, snapshots, network_state(), "event_id", order="event_id")
    return _network_record(state, "1", 1).unionByName(_network_record(state, "2", 2))


def scan_network(t: fx.Tables, grid: Grid, snapshots: DataFrame, network_id: str = "1") -> DataFrame:
    """A6/C1 (``global``): the one network record with ``id = network_id``.

    The id filter is pushed through the union, so the decoy branch is pruned
    by the optimizer and never computed.
    """
    return network_records(t, grid, snapshots).where(F.col("graphNetwork.id") == network_id)


def scan_network_latest(t: fx.Tables, network_id: str = "1") -> DataFrame:
    """A10 of the network: its one record at the latest block of the log; an
    empty log has none."""
    state = latest_state(fx.event_log(t), [], network_state(), "event_id", order="event_id").where(F.col("block").isNotNull())
    return _network_record(state, "1", 1).unionByName(_network_record(state, "2", 2)).where(F.col("graphNetwork.id") == network_id)


# Rows of the orders and their lines in a part, and in one of more than
# ``FEW_PARTS``: up to so many, Spark's map side writes each part's rows at once
# and sorts none of them in memory.
ORDER_ROWS, MOST_ORDER_ROWS, FEW_PARTS = 250_000, 1_500_000, 200


def _by_order(t: fx.Tables, lines: DataFrame) -> DataFrame:
    """``lines`` dealt by their order, in as many parts as the tables' rows ask
    for (counted from the files' footers), so that a task's sorts and hash
    tables stay bounded however large the tables are; those that fit in one
    part are dealt as the session says."""
    rows = t.memo("order_rows", lambda: t.lineitem.count() + t.orders.count())
    parts = max(min(-(-rows // ORDER_ROWS), FEW_PARTS), -(-rows // MOST_ORDER_ROWS))
    return lines.repartition(parts, "l_orderkey") if parts > 1 else lines.repartition("l_orderkey")


def _versions(t: fx.Tables, orders: DataFrame | None = None) -> DataFrame:
    """Line sums of each distinct version of an order, or of ``orders``
    (l_orderkey) alone.  The lines are dealt by their order once; order totals
    and version ids both come from it without another exchange."""
    lines = t.lineitem.select(
        "l_orderkey", "l_suppkey", "l_linenumber",
        fx.money_cents("l_extendedprice").alias("qf"), fx.money_cents(F.col("l_extendedprice") * F.col("l_discount")).alias("fee"),
    )
    if orders is not None:
        lines = lines.join(orders, "l_orderkey", "left_semi")
    return _by_order(t, lines).groupBy("l_orderkey", "l_suppkey", "l_linenumber").agg(
        F.sum("qf").alias("qf_cents"), F.sum("fee").alias("fee_cents")
    )


def _orders(t: fx.Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderdate",
        "o_orderstatus",
        fx.money_cents("o_totalprice").alias("total_cents"),
        fx.order_day("o_orderdate").alias("day"),
    )


def _allocations_base(t: fx.Tables) -> DataFrame:
    """One row per order with its line sums and number of versions (null: it
    has none)."""
    lines = _versions(t).groupBy("l_orderkey").agg(
        F.sum("qf_cents").alias("qf_cents"), F.sum("fee_cents").alias("fee_cents"), F.count(F.lit(1)).alias("n_versions")
    )
    return _orders(t).join(lines, "l_orderkey", "left")


def _version_id() -> Column:
    return F.concat(F.col("l_suppkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def _allocation_versions(t: fx.Tables) -> DataFrame:
    """One row per order and version (one without a version if it has none)
    with the order's line sums: the lines are read and dealt once, and window
    sums over the order give its totals on each of its versions.  An order's
    versions are streamed through one task, sorted with spill."""
    return _orders(t).join(_version_sums(t), "l_orderkey", "left")


def _version_sums(t: fx.Tables, orders: DataFrame | None = None) -> DataFrame:
    whole = Window.partitionBy("l_orderkey")
    return _versions(t, orders).select(
        "l_orderkey", _version_id().alias("version_id"),
        F.sum("qf_cents").over(whole).alias("qf_cents"), F.sum("fee_cents").over(whole).alias("fee_cents"),
    )


def _allocation_fields() -> dict:
    closed = F.when(
        (F.col("o_orderstatus") == "F") & (F.col("day") + F.lit(fx.CLOSE_AFTER_DAYS) <= F.col("block")),
        F.col("day") + F.lit(fx.CLOSE_AFTER_DAYS),
    )
    aid = F.col("l_orderkey").cast("string")
    return {
        "id": aid.alias("id"),
        "queryFeesCollected": fx.cents_text(_z("qf_cents")).alias("queryFeesCollected"),
        "delegationFees": fx.cents_text(_z("fee_cents")).alias("delegationFees"),
        "deployment": F.concat(F.lit("d"), aid),
        "allocatedTokens": fx.cents_text(F.col("total_cents")).alias("allocatedTokens"),
        "status": F.when(closed.isNotNull(), F.lit("Closed")).otherwise(F.lit("Active")).alias("status"),
        "closedAtBlockNumber": closed.cast("bigint").alias("closedAtBlockNumber"),
    }


def _spread_orders(base: DataFrame, grid: Grid, snapshots: DataFrame) -> DataFrame:
    return spread(assign_snapshot(base, grid, snapshots, "day"), grid, snapshots)


# Versions in a page of a deployment's list, about.
PAGE = 1000


def scan_allocations(t: fx.Tables, grid: Grid, snapshots: DataFrame, page: int = PAGE) -> DataFrame:
    """A7 (``allocations``): allocations with ``subgraphDeployment.versions``
    as sorted ``array<struct<id>>`` (empty when there are none), one row per
    allocation, page of its list and distinct snapshot block.

    D4 in pages: a deployment of more than ``page`` versions has several
    rows, numbered by ``page`` and dealt by the digest of the version id, so
    no list grows with a deployment; ``merge_pages`` puts them together where
    they are known to fit.  The job path uses ``allocation_rows``, which
    gives the exploded rows without lists.
    """
    whole = Window.partitionBy("l_orderkey")
    versions = _versions(t).select(
        "l_orderkey", _version_id().alias("version_id"), F.count(F.lit(1)).over(whole).alias("n"),
        F.sum("qf_cents").over(whole).alias("qf_cents"), F.sum("fee_cents").over(whole).alias("fee_cents"),
    )
    number = F.pmod(F.xxhash64("version_id"), F.ceil(F.col("n") / F.lit(page))).cast("int")
    lists = versions.withColumn("page", number).groupBy("l_orderkey", "page", "qf_cents", "fee_cents").agg(
        F.array_sort(F.collect_list(F.struct(F.col("version_id").alias("id")))).alias("versions")
    )
    rows = _spread_orders(_orders(t).join(lists, "l_orderkey", "left"), grid, snapshots)
    f = _allocation_fields()
    empty = F.array().cast("array<struct<id:string>>")
    deployment = F.struct(f["deployment"].alias("id"), F.coalesce(F.col("versions"), empty).alias("versions"))
    return rows.select(
        "block",
        f["id"],
        F.coalesce("page", F.lit(0)).alias("page"),
        f["queryFeesCollected"],
        f["delegationFees"],
        deployment.alias("subgraphDeployment"),
        f["allocatedTokens"],
        f["status"],
        f["closedAtBlockNumber"],
    )


def allocation_rows(t: fx.Tables, grid: Grid, snapshots: DataFrame, cap: int | None = None) -> DataFrame:
    """A7 + B4 + B1 without lists: the flat rows that exploding and
    flattening ``scan_allocations`` gives.

    ``explode_outer`` of a list equals the left join with the versions; it
    comes before the spread over snapshots, so rows are multiplied once, at
    the end.  ``cap`` (A8) limits the allocations of a snapshot.  Every order
    has a row at each snapshot from its own on, with versions or without, so
    the cap is taken on the orders, and only those left meet their versions.
    """
    if cap is None:
        return _flat_allocations(_spread_orders(_allocation_versions(t), grid, snapshots))
    present = _spread_orders(_orders(t), grid, snapshots).withColumn("id", F.col("l_orderkey").cast("string"))
    kept = cap_per_snapshot(present, cap, "block", "id", grid).drop("id")
    ids = kept.select("l_orderkey").distinct()
    # At most ``cap`` ids a stamp.
    few = F.broadcast(ids) if cap * grid.count <= BROADCAST_STAMPS else ids
    return _flat_allocations(kept.join(_version_sums(t, few), "l_orderkey", "left"))


def allocation_rows_latest(t: fx.Tables) -> DataFrame:
    """A10 of the allocations, exploded and flat: every one with a day at the
    latest of these, which a scalar subquery over one column gives."""
    day = fx.order_day("o_orderdate")
    rows = _allocation_versions(t).where(F.col("day").isNotNull())
    return _flat_allocations(rows.withColumn("block", t.orders.agg(F.max(day)).scalar()))


def _flat_allocations(rows: DataFrame) -> DataFrame:
    f = _allocation_fields()
    return rows.select(
        "block",
        f["id"],
        f["queryFeesCollected"],
        f["delegationFees"],
        f["deployment"].alias("subgraphDeployment_id"),
        F.col("version_id").alias("subgraphDeployment_versions_id"),
        f["allocatedTokens"],
        f["status"],
        f["closedAtBlockNumber"],
    )


def allocation_block_bounds(t: fx.Tables, grid: Grid, snapshots: DataFrame) -> Column:
    """E4 for the allocation rows: ``struct(lo, hi)`` of their ``block``
    column, as one scalar subquery over small inputs.

    An allocation has a row at every distinct snapshot block at or after its
    own, so the frame's blocks are the snapshot blocks from the earliest
    order day on: one column of the orders and the snapshot table, not the
    exploded frame.
    """
    first = t.orders.agg(F.min(fx.order_day("o_orderdate"))).scalar()
    present = snapshots.where(F.col("first_of_block") & (F.col("block") >= first))
    return present.agg(F.struct(F.min("block").alias("lo"), F.max("block").alias("hi"))).scalar()


def fee_totals(t: fx.Tables, grid: Grid, snapshots: DataFrame) -> Column:
    """E5's two sums over the allocations output as ``struct(fees,
    collected)`` in cents, without its rows.

    The output has an order once per version (at least once) and snapshot
    block from its own on whose close block lies in the frame's range; the
    close block is null, taken as 0, before the order closes.  So an order
    counts ``versions * blocks`` times, and the blocks depend only on its day
    and whether it closes: the orders are summed by these first, and only the
    distinct days are placed among the snapshot blocks.
    """
    exact = lambda c: F.sum(F.coalesce(c, F.lit(0)).cast("decimal(28,0)") * F.coalesce("n_versions", F.lit(1)))
    closes = (F.col("o_orderstatus") == "F").alias("closing")
    days = _allocations_base(t).groupBy("day", closes).agg(exact("fee_cents").alias("fees"), exact("qf_cents").alias("collected"))
    days = days.withColumn("closes", F.when(F.col("closing"), F.col("day") + F.lit(fx.CLOSE_AFTER_DAYS)))
    opened = place(days, grid, snapshots, F.col("day"), "left").drop("idx").withColumnRenamed("place", "_from")
    placed = place(opened, grid, snapshots, F.col("closes"), "left").withColumnRenamed("place", "_closed")
    n = snapshots.agg(F.count_if("first_of_block")).scalar()
    limits = allocation_block_bounds(t, grid, snapshots)
    placed = placed.withColumns({"_n": n, "_range": limits})
    inside = lambda x: x.between(F.col("_range")["lo"], F.col("_range")["hi"])
    # Blocks at or after the day, and those of them at or after the closing.
    present, closed = (F.coalesce(F.col("_n") - F.col(c), F.lit(0)) for c in ("_from", "_closed"))
    weight = F.when(inside(F.col("closes")), closed).otherwise(0) + F.when(inside(F.lit(0)), present - closed).otherwise(0)
    total = lambda c: F.sum(F.col(c) * weight).alias(c)
    return placed.agg(F.struct(total("fees"), total("collected"))).scalar()
