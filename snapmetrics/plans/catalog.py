"""Registered queries: one Spark plan and (where SQL can say it) one oracle
SQL string per surveyed operator.

Every query reads the given tables, over their whole extent.  Double columns
are rounded to ``ROUND_DIGITS`` in both engines (trap T12): sums of the same
floats in another order differ in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from snapmetrics.operators import relations as R
from snapmetrics.operators.shape import explode_child, flatten, rename_map, root_select, union_all
from snapmetrics.functions import metrics as M
from snapmetrics.operators.snapshots import COUNT, LATEST, as_of, cap_per_snapshot
from snapmetrics.plans import columns as C
from snapmetrics.plans import jobs as J
from snapmetrics.plans import oracle as O
from snapmetrics.plans import publish as P
from snapmetrics.sources import fixtures as fx
from snapmetrics.sources import scans
from snapmetrics.sources.grid import Grid, pinned, resolve_blocks

ROUND_DIGITS = O.ROUND_DIGITS


@dataclass
class Query:
    name: str
    build: Callable[[fx.Tables], DataFrame]
    cols: list[str]
    sql: str | None = None
    needs: tuple[str, ...] = ()
    doubles: set[str] | None = field(default=None)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(self.build(fx.Tables(spark, sf_dir)).select(*self.cols))

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        doubles = O.DOUBLES if self.doubles is None else self.doubles
        items = [f"{O.round_sql(c)} AS {c}" if c in doubles else c for c in self.cols]
        return f"SELECT {', '.join(items)} FROM ({O.with_ctes(self.sql, *self.needs)}) q"


REGISTRY: dict[str, Query] = {}


def register(name: str, cols: list[str], sql: str | None = None, needs=(), doubles=None):
    def deco(fn: Callable[[fx.Tables], DataFrame]):
        REGISTRY[name] = Query(name, fn, list(cols), sql, tuple(needs), doubles)
        return fn

    return deco


def round_half_away(c: str) -> Column:
    """``x`` rounded to ``ROUND_DIGITS`` decimals with plain IEEE steps
    (scale, add a half, floor/ceil, unscale), written identically in the
    oracle SQL.  Exact decimal ties are common in fixture data (cents over
    round stakes) and a sum formed in another order can sit one ulp either
    side of them, so a tie is widened by ``TIE`` of the last kept digit."""
    x = F.col(c)
    m = F.lit(float(10**ROUND_DIGITS))
    half = F.lit(0.5 + O.TIE)
    up = F.floor(x * m + half).cast("double")
    down = F.ceil(x * m - half).cast("double")
    return F.when(x >= 0, up).otherwise(down) / m


def finish(df: DataFrame) -> DataFrame:
    """Round every double column."""
    return df.select(
        *[
            round_half_away(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def select_from(cte_name: str, cols: list[str], extra: str = "") -> str:
    return f"SELECT {', '.join(cols)} FROM {cte_name} {extra}".strip()


# --- shared Spark pieces ------------------------------------------------------------


def _snaps(t: fx.Tables, grid: Grid, orders: bool = False) -> DataFrame:
    return t.memo(
        ("snapshots", orders, grid),
        lambda: pinned(resolve_blocks(fx.order_blocks(t) if orders else fx.event_blocks(t), grid), grid),
    )


GLOBAL_6H = J.with_spec(J.GLOBAL, days=30, step=6)
JOB_GLOBAL = J.with_spec(J.GLOBAL, rows=20)  # rows cut visible at fixture scale
TAIL_ROWS = 1000


# Plans shared by several queries are built once per input set (plan objects
# only; no data is cached).


def _fee_split(t: fx.Tables):
    return t.memo("fee_split", lambda: J.fee_split_of(t))


def _global_frame(t: fx.Tables, spec: J.JobSpec = J.GLOBAL) -> DataFrame:
    return t.memo(("global_frame", spec), lambda: J.global_frame(t, _fee_split(t), spec))


def _subgraph_frame(t: fx.Tables) -> DataFrame:
    return t.memo("subgraph_frame", lambda: J.subgraphs_frame(t, _fee_split(t)))


def _versions_flat(t: fx.Tables, grid: Grid = fx.G1_DAILY) -> DataFrame:
    return flatten(scans.scan_versions(t, grid, _snaps(t, grid)))


def _network_flat(t: fx.Tables, spec: J.JobSpec = J.GLOBAL) -> DataFrame:
    snaps = _snaps(t, spec.grid)
    return flatten(root_select(scans.scan_network(t, spec.grid, snaps), spec.return_value))


# --- A1-A3: grid and as-of lookup ---------------------------------------------------

ASOF_COLS = ["stamp", "block"]
for _name, _grid, _s, _orders in (
    ("asof_block", fx.G1_DAILY, "s1", False),
    ("asof_block_6h", fx.G2_SIX_HOURLY, "s2", False),
    ("asof_block_20m", fx.G3_TWENTY_MINUTES, "s3", False),
    ("asof_block_unresolved", fx.G4_EARLY_START, "s4", False),
    ("asof_block_orders", fx.G5_ORDERS, "s5", True),
):
    register(_name, ASOF_COLS, select_from(_s, ASOF_COLS), [_s])(
        (lambda g, o: lambda t: resolve_blocks(fx.order_blocks(t) if o else fx.event_blocks(t), g))(_grid, _orders)
    )


def grid_with_blocks(t: fx.Tables, grid: Grid) -> DataFrame:
    """A1 + A2 before A3: every stamp of the grid with its as-of block, null
    where no block lies at or before it."""
    resolved = _snaps(t, grid).select("idx", "block")
    return grid.to_df(t.spark).join(F.broadcast(resolved), "idx", "left")


for _name, _grid, _s in (("snapshot_grid", fx.G4_EARLY_START, "s4"), ("snapshot_grid_6h", fx.G2_SIX_HOURLY, "s2")):
    register(_name, ["idx", "stamp", "block"], select_from(f"{_s}_all", ["idx", "stamp", "CAST(block AS BIGINT) AS block"]), [f"{_s}_all"])(
        (lambda g: lambda t: grid_with_blocks(t, g))(_grid)
    )


# --- A4, A9, A10: state as of blocks --------------------------------------------------

VSTATE_COLS = ["user_id", "event_type", "block", *scans.VERSION_STATE_COLS]
USTATE_COLS = ["user_id", "block", *scans.SUBGRAPH_STATE_COLS]


@register("totals_as_of", VSTATE_COLS, select_from("vstate_s1", VSTATE_COLS), ["vstate_s1"])
def _totals_as_of(t):
    snaps = _snaps(t, fx.G1_DAILY)
    return as_of(fx.event_log(t), ["user_id", "event_type"], fx.G1_DAILY, snaps, scans.version_state(), "event_id", order="event_id")


@register("state_as_of", USTATE_COLS, select_from("ustate_s1", USTATE_COLS), ["ustate_s1"])
def _state_as_of(t):
    snaps = _snaps(t, fx.G1_DAILY)
    return as_of(fx.event_log(t), ["user_id"], fx.G1_DAILY, snaps, scans.subgraph_state(), "event_id", order="event_id")


@register("state_as_of_20m", USTATE_COLS, select_from("ustate_s3", USTATE_COLS), ["ustate_s3"])
def _state_as_of_20m(t):
    snaps = _snaps(t, fx.G3_TWENTY_MINUTES)
    return as_of(fx.event_log(t), ["user_id"], fx.G3_TWENTY_MINUTES, snaps, scans.subgraph_state(), "event_id", order="event_id")


@register("totals_as_of_20m", VSTATE_COLS, select_from("vstate_s3", VSTATE_COLS), ["vstate_s3"])
def _totals_as_of_20m(t):
    snaps = _snaps(t, fx.G3_TWENTY_MINUTES)
    return as_of(
        fx.event_log(t), ["user_id", "event_type"], fx.G3_TWENTY_MINUTES, snaps, scans.version_state(), "event_id", order="event_id"
    )


# A log whose block order differs from its time order: the ids of neighbours
# are swapped in pairs, so state by block and state by time are not the same.
SWAPPED = "event_id + CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END"
O.cte("sblocks", f"SELECT {SWAPPED} AS block, ts AS block_time FROM events")
O.snaps("s3w", fx.G3_TWENTY_MINUTES, "sblocks")
USWAP_COLS = ["user_id", "block", "n_events", "last_k"]


@register(
    "state_as_of_unordered",
    USWAP_COLS,
    f"""SELECT e.user_id, p.block, count(*) AS n_events, arg_max(e.k, e.{SWAPPED}) AS last_k
FROM s3w_pb p JOIN ev e ON e.{SWAPPED} <= p.block GROUP BY e.user_id, p.block""".replace("e.event_id + CASE WHEN event_id", "e.event_id + CASE WHEN e.event_id"),
    ["s3w_pb", "ev"],
)
def _state_as_of_unordered(t):
    log = fx.event_log(t).withColumn("block", F.expr(SWAPPED))
    blocks = t.events.select(F.expr(SWAPPED).alias("block"), F.col("ts").alias("block_time"))
    grid = fx.G3_TWENTY_MINUTES
    aggs = {"n_events": (COUNT, F.col("event_id")), "last_k": (LATEST, F.col("k"))}
    return as_of(log, ["user_id"], grid, resolve_blocks(blocks, grid), aggs, order="block")


# Block numbers as text, some of them bad or missing.
TEXT_BLOCK = "CASE WHEN event_id % 5 = 0 THEN 'pending' WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id AS STRING) END"
O.cte("tblocks", f"SELECT TRY_CAST({TEXT_BLOCK.replace('STRING', 'VARCHAR')} AS BIGINT) AS block, ts AS block_time FROM events")
O.snaps("s2t", fx.G2_SIX_HOURLY, "tblocks")


@register("asof_block_text", ASOF_COLS, select_from("s2t", ASOF_COLS), ["s2t"])
def _asof_block_text(t):
    blocks = t.events.select(F.expr(TEXT_BLOCK).alias("block"), F.col("ts").alias("block_time"))
    return resolve_blocks(blocks, fx.G2_SIX_HOURLY)


VRAW_COLS = [
    "block",
    "id",
    "subgraph_id",
    "subgraph_createdAt",
    "subgraph_displayName",
    "subgraph_owner_id",
    "subgraph_active",
    "subgraphDeployment_id",
    "subgraphDeployment_stakedTokens",
    "subgraphDeployment_indexingIndexerRewardAmount",
    "subgraphDeployment_indexingDelegatorRewardAmount",
    "subgraphDeployment_queryFeesAmount",
    "subgraphDeployment_curatorFeeRewards",
    "subgraphDeployment_signalledTokens",
    "subgraphDeployment_signalAmount",
    "subgraphDeployment_pricePerShare",
    "subgraphDeployment_network_id",
]
O.cte("slatest_pb", "SELECT max(event_id) AS block FROM events")
O.versions("slatest")


@register("state_latest", VRAW_COLS, select_from("vraw_slatest", VRAW_COLS), ["vraw_slatest"], doubles=set())
def _state_latest(t):
    return flatten(scans.scan_versions_latest(t))


@register("json_root_select", ["event_id", "k"], select_from("ev", ["event_id", "k"]), ["ev"])
def _json_root_select(t):
    return fx.event_log(t)


@register(
    "flatten_json",
    ["event_id", "body_k", "body_owner_id"],
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS body_k, user_id AS body_owner_id FROM events",
    doubles=set(),
)
def _flatten_json(t):
    """B1 on JSON text: parsed to nested structs, then flattened."""
    body = F.concat(F.lit('{"body": '), F.regexp_replace("props", r"\}\s*$", ""), F.lit(', "owner": {"id": '), F.col("user_id").cast("string"), F.lit("}}}"))
    nested = F.from_json(body, "body struct<k: bigint, owner: struct<id: bigint>>")
    return flatten(t.events.select("event_id", nested.alias("json")).select("event_id", "json.*"))


# --- A5-A8, B1-B5: scans and shaping ---------------------------------------------------


@register("flatten_versions", VRAW_COLS, select_from("vraw_s1", VRAW_COLS), ["vraw_s1"], doubles=set())
def _flatten_versions(t):
    return _versions_flat(t)


def _as_json(df: DataFrame, keep: list[str]) -> DataFrame:
    """Nested columns as compact JSON text (comparable across engines)."""
    return df.select(*keep, *[F.to_json(c).alias(c) for c in df.columns if c not in keep])


SCAN_VERSIONS_SQL = """SELECT block, id,
  CAST(to_json({'id': subgraph_id, 'createdAt': subgraph_createdAt, 'displayName': subgraph_displayName,
                'owner': {'id': subgraph_owner_id}, 'active': subgraph_active}) AS VARCHAR) AS subgraph,
  CAST(to_json({'id': subgraphDeployment_id, 'stakedTokens': subgraphDeployment_stakedTokens,
                'indexingIndexerRewardAmount': subgraphDeployment_indexingIndexerRewardAmount,
                'indexingDelegatorRewardAmount': subgraphDeployment_indexingDelegatorRewardAmount,
                'queryFeesAmount': subgraphDeployment_queryFeesAmount,
                'curatorFeeRewards': subgraphDeployment_curatorFeeRewards,
                'signalledTokens': subgraphDeployment_signalledTokens,
                'signalAmount': subgraphDeployment_signalAmount,
                'pricePerShare': subgraphDeployment_pricePerShare,
                'network': {'id': subgraphDeployment_network_id}}) AS VARCHAR) AS subgraphDeployment
FROM vraw_s1"""


@register("scan_versions", ["block", "id", "subgraph", "subgraphDeployment"], SCAN_VERSIONS_SQL, ["vraw_s1"], doubles=set())
def _scan_versions(t):
    return _as_json(scans.scan_versions(t, fx.G1_DAILY, _snaps(t, fx.G1_DAILY)), ["block", "id"])


O.cte(
    "anested",
    """SELECT block, id, queryFeesCollected, delegationFees,
  CAST(to_json({'id': subgraphDeployment_id,
                'versions': coalesce(list({'id': subgraphDeployment_versions_id} ORDER BY subgraphDeployment_versions_id)
                                     FILTER (WHERE subgraphDeployment_versions_id IS NOT NULL), [])}) AS VARCHAR)
    AS subgraphDeployment,
  allocatedTokens, status, closedAtBlockNumber
FROM araw
GROUP BY block, id, queryFeesCollected, delegationFees, subgraphDeployment_id, allocatedTokens, status, closedAtBlockNumber""",
    "araw",
)
ANESTED_COLS = ["block", "id", "queryFeesCollected", "delegationFees", "subgraphDeployment", "allocatedTokens",
                "status", "closedAtBlockNumber"]


@register("scan_allocations_nested", ANESTED_COLS, select_from("anested", ANESTED_COLS), ["anested"], doubles=set())
def _scan_allocations_nested(t):
    nested = scans.scan_allocations(t, fx.G5_ORDERS, _snaps(t, fx.G5_ORDERS, True))
    return nested.withColumn("subgraphDeployment", F.to_json("subgraphDeployment"))


GRAW_COLS = [
    "block",
    "id",
    "curationPercentage",
    "delegationRatio",
    "totalTokensStaked",
    "totalTokensAllocated",
    "totalDelegatedTokens",
    "totalQueryFees",
    "totalCuratorQueryFees",
    "totalIndexingIndexerRewards",
    "totalIndexingDelegatorRewards",
    "totalTokensSignalled",
]


O.network("slatest")


@register("network_latest", GRAW_COLS, select_from("graw_slatest", GRAW_COLS), ["graw_slatest"], doubles=set())
def _network_latest(t):
    return flatten(root_select(scans.scan_network_latest(t), J.GLOBAL.return_value))


@register("scan_global", GRAW_COLS, select_from("graw_s6", GRAW_COLS), ["graw_s6"], doubles=set())
def _scan_global(t):
    return _network_flat(t)


ARAW_COLS = [
    "block",
    "id",
    "queryFeesCollected",
    "delegationFees",
    "subgraphDeployment_id",
    "subgraphDeployment_versions_id",
    "allocatedTokens",
    "status",
    "closedAtBlockNumber",
]


@register("scan_allocations", ARAW_COLS, select_from("araw", ARAW_COLS), ["araw"], doubles=set())
def _scan_allocations(t):
    return scans.allocation_rows(t, fx.G5_ORDERS, _snaps(t, fx.G5_ORDERS, True))


@register("allocations_latest", ARAW_COLS, select_from("araw_latest", ARAW_COLS), ["araw_latest"], doubles=set())
def _allocations_latest(t):
    return scans.allocation_rows_latest(t)


@register("explode_versions", ARAW_COLS, select_from("araw", ARAW_COLS), ["araw"], doubles=set())
def _explode_versions(t):
    nested = scans.scan_allocations(t, fx.G5_ORDERS, _snaps(t, fx.G5_ORDERS, True))
    return explode_child(flatten(nested), "subgraphDeployment_versions")


@register(
    "cap_per_snapshot",
    ARAW_COLS,
    "SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY block ORDER BY id) AS rk FROM araw) WHERE rk <= 1000",
    ["araw"],
    doubles=set(),
)
def _cap_per_snapshot(t):
    return scans.allocation_rows(t, fx.G5_ORDERS, _snaps(t, fx.G5_ORDERS, True), cap=1000)


GCLEAN_COLS = [
    "block",
    "stamp",
    "date",
    "curation_pct",
    "delegation_ratio",
    "stake",
    "delegation",
    "allocation",
    "QF_total",
    "curator_rewards_total",
    "indexer_rewards_total",
    "delegator_rewards_total",
    "signal",
]


@register(
    "union_by_name",
    GCLEAN_COLS,
    "SELECT * EXCLUDE (delegation_ratio) FROM gtime_s6 WHERE date < DATE '2024-01-15' "
    "UNION ALL BY NAME SELECT * FROM gtime_s6 WHERE date >= DATE '2024-01-15'",
    ["gtime_s6"],
)
def _union_by_name(t):
    rows = J.global_clean(t)
    old = rows.where(F.col("date") < F.lit("2024-01-15").cast("date")).drop("delegation_ratio")
    new = rows.where(F.col("date") >= F.lit("2024-01-15").cast("date"))
    return union_all([old, new])


VREN_COLS = [
    "block",
    "version_id",
    "subgraph_id",
    "created_at",
    "display_name",
    "owner_id",
    "active",
    "deployment_id",
    "stake",
    "indexer_rewards_total",
    "delegator_rewards_total",
    "QF_total",
    "curator_rewards_total",
    "signal",
    "shares",
    "price_per_share",
    "network_id",
]


@register("rename_main", VREN_COLS, select_from("vren_s1", VREN_COLS), ["vren_s1"], doubles=set())
def _rename_main(t):
    return rename_map(_versions_flat(t), C.RENAME_MAIN)


GREN_COLS = ["block", "curation_pct", "delegation_ratio", *C.SCALED_GLOBAL]
GREN_SQL = (
    "SELECT block, curationPercentage AS curation_pct, delegationRatio AS delegation_ratio, "
    "totalTokensStaked AS stake, totalDelegatedTokens AS delegation, totalTokensAllocated AS allocation, "
    "totalQueryFees AS QF_total, totalCuratorQueryFees AS curator_rewards_total, "
    "totalIndexingIndexerRewards AS indexer_rewards_total, totalIndexingDelegatorRewards AS delegator_rewards_total, "
    "totalTokensSignalled AS signal FROM graw_s6"
)


@register("rename_global", GREN_COLS, GREN_SQL, ["graw_s6"], doubles=set())
def _rename_global(t):
    return rename_map(_network_flat(t), C.RENAME_GLOBAL)


AREN_COLS = [
    "block",
    "id",
    "QF_collected",
    "delegation_fees",
    "deployment_id",
    "version_id",
    "allocated_tokens",
    "status",
    "closed_at_block",
]
AREN_SQL = (
    "SELECT block, id, queryFeesCollected AS QF_collected, delegationFees AS delegation_fees, "
    "subgraphDeployment_id AS deployment_id, subgraphDeployment_versions_id AS version_id, "
    "allocatedTokens AS allocated_tokens, status, closedAtBlockNumber AS closed_at_block FROM araw"
)


@register("rename_allocations", AREN_COLS, AREN_SQL, ["araw"], doubles=set())
def _rename_allocations(t):
    return rename_map(_scan_allocations(t), C.RENAME_ALLOCATIONS)


# --- I1-I6: cleaning -------------------------------------------------------------------


@register("clean_main", VREN_COLS, select_from("vclean_s1", VREN_COLS), ["vclean_s1"])
def _clean_main(t):
    return J.clean_main(rename_map(_versions_flat(t), C.RENAME_MAIN))


GCLEAN_ONLY = [c for c in GCLEAN_COLS if c not in ("stamp", "date")]


@register("clean_global", GCLEAN_ONLY, select_from("gclean_s6", GCLEAN_ONLY), ["gclean_s6"])
def _clean_global(t):
    return J.clean_global(rename_map(_network_flat(t), C.RENAME_GLOBAL))


ACLEAN_COLS = [
    "id",
    "status",
    "block",
    "allocated_tokens",
    "delegation_fees",
    "QF_collected",
    "closed_at_block",
    "version_id",
    "deployment_id",
    "subgraph_id",
]


@register("clean_allocations", ACLEAN_COLS, select_from("aclean", ACLEAN_COLS), ["aclean"])
def _clean_allocations(t):
    return J.allocations_clean(t)


@register(
    "epoch_to_timestamp",
    ["subgraph_id", "block", "created_at", "created_date"],
    "SELECT DISTINCT subgraph_id, block, created_at, CAST(created_at AS DATE) AS created_date FROM vclean_s1",
    ["vclean_s1"],
)
def _epoch_to_timestamp(t):
    df = _clean_main(t).select("subgraph_id", "block", "created_at").distinct()
    return df.withColumn("created_date", F.to_date("created_at"))


@register(
    "strip_version_suffix",
    ["version_id", "subgraph_id"],
    select_from("aclean", ["version_id", "subgraph_id"]),
    ["aclean"],
)
def _strip_version_suffix(t):
    return J.allocations_clean(t)


# --- D1, C2-C4, D2, D5, E1-E5 ------------------------------------------------------------

VTIME_COLS = VREN_COLS + ["stamp", "date"]


@register("join_blocktimes", VTIME_COLS, select_from("vtime_s1", VTIME_COLS), ["vtime_s1"])
def _join_blocktimes(t):
    return J.versions_clean(t)


ROLL_COLS = list(J.ROLLUP_KEYS) + list(C.ROLLUP_MAX) + list(C.ROLLUP_SUM)


@register("rollup_subgraphs", ROLL_COLS, select_from("roll_s1", ROLL_COLS), ["roll_s1"])
def _rollup_subgraphs(t):
    return R.rollup(J.versions_clean(t), J.ROLLUP_KEYS, C.ROLLUP_SUM, C.ROLLUP_MAX)


# Null keys and null measures, made from real columns.
NULL_KEYS = {"subgraph_id": "CASE WHEN price_per_share > 5 THEN NULL ELSE subgraph_id END",
             "date": "CASE WHEN shares > 400 THEN NULL ELSE date END"}
NULL_MEASURES = {"signal": "CASE WHEN owner_id < '2' THEN NULL ELSE signal END",
                 "shares": "CASE WHEN owner_id < '2' THEN NULL ELSE shares END",
                 "active": "CASE WHEN owner_id < '2' THEN NULL ELSE active END"}


def _roll_sql(changes: dict[str, str]) -> str:
    sums = ", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in C.ROLLUP_SUM)
    maxes = ", ".join(f"max({c}) AS {c}" for c in C.ROLLUP_MAX)
    keys = ", ".join(J.ROLLUP_KEYS)
    present = " AND ".join(f"{k} IS NOT NULL" for k in J.ROLLUP_KEYS)
    replaced = ", ".join(f"{e} AS {c}" for c, e in changes.items())
    return f"SELECT {keys}, {maxes}, {sums} FROM (SELECT * REPLACE ({replaced}) FROM vtime_s1) WHERE {present} GROUP BY {keys}"


for _name, _changes in (("rollup_null_keys", NULL_KEYS), ("rollup_null_measures", NULL_MEASURES)):
    register(_name, ROLL_COLS, _roll_sql(_changes), ["vtime_s1"])(
        (lambda ch: lambda t: R.rollup(
            J.versions_clean(t).withColumns({c: F.expr(e) for c, e in ch.items()}), J.ROLLUP_KEYS, C.ROLLUP_SUM, C.ROLLUP_MAX
        ))(_changes)
    )


@register("distinct_names", ["display_name", "subgraph_id"], select_from("names_all_s1", ["display_name", "subgraph_id"]), ["names_all_s1"])
def _distinct_names(t):
    return R.distinct_names(J.versions_clean(t))


NAMED_COLS = ROLL_COLS + ["display_name"]


@register("join_names_latest", NAMED_COLS, select_from("named_s1", NAMED_COLS), ["named_s1"])
def _join_names_latest(t):
    return J.subgraphs_rollup(J.versions_clean(t), "latest")


@register(
    "join_names_all",
    NAMED_COLS,
    "SELECT r.*, n.display_name FROM roll_s1 r JOIN names_all_s1 n ON n.subgraph_id = r.subgraph_id",
    ["roll_s1", "names_all_s1"],
)
def _join_names_all(t):
    return J.subgraphs_rollup(J.versions_clean(t), "all")


# Names that change over time (trap T8): the two modes then differ.
RENAMED = "concat(display_name, CASE WHEN date < DATE '2024-01-11' THEN ' I' WHEN date < DATE '2024-01-21' THEN ' II' ELSE ' III' END)"
O.cte("vrenamed_s1", f"SELECT * REPLACE ({RENAMED} AS display_name) FROM vtime_s1", "vtime_s1")


def _renamed(t):
    return J.versions_clean(t).withColumn("display_name", F.expr(RENAMED))


@register(
    "rename_latest",
    NAMED_COLS,
    "SELECT r.*, n.display_name FROM roll_s1 r JOIN "
    "(SELECT subgraph_id, arg_max(display_name, block) AS display_name FROM vrenamed_s1 GROUP BY 1) n ON n.subgraph_id = r.subgraph_id",
    ["roll_s1", "vrenamed_s1"],
)
def _rename_latest(t):
    return J.subgraphs_rollup(_renamed(t), "latest")


@register(
    "rename_all",
    NAMED_COLS,
    "SELECT r.*, n.display_name FROM roll_s1 r JOIN (SELECT DISTINCT display_name, subgraph_id FROM vrenamed_s1) n ON n.subgraph_id = r.subgraph_id",
    ["roll_s1", "vrenamed_s1"],
)
def _rename_all(t):
    return J.subgraphs_rollup(_renamed(t), "all")


@register("filter_closed_in_range", ACLEAN_COLS, select_from("aframe", ACLEAN_COLS), ["aframe"])
def _filter_closed_in_range(t):
    return J.allocations_frame(t)


@register("feesplit", ["fee_split"], "SELECT fs AS fee_split FROM fs", ["fs"])
def _feesplit(t):
    """E5 from the weighted sums that the jobs use."""
    return t.spark.range(1).select(_fee_split(t).alias("fee_split"))


@register("feesplit_of_output", ["fee_split"], "SELECT fs AS fee_split FROM fs", ["fs"])
def _feesplit_of_output(t):
    """E5 over the written-out allocations frame, as the source takes it."""
    return t.spark.range(1).select(R.fee_split(J.allocations_output(J.allocations_frame(t))).alias("fee_split"))


@register(
    "join_scalar_feesplit",
    ["date", "block", "fee_split"],
    "SELECT g.date, g.block, f.fs AS fee_split FROM gtime_s6 g CROSS JOIN fs f",
    ["gtime_s6", "fs"],
)
def _join_scalar_feesplit(t):
    return R.attach_scalar(J.global_clean(t), "fee_split", _fee_split(t))


# --- F1-F7 windows --------------------------------------------------------------------------

GDIFF1 = ["date", "block", "QF", "signal_change", "stake_change", "allocation_change", "delegation_change",
          "curator_rewards", "indexer_rewards", "delegator_rewards"]


@register("global_diff1", GDIFF1, select_from("gdiff_s6", GDIFF1), ["gdiff_s6"])
def _global_diff1(t):
    return J.global_windows(J.global_clean(t))


GLONG = ["stamp", "block", "QF", "signal_change", "delegation_change_7d", "stake_change_30d", "QF_7d", "curator_rewards_30d", "signal_30d_mean", "stake_30d_mean"]


@register("global_long_grid", GLONG, select_from("groll_s7", GLONG), ["groll_s7"])
def _global_long_grid(t):
    """F1-F4 over more stamps than one task orders."""
    grid = fx.G7_LONG
    snaps = _snaps(t, grid)
    return J.global_windows(J.global_clean_from(scans.scan_network(t, grid, snaps), snaps, J.GLOBAL.return_value, grid), grid)


GDIFFN = ["date", "stamp", "block"] + [f"{b}_change_{n}d" for b in ("signal", "stake", "allocation", "delegation") for n in (7, 30)]


@register("global_diff_n", GDIFFN, select_from("gdiff_s2", GDIFFN), ["gdiff_s2"])
def _global_diff_n(t):
    return J.global_windows(J.global_clean(t, GLOBAL_6H))


GROLL = ["date", "stamp", "block"] + [f"{b}_{n}d" for b in ("QF", "curator_rewards", "indexer_rewards", "delegator_rewards") for n in (7, 30)]


@register("global_rolling_sum", GROLL, select_from("groll_s2", GROLL), ["groll_s2"])
def _global_rolling_sum(t):
    return J.global_windows(J.global_clean(t, GLOBAL_6H))


GMEAN = ["date", "stamp", "block", "signal_30d_mean", "stake_30d_mean", "delegation_30d_mean"]


@register("global_rolling_mean", GMEAN, select_from("groll_s2", GMEAN), ["groll_s2"])
def _global_rolling_mean(t):
    return J.global_windows(J.global_clean(t, GLOBAL_6H))


KEY = ["subgraph_id", "block", "stamp"]
KDIFF = KEY + ["QF", "signal_change", "stake_change", "shares_change", "price_change", "curator_rewards",
               "indexer_rewards", "delegator_rewards"]


@register("keyed_diff", KDIFF, select_from("sframe_s1", KDIFF), ["sframe_s1"])
def _keyed_diff(t):
    return _subgraph_frame(t)


KSUM = KEY + [f"QF_{n}d" for n in (7, 14, 30)] + [
    f"{b}_change_{n}d" for b in ("signal", "stake", "shares", "price") for n in (7, 14, 30)
] + [f"{b}_{n}d" for b in ("curator_rewards", "indexer_rewards", "delegator_rewards") for n in (7, 14, 30)]


@register("keyed_rolling_sum", KSUM, select_from("sframe_s1", KSUM), ["sframe_s1"])
def _keyed_rolling_sum(t):
    return _subgraph_frame(t)


KMEAN = KEY + [f"{b}_{n}d_MA" for b in ("signal", "stake", "shares", "price") for n in (7, 14, 30)]


@register("keyed_rolling_mean", KMEAN, select_from("sframe_s1", KMEAN), ["sframe_s1"])
def _keyed_rolling_mean(t):
    return _subgraph_frame(t)


# --- M1-M12 rates --------------------------------------------------------------------------

GRATES = ["date", "block", "signal_per_stake", "QF30D_per_signal"]


@register("global_rates", GRATES, select_from("gframe_s6", GRATES), ["gframe_s6"])
def _global_rates(t):
    return _global_frame(t)


GAPR = ["date", "block", "curator_apr_30d_estimate", "indexer_apr_30d_estimate", "delegator_apr_30d_estimate"]


@register("global_apr", GAPR, select_from("gframe_s6", GAPR), ["gframe_s6"])
def _global_apr(t):
    return _global_frame(t)


@register("global_apr_6h", GAPR, select_from("gframe_s2", GAPR), ["gframe_s2"])
def _global_apr_6h(t):
    return _global_frame(t, GLOBAL_6H)


# Zero and null denominators on real columns.
SAFE = "CASE WHEN subgraph_id LIKE '%1' THEN 0 WHEN subgraph_id LIKE '%2' THEN NULL ELSE stake END"


@register(
    "safe_ratios",
    KEY + ["signal_per_stake", "price_growth_7d"],
    f"SELECT subgraph_id, block, stamp, signal / nullif({SAFE}, 0) AS signal_per_stake, "
    f"-price_per_share / nullif(CASE WHEN subgraph_id LIKE '%1' THEN price_per_share ELSE 1 END - price_per_share, 0) - 1 AS price_growth_7d "
    "FROM roll_s1",
    ["roll_s1"],
)
def _safe_ratios(t):
    rows = R.rollup(J.versions_clean(t), J.ROLLUP_KEYS, C.ROLLUP_SUM, C.ROLLUP_MAX)
    change = F.expr("CASE WHEN subgraph_id LIKE '%1' THEN price_per_share ELSE 1 END")
    return rows.select(
        *KEY, M.ratio("signal", F.expr(SAFE)).alias("signal_per_stake"), M.price_growth("price_per_share", change).alias("price_growth_7d")
    )


SRATES = KEY + ["signal_per_stake"] + [f"curator_rewards_per_signal_{n}d" for n in (7, 14, 30)] + [
    f"indexer_rewards_per_stake_{n}d" for n in (7, 14, 30)
] + ["curator_rewards_per_share_30d"]


@register("subgraph_rates", SRATES, select_from("sframe_s1", SRATES), ["sframe_s1"])
def _subgraph_rates(t):
    return _subgraph_frame(t)


SAPR = KEY + ["curator_apr_30d_estimate", "indexer_apr_30d_estimate"]


@register("subgraph_apr", SAPR, select_from("sframe_s1", SAPR), ["sframe_s1"])
def _subgraph_apr(t):
    return _subgraph_frame(t)


PGROW = KEY + ["price_per_share"] + [f"price_growth_{n}d" for n in (7, 14, 30)]


@register("price_growth", PGROW, select_from("sframe_s1", PGROW), ["sframe_s1"])
def _price_growth(t):
    return _subgraph_frame(t)


# --- G3, A14, L1-L5, L7: outputs ----------------------------------------------------------


@register(
    "tail_by_date",
    C.OUT_SUBGRAPHS,
    select_from("sframe_s1", C.OUT_SUBGRAPHS, f"ORDER BY date DESC, md5(subgraph_id || ':' || block) DESC, subgraph_id DESC, block DESC LIMIT {TAIL_ROWS}"),
    ["sframe_s1"],
)
def _tail_by_date(t):
    return J.job_output(_subgraph_frame(t), J.with_spec(J.SUBGRAPHS, rows=TAIL_ROWS))


@register(
    "dated_output_name",
    ["name"],
    "SELECT 'global_' || strftime(max(date), '%m_%d_%Y') AS name FROM gtime_s6",
    ["gtime_s6"],
)
def _dated_output_name(t):
    return J.global_clean(t).agg(J.dated_name(J.GLOBAL.filename).alias("name"))


@register("job_allocations", C.OUT_ALLOCATIONS, select_from("aframe", C.OUT_ALLOCATIONS), ["aframe"])
def _job_allocations(t):
    return J.job_output(J.allocations_frame(t), J.ALLOCATIONS)


JOB_GLOBAL_SQL = select_from("gframe_s6", C.OUT_GLOBAL, f"ORDER BY date DESC, block DESC, stamp DESC LIMIT {JOB_GLOBAL.rows}")


@register("job_global", C.OUT_GLOBAL, JOB_GLOBAL_SQL, ["gframe_s6"])
def _job_global(t):
    return J.job_output(_global_frame(t), JOB_GLOBAL)


@register("job_subgraphs", C.OUT_SUBGRAPHS, select_from("sframe_s1", C.OUT_SUBGRAPHS), ["sframe_s1"])
def _job_subgraphs(t):
    return J.job_output(_subgraph_frame(t), J.SUBGRAPHS)


SHEET_SUB_SQL = select_from(
    "sframe_s1", C.SHEET_SUBGRAPHS, "WHERE date = (SELECT max(date) FROM sframe_s1) AND active"
)


@register("filter_latest_active", C.SHEET_SUBGRAPHS, SHEET_SUB_SQL, ["sframe_s1"])
def _filter_latest_active(t):
    return R.latest_active(_subgraph_frame(t), top=J.latest_date(J.snapshots_for(t, J.SUBGRAPHS)))


@register("sheet_subgraphs", C.SHEET_SUBGRAPHS, SHEET_SUB_SQL, ["sframe_s1"])
def _sheet_subgraphs(t):
    return P.sheet_subgraphs(_subgraph_frame(t), J.latest_date(J.snapshots_for(t, J.SUBGRAPHS)))


@register("sheet_global", C.SHEET_GLOBAL, select_from("gframe_s6", C.SHEET_GLOBAL), ["gframe_s6"])
def _sheet_global(t):
    return P.sheet_global(_global_frame(t))


# Display formats (I12), on values rounded as everywhere (T12), so that both
# engines format the same number.


def _text_sql(cols: list[str], ranges, source: str) -> str:
    fmts = P.column_formats(cols, ranges)
    number = {"#,##0.00": ("{:,.2f}", ""), "#,##0": ("{:,.0f}", ""), "0.00%": ("{:.2f}%", " * 100"), "0.0000%": ("{:.4f}%", " * 100")}
    items = []
    for c in cols:
        if c not in fmts:
            items.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif fmts[c] == "yyyy-mm-dd":
            items.append(f"strftime({c}, '%Y-%m-%d') AS {c}")
        else:
            pattern, times = number[fmts[c]]
            items.append(f"CASE WHEN {c} IS NOT NULL THEN format('{pattern}', {O.round_sql(c)}{times}) END AS {c}")
    return f"SELECT {', '.join(items)} FROM ({source}) v"


@register("sheet_subgraphs_text", C.SHEET_SUBGRAPHS, _text_sql(C.SHEET_SUBGRAPHS, C.FORMATS_SUBGRAPHS, SHEET_SUB_SQL), ["sframe_s1"], doubles=set())
def _sheet_subgraphs_text(t):
    return P.text_view(finish(_sheet_subgraphs(t)), C.FORMATS_SUBGRAPHS)


@register("sheet_global_text", C.SHEET_GLOBAL, _text_sql(C.SHEET_GLOBAL, C.FORMATS_GLOBAL, select_from("gframe_s6", C.SHEET_GLOBAL)), ["gframe_s6"], doubles=set())
def _sheet_global_text(t):
    return P.text_view(finish(P.sheet_global(_global_frame(t))), C.FORMATS_GLOBAL)


ACAP = 100
O.cte(
    "acap",
    f"SELECT * FROM aclean WHERE id IN (SELECT id FROM (SELECT block AS b, id, dense_rank() OVER (PARTITION BY block ORDER BY id) AS rk FROM aclean) WHERE rk <= {ACAP} AND b = aclean.block)",
    "aclean",
)


@register(
    "job_allocations_capped",
    C.OUT_ALLOCATIONS,
    f"SELECT {', '.join(C.OUT_ALLOCATIONS)} FROM acap WHERE closed_at_block BETWEEN (SELECT min(block) FROM acap) AND (SELECT max(block) FROM acap)",
    ["acap"],
)
def _job_allocations_capped(t):
    spec = J.with_spec(J.ALLOCATIONS, cap=ACAP)
    return J.job_output(J.allocations_frame(t, spec), spec)


RUN_ALL = ["job", "name", "label", "n_rows", "QF"]
# Sums of whole outputs are taken exactly, in millionths: a sum of doubles
# depends on the order of its rows.
EXACT = "CAST(sum(CAST(round({}, 6) AS DECIMAL(38, 6))) AS DOUBLE)"


@register(
    "run_all",
    RUN_ALL,
    f"""SELECT 'allocations' AS job, 'allocations' AS name, CAST(NULL AS VARCHAR) AS label, count(*) AS n_rows, {EXACT.format('QF_collected')} AS QF FROM aframe
UNION ALL
SELECT 'global', 'global_' || strftime(max(date), '%m_%d_%Y'), '{P.run_label(J.GLOBAL.end)}', least(count(*), {J.GLOBAL.rows}), {EXACT.format('QF')} FROM gframe_s6
UNION ALL
SELECT 'subgraphs', 'subgraphs_' || strftime(max(date), '%m_%d_%Y'), '{P.run_label(J.SUBGRAPHS.end)}', count(*), {EXACT.format('QF')} FROM sframe_s1""",
    ["aframe", "gframe_s6", "sframe_s1"],
)
def _run_all(t):
    """Run the jobs, then describe each output as read back."""
    base = P.scratch_path(t.spark, "run-all")
    out = []
    for job, path in P.run_all(t.spark, t.sf_dir, base).items():
        rows = t.spark.read.option("header", True).option("inferSchema", True).csv(path)
        qf = F.expr(EXACT.format("QF_collected" if job == "allocations" else "QF"))
        label = F.lit(None).cast("string") if job == "allocations" else F.lit(P.published(t.spark, base, f"{job}_sheet")[1])
        out.append(rows.agg(F.count(F.lit(1)).alias("n_rows"), qf.alias("QF")).select(F.lit(job).alias("job"), F.lit(path.rsplit("/", 1)[1]).alias("name"), label.alias("label"), "n_rows", "QF"))
    return union_all(out)


@register("csv_roundtrip", C.OUT_ALLOCATIONS, select_from("aframe", C.OUT_ALLOCATIONS), ["aframe"])
def _csv_roundtrip(t):
    return P.csv_roundtrip(_job_allocations(t))


@register("csv_roundtrip_dates", C.OUT_GLOBAL, JOB_GLOBAL_SQL, ["gframe_s6"])
def _csv_roundtrip_dates(t):
    out = _job_global(t)
    path = P.scratch_path(t.spark, "global-csv")
    P.write_csv(out, path)
    return P.read_csv(t.spark, path, P.global_csv_schema())


@register("republish_global", C.SHEET_GLOBAL, JOB_GLOBAL_SQL, ["gframe_s6"])
def _republish_global(t):
    out = _job_global(t)
    path = P.scratch_path(t.spark, "global-csv")
    P.write_csv(out, path)
    return P.republish_global(t.spark, path)


@register("published_sheet_subgraphs", C.SHEET_SUBGRAPHS, SHEET_SUB_SQL, ["sframe_s1"])
def _published_sheet_subgraphs(t):
    """Two versions are published, the second is read through its pointer."""
    base = P.scratch_path(t.spark, "published")
    view = P.sheet_subgraphs(_subgraph_frame(t), J.latest_date(J.snapshots_for(t, J.SUBGRAPHS)))
    P.publish(view.limit(1), base, "sheet", P.run_label(J.SUBGRAPHS.end))
    P.publish(view, base, "sheet", P.run_label(J.SUBGRAPHS.end))
    return P.published(t.spark, base, "sheet")[0]


@register("published_sheet_global", C.SHEET_GLOBAL, select_from("gframe_s6", C.SHEET_GLOBAL), ["gframe_s6"])
def _published_sheet_global(t):
    base = P.scratch_path(t.spark, "published")
    P.publish(P.sheet_global(_global_frame(t)), base, "sheet", P.run_label(J.GLOBAL.end))
    return P.published(t.spark, base, "sheet")[0]


@register("csv_reordered", C.OUT_GLOBAL, JOB_GLOBAL_SQL, ["gframe_s6"])
def _csv_reordered(t):
    """A saved file with its columns in another order, and one more, is
    read by name."""
    path = P.scratch_path(t.spark, "reordered")
    P.write_csv(_job_global(t).select(F.lit("x").alias("extra"), *reversed(C.OUT_GLOBAL)), path)
    return P.read_csv(t.spark, path, P.global_csv_schema())


BAD_ROW = "event_id % 11 = 3"


@register(
    "csv_bad_rows",
    ["ok", "n_rows", "ids", "cents"],
    f"""SELECT NOT ({BAD_ROW}) AS ok, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS ids,
CAST(sum(CASE WHEN {BAD_ROW} THEN NULL ELSE round(value * 100) END) AS BIGINT) AS cents FROM events GROUP BY 1""",
    [],
    doubles=set(),
)
def _csv_bad_rows(t):
    """Rows whose amount does not parse come by the bad-row channel."""
    path = P.scratch_path(t.spark, "bad-rows")
    text = F.when(F.expr(BAD_ROW), F.lit("n/a")).otherwise(fx.money_cents("value").cast("string"))
    P.write_csv(t.events.select("event_id", text.alias("cents")), path)
    good, bad = P.read_csv_checked(t.spark, path, StructType([StructField("event_id", LongType()), StructField("cents", LongType())]))
    rows = good.withColumn("ok", F.lit(True)).unionByName(bad.drop(P.BAD_LINE).withColumn("ok", F.lit(False)))
    return rows.groupBy("ok").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"), F.sum("cents").alias("cents"))


# --- B9 raw dump ------------------------------------------------------------------------------

RAW_SQL = """SELECT v.subgraph_displayName AS displayName, v.subgraph_id, v.id AS version_id,
       v.subgraphDeployment_id AS deployment_id, v.subgraph_owner_id AS owner_id,
       v.subgraphDeployment_network_id AS network_id, v.block, CAST(s.stamp AS DATE) AS blockDate,
       CAST(epoch_us(s.stamp) // 1000000 AS BIGINT) AS blockTime, v.subgraph_active AS active,
       v.subgraphDeployment_curatorFeeRewards AS curatorFeeRewards,
       v.subgraphDeployment_indexingIndexerRewardAmount AS indexerRewardAmount,
       v.subgraphDeployment_indexingDelegatorRewardAmount AS delegatorRewardAmount,
       v.subgraphDeployment_queryFeesAmount AS queryFeesAmount, v.subgraphDeployment_signalAmount AS signalAmount,
       v.subgraphDeployment_signalledTokens AS signalledTokens, v.subgraphDeployment_pricePerShare AS pricePerShare,
       v.subgraphDeployment_stakedTokens AS stakedTokens,
       CAST(make_timestamp(v.subgraph_createdAt * 1000000) AS DATE) AS createdDate
FROM vraw_s1 v JOIN s1 s ON s.block = v.block"""


@register("raw_dump", C.RAW_DUMP, RAW_SQL, ["vraw_s1", "s1"], doubles=set())
def _raw_dump(t):
    return J.raw_dump(_versions_flat(t), _snaps(t, fx.G1_DAILY))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.spark for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, q in REGISTRY.items():
        sql = q.oracle()
        if sql is not None:
            out[name] = sql
    return out
