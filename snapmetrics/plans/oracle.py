"""Plain-SQL formulations of the registered queries, for DuckDB.

These are the correctness oracle, written independently of the Spark plans:
state "as of block b" is the triangular join ``log.block <= b`` followed by a
grouped aggregate (no interval trick, no carry-forward), the as-of lookup is
a correlated ``max``, and rolling windows sum their frame in row order
(``list_sum``) so that float sums are formed in the same order as Spark's
sliding frames.  Tables ``events customer orders lineitem`` are views.
"""

from __future__ import annotations

from snapmetrics.plans import columns as C
from snapmetrics.sources import fixtures as fx
from snapmetrics.sources.grid import Grid

ROUND_DIGITS = 6
TIE = 1e-6  # tie tolerance, in units of the last kept digit

_CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    _CTE[name] = (sql, deps)


def with_ctes(final: str, *needs: str) -> str:
    """``WITH`` clause holding ``needs`` and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTE[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{_CTE[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def txt(expr: str, zeros: int) -> str:
    return f"(CAST({expr} AS VARCHAR) || '{'0' * zeros}')"


def scaled(text_col: str) -> str:
    return f"(CAST({text_col} AS DOUBLE) / 1e18)"


# --- double columns (rounded in both engines, trap T12) ---------------------

NOT_DOUBLE = {
    "subgraph_id", "display_name", "block", "date", "created_at", "active", "id", "status", "closed_at_block",
    "version_id", "deployment_id", "owner_id", "network_id", "stamp", "curation_pct", "delegation_ratio",
    "user_id", "event_type", "event_id", "k", "n_events", "qf_cents", "curator_cents", "indexer_cents",
    "delegator_cents", "signal_k", "max_cents", "last_k", "first_ts", "user_last_k", "name", "created_date",
    "idx", "blockTime", "blockDate", "createdDate", "label", "job", "n_rows",
}


DOUBLES = {c for c in C.OUT_SUBGRAPHS + C.OUT_GLOBAL + C.OUT_ALLOCATIONS if c not in NOT_DOUBLE} | {
    "signal_30d_mean",
    "stake_30d_mean",
    "delegation_30d_mean",
    "curator_rewards_per_share_30d",
    "fee_split",
}


def round_sql(c: str) -> str:
    """Same IEEE steps as ``catalog.round_half_away``."""
    m = f"CAST({10**ROUND_DIGITS} AS DOUBLE)"
    half = f"CAST({0.5 + TIE!r} AS DOUBLE)"
    return (
        f"(CASE WHEN {c} >= 0 THEN CAST(floor({c} * {m} + {half}) AS DOUBLE) "
        f"ELSE CAST(ceil({c} * {m} - {half}) AS DOUBLE) END / {m})"
    )


# --- inputs ---------------------------------------------------------------------

_TYPES = ", ".join(f"'{t}'" for t in fx.EVENT_TYPES)

cte(
    "ev",
    """SELECT event_id, ts, user_id, event_type,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(round(value * 100) AS BIGINT) AS cents
FROM events""",
)
cte("evs", "SELECT *, CASE WHEN event_type = 'error' THEN -k ELSE k END AS signed_k FROM ev", "ev")
cte("eblocks", "SELECT event_id AS block, ts AS block_time FROM events")
cte(
    "oblocks",
    f"SELECT date_diff('day', DATE '{fx.ORDER_EPOCH}', CAST(o_orderdate AS DATE)) AS block, o_orderdate AS block_time FROM orders",
)


def grid_sql(g: Grid) -> str:
    start = g.start.strftime("%Y-%m-%d %H:%M:%S")
    return (
        f"SELECT CAST(i AS INTEGER) AS idx, TIMESTAMP '{start}' + to_seconds(i * {g.step_seconds}) AS stamp "
        f"FROM range({g.count}) t(i)"
    )


def snaps(name: str, g: Grid, blocks: str) -> None:
    """``{name}``: resolved stamps; ``{name}_pb``: distinct payload blocks."""
    cte(f"{name}_grid", grid_sql(g))
    cte(
        f"{name}_all",
        f"SELECT g.idx, g.stamp, (SELECT max(b.block) FROM {blocks} b WHERE b.block_time <= g.stamp) AS block FROM {name}_grid g",
        f"{name}_grid",
        blocks,
    )
    cte(name, f"SELECT idx, stamp, CAST(block AS BIGINT) AS block FROM {name}_all WHERE block IS NOT NULL", f"{name}_all")
    cte(f"{name}_pb", f"SELECT DISTINCT block FROM {name}", name)


snaps("s1", fx.G1_DAILY, "eblocks")
snaps("s2", fx.G2_SIX_HOURLY, "eblocks")
snaps("s3", fx.G3_TWENTY_MINUTES, "eblocks")
snaps("s4", fx.G4_EARLY_START, "eblocks")
snaps("s5", fx.G5_ORDERS, "oblocks")
snaps("s6", fx.G6_GLOBAL_60, "eblocks")


# --- versions (main) -------------------------------------------------------------


def versions(s: str) -> None:
    cte(
        f"vstate_{s}",
        f"""SELECT p.block, e.user_id, e.event_type,
       count(e.event_id) AS n_events,
       CAST(sum(e.cents) AS BIGINT) AS qf_cents,
       CAST(sum(CASE WHEN e.k % 3 = 0 THEN e.cents END) AS BIGINT) AS curator_cents,
       CAST(sum(CASE WHEN e.k % 3 = 1 THEN e.cents END) AS BIGINT) AS indexer_cents,
       CAST(sum(CASE WHEN e.k % 3 = 2 THEN e.cents END) AS BIGINT) AS delegator_cents,
       CAST(sum(e.signed_k) AS BIGINT) AS signal_k,
       max(e.cents) AS max_cents,
       arg_max(e.k, e.event_id) AS last_k
FROM {s}_pb p JOIN evs e ON e.event_id <= p.block
GROUP BY p.block, e.user_id, e.event_type""",
        f"{s}_pb",
        "evs",
    )
    cte(
        f"ustate_{s}",
        f"""SELECT p.block, e.user_id, min(e.ts) AS first_ts, arg_max(e.k, e.event_id) AS user_last_k
FROM {s}_pb p JOIN evs e ON e.event_id <= p.block
GROUP BY p.block, e.user_id""",
        f"{s}_pb",
        "evs",
    )
    vid = f"CAST(v.user_id AS VARCHAR) || '-' || CAST(list_position([{_TYPES}], v.event_type) - 1 AS VARCHAR)"
    cte(
        f"vraw_{s}",
        f"""SELECT v.block,
       {vid} AS id,
       CAST(v.user_id AS VARCHAR) AS subgraph_id,
       CAST(epoch_us(u.first_ts) // 1000000 AS BIGINT) AS subgraph_createdAt,
       c.c_name AS subgraph_displayName,
       CAST(c.c_nationkey AS VARCHAR) AS subgraph_owner_id,
       (u.user_last_k % 2 = 0) AS subgraph_active,
       'd' || {vid} AS subgraphDeployment_id,
       {txt('100 * v.n_events', 18)} AS subgraphDeployment_stakedTokens,
       {txt('coalesce(v.indexer_cents, 0)', 16)} AS subgraphDeployment_indexingIndexerRewardAmount,
       {txt('coalesce(v.delegator_cents, 0)', 16)} AS subgraphDeployment_indexingDelegatorRewardAmount,
       {txt('coalesce(v.qf_cents, 0)', 16)} AS subgraphDeployment_queryFeesAmount,
       {txt('coalesce(v.curator_cents, 0)', 16)} AS subgraphDeployment_curatorFeeRewards,
       {txt('coalesce(v.signal_k, 0)', 18)} AS subgraphDeployment_signalledTokens,
       {txt('v.max_cents', 16)} AS subgraphDeployment_signalAmount,
       CAST(1 + v.last_k // 10 AS VARCHAR) || '.' || CAST(v.last_k % 10 AS VARCHAR) AS subgraphDeployment_pricePerShare,
       '{fx.NETWORK_ID}' AS subgraphDeployment_network_id
FROM vstate_{s} v
JOIN ustate_{s} u ON u.user_id = v.user_id AND u.block = v.block
LEFT JOIN customer c ON c.c_custkey = v.user_id""",
        f"vstate_{s}",
        f"ustate_{s}",
    )
    cte(
        f"vren_{s}",
        f"""SELECT block, id AS version_id, subgraph_id, subgraph_createdAt AS created_at,
       subgraph_displayName AS display_name, subgraph_owner_id AS owner_id, subgraph_active AS active,
       subgraphDeployment_id AS deployment_id, subgraphDeployment_stakedTokens AS stake,
       subgraphDeployment_indexingIndexerRewardAmount AS indexer_rewards_total,
       subgraphDeployment_indexingDelegatorRewardAmount AS delegator_rewards_total,
       subgraphDeployment_queryFeesAmount AS QF_total,
       subgraphDeployment_curatorFeeRewards AS curator_rewards_total,
       subgraphDeployment_signalledTokens AS signal, subgraphDeployment_signalAmount AS shares,
       subgraphDeployment_pricePerShare AS price_per_share, subgraphDeployment_network_id AS network_id
FROM vraw_{s}""",
        f"vraw_{s}",
    )
    cte(
        f"vclean_{s}",
        f"""SELECT block, version_id, subgraph_id, make_timestamp(created_at * 1000000) AS created_at,
       display_name, owner_id, active, deployment_id,
       {scaled('stake')} AS stake, {scaled('indexer_rewards_total')} AS indexer_rewards_total,
       {scaled('delegator_rewards_total')} AS delegator_rewards_total, {scaled('QF_total')} AS QF_total,
       {scaled('curator_rewards_total')} AS curator_rewards_total, {scaled('signal')} AS signal,
       {scaled('shares')} AS shares, CAST(price_per_share AS DOUBLE) AS price_per_share, network_id
FROM vren_{s}""",
        f"vren_{s}",
    )
    cte(
        f"vtime_{s}",
        f"SELECT v.*, s.stamp, CAST(s.stamp AS DATE) AS date FROM vclean_{s} v JOIN {s} s ON s.block = v.block",
        f"vclean_{s}",
        s,
    )
    sums = ", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in C.ROLLUP_SUM)
    maxes = ", ".join(f"max({c}) AS {c}" for c in C.ROLLUP_MAX)
    cte(
        f"roll_{s}",
        f"""SELECT subgraph_id, block, stamp, date, created_at, {maxes}, {sums}
FROM vtime_{s}
WHERE subgraph_id IS NOT NULL AND block IS NOT NULL AND stamp IS NOT NULL AND date IS NOT NULL AND created_at IS NOT NULL
GROUP BY subgraph_id, block, stamp, date, created_at""",
        f"vtime_{s}",
    )
    cte(
        f"names_latest_{s}",
        f"SELECT subgraph_id, arg_max(display_name, block) AS display_name FROM vtime_{s} GROUP BY subgraph_id",
        f"vtime_{s}",
    )
    cte(f"names_all_{s}", f"SELECT DISTINCT display_name, subgraph_id FROM vtime_{s}", f"vtime_{s}")
    cte(
        f"named_{s}",
        f"SELECT r.*, n.display_name FROM roll_{s} r JOIN names_latest_{s} n ON n.subgraph_id = r.subgraph_id",
        f"roll_{s}",
        f"names_latest_{s}",
    )


# --- windows ------------------------------------------------------------------------


def dsql(x: str, n: int, w: str) -> str:
    return f"coalesce({x} - lag({x}, {n}) OVER ({w}), 0)"


def _frame(w: str, n: int) -> str:
    return f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rsum(x: str, n: int, w: str) -> str:
    f = _frame(w, n)
    return f"CASE WHEN count({x}) OVER {f} = {n} THEN list_sum(list({x}) OVER {f}) END"


def ravg(x: str, n: int, w: str) -> str:
    f = _frame(w, n)
    return f"CASE WHEN count({x}) OVER {f} = {n} THEN list_sum(list({x}) OVER {f}) / count({x}) OVER {f} END"


def ratio(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


ENTITY_W = "PARTITION BY subgraph_id ORDER BY block, stamp"
GLOBAL_W = "ORDER BY block, stamp"


def subgraph_frame(s: str, fs_cte: str = "fs") -> None:
    w = ENTITY_W
    changes = [
        f"{dsql('QF_total', 1, w)} AS QF",
        f"{dsql('signal', 1, w)} AS signal_change",
        f"{dsql('stake', 1, w)} AS stake_change",
        f"{dsql('shares', 1, w)} AS shares_change",
        f"{dsql('price_per_share', 1, w)} AS price_change",
        f"{dsql('curator_rewards_total', 1, w)} AS curator_rewards",
        f"{dsql('indexer_rewards_total', 1, w)} AS indexer_rewards",
        f"{dsql('delegator_rewards_total', 1, w)} AS delegator_rewards",
    ]
    cte(f"sdiff_{s}", f"SELECT *, {', '.join(changes)} FROM named_{s}", f"named_{s}")
    rolls = [f"{rsum('QF', n, w)} AS QF_{n}d" for n in (7, 14, 30)]
    for base, level in (("signal", "signal"), ("stake", "stake"), ("shares", "shares"), ("price", "price_per_share")):
        rolls += [f"{rsum(base + '_change', n, w)} AS {base}_change_{n}d" for n in (7, 14, 30)]
        rolls += [f"{ravg(level, n, w)} AS {base}_{n}d_MA" for n in (7, 14, 30)]
    for base in ("curator_rewards", "indexer_rewards", "delegator_rewards"):
        rolls += [f"{rsum(base, n, w)} AS {base}_{n}d" for n in (7, 14, 30)]
    cte(f"sroll_{s}", f"SELECT *, {', '.join(rolls)} FROM sdiff_{s}", f"sdiff_{s}")
    rates = [f"{ratio('signal', 'stake')} AS signal_per_stake"]
    rates += [f"{ratio(f'curator_rewards_{n}d', f'signal_{n}d_MA')} AS curator_rewards_per_signal_{n}d" for n in (7, 14, 30)]
    rates += [f"{ratio(f'indexer_rewards_{n}d', f'stake_{n}d_MA')} AS indexer_rewards_per_stake_{n}d" for n in (7, 14, 30)]
    rates.append(f"{ratio('curator_rewards_30d', 'signal_30d_MA')} * 12 AS curator_apr_30d_estimate")
    rates.append(
        f"{ratio('QF_30d * (1 - f.fs) + indexer_rewards_30d', 'stake_30d_MA')} * 12 AS indexer_apr_30d_estimate"
    )
    rates += [
        f"({ratio('-price_per_share', f'price_change_{n}d - price_per_share')} - 1) AS price_growth_{n}d"
        for n in (7, 14, 30)
    ]
    rates.append(f"{ratio('curator_rewards_30d', 'shares_30d_MA')} AS curator_rewards_per_share_30d")
    cte(f"sframe_{s}", f"SELECT r.*, {', '.join(rates)} FROM sroll_{s} r CROSS JOIN {fs_cte} f", f"sroll_{s}", fs_cte)


# --- network (global) ---------------------------------------------------------------


def network(s: str) -> None:
    cte(
        f"gstate_{s}",
        f"""SELECT p.block, count(e.event_id) AS n_events,
       CAST(sum(e.k) AS BIGINT) AS alloc_k, CAST(sum(100 - e.k) AS BIGINT) AS deleg_k,
       CAST(sum(e.cents) AS BIGINT) AS qf_cents,
       CAST(sum(CASE WHEN e.k % 3 = 0 THEN e.cents END) AS BIGINT) AS curator_cents,
       CAST(sum(CASE WHEN e.k % 3 = 1 THEN e.cents END) AS BIGINT) AS indexer_cents,
       CAST(sum(CASE WHEN e.k % 3 = 2 THEN e.cents END) AS BIGINT) AS delegator_cents,
       CAST(sum(e.signed_k) AS BIGINT) AS signal_k
FROM {s}_pb p JOIN evs e ON e.event_id <= p.block
GROUP BY p.block""",
        f"{s}_pb",
        "evs",
    )
    cte(
        f"graw_{s}",
        f"""SELECT block, '1' AS id, '{fx.CURATION_PERCENTAGE}' AS curationPercentage,
       '{fx.DELEGATION_RATIO}' AS delegationRatio,
       {txt('1000 * n_events', 18)} AS totalTokensStaked,
       {txt('coalesce(alloc_k, 0)', 18)} AS totalTokensAllocated,
       {txt('coalesce(deleg_k, 0)', 18)} AS totalDelegatedTokens,
       {txt('coalesce(qf_cents, 0)', 16)} AS totalQueryFees,
       {txt('coalesce(curator_cents, 0)', 16)} AS totalCuratorQueryFees,
       {txt('coalesce(indexer_cents, 0)', 16)} AS totalIndexingIndexerRewards,
       {txt('coalesce(delegator_cents, 0)', 16)} AS totalIndexingDelegatorRewards,
       {txt('coalesce(signal_k, 0)', 18)} AS totalTokensSignalled
FROM gstate_{s}""",
        f"gstate_{s}",
    )
    cte(
        f"gclean_{s}",
        f"""SELECT block, curationPercentage AS curation_pct, delegationRatio AS delegation_ratio,
       {scaled('totalTokensStaked')} AS stake, {scaled('totalDelegatedTokens')} AS delegation,
       {scaled('totalTokensAllocated')} AS allocation, {scaled('totalQueryFees')} AS QF_total,
       {scaled('totalCuratorQueryFees')} AS curator_rewards_total,
       {scaled('totalIndexingIndexerRewards')} AS indexer_rewards_total,
       {scaled('totalIndexingDelegatorRewards')} AS delegator_rewards_total,
       {scaled('totalTokensSignalled')} AS signal
FROM graw_{s}""",
        f"graw_{s}",
    )
    cte(
        f"gtime_{s}",
        f"SELECT g.*, s.stamp, CAST(s.stamp AS DATE) AS date FROM gclean_{s} g JOIN {s} s ON s.block = g.block",
        f"gclean_{s}",
        s,
    )
    w = GLOBAL_W
    changes = [f"{dsql('QF_total', 1, w)} AS QF"]
    for base in ("signal", "stake", "allocation", "delegation"):
        changes += [
            f"{dsql(base, 1, w)} AS {base}_change",
            f"{dsql(base, 7, w)} AS {base}_change_7d",
            f"{dsql(base, 30, w)} AS {base}_change_30d",
        ]
    for base in ("curator_rewards", "indexer_rewards", "delegator_rewards"):
        changes.append(f"{dsql(base + '_total', 1, w)} AS {base}")
    cte(f"gdiff_{s}", f"SELECT *, {', '.join(changes)} FROM gtime_{s}", f"gtime_{s}")
    rolls = []
    for base in ("QF", "curator_rewards", "indexer_rewards", "delegator_rewards"):
        rolls += [f"{rsum(base, 7, w)} AS {base}_7d", f"{rsum(base, 30, w)} AS {base}_30d"]
    for base in ("signal", "stake", "delegation"):
        rolls.append(f"{ravg(base, 30, w)} AS {base}_30d_mean")
    cte(f"groll_{s}", f"SELECT *, {', '.join(rolls)} FROM gdiff_{s}", f"gdiff_{s}")
    rates = [
        f"{ratio('signal', 'allocation')} AS signal_per_stake",
        f"{ratio('QF_30d', 'signal')} AS QF30D_per_signal",
        f"{ratio('curator_rewards_30d', 'signal_30d_mean')} * 12 AS curator_apr_30d_estimate",
        f"{ratio('indexer_rewards_30d + (1 - f.fs) * QF_30d', 'stake_30d_mean')} * 12 AS indexer_apr_30d_estimate",
        f"{ratio('delegator_rewards_30d + f.fs * QF_30d', 'delegation_30d_mean')} * 12 AS delegator_apr_30d_estimate",
    ]
    cte(f"gframe_{s}", f"SELECT r.*, {', '.join(rates)} FROM groll_{s} r CROSS JOIN fs f", f"groll_{s}", "fs")


# --- allocations -------------------------------------------------------------------

cte(
    "lines",
    """SELECT l_orderkey,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS qf_cents,
       CAST(sum(CAST(round(l_extendedprice * l_discount * 100) AS BIGINT)) AS BIGINT) AS fee_cents
FROM lineitem GROUP BY l_orderkey""",
)
cte(
    "vids",
    "SELECT DISTINCT l_orderkey, CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS version_id FROM lineitem",
)


def allocations(name: str, pb: str) -> None:
    cte(
        name,
        f"""SELECT p.block, CAST(o.o_orderkey AS VARCHAR) AS id,
       {txt('coalesce(l.qf_cents, 0)', 16)} AS queryFeesCollected,
       {txt('coalesce(l.fee_cents, 0)', 16)} AS delegationFees,
       'd' || CAST(o.o_orderkey AS VARCHAR) AS subgraphDeployment_id,
       v.version_id AS subgraphDeployment_versions_id,
       {txt('CAST(round(o.o_totalprice * 100) AS BIGINT)', 16)} AS allocatedTokens,
       CASE WHEN o.o_orderstatus = 'F'
                 AND date_diff('day', DATE '{fx.ORDER_EPOCH}', CAST(o.o_orderdate AS DATE)) + {fx.CLOSE_AFTER_DAYS} <= p.block
            THEN 'Closed' ELSE 'Active' END AS status,
       CAST(CASE WHEN o.o_orderstatus = 'F'
                 AND date_diff('day', DATE '{fx.ORDER_EPOCH}', CAST(o.o_orderdate AS DATE)) + {fx.CLOSE_AFTER_DAYS} <= p.block
            THEN date_diff('day', DATE '{fx.ORDER_EPOCH}', CAST(o.o_orderdate AS DATE)) + {fx.CLOSE_AFTER_DAYS} END AS BIGINT)
         AS closedAtBlockNumber
FROM {pb} p
JOIN orders o ON date_diff('day', DATE '{fx.ORDER_EPOCH}', CAST(o.o_orderdate AS DATE)) <= p.block
LEFT JOIN lines l ON l.l_orderkey = o.o_orderkey
LEFT JOIN vids v ON v.l_orderkey = o.o_orderkey""",
        pb,
        "lines",
        "vids",
    )


allocations("araw", "s5_pb")
cte("alatest_pb", "SELECT max(block) AS block FROM oblocks", "oblocks")
allocations("araw_latest", "alatest_pb")
cte(
    "aclean",
    f"""SELECT id, status, block, {scaled('allocatedTokens')} AS allocated_tokens,
       {scaled('delegationFees')} AS delegation_fees, {scaled('queryFeesCollected')} AS QF_collected,
       coalesce(closedAtBlockNumber, 0) AS closed_at_block,
       subgraphDeployment_versions_id AS version_id, subgraphDeployment_id AS deployment_id,
       CASE WHEN subgraphDeployment_versions_id <> ''
            THEN left(subgraphDeployment_versions_id, length(subgraphDeployment_versions_id) - 2) END AS subgraph_id
FROM araw""",
    "araw",
)
cte(
    "aframe",
    """SELECT * FROM aclean
WHERE closed_at_block BETWEEN (SELECT min(block) FROM aclean) AND (SELECT max(block) FROM aclean)""",
    "aclean",
)
cte("fs", "SELECT sum(delegation_fees) / nullif(sum(QF_collected), 0) AS fs FROM aframe", "aframe")

versions("s1")
versions("s3")
subgraph_frame("s1")
network("s6")
network("s2")
network("s1")

# A long grid: as-of by a join on the running greatest block, state by running
# sums over the log (a triangular join would be too slow).
cte("s7_grid", grid_sql(fx.G7_LONG))
cte(
    "s7",
    """SELECT g.idx, g.stamp, CAST(b.block AS BIGINT) AS block FROM s7_grid g
ASOF JOIN (SELECT block_time, max(max(block)) OVER (ORDER BY block_time) AS block FROM eblocks GROUP BY block_time) b
ON g.stamp >= b.block_time""",
    "s7_grid",
    "eblocks",
)
network("s7")
cte(
    "gstate_s7",
    """SELECT DISTINCT event_id AS block, count(event_id) OVER w AS n_events,
       CAST(sum(k) OVER w AS BIGINT) AS alloc_k, CAST(sum(100 - k) OVER w AS BIGINT) AS deleg_k,
       CAST(sum(cents) OVER w AS BIGINT) AS qf_cents,
       CAST(sum(CASE WHEN k % 3 = 0 THEN cents END) OVER w AS BIGINT) AS curator_cents,
       CAST(sum(CASE WHEN k % 3 = 1 THEN cents END) OVER w AS BIGINT) AS indexer_cents,
       CAST(sum(CASE WHEN k % 3 = 2 THEN cents END) OVER w AS BIGINT) AS delegator_cents,
       CAST(sum(signed_k) OVER w AS BIGINT) AS signal_k
FROM evs WINDOW w AS (ORDER BY event_id)""",
    "evs",
)
