"""Column contracts of the three jobs and two sheets (survey B5, B7–B9, §2.16).

Fixed values: these names, maps and orders must equal the published
outputs, so they are stated here plainly and in output order.
"""

from __future__ import annotations

# --- Fixed values: raw field -> clean name, per source query -------------

RENAME_ALLOCATIONS = {
    "allocatedTokens": "allocated_tokens",
    "closedAtBlockNumber": "closed_at_block",
    "delegationFees": "delegation_fees",
    "subgraphDeployment_id": "deployment_id",
    "queryFeesCollected": "QF_collected",
    "subgraphDeployment_versions_id": "version_id",
}

RENAME_MAIN = {
    "subgraph_active": "active",
    "id": "version_id",
    "subgraph_displayName": "display_name",
    "subgraph_owner_id": "owner_id",
    "subgraphDeployment_curatorFeeRewards": "curator_rewards_total",
    "subgraphDeployment_id": "deployment_id",
    "subgraphDeployment_indexingDelegatorRewardAmount": "delegator_rewards_total",
    "subgraphDeployment_indexingIndexerRewardAmount": "indexer_rewards_total",
    "subgraphDeployment_network_id": "network_id",  # spelled right (trap T17)
    "subgraphDeployment_pricePerShare": "price_per_share",
    "subgraphDeployment_queryFeesAmount": "QF_total",
    "subgraphDeployment_reserveRatio": "reserve_ratio",
    "subgraphDeployment_signalAmount": "shares",
    "subgraphDeployment_signalledTokens": "signal",
    "subgraphDeployment_stakedTokens": "stake",
    "subgraph_createdAt": "created_at",
}

RENAME_GLOBAL = {
    "curationPercentage": "curation_pct",
    "delegationRatio": "delegation_ratio",
    "totalTokensStaked": "stake",
    "totalDelegatedTokens": "delegation",
    "totalTokensAllocated": "allocation",
    "totalQueryFees": "QF_total",
    "totalCuratorQueryFees": "curator_rewards_total",
    "totalIndexingIndexerRewards": "indexer_rewards_total",
    "totalIndexingDelegatorRewards": "delegator_rewards_total",
    "totalTokensSignalled": "signal",
}

# --- Fixed values: amounts scaled by 10^-18 per source query (I1) --------

SCALED_MAIN = (
    "signal",
    "curator_rewards_total",
    "indexer_rewards_total",
    "delegator_rewards_total",
    "QF_total",
    "shares",
    "stake",
)
SCALED_GLOBAL = (
    "stake",
    "delegation",
    "allocation",
    "QF_total",
    "curator_rewards_total",
    "indexer_rewards_total",
    "delegator_rewards_total",
    "signal",
)
SCALED_ALLOCATIONS = ("allocated_tokens", "delegation_fees", "QF_collected")

# --- Fixed values: version -> subgraph rollup (E1) -----------------------

ROLLUP_MAX = ("active", "price_per_share", "shares")
ROLLUP_SUM = (
    "curator_rewards_total",
    "delegator_rewards_total",
    "indexer_rewards_total",
    "QF_total",
    "signal",
    "stake",
)

# --- Fixed values: output column lists -----------------------------------

OUT_ALLOCATIONS = [
    "subgraph_id",
    "id",
    "status",
    "block",
    "allocated_tokens",
    "delegation_fees",
    "QF_collected",
    "closed_at_block",
    "version_id",
    "deployment_id",
]

OUT_GLOBAL = [
    "date",
    "stake",
    "signal",
    "delegation",
    "allocation",
    "QF_total",
    "indexer_rewards_total",
    "delegator_rewards_total",
    "curator_rewards_total",
    "stake_change",
    "stake_change_7d",
    "stake_change_30d",
    "signal_change",
    "signal_change_7d",
    "signal_change_30d",
    "delegation_change",
    "delegation_change_7d",
    "delegation_change_30d",
    "allocation_change",
    "allocation_change_7d",
    "allocation_change_30d",
    "QF",
    "QF_7d",
    "QF_30d",
    "indexer_rewards",
    "indexer_rewards_7d",
    "indexer_rewards_30d",
    "delegator_rewards",
    "delegator_rewards_7d",
    "delegator_rewards_30d",
    "curator_rewards",
    "curator_rewards_7d",
    "curator_rewards_30d",
    "signal_per_stake",
    "QF30D_per_signal",
    "indexer_apr_30d_estimate",
    "delegator_apr_30d_estimate",
    "curator_apr_30d_estimate",
]

OUT_SUBGRAPHS = [
    "subgraph_id",
    "display_name",
    "block",
    "date",
    "created_at",
    "active",
    "QF_total",
    "shares",
    "signal",
    "stake",
    "curator_rewards_total",
    "delegator_rewards_total",
    "indexer_rewards_total",
    "price_per_share",
    "QF",
    "signal_change",
    "stake_change",
    "shares_change",
    "price_change",
    "curator_rewards",
    "indexer_rewards",
    "delegator_rewards",
    "QF_7d",
    "QF_14d",
    "QF_30d",
    "signal_change_7d",
    "signal_change_14d",
    "signal_change_30d",
    "signal_7d_MA",
    "signal_14d_MA",
    "signal_30d_MA",
    "stake_change_7d",
    "stake_change_14d",
    "stake_change_30d",
    "stake_7d_MA",
    "stake_14d_MA",
    "stake_30d_MA",
    "shares_change_7d",
    "shares_change_14d",
    "shares_change_30d",
    "shares_7d_MA",
    "shares_14d_MA",
    "shares_30d_MA",
    "price_change_7d",
    "price_change_14d",
    "price_change_30d",
    "price_7d_MA",
    "price_14d_MA",
    "price_30d_MA",
    "curator_rewards_7d",
    "curator_rewards_14d",
    "curator_rewards_30d",
    "indexer_rewards_7d",
    "indexer_rewards_14d",
    "indexer_rewards_30d",
    "delegator_rewards_7d",
    "delegator_rewards_14d",
    "delegator_rewards_30d",
    "curator_rewards_per_signal_7d",
    "curator_rewards_per_signal_14d",
    "curator_rewards_per_signal_30d",
    "indexer_rewards_per_stake_7d",
    "indexer_rewards_per_stake_14d",
    "indexer_rewards_per_stake_30d",
    "signal_per_stake",
    "curator_apr_30d_estimate",
    "indexer_apr_30d_estimate",
    "price_growth_7d",
    "price_growth_14d",
    "price_growth_30d",
]

OUT_BY_JOB = {"allocations": OUT_ALLOCATIONS, "global": OUT_GLOBAL, "subgraphs": OUT_SUBGRAPHS}

# --- Fixed values: sheet column lists ------------------------------------

SHEET_SUBGRAPHS = [
    "subgraph_id",
    "display_name",
    "date",
    "curator_apr_30d_estimate",
    "indexer_apr_30d_estimate",
    "QF_30d",
    "shares",
    "signal",
    "stake",
    "signal_per_stake",
    "curator_rewards_total",
    "delegator_rewards_total",
    "indexer_rewards_total",
    "price_per_share",
    "QF_total",
    "signal_change_7d",
    "signal_change_14d",
    "signal_change_30d",
    "price_growth_7d",
    "price_growth_14d",
    "price_growth_30d",
]

SHEET_GLOBAL = list(OUT_GLOBAL)  # the two global lists are identical

# --- Fixed values: raw dump projection (B9), with the fused pair split ---

RAW_DUMP = [
    "displayName",
    "subgraph_id",
    "version_id",
    "deployment_id",
    "owner_id",
    "network_id",
    "block",
    "blockDate",
    "blockTime",
    "active",
    "curatorFeeRewards",
    "indexerRewardAmount",
    "delegatorRewardAmount",
    "queryFeesAmount",
    "signalAmount",
    "signalledTokens",
    "pricePerShare",
    "stakedTokens",
    "createdDate",
]

# --- Fixed values: sheet display formats (I12), later entries win -------
# Spreadsheet column letters are resolved against the sheet lists above.

FORMATS_SUBGRAPHS = [
    ("D:S", "#,##0.00"),
    ("D:E", "0.00%"),
    ("J:J", "0.00%"),
    ("S:U", "0.00%"),
    ("C:C", "yyyy-mm-dd"),
    ("H:I", "#,##0"),
    ("K:M", "#,##0"),
    ("O:R", "#,##0"),
]

FORMATS_GLOBAL = [
    ("B:AG", "#,##0"),
    ("F:F", "#,##0.00"),
    ("V:X", "#,##0.00"),
    ("AE:AG", "#,##0.00"),
    ("AH:AH", "0.0000%"),
    ("AI:AL", "0.00%"),
    ("A:A", "yyyy-mm-dd"),
]

# Where each raw-dump column comes from in the flattened rows
# (None: derived from the snapshot time or the creation time).
RAW_DUMP_FROM = {
    "displayName": "subgraph_displayName",
    "subgraph_id": "subgraph_id",
    "version_id": "id",
    "deployment_id": "subgraphDeployment_id",
    "owner_id": "subgraph_owner_id",
    "network_id": "subgraphDeployment_network_id",
    "block": "block",
    "blockDate": None,
    "blockTime": None,
    "active": "subgraph_active",
    "curatorFeeRewards": "subgraphDeployment_curatorFeeRewards",
    "indexerRewardAmount": "subgraphDeployment_indexingIndexerRewardAmount",
    "delegatorRewardAmount": "subgraphDeployment_indexingDelegatorRewardAmount",
    "queryFeesAmount": "subgraphDeployment_queryFeesAmount",
    "signalAmount": "subgraphDeployment_signalAmount",
    "signalledTokens": "subgraphDeployment_signalledTokens",
    "pricePerShare": "subgraphDeployment_pricePerShare",
    "stakedTokens": "subgraphDeployment_stakedTokens",
    "createdDate": None,
}
