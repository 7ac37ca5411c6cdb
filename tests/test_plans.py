"""Physical-plan properties that matter at scale."""

import re

from pyspark.sql import functions as F

from snapmetrics.plans import jobs as J
from snapmetrics.sources import fixtures as fx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_job(tables):
    fs = J.fee_split_of(tables)
    for df in (J.allocations_frame(tables), J.global_frame(tables, fs), J.subgraphs_frame(tables, fs)):
        p = _plan(df)
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def _exchanges(plan):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)\(?([^)]*)", plan)


def test_time_bound_and_pruned_columns_reach_the_scan(tables):
    from snapmetrics.sources.grid import resolve_blocks

    p = _plan(resolve_blocks(fx.event_blocks(tables), fx.G1_DAILY))
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_keyed_windows_share_one_exchange(tables):
    rolled = J.subgraphs_rolled(tables)
    extra = len(_exchanges(_plan(J.subgraphs_windows(rolled)))) - len(_exchanges(_plan(rolled)))
    # The latest-name window already deals the rows by subgraph.
    assert extra == 0
    assert _plan(J.subgraphs_windows(rolled)).count("Window [") >= 3


def test_version_rows_meet_a_partial_aggregate_before_they_are_dealt(tables):
    """After the spread over snapshots every exchange carries combined rows."""
    p = _plan(J.subgraphs_rolled(tables))
    spread = p.index("Generate explode(sequence(")
    above = p[:spread]
    dealt = [m.start() for m in re.finditer("Exchange hashpartitioning", above)]
    assert len(dealt) == 2
    below = [above[i:].split("\n")[1] for i in dealt]
    assert any("Aggregate" in x and "partial_" in x for x in below)


def test_owners_join_before_the_spread(tables):
    p = _plan(J.subgraphs_rolled(tables))
    assert p.index("customer.parquet") > p.index("Generate explode(sequence(")


def test_snapshot_table_is_broadcast(tables):
    p = _plan(J.versions_clean(tables))
    assert "BroadcastHashJoin" in p and "BroadcastNestedLoopJoin" not in p
    assert "CartesianProduct" not in p


def test_first_shuffle_of_the_log_is_partial_aggregate(tables):
    from snapmetrics.sources import scans

    p = _plan(scans.version_rows(tables, fx.G1_DAILY, J.snapshots_for(tables, J.SUBGRAPHS)))
    first = p[p.index("Exchange hashpartitioning(user_id#"):]
    assert "partial_count" in p and p.count("partial_max") >= 1
    assert "Exchange hashpartitioning" in first


def test_decoy_network_branch_is_pruned(tables):
    from snapmetrics.sources import scans

    snaps = J.snapshots_for(tables, J.GLOBAL)
    df = scans.scan_network(tables, J.GLOBAL.grid, snaps)
    assert "Union" not in _plan(df)


def test_last_n_ranks_only_a_slice_of_a_date(spark):
    df = spark.range(5000).selectExpr("DATE '2024-01-01' + CAST(id % 2 AS INT) AS date", "CAST(id AS STRING) AS k")
    out = J.last_n(df, 3000, "date", ("k",))
    p = _plan(out)
    assert "TakeOrderedAndProject" not in p and "GlobalLimit" not in p
    assert re.search(r"row_number\(\) windowspecdefinition\(_slice", p)
    rows = out.collect()
    assert len(rows) == 3000 and sum(r.date.day == 2 for r in rows) == 2500
    again = {r.k for r in J.last_n(df.repartition(7), 3000, "date", ("k",)).collect()}
    assert again == {r.k for r in rows}


def test_no_rows_are_cut_unless_asked(tables):
    assert J.SUBGRAPHS.rows is None and J.ALLOCATIONS.rows is None
    frame = J.subgraphs_frame(tables, F.lit(0.05))
    assert J.job_output(frame, J.SUBGRAPHS).count() == frame.count()


def test_passes_over_the_lines(tables):
    """Totals and version ids come from one read and one exchange of the lines."""
    fee = _plan(tables.spark.range(1).select(J.fee_split_of(tables).alias("f")))
    for p in (fee, _plan(J.allocations_frame(tables))):
        # A subquery of two fields is printed twice and run once.
        assert len(set(re.findall(r"FileScan parquet (\[l_orderkey[^\]]*\])", p))) == 1
        assert len(set(re.findall(r"Exchange hashpartitioning\((l_orderkey#\d+L?), \d+\), REPARTITION_BY_COL", p))) == 1


def test_fee_split_places_days_not_orders(tables):
    p = _plan(tables.spark.range(1).select(J.fee_split_of(tables).alias("f")))
    # The orders meet a partial sum by day and closing before any placement.
    assert re.search(r"functions=\[partial_sum\([^\n]*fee_cents[^\n]*n_versions", p) and "lambda" not in p


def test_fee_split_has_no_version_join(tables):
    df = tables.spark.range(1).select(J.fee_split_of(tables).alias("f"))
    p = _plan(df)
    assert "explode(sequence(cast" not in p and "sequence(idx" not in p
