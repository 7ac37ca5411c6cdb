"""Filters, joins and aggregations between snapshot frames (survey C2–C4,
D1, D2, D5, E1–E5).

Scalars that a whole frame contributes (its block range, its latest date,
the fee split) are attached as uncorrelated scalar subqueries: Spark runs
each once as a tiny aggregation job and inlines the value, so no cross join
and no driver round trip is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions.clean import to_date
from snapmetrics.sources.grid import Grid


def attach_time(df: DataFrame, blocktimes: DataFrame, grid: Grid | None = None) -> DataFrame:
    """Rows x ``(block, stamp)`` on ``block``, plus the UTC ``date``.

    Two stamps on one block give two rows, as in the source.  With ``grid``,
    which ``blocktimes`` then comes from, its size is known and it may be
    broadcast; a caller's own table is left to Spark.
    """
    bt = blocktimes.select("block", "stamp")
    bt = grid.small(bt) if grid else bt
    return df.join(bt, "block", "inner").withColumn("date", to_date("stamp"))


def rollup(
    df: DataFrame, keys: Sequence[str], sums: Sequence[str], maxes: Sequence[str], name: str | None = None
) -> DataFrame:
    """E1 + C4: group by ``keys``; ``max`` of ``maxes``, ``sum`` of ``sums``.

    Rows with a null key are dropped first (the source's grouping drops them,
    Spark would keep a null group).  A sum over only nulls is 0, a max over
    only nulls is null.  ``name``: a label to keep, the greatest of a group.
    """
    keys = list(keys)
    aggs = [F.max(c).alias(c) for c in maxes] + [
        F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums
    ]
    if name:
        aggs.append(F.max(name).alias(name))
    return df.dropna(subset=keys).groupBy(*keys).agg(*aggs)


def distinct_names(df: DataFrame, name: str = "display_name", key: str = "subgraph_id") -> DataFrame:
    """Distinct ``(name, key)`` pairs; null names count as equal."""
    return df.select(name, key).dropDuplicates()


def latest_names(df: DataFrame, name: str = "display_name", key: str = "subgraph_id", order: str = "block") -> DataFrame:
    """One name per key: the name at the greatest ``order`` (partial aggregate)."""
    return df.groupBy(key).agg(F.max_by(name, order).alias(name))


def attach_names(
    df: DataFrame,
    names_from: DataFrame,
    mode: str = "latest",
    name: str = "display_name",
    key: str = "subgraph_id",
) -> DataFrame:
    """Inner join of names on ``key``.

    ``all`` reproduces the source: every distinct name of a key joins, so a
    renamed key doubles its rows (trap T8).  ``latest`` (the default) keeps
    the name at the latest block.  The join strategy is left to AQE, which
    broadcasts the names only when their measured size allows it.
    """
    if mode == "all":
        names = distinct_names(names_from, name, key)
    elif mode == "latest":
        names = latest_names(names_from, name, key)
    else:
        raise ValueError(f"unknown names mode {mode!r}")
    return df.join(names, key, "inner")


def own_range(df: DataFrame, bound: str) -> Column:
    """``struct(lo, hi)`` = min and max of ``bound`` over the frame."""
    return df.agg(F.struct(F.min(bound).alias("lo"), F.max(bound).alias("hi"))).scalar()


def within_range(df: DataFrame, value: str, limits: Column) -> DataFrame:
    """Keep rows with ``limits.lo <= value <= limits.hi`` (nulls fall out)."""
    return df.where(F.col(value).between(limits.getField("lo"), limits.getField("hi")))


def within_own_range(df: DataFrame, value: str, bound: str) -> DataFrame:
    """Keep rows with ``min(bound) <= value <= max(bound)`` over the
    frame itself.  The bounds are a scalar subquery over the same frame;
    where the bounds can be had from a smaller input, pass them to
    ``within_range`` instead (the allocations job does)."""
    return within_range(df, value, own_range(df, bound))


def latest_active(df: DataFrame, date: str = "date", active: str = "active", top: Column | None = None) -> DataFrame:
    """Rows of the frame's latest date that are active (null is not).

    ``top`` is that date where it can be had from a smaller input: state
    carries forward, so a frame's latest date is that of the last stamp."""
    top = df.agg(F.max(date)).scalar() if top is None else top
    return df.where((F.col(date) == top) & F.col(active))


def fee_split(allocations: DataFrame, fees: str = "delegation_fees", collected: str = "QF_collected") -> Column:
    """E5: ``sum(fees) / sum(collected)`` over the allocations output, as a
    scalar column (null when nothing was collected)."""
    return allocations.agg(F.try_divide(F.sum(fees), F.sum(collected))).scalar()


def attach_scalar(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The same scalar on every row."""
    return df.withColumn(name, value)
