"""Entity state as of every snapshot block (survey A4, A8, A10; design §7.3).

The source asks a remote store for the full entity state at each block, one
request per block.  Here the state comes from an append-only change log
``(keys..., time, ...)`` in four steps that never multiply the log by the
number of snapshots:

1. every log row gets the index of the first snapshot whose block is at or
   after the row's block, by an interval-bin join with the snapshot table
   (``place``); later rows are dropped;
2. a partial aggregation per ``(keys, idx)`` - map-side combined, so a hot
   key is reduced to at most one row per snapshot and partition before the
   shuffle;
3. running sums / max / min per key over those interval rows (at most
   ``grid.count`` rows per key, so no window partition can be skewed);
4. each interval row is carried forward to the snapshots up to the next
   change (``explode(sequence)``), and the snapshot block is attached by a
   broadcast join on the bounded snapshot table.

State is taken by block, as the source does, never by time: in a log whose
block order and time order differ, no row is lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from snapmetrics.sources.grid import Grid, block_range, chunk_of

# Aggregation kinds for ``as_of``: how a per-interval partial becomes state.
SUM, COUNT, MAX, MIN, LATEST = "sum", "count", "max", "min", "latest"
_RUNNING = {SUM: F.sum, COUNT: F.sum, MAX: F.max, MIN: F.min}


def _plus(a: Column, b: Column) -> Column:
    """The sum of two partials, either of which may be null."""
    return F.coalesce(a + b, a, b)


# Two partials of a kind to one; a null one has no rows.
_BOTH = {SUM: _plus, COUNT: _plus, MAX: F.greatest, MIN: F.least}


# Bins of the block axis per stamp of the grid.
BINS_PER_STAMP = 4


def _bin(block: Column, lo: Column, hi: Column, grid: Grid) -> Column:
    """The bin of a block: its distance from the first snapshot block, shifted
    so far that the snapshots span at most ``BINS_PER_STAMP`` bins a stamp."""
    bins = float(BINS_PER_STAMP * max(grid.count, 1))
    shift = F.greatest(F.lit(0), F.ceil(F.log2((hi - lo + 1).cast("double") / F.lit(bins))).cast("int"))
    beyond = F.call_function("shiftright", block - lo, shift)
    return F.when(block <= lo, F.lit(0).cast("bigint")).when(block <= hi, beyond)


def place(df: DataFrame, grid: Grid, snapshots: DataFrame, block: Column, how: str = "inner") -> DataFrame:
    """Add ``idx``, the first snapshot whose block is at or after ``block``,
    and ``place``, the number of distinct snapshot blocks before it.

    An interval-bin join: the block axis is cut into bins, each snapshot's
    interval ``(prior, block]`` lies in the bins that it meets, and a row
    looks only at the intervals of its own bin.  An equi-join on the bin with
    a range condition, so it is compiled, each row is placed once, and the
    interval table has at most a few rows per stamp.  ``how="left"`` keeps
    rows without a block or after the last one (both columns null).
    """
    lo, hi = block_range(snapshots)
    first, last = _bin(F.col("_prior") + F.lit(1), lo, hi, grid), _bin(F.col("_upto"), lo, hi, grid)
    intervals = snapshots.where("first_of_block").select("idx", "place", F.col("prior").alias("_prior"), F.col("block").alias("_upto"))
    intervals = intervals.withColumn("_bin", F.explode(F.sequence(F.coalesce(first, F.lit(0).cast("bigint")), last)))
    rows = df.withColumns({"_block": block, "_bin": _bin(block, lo, hi, grid)}).alias("r")
    near = grid.small(intervals).alias("i")
    inside = (F.col("r._block") <= F.col("i._upto")) & (F.col("i._prior").isNull() | (F.col("r._block") > F.col("i._prior")))
    found = rows.join(near, (F.col("r._bin") == F.col("i._bin")) & inside, how)
    return found.select(*[F.col(f"r.`{c}`") for c in df.columns], "i.idx", "i.place")


def assign_snapshot(log: DataFrame, grid: Grid, snapshots: DataFrame, block: str = "block") -> DataFrame:
    """Add ``idx``, the first snapshot whose block is at or after the row's;
    drop rows without a block and those after the last snapshot block."""
    return place(log, grid, snapshots, F.col(block)).drop("place")


def payload_blocks(grid: Grid, snapshots: DataFrame) -> DataFrame:
    """``(idx, block)`` for the first stamp of each distinct block."""
    return grid.small(snapshots.where("first_of_block").select("idx", "block"))


def spread(df: DataFrame, grid: Grid, snapshots: DataFrame, idx: str = "idx", until: str | None = None) -> DataFrame:
    """Carry each row forward from snapshot ``idx`` to ``until`` (default the
    last stamp), one row per distinct block, with ``block`` attached.

    The output is exactly the entity x snapshot rows the state has, so the
    explode is the inherent size of the result, not a fan-out of the input.
    """
    last = F.lit(grid.count - 1)
    stop = F.coalesce(F.col(until), last) if until else last
    exploded = df.withColumn(idx, F.explode(F.sequence(F.col(idx), stop)))
    if until:
        exploded = exploded.drop(until)
    return exploded.join(payload_blocks(grid, snapshots), idx, "inner").drop(idx)


def _partial(kind: str, name: str, expr: Column, order) -> list[Column]:
    if kind == SUM:
        return [F.sum(expr).alias(name)]
    if kind == COUNT:
        return [F.count(expr).alias(name)]
    if kind == MAX:
        return [F.max(expr).alias(name)]
    if kind == MIN:
        return [F.min(expr).alias(name)]
    if kind == LATEST:
        if order is None:
            raise ValueError("'latest' state needs an order column")
        return [F.max_by(expr, order).alias(name), F.max(order).alias(f"_ord_{name}")]
    raise ValueError(f"unknown state kind {kind!r}")


def interval_partials(
    log: DataFrame,
    keys: Sequence[str],
    grid: Grid,
    snapshots: DataFrame,
    aggs: Mapping[str, tuple[str, Column]],
    block: str = "block",
    order: str | Column | None = None,
) -> DataFrame:
    """Steps 1-2: one row per ``(keys, idx)`` with the interval's partials
    (``latest`` also keeps its order value as ``_ord_<name>``)."""
    cols = [c for name, (kind, expr) in aggs.items() for c in _partial(kind, name, expr, order)]
    return assign_snapshot(log, grid, snapshots, block).groupBy(*keys, "idx").agg(*cols)


def carry_forward(
    intervals: DataFrame,
    keys: Sequence[str],
    grid: Grid,
    snapshots: DataFrame,
    kinds: Mapping[str, str],
    keep_order: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Steps 3-4: running state per key over its interval rows, carried to
    every distinct snapshot block up to the next change.  ``keep_order``
    also carries each ``latest`` state's order value (``_ord_<name>``), so a
    parent can pick the latest among its children; ``carry`` names columns
    that are constant per key."""
    keys = list(keys)
    if not keys and grid.long:
        return spread(_one_series(intervals, kinds, keep_order, carry), grid, snapshots, "idx", "_until")
    w = Window.partitionBy(*keys).orderBy("idx")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state_cols = []
    for name, kind in kinds.items():
        if kind == LATEST:
            # The interval's own latest value is the state until the next change.
            state_cols.append(F.col(name))
            if keep_order:
                state_cols.append(F.col(f"_ord_{name}"))
        else:
            state_cols.append(_RUNNING[kind](name).over(upto).alias(name))
    state = intervals.select(*keys, *carry, "idx", (F.lead("idx").over(w) - F.lit(1)).alias("_until"), *state_cols)
    return spread(state, grid, snapshots, "idx", "_until")


def _one_series(intervals: DataFrame, kinds: Mapping[str, str], keep_order: bool, carry: Sequence[str]) -> DataFrame:
    """Running state of the one entity of a log without keys over a long
    grid: its interval rows are windowed in chunks of stamps, which take over
    the state before them and the next interval from a table of chunk ends."""
    part = intervals.withColumn("_chunk", chunk_of("idx"))
    running = {name: kind for name, kind in kinds.items() if kind != LATEST}
    totals = [_RUNNING[kind](name).alias(f"_sofar_{name}") for name, kind in running.items()]
    ends = part.groupBy("_chunk").agg(F.min("idx").alias("_first"), *totals)
    # One row per chunk.
    line = Window.orderBy("_chunk")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    carried = [_RUNNING[kind](f"_sofar_{name}").over(before).alias(f"_sofar_{name}") for name, kind in running.items()]
    ends = ends.select("_chunk", F.lead("_first").over(line).alias("_next"), *carried)
    w = Window.partitionBy("_chunk").orderBy("idx")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = []
    for name, kind in kinds.items():
        if kind == LATEST:
            state += [F.col(name), F.col(f"_ord_{name}")] if keep_order else [F.col(name)]
        else:
            state.append(_BOTH[kind](F.col(f"_sofar_{name}"), _RUNNING[kind](name).over(upto)).alias(name))
    until = F.coalesce(F.lead("idx").over(w), "_next") - F.lit(1)
    return part.join(ends, "_chunk").select(*carry, "idx", until.alias("_until"), *state)


def as_of(
    log: DataFrame,
    keys: Sequence[str],
    grid: Grid,
    snapshots: DataFrame,
    aggs: Mapping[str, tuple[str, Column]],
    block: str = "block",
    order: str | Column | None = None,
) -> DataFrame:
    """A4: state per ``keys`` at every distinct snapshot block.

    ``aggs`` maps an output name to ``(kind, expression)``; kinds are
    ``sum``/``count`` (running total), ``max``/``min`` (running extreme) and
    ``latest`` (value of the row with the greatest ``order`` so far).  An
    entity has no row before its first log row; ``block`` is the log's block
    column.  Returns ``(keys..., block, <aggs>)``.
    """
    partials = interval_partials(log, keys, grid, snapshots, aggs, block, order)
    return carry_forward(partials, keys, grid, snapshots, {n: k for n, (k, _) in aggs.items()})


def latest_state(
    log: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, tuple[str, Column]],
    block: str,
    order: str | Column | None = None,
) -> DataFrame:
    """A10: state at the latest block of the log (the request without a block).

    One grouped aggregation; the block is the log's own maximum, attached as
    a scalar subquery.
    """
    exprs = []
    for name, (kind, expr) in aggs.items():
        if kind in (SUM,):
            exprs.append(F.sum(expr).alias(name))
        elif kind == COUNT:
            exprs.append(F.count(expr).alias(name))
        elif kind == MAX:
            exprs.append(F.max(expr).alias(name))
        elif kind == MIN:
            exprs.append(F.min(expr).alias(name))
        elif kind == LATEST:
            exprs.append(F.max_by(expr, order).alias(name))
        else:
            raise ValueError(f"unknown state kind {kind!r}")
    top = log.agg(F.max(block)).scalar()
    return log.groupBy(*keys).agg(*exprs).withColumn("block", top)


# Ranges into which the keys of a snapshot are counted, and how often the
# range that holds the cut is counted again.
CAP_RANGES, CAP_LEVELS = 4096, 2


def _magnitude(df: DataFrame, order: str) -> Column:
    """A number that never falls as ``order`` rises: of text, its bytes after
    the prefix that the least and greatest key share, as far as a double
    goes; of a number, itself."""
    kind = df.schema[order].dataType
    if isinstance(kind, NumericType):
        return F.col(order).cast("double")
    if not isinstance(kind, StringType):
        raise TypeError(f"cannot cap by a column of type {kind.simpleString()}")
    raw = lambda c: F.hex(F.col(c).cast("binary"))
    ends = df.agg(F.min(order).alias("_a"), F.max(order).alias("_b")).select(raw("_a").alias("_a"), raw("_b").alias("_b"))
    digit = lambda c, i: F.substring(c, i, F.lit(1))
    same = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length("_a"), F.lit(1))),
        F.lit(0),
        lambda n, i: F.when((n == i - 1) & (digit("_a", i) == digit("_b", i)), i).otherwise(n),
    )
    digits = F.rpad(F.substring(raw(order), ends.select(same + 1).scalar(), F.lit(12)), 12, "0")
    return F.conv(digits, 16, 10).cast("double")


def _by_snapshot(df: DataFrame, grid: Grid | None) -> DataFrame:
    """``df``, which has one row per snapshot, as broadcast, so that rows never
    meet it by snapshot: a few snapshots would be as few tasks.  (Left to
    itself Spark keeps the shuffle join, since most partitions are empty.)"""
    return grid.small(df) if grid is not None else F.broadcast(df)


def _cut_range(keys: DataFrame, by: str, grid: Grid | None = None) -> DataFrame:
    """For each snapshot of ``keys`` (by, key, _v, _left) the range of values
    that holds its ``_left``-th smallest key: the keys in it and how many of
    them are kept.  Snapshots with fewer keys are left out."""
    span = keys.groupBy(by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-300))
    part = F.least(F.floor((F.col("_v") - F.col("_lo")) / width * CAP_RANGES), F.lit(CAP_RANGES - 1))
    parted = keys.join(_by_snapshot(span, grid), by).withColumn("_part", part).drop("_lo", "_hi")
    counts = parted.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_n"), F.max("_left").alias("_left"))
    # At most CAP_RANGES rows a snapshot.
    upto = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("_upto", F.sum("_n").over(upto))
    before = F.col("_upto") - F.col("_n")
    cut = running.where((F.col("_upto") >= F.col("_left")) & (before < F.col("_left"))).select(by, "_part", (F.col("_left") - before).alias("_rest"))
    return parted.join(_by_snapshot(cut, grid), [by, "_part"]).withColumn("_left", F.col("_rest")).drop("_part", "_rest")


def cap_threshold(df: DataFrame, n: int, by: str = "block", order: str = "id", grid: Grid | None = None) -> DataFrame:
    """``(by, _most)``: each snapshot's ``n``-th smallest key, for snapshots
    that have so many.

    Threshold selection: keys are counted in ``CAP_RANGES`` ranges of their
    values, the one range that holds the n-th key is counted again in finer
    ones, and only the keys of the last cut range are ranked.
    """
    keys = df.select(by, order).where(F.col(by).isNotNull() & F.col(order).isNotNull()).distinct()
    keys = keys.withColumns({"_v": _magnitude(df, order), "_left": F.lit(n).cast("bigint")})
    for _ in range(CAP_LEVELS):
        keys = _cut_range(keys, by, grid)
    last = Window.partitionBy(by).orderBy(order)
    ranked = keys.withColumn("_rk", F.row_number().over(last)).where(F.col("_rk") == F.col("_left"))
    return ranked.select(by, F.col(order).alias("_most"))


def cap_per_snapshot(df: DataFrame, n: int, by: str = "block", order: str = "id", grid: Grid | None = None) -> DataFrame:
    """At most ``n`` entities per snapshot, lowest ``order`` first.

    The source's ``first: n`` has no stated order; we make it deterministic.
    All rows of one entity stay together.  Rows are kept by comparing their
    key with the snapshot's n-th one (``cap_threshold``), so no snapshot is
    ranked whole; rows without a key or snapshot fall out.  ``order`` is text
    or a number.  ``grid``, if known, tells whether one row per snapshot may be
    broadcast.
    """
    if n <= 0:
        return df.where(F.lit(False))
    most = _by_snapshot(cap_threshold(df, n, by, order, grid), grid)
    kept = df.where(F.col(by).isNotNull() & F.col(order).isNotNull()).join(most, by, "left")
    return kept.where(F.col("_most").isNull() | (F.col(order) <= F.col("_most"))).select(*df.columns)
