"""Snapshot grid and backward as-of block resolution (survey A1–A3, I10, I11).

The source job builds a list of UTC stamps at a fixed time of day and asks a
remote service, one stamp at a time, for "the last block at or before" each
stamp.  Here the grid is a small parameter object and the lookup is one
distributed aggregation over a block table ``(block, block_time)``:

* each block is given the index of the first stamp at or after its time by
  arithmetic (no join, no broadcast of the block table);
* a partial ``max(block)`` per stamp index collapses the block table to at
  most ``grid.count`` rows per partition before any shuffle;
* a running max over the stamp index fills stamps that saw no new block, and
  stamps before the first block stay null and are dropped (A3).

A table with one row per stamp is broadcast only for grids of at most
``BROADCAST_STAMPS`` stamps (``Grid.small``); beyond that the same equi-joins
are left to Spark.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmetrics.functions.clean import block_number, epoch_micros

# Stamps up to which a snapshot table is a proven small broadcast (about 40
# bytes a row, so a few MB).
BROADCAST_STAMPS = 100_000


@dataclass(frozen=True)
class Grid:
    """Regular grid of ``count`` stamps: ``start + i * step_seconds``."""

    start: _dt.datetime
    step_seconds: int
    count: int

    def __post_init__(self) -> None:
        if self.step_seconds <= 0:
            raise ValueError("grid step must be positive")
        if self.count < 0:
            raise ValueError("a grid cannot have a negative number of stamps")

    @classmethod
    def between(cls, first: _dt.datetime, last: _dt.datetime, step_seconds: int) -> "Grid":
        """Grid from ``first`` to ``last`` inclusive (a plain ``sequence``)."""
        span = int((last - first).total_seconds())
        return cls(first, step_seconds, span // step_seconds + 1 if span >= 0 else 0)

    @property
    def last(self) -> _dt.datetime:
        return self.start + _dt.timedelta(seconds=self.step_seconds * max(self.count - 1, 0))

    @property
    def long(self) -> bool:
        """More stamps than one task orders or a broadcast holds."""
        return self.count > BROADCAST_STAMPS

    def small(self, df: DataFrame) -> DataFrame:
        """``df``, which has at most a few rows per stamp, hinted as broadcast
        where the grid proves it small."""
        return df if self.long else F.broadcast(df)

    def stamp(self, i: int) -> _dt.datetime:
        return self.start + _dt.timedelta(seconds=self.step_seconds * i)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """``(idx int, stamp timestamp_ntz)``, one small partition."""
        start = F.lit(self.start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
        return spark.range(0, self.count, 1, 1).select(
            F.col("id").cast("int").alias("idx"),
            F.timestamp_add("SECOND", F.col("id") * F.lit(self.step_seconds), start).alias("stamp"),
        )

    def index_of(self, ts: str | Column) -> Column:
        """Index of the first stamp at or after ``ts`` (0 for times before start).

        Exact integer arithmetic on microseconds:
        ``ceil((ts - start) / step)`` clamped at 0.
        """
        t = F.col(ts) if isinstance(ts, str) else ts
        start_us = int((self.start - _dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        step_us = self.step_seconds * 1_000_000
        # ceil(d / s) = -floor(-d / s); floor via pmod keeps it exact.
        neg = F.lit(start_us) - epoch_micros(t)
        s = F.lit(step_us)
        ceil_q = -((neg - F.pmod(neg, s)) / s).cast("bigint")
        return F.greatest(F.lit(0).cast("bigint"), ceil_q).cast("int")

    def covers(self, ts: str | Column) -> Column:
        """Predicate ``ts <= last stamp``; a literal bound that reaches the scan."""
        t = F.col(ts) if isinstance(ts, str) else ts
        return t <= F.lit(self.last.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def snapshot_grid(
    end: _dt.date,
    days: int = 30,
    hours: int = 23,
    minutes: int = 59,
    seconds: int = 59,
    step: int = 24,
) -> Grid:
    """A1: stamps at ``hours:minutes:seconds`` UTC from ``end - days`` up to but
    excluding ``end`` (both at that time of day), every ``step`` hours.

    The source takes ``end`` as today; here it is a parameter.
    """
    end_time = _dt.datetime.combine(end, _dt.time(hours, minutes, seconds))
    start = end_time - _dt.timedelta(days=days)
    step_s = step * 3600
    span = int((end_time - start).total_seconds())
    count = max(0, -(-span // step_s))
    return Grid(start, step_s, count)


# Stamps of a long grid that are ordered in one task.
CHUNK_BITS = 12


def chunk_of(idx: str | Column) -> Column:
    """The chunk of a long grid that stamp ``idx`` lies in."""
    return F.shiftright(idx, CHUNK_BITS)


def _resolved(stamps: DataFrame, chunked: bool) -> DataFrame:
    """``(idx, stamp, last_block)`` per stamp to the snapshot table.

    A short grid is one window over its stamps.  A long one is windowed in
    chunks of stamps apart from each other; what a chunk takes over from
    those before it, its greatest block so far and the number of distinct
    blocks, comes from a table with one row per chunk.
    """
    if not chunked:
        order = Window.orderBy("idx")
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = stamps.withColumn("block", F.max("last_block").over(upto)).where(F.col("block").isNotNull())
        out = out.withColumn("prior", F.lag("block").over(order))
        first = F.coalesce(F.col("prior") != F.col("block"), F.lit(True))
        out = out.withColumn("first_of_block", first)
        return out.withColumn("place", F.sum(F.col("first_of_block").cast("int")).over(upto) - F.lit(1))
    order = Window.partitionBy("_chunk").orderBy("idx")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The chunk table has one row per 2^CHUNK_BITS stamps.
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    def carried(df: DataFrame, total: Column, take) -> DataFrame:
        ends = df.groupBy("_chunk").agg(total.alias("_total"))
        return df.join(ends.select("_chunk", take(F.col("_total")).over(before).alias("_carry")), "_chunk")

    part = stamps.withColumn("_chunk", chunk_of("idx"))
    part = carried(part, F.max("last_block"), F.max)
    part = part.withColumn("block", F.greatest("_carry", F.max("last_block").over(upto)))
    part = part.withColumn("prior", F.coalesce(F.lag("block").over(order), "_carry")).drop("_carry").where(F.col("block").isNotNull())
    part = part.withColumn("first_of_block", F.coalesce(F.col("prior") != F.col("block"), F.lit(True)))
    first = F.col("first_of_block").cast("int")
    part = carried(part, F.sum(first), F.sum)
    return part.withColumn("place", F.coalesce("_carry", F.lit(0)) + F.sum(first).over(upto) - F.lit(1))


def resolve_blocks(block_table: DataFrame, grid: Grid, block: str = "block", time: str = "block_time") -> DataFrame:
    """A2/A3: backward as-of lookup of every stamp in ``grid``.

    Returns ``(idx int, stamp timestamp_ntz, block bigint, first_of_block
    boolean, prior bigint, place bigint)``, one row per resolved stamp.
    ``first_of_block`` marks the first stamp of each distinct block: the
    source keys payloads by block, so a block shared by two stamps is fetched
    once (D1 fans it out again).  ``prior`` is the block of the stamp before
    (null for the first), ``place`` counts the distinct blocks before.  Block
    text that does not parse is ignored (I10), as is a stamp with no block at
    or before it (A3).
    """
    spark = block_table.sparkSession
    per_idx = (
        block_table.where(grid.covers(time))
        .select(grid.index_of(time).alias("idx"), block_number(block).alias("block"))
        .where(F.col("block").isNotNull())
        .groupBy("idx")
        .agg(F.max("block").alias("last_block"))
    )
    # Both sides hold at most grid.count rows.
    stamps = grid.to_df(spark).join(grid.small(per_idx), "idx", "left")
    out = _resolved(stamps, chunked=grid.long)
    return out.select("idx", "stamp", "block", "first_of_block", "prior", F.col("place").cast("bigint").alias("place"))


def pinned(snapshots: DataFrame, grid: Grid) -> DataFrame:
    """The snapshot table, resolved once: the source, too, looks its stamps up
    before it asks for any state.

    A table of at most ``BROADCAST_STAMPS`` rows, which every plan would
    broadcast anyway, becomes a local relation, so that plans using it do not
    scan the block table again.  A larger one stays as it is.
    """
    if grid.long:
        return snapshots
    rows = snapshots.toArrow()
    out = snapshots.sparkSession.createDataFrame(rows, schema=snapshots.schema)
    blocks = rows.column("block").to_pylist()
    _RANGES[out] = (min(blocks), max(blocks)) if blocks else (0, 0)
    return out


#: First and last block of each pinned table.
_RANGES: WeakKeyDictionary = WeakKeyDictionary()


def block_range(snapshots: DataFrame) -> tuple[Column, Column]:
    """First and last snapshot block: literals of a pinned table, scalar
    subqueries of another."""
    if snapshots in _RANGES:
        lo, hi = _RANGES[snapshots]
        return F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint")
    return snapshots.agg(F.min("block")).scalar(), snapshots.agg(F.max("block")).scalar()
