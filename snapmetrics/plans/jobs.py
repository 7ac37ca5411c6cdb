"""The three snapshot jobs and the run-all driver (survey L1–L3, L6).

Each job is one lazy DataFrame: scan -> flatten -> rename -> clean -> attach
time -> (rollup) -> windows -> rates.  Nothing runs until a sink writes it.
The allocations output feeds the other two jobs only through one scalar,
the fee split (E5), attached as a scalar subquery.

``allocations_from``, ``global_from`` and ``subgraphs_from`` take a caller's
own nested payloads and block times; the functions on ``Tables`` are the
adapter for the test tables.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmetrics.functions.clean import epoch_to_ts, null_to_zero_int, scale_tokens, strip_suffix, to_double
from snapmetrics.functions.metrics import (
    GLOBAL_REACH,
    entity_changes,
    entity_rates,
    entity_rolling,
    global_changes,
    global_rates,
    global_rolling,
)
from snapmetrics.operators.relations import (
    attach_names,
    attach_time,
    fee_split,
    rollup,
    within_own_range,
    within_range,
)
from snapmetrics.operators.shape import explode_child, flatten, rename_map, root_select
from snapmetrics.operators.snapshots import cap_per_snapshot
from snapmetrics.operators.windows import in_chunks, own_rows, rolling, series
from snapmetrics.plans import columns as C
from snapmetrics.sources import fixtures as fx
from snapmetrics.sources import grid as grids
from snapmetrics.sources import scans
from snapmetrics.sources.grid import Grid, pinned, resolve_blocks, snapshot_grid


@dataclass(frozen=True)
class JobSpec:
    """What the source keeps in its job dictionaries (plus ``end``, which the
    source takes from the clock)."""

    type: str
    query: str
    return_value: str
    end: _dt.date
    days: int = 30
    hours: int = 23
    minutes: int = 59
    seconds: int = 59
    step: int = 24
    rows: int | None = None  # G3: the last N rows; None keeps all
    filename: str = ""
    upload: str | bool = False
    names: str = "latest"  # D2 mode (trap T8)
    cap: int | None = None  # A8, off by default (trap T13)

    @property
    def grid(self) -> Grid:
        return snapshot_grid(self.end, self.days, self.hours, self.minutes, self.seconds, self.step)


# The three job specifications, in run order, with the
# fixture's end dates.
ALLOCATIONS = JobSpec("allocations", "allocations", "allocations", _dt.date(2001, 8, 2), days=150, step=720,
                      filename="allocations", upload=False)
GLOBAL = JobSpec("global", "global", "graphNetwork", _dt.date(2024, 1, 31), days=60, step=24, rows=60,
                 filename="global", upload="sheet")
SUBGRAPHS = JobSpec("subgraphs", "main", "subgraphVersions", _dt.date(2024, 1, 31), days=30, step=24,
                    filename="subgraphs", upload="sheet")
JOBS = (ALLOCATIONS, GLOBAL, SUBGRAPHS)


def snapshots_for(t: fx.Tables, spec: JobSpec) -> DataFrame:
    """A1-A3 for a job: the resolved ``(idx, stamp, block, first_of_block)``."""
    orders = spec.query == "allocations"
    return t.memo(
        ("snapshots", orders, spec.grid),
        lambda: pinned(resolve_blocks(fx.order_blocks(t) if orders else fx.event_blocks(t), spec.grid), spec.grid),
    )


# --- cleaning per source query (I1-I5) -------------------------------------


def clean_main(df: DataFrame) -> DataFrame:
    """I1-I3 for versions: scale amounts, cast price, epoch -> timestamp."""
    out = df.withColumns({c: scale_tokens(c) for c in C.SCALED_MAIN})
    return out.withColumns(
        {
            "price_per_share": to_double("price_per_share"),
            "created_at": epoch_to_ts("created_at"),
        }
    )


def clean_global(df: DataFrame) -> DataFrame:
    return df.withColumns({c: scale_tokens(c) for c in C.SCALED_GLOBAL})


def clean_allocations(df: DataFrame) -> DataFrame:
    out = df.withColumns({c: scale_tokens(c) for c in C.SCALED_ALLOCATIONS})
    return out.withColumn("closed_at_block", null_to_zero_int("closed_at_block"))


# --- L1 allocations ----------------------------------------------------------


def allocations_clean_from(flat: DataFrame) -> DataFrame:
    """Flat allocation rows after rename, clean and I6."""
    out = clean_allocations(rename_map(flat, C.RENAME_ALLOCATIONS))
    return out.withColumn("subgraph_id", strip_suffix("version_id"))


def allocations_from(payload: DataFrame, cap: int | None = None) -> DataFrame:
    """L1 on a caller's payload: ``block`` and the allocation's fields, with
    ``subgraphDeployment.versions`` as a list.  The close-block range is the
    frame's own (C2); ``cap`` limits the allocations of a snapshot (A8)."""
    if cap is not None:
        payload = cap_per_snapshot(payload, cap, "block", "id")
    rows = explode_child(flatten(payload), "subgraphDeployment_versions")
    return within_own_range(allocations_clean_from(rows), "closed_at_block", "block")


def allocations_clean(t: fx.Tables, spec: JobSpec = ALLOCATIONS, snaps: DataFrame | None = None) -> DataFrame:
    """Allocation rows after explode, flatten, rename, clean and I6."""
    snaps = snapshots_for(t, spec) if snaps is None else snaps
    return allocations_clean_from(scans.allocation_rows(t, spec.grid, snaps, spec.cap))


def allocations_frame(t: fx.Tables, spec: JobSpec = ALLOCATIONS) -> DataFrame:
    """L1: allocations whose close block lies in the frame's own block range.

    With the cap off the range comes from the snapshot table
    (``allocation_block_bounds``), and the filter reaches below the version
    join; with a cap the frame's own range is taken.
    """
    snaps = snapshots_for(t, spec)
    rows = allocations_clean(t, spec, snaps)
    if spec.cap is not None:
        return within_own_range(rows, "closed_at_block", "block")
    return within_range(rows, "closed_at_block", scans.allocation_block_bounds(t, spec.grid, snaps))


def allocations_output(frame: DataFrame) -> DataFrame:
    return frame.select(*C.OUT_ALLOCATIONS)


def fee_split_of(t: fx.Tables, spec: JobSpec = ALLOCATIONS) -> Column:
    """E5 of the allocations output, as a scalar column.  Without a cap it
    comes from two weighted sums over the orders (``scans.fee_totals``)."""
    if spec.cap is not None:
        return fee_split(allocations_output(allocations_frame(t, spec)))
    totals = scans.fee_totals(t, spec.grid, snapshots_for(t, spec))
    return F.try_divide(totals["fees"].cast("double"), totals["collected"].cast("double"))


# --- L2 global -----------------------------------------------------------------


def global_clean_from(payload: DataFrame, blocktimes: DataFrame, return_value: str = GLOBAL.return_value, grid: Grid | None = None) -> DataFrame:
    """Network rows after root select, rename, clean and D1 (block, stamp, date)."""
    flat = flatten(root_select(payload, return_value)).drop("id")
    return attach_time(clean_global(rename_map(flat, C.RENAME_GLOBAL)), blocktimes, grid)


def global_clean(t: fx.Tables, spec: JobSpec = GLOBAL) -> DataFrame:
    snaps = snapshots_for(t, spec)
    return global_clean_from(scans.scan_network(t, spec.grid, snaps), snaps, spec.return_value, spec.grid)


def non_nullable(df: DataFrame) -> frozenset:
    """Columns the analyzed schema guarantees are never null."""
    return frozenset(f.name for f in df.schema.fields if not f.nullable)


def global_windows(df: DataFrame, grid: Grid | None = None) -> DataFrame:
    """F1-F4 over the network frame, ordered by block then stamp.

    The frame has one row per snapshot, bounded by the grid, so an
    unpartitioned window is acceptable here and only here.  The frame of a
    long ``grid`` is windowed in chunks of its stamps: state carries forward,
    so from its first stamp on it has a row at every one, and blocks never
    fall from stamp to stamp.
    """
    chunked = grid is not None and grid.long
    df, w = in_chunks(df, grid.index_of("stamp"), grids.CHUNK_BITS, GLOBAL_REACH) if chunked else (df, series(["block", "stamp"]))
    changed = df.select("*", *global_changes(w))
    out = rolling(changed, w, global_rolling(), non_nullable(changed))
    return own_rows(out, grids.CHUNK_BITS) if chunked else out


def global_from(payload: DataFrame, blocktimes: DataFrame, fs: Column) -> DataFrame:
    """L2 on a caller's payload: ``block`` and the struct ``graphNetwork``;
    ``blocktimes`` has ``(block, stamp)``, ``fs`` is the fee split."""
    return global_windows(global_clean_from(payload, blocktimes)).select("*", *global_rates(fs))


def global_frame(t: fx.Tables, fs: Column, spec: JobSpec = GLOBAL) -> DataFrame:
    """L2 before the last-N cut: every column the outputs and sheet use."""
    return global_windows(global_clean(t, spec), spec.grid).select("*", *global_rates(fs))


# --- L3 subgraphs --------------------------------------------------------------


def versions_clean_from(payload: DataFrame, blocktimes: DataFrame, grid: Grid | None = None) -> DataFrame:
    """Version rows after flatten, rename, clean and D1."""
    cleaned = clean_main(rename_map(flatten(payload), C.RENAME_MAIN))
    return attach_time(cleaned, blocktimes, grid)


def versions_clean(t: fx.Tables, spec: JobSpec = SUBGRAPHS) -> DataFrame:
    snaps = snapshots_for(t, spec)
    raw = scans.scan_versions(t, spec.grid, snaps)
    if spec.cap is not None:
        raw = cap_per_snapshot(raw, spec.cap, "block", "id", spec.grid)
    return versions_clean_from(raw, snaps, spec.grid)


ROLLUP_KEYS = ("subgraph_id", "block", "stamp", "date", "created_at")  # stamp added (trap T18)


def subgraphs_rollup(versions: DataFrame, names: str = "latest") -> DataFrame:
    """C4 + E1 + E2/D2: versions -> subgraph x snapshot, with names.

    ``latest``: the rollup's aggregate, combined before its shuffle, carries
    each snapshot's name, and a window over the rolled rows (at most one per
    snapshot and subgraph) takes the latest; its exchange also serves the
    keyed windows that follow.  ``all``: the source's join on distinct names
    (a renamed subgraph fans out).
    """
    if names != "latest":
        return attach_names(rollup(versions, ROLLUP_KEYS, C.ROLLUP_SUM, C.ROLLUP_MAX), versions, names)
    rolled = rollup(versions, ROLLUP_KEYS, C.ROLLUP_SUM, C.ROLLUP_MAX, name="display_name")
    return latest_name(rolled)


def latest_name(rolled: DataFrame) -> DataFrame:
    """Each subgraph's name at its latest block, on all its rows."""
    name = F.max_by("display_name", "block").over(Window.partitionBy("subgraph_id"))
    return rolled.withColumn("display_name", name)


def subgraphs_rolled(t: fx.Tables, spec: JobSpec = SUBGRAPHS) -> DataFrame:
    """The rollup of the test tables' versions.  Without a cap or all names,
    a subgraph's creation time and activity at a block are combined by the
    rollup itself, so version rows are never sorted by subgraph."""
    if spec.cap is not None or spec.names != "latest":
        return subgraphs_rollup(versions_clean(t, spec), spec.names)
    snaps = snapshots_for(t, spec)
    rows = versions_clean_from(scans.subgraph_rows(t, spec.grid, snaps), snaps, spec.grid)
    keys = [k for k in ROLLUP_KEYS if k != "created_at"]
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in C.ROLLUP_SUM]
    maxes = [F.max(c).alias(c) for c in C.ROLLUP_MAX if c != "active"]
    rolled = rows.dropna(subset=[*keys, "created_at"]).groupBy(*keys).agg(
        F.min("created_at").alias("created_at"), F.max_by("active", "_active_at").alias("active"), *sums, *maxes,
        F.max("display_name").alias("display_name"),
    )
    return latest_name(rolled)


def subgraphs_windows(df: DataFrame) -> DataFrame:
    """F5-F7 per subgraph over (block, stamp): one Exchange, one Sort."""
    w = series(["block", "stamp"], "subgraph_id")
    changed = df.select("*", *entity_changes(w))
    return rolling(changed, w, entity_rolling(), non_nullable(changed))


def subgraphs_frame(t: fx.Tables, fs: Column, spec: JobSpec = SUBGRAPHS) -> DataFrame:
    """L3 before the last-N cut."""
    return subgraphs_windows(subgraphs_rolled(t, spec)).select("*", *entity_rates(fs))


def subgraphs_from(payload: DataFrame, blocktimes: DataFrame, fs: Column, names: str = "latest", cap: int | None = None) -> DataFrame:
    """L3 on a caller's payload: ``block``, ``id`` and the structs
    ``subgraph`` and ``subgraphDeployment``; ``cap`` limits the versions of a
    snapshot (A8)."""
    if cap is not None:
        payload = cap_per_snapshot(payload, cap, "block", "id")
    rolled = subgraphs_rollup(versions_clean_from(payload, blocktimes), names)
    return subgraphs_windows(rolled).select("*", *entity_rates(fs))


# --- outputs (G3, B7) ------------------------------------------------------------


def _tie_key(tie: tuple[str, ...]) -> Column:
    """What breaks ties inside the cut date: a digest of the tie columns.
    Any order is as good (the source's is arbitrary); a digest's is even, so
    its prefixes cut a date into small slices."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in tie]).cast("binary"))


def _room(df: DataFrame, group: str, n: Column) -> DataFrame:
    """``group``, whether all its rows are kept, and how many if not, when the
    greatest groups come first and ``n`` rows are kept (one row per group)."""
    newest_first = Window.orderBy(F.col(group).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = F.sum("_rows").over(newest_first) - F.col("_rows")
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows"), n.alias("_n")).select(group, "_rows", "_n", later.alias("_later"))
    left = F.col("_n") - F.col("_later")
    return counts.where(left > 0).select(group, (F.col("_rows") <= left).alias("_whole"), left.alias("_left"))


def last_n(df: DataFrame, n: int, by: str = "date", tie: tuple[str, ...] = ()) -> DataFrame:
    """The last ``n`` rows by ``by``; ties inside the cut date are broken
    by a digest of ``tie``, then ``tie`` itself, greatest first.

    Rows are counted per date; dates that fit whole pass a filter.  The one
    date that is cut is counted again per slice of the digest (4096 slices),
    and only the one slice that is cut is ranked, so no task sorts a date.
    """
    marked = df.join(_room(df, by, F.lit(n)), by, "inner")
    whole = marked.where("_whole").drop("_whole", "_left")
    cut = marked.where(~F.col("_whole")).withColumnRenamed("_left", "_date_left").drop("_whole")
    cut = cut.withColumn("_key", _tie_key(tie)).withColumn("_slice", F.substring("_key", 1, 3))
    sliced = cut.join(_room(cut, "_slice", F.max("_date_left")), "_slice", "inner")
    best = Window.partitionBy("_slice").orderBy(F.col("_key").desc(), *[F.col(c).desc() for c in tie])
    ranked = sliced.where(~F.col("_whole")).withColumn("_rk", F.row_number().over(best)).where(F.col("_rk") <= F.col("_left"))
    cols = df.columns
    return whole.select(*cols).unionByName(sliced.where("_whole").select(*cols)).unionByName(ranked.select(*cols))


def last_snapshots(frame: DataFrame, n: int) -> DataFrame:
    """G3 for a frame with one row per snapshot, which the grid bounds: the
    last ``n`` by (date, block, stamp), one pass over the frame."""
    return frame.orderBy(*[F.col(c).desc() for c in ("date", "block", "stamp")]).limit(n)


def job_output(frame: DataFrame, spec: JobSpec) -> DataFrame:
    """The CSV output of a job: all rows, or the last N by date if asked."""
    cols = C.OUT_BY_JOB[spec.type]
    if spec.rows is None or spec.type == "allocations":
        return frame.select(*cols)
    if spec.type == "global":
        return last_snapshots(frame, spec.rows).select(*cols)
    tie = ("subgraph_id", "block")
    return last_n(frame.select(*dict.fromkeys([*cols, "date", *tie])), spec.rows, "date", tie).select(*cols)


def dated_name(filename: str) -> Column:
    """``<filename>_<MM_dd_yyyy of max(date)>``, an aggregate."""
    return F.concat(F.lit(f"{filename}_"), F.date_format(F.max("date"), "MM_dd_yyyy"))


def latest_date(snapshots: DataFrame) -> Column:
    """E3 without the frame: state carries forward, so the latest date of any
    frame of these snapshots is that of the last resolved stamp."""
    return snapshots.agg(F.max(F.to_date("stamp"))).scalar()


def with_spec(spec: JobSpec, **kw) -> JobSpec:
    return replace(spec, **kw)


def raw_dump(flat: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The declared raw-dump projection over flattened version rows with
    their snapshot time (``blockDate`` and ``blockTime`` as two columns)."""
    from snapmetrics.functions.clean import epoch_seconds

    timed = attach_time(flat, snapshots)
    derived = {
        "blockDate": F.col("date"),
        "blockTime": epoch_seconds("stamp"),
        "createdDate": F.to_date(epoch_to_ts("subgraph_createdAt")),
    }
    return timed.select(
        *[(derived[c] if src is None else F.col(src)).alias(c) for c, src in C.RAW_DUMP_FROM.items()]
    )
