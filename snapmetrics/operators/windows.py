"""Per-snapshot changes and row-count rolling windows (survey F1–F7).

Null rules (checked against the source's frame library):

* ``diff_n(x) = coalesce(x - lag(x, n), 0)``: the first ``n`` rows are 0 and a
  null operand gives 0;
* ``roll_f(x, n)`` is ``f`` over the last ``n`` rows, null until ``n`` rows
  exist and null when any of them is null.  Windows count rows, not days
  (trap T5).

All expressions built from one ``WindowSpec`` share one Exchange and one Sort;
Spark evaluates the ``lag`` columns and every frame length in adjacent Window
nodes over the same sorted partition.

``rolling`` makes many rolling columns at once from prefix sums: one running
sum per column in integer units, which is exact, and each window is the
difference of two of its rows.  A row then costs the same whatever the window
lengths are; ``roll_sum`` and ``roll_avg`` sum each frame anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def series(order: Sequence[str], key: Sequence[str] | str | None = None) -> WindowSpec:
    """Window over one time series (``key`` None: the whole frame in one task,
    acceptable only for one-row-per-snapshot frames)."""
    keys = [key] if isinstance(key, str) else list(key or [])
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(*order)


def in_chunks(df: DataFrame, place: Column, bits: int, back: int) -> tuple[DataFrame, WindowSpec]:
    """``df``, one long series, cut for windows that look at most ``back`` rows
    back, and the window over a chunk.

    ``place`` numbers the rows without gaps; a chunk has 2^``bits`` places and
    copies of the ``back`` rows before them.  ``own_rows`` drops the copies
    once the windowed columns are made.  One exchange, on the chunk.
    """
    cut = df.withColumn("_place", place)
    chunks = F.sequence(F.shiftright("_place", bits), F.shiftright(F.col("_place") + F.lit(back), bits))
    return cut.withColumn("_chunk", F.explode(chunks)), Window.partitionBy("_chunk").orderBy("_place")


def own_rows(df: DataFrame, bits: int) -> DataFrame:
    """Each row of ``in_chunks`` once, in its own chunk."""
    return df.where(F.col("_chunk") == F.shiftright("_place", bits)).drop("_place", "_chunk")


def diff_n(c: str | Column, n: int, w: WindowSpec) -> Column:
    """Change against ``n`` rows back; 0 where it cannot be formed."""
    x = _col(c)
    return F.coalesce(x - F.lag(x, n).over(w), F.lit(0.0))


def _frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def _full(x: Column, n: int, w: WindowSpec, nullable: bool) -> Column:
    # For a column that cannot be null, "n values in the frame" is just "at
    # least n rows so far": one row_number shared by every such column
    # instead of one count per column and frame.
    if nullable:
        return F.count(x).over(_frame(w, n)) == n
    return F.row_number().over(w) >= n


def roll_sum(c: str | Column, n: int, w: WindowSpec, nullable: bool = True) -> Column:
    """Sum of the last ``n`` rows; null unless all ``n`` are present."""
    x = _col(c)
    return F.when(_full(x, n, w, nullable), F.sum(x).over(_frame(w, n)))


def roll_avg(c: str | Column, n: int, w: WindowSpec, nullable: bool = True) -> Column:
    """Mean of the last ``n`` rows; null unless all ``n`` are present."""
    x = _col(c)
    return F.when(_full(x, n, w, nullable), F.avg(x).over(_frame(w, n)))


# A double is summed as whole units and as 10^-12 parts of one, both integers.
FRACTION = 1e12
SUM, MEAN = "sum", "mean"


def rolling(df: DataFrame, w: WindowSpec, wanted: Mapping[str, tuple[str, str, int]], nonnull: frozenset = frozenset()) -> DataFrame:
    """``df`` with rolling columns: ``wanted`` maps a name to (``SUM`` or
    ``MEAN``, column, rows).  Null rules as for ``roll_sum``; ``nonnull``:
    columns the schema declares not nullable.

    Two adjacent steps over the same sorted rows: running sums of the whole
    and fractional units (exact to 10^-12 a row, for columns below 9e18) and,
    for nullable columns, running counts; then each window as the difference
    of a running sum and the one ``n`` rows before.
    """
    sources = sorted({c for _, c, _ in wanted.values()})
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole, part, seen = (lambda c, p=p: f"_{p}_{c}" for p in ("whole", "part", "seen"))
    running = {"_row": F.row_number().over(w)}
    for c in sources:
        x = F.col(c) if c in nonnull else F.coalesce(F.col(c), F.lit(0.0))
        unit = F.floor(x).cast("bigint")
        running[whole(c)] = F.sum(unit).over(upto)
        running[part(c)] = F.sum(F.round((x - unit) * F.lit(FRACTION)).cast("bigint")).over(upto)
        if c not in nonnull:
            running[seen(c)] = F.count(c).over(upto)
    sums = df.select("*", *[x.alias(name) for name, x in running.items()])
    # All running sums of an earlier row come as one value per window length.
    sums = sums.select(*df.columns, "_row", F.struct(*[name for name in running if name != "_row"]).alias("_sums"))
    lengths = sorted({n for _, _, n in wanted.values()})
    summed = sums.select("*", *[F.lag("_sums", n).over(w).alias(f"_sums_{n}") for n in lengths])

    def over(name: str, n: int) -> Column:
        return F.col(f"_sums.{name}") - F.coalesce(F.col(f"_sums_{n}.{name}"), F.lit(0))

    out = []
    for name, (kind, c, n) in wanted.items():
        full = F.col("_row") >= n if c in nonnull else over(seen(c), n) == n
        total = over(whole(c), n).cast("double") + over(part(c), n).cast("double") / F.lit(FRACTION)
        out.append(F.when(full, total if kind == SUM else total / F.lit(float(n))).alias(name))
    return summed.select(*df.columns, *out)
