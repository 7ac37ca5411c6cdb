"""Map the given Parquet tables onto the three entity shapes (FIXTURES.md).

The source reads its entities from a remote time-travel store; there is no
such store here, so the nested payloads are derived from change logs in the
test tables:

* ``events`` -> block table (``block = event_id``, ``block_time = ts``), the
  versions log (``main`` shape) and the network totals (``global`` shape);
* ``orders`` + ``lineitem`` -> allocations with a child list, on a block
  table of order days.

Amounts become integer text in units of 10^-18, like the source's payloads.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.operators.shape import parse_json_field
from snapmetrics.sources.grid import Grid, snapshot_grid

# Fixed values of the fixture mapping.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]  # ordinal = position
NEGATIVE_SIGNAL_TYPE = "error"
NETWORK_ID = "n0"
CURATION_PERCENTAGE = "10000"
DELEGATION_RATIO = "16"
ORDER_EPOCH = "1995-01-01"  # order block = days since this date
CLOSE_AFTER_DAYS = 30

# The fixture grids (FIXTURES.md §3).
G1_DAILY = snapshot_grid(_dt.date(2024, 1, 31), days=30, step=24)
G2_SIX_HOURLY = snapshot_grid(_dt.date(2024, 1, 31), days=30, step=6)
G3_TWENTY_MINUTES = Grid.between(_dt.datetime(2024, 1, 1, 5, 59, 59), _dt.datetime(2024, 1, 30, 23, 59, 59), 20 * 60)
G4_EARLY_START = snapshot_grid(_dt.date(2024, 1, 5), days=8, step=24)
G5_ORDERS = snapshot_grid(_dt.date(2001, 8, 2), days=150, step=720)
G6_GLOBAL_60 = snapshot_grid(_dt.date(2024, 1, 31), days=60, step=24)
G7_LONG = Grid.between(_dt.datetime(2024, 1, 1, 6, 0, 0), _dt.datetime(2024, 1, 31, 5, 59, 59), 20)

TABLES = ("events", "customer", "orders", "lineitem")


@dataclass
class Tables:
    """Lazily read inputs; nothing is scanned until an action runs.  Each
    table's relation is created once (one listing and footer read)."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict, repr=False)

    def read(self, name: str) -> DataFrame:
        return self.memo(("table", name), lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    def memo(self, key, build):
        """One DataFrame per derived input (e.g. a snapshot table), so a plan
        that uses it twice holds the same subtree twice and Spark reuses its
        exchanges instead of planning it again."""
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    @property
    def events(self) -> DataFrame:
        return self.read("events")

    @property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")


def money_cents(c: str | Column) -> Column:
    """Money as exact integer cents."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x * F.lit(100)).cast("bigint")


def amount_text(units: Column, zeros: int) -> Column:
    """Integer amount text with ``zeros`` zeros appended (10^-18 units)."""
    return F.concat(units.cast("string"), F.lit("0" * zeros))


def cents_text(cents: Column) -> Column:
    return amount_text(cents, 16)


def int_text(n: Column) -> Column:
    return amount_text(n, 18)


def event_log(t: Tables) -> DataFrame:
    """Events with the JSON field ``k`` (A9), money in cents and signed k."""
    return t.memo("event_log", lambda: _event_log(t))


def _event_log(t: Tables) -> DataFrame:
    k = parse_json_field("props", "k", "bigint")
    return t.events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        k.alias("k"),
        money_cents("value").alias("cents"),
    ).withColumn(
        "signed_k", F.when(F.col("event_type") == NEGATIVE_SIGNAL_TYPE, -F.col("k")).otherwise(F.col("k"))
    )


def event_blocks(t: Tables) -> DataFrame:
    """Block table of the events: ``block = event_id``, ``block_time = ts``."""
    return t.events.select(F.col("event_id").alias("block"), F.col("ts").alias("block_time"))


def order_day(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.date_diff(F.to_date(x), F.lit(ORDER_EPOCH).cast("date")).cast("bigint")


def order_blocks(t: Tables) -> DataFrame:
    """Block table of the orders: one block per order day."""
    return t.orders.select(order_day("o_orderdate").alias("block"), F.col("o_orderdate").alias("block_time"))


def type_ordinal(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    place = F.array_position(F.array(*[F.lit(v) for v in EVENT_TYPES]), x)
    unknown = F.raise_error(F.concat(F.lit("unknown event type: "), x)).cast("int")
    return F.when(place > 0, (place - 1).cast("int")).when(x.isNotNull(), unknown)
