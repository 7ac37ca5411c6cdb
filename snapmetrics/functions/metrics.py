"""Derived rates over windowed frames (survey E5, I7, M1–M12).

Every division is ``try_divide``: null on a zero or null denominator, which is
what the source gets by turning +-inf into missing values at the end (trap
T1; no formula here can bring an infinity back to a finite value).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmetrics.operators.windows import MEAN, SUM, diff_n


def ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b``, null when ``b`` is 0 or null."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a, b)


def price_growth(price: str | Column, change: str | Column) -> Column:
    """``-p / (change - p) - 1``, i.e. growth over the window."""
    p = F.col(price) if isinstance(price, str) else price
    c = F.col(change) if isinstance(change, str) else change
    return ratio(-p, c - p) - F.lit(1.0)


# Fixed value: rates over 30 snapshots are annualised by 12.
ANNUALISE_30D = 12.0


def global_changes(w) -> list[Column]:
    """F1/F2 for the network frame, in the source's order."""
    cols = [diff_n("QF_total", 1, w).alias("QF")]
    for base in ("signal", "stake", "allocation", "delegation"):
        cols.append(diff_n(base, 1, w).alias(f"{base}_change"))
        cols.append(diff_n(base, 7, w).alias(f"{base}_change_7d"))
        cols.append(diff_n(base, 30, w).alias(f"{base}_change_30d"))
    for base in ("curator_rewards", "indexer_rewards", "delegator_rewards"):
        cols.append(diff_n(f"{base}_total", 1, w).alias(base))
    return cols


def global_rolling() -> dict[str, tuple[str, str, int]]:
    """F3/F4 for the network frame (the 30-row means feed the yields), as
    ``windows.rolling`` takes them."""
    out = {}
    for base in ("QF", "curator_rewards", "indexer_rewards", "delegator_rewards"):
        for n in (7, 30):
            out[f"{base}_{n}d"] = (SUM, base, n)
    for base in ("signal", "stake", "delegation"):
        out[f"{base}_30d_mean"] = (MEAN, base, 30)
    return out


# Rows before its own that a row of F1-F4 depends on: 30 one-row changes.
GLOBAL_REACH = 30


def global_rates(fs: Column) -> list[Column]:
    """M1–M5 (``fs``: the fee split E5)."""
    one = F.lit(1.0)
    return [
        ratio("signal", "allocation").alias("signal_per_stake"),
        ratio("QF_30d", "signal").alias("QF30D_per_signal"),
        (ratio("curator_rewards_30d", "signal_30d_mean") * ANNUALISE_30D).alias("curator_apr_30d_estimate"),
        (
            ratio(F.col("indexer_rewards_30d") + (one - fs) * F.col("QF_30d"), "stake_30d_mean") * ANNUALISE_30D
        ).alias("indexer_apr_30d_estimate"),
        (
            ratio(F.col("delegator_rewards_30d") + fs * F.col("QF_30d"), "delegation_30d_mean") * ANNUALISE_30D
        ).alias("delegator_apr_30d_estimate"),
    ]


# The keyed frame's rolling lengths.
ENTITY_WINDOWS = (7, 14, 30)


def entity_changes(w) -> list[Column]:
    """per-key one-step changes."""
    return [
        diff_n("QF_total", 1, w).alias("QF"),
        diff_n("signal", 1, w).alias("signal_change"),
        diff_n("stake", 1, w).alias("stake_change"),
        diff_n("shares", 1, w).alias("shares_change"),
        diff_n("price_per_share", 1, w).alias("price_change"),
        diff_n("curator_rewards_total", 1, w).alias("curator_rewards"),
        diff_n("indexer_rewards_total", 1, w).alias("indexer_rewards"),
        diff_n("delegator_rewards_total", 1, w).alias("delegator_rewards"),
    ]


def entity_rolling() -> dict[str, tuple[str, str, int]]:
    """per-key rolling sums and means over 7/14/30 rows, as
    ``windows.rolling`` takes them."""
    out = {f"QF_{n}d": (SUM, "QF", n) for n in ENTITY_WINDOWS}
    for base, level in (("signal", "signal"), ("stake", "stake"), ("shares", "shares"), ("price", "price_per_share")):
        out |= {f"{base}_change_{n}d": (SUM, f"{base}_change", n) for n in ENTITY_WINDOWS}
        out |= {f"{base}_{n}d_MA": (MEAN, level, n) for n in ENTITY_WINDOWS}
    for base in ("curator_rewards", "indexer_rewards", "delegator_rewards"):
        out |= {f"{base}_{n}d": (SUM, base, n) for n in ENTITY_WINDOWS}
    return out


def entity_rates(fs: Column) -> list[Column]:
    """M6–M12 (``fs``: the fee split E5)."""
    cols = [ratio("signal", "stake").alias("signal_per_stake")]
    for n in ENTITY_WINDOWS:
        cols.append(ratio(f"curator_rewards_{n}d", f"signal_{n}d_MA").alias(f"curator_rewards_per_signal_{n}d"))
    for n in ENTITY_WINDOWS:
        cols.append(ratio(f"indexer_rewards_{n}d", f"stake_{n}d_MA").alias(f"indexer_rewards_per_stake_{n}d"))
    cols.append(
        (ratio("curator_rewards_30d", "signal_30d_MA") * ANNUALISE_30D).alias("curator_apr_30d_estimate")
    )
    cols.append(
        (
            ratio(F.col("QF_30d") * (F.lit(1.0) - fs) + F.col("indexer_rewards_30d"), "stake_30d_MA")
            * ANNUALISE_30D
        ).alias("indexer_apr_30d_estimate")
    )
    for n in ENTITY_WINDOWS:
        cols.append(price_growth("price_per_share", f"price_change_{n}d").alias(f"price_growth_{n}d"))
    cols.append(ratio("curator_rewards_30d", "shares_30d_MA").alias("curator_rewards_per_share_30d"))
    return cols
