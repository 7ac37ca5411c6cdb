"""Scalar cleaning functions (survey §2.8, I1–I6, I10, I11).

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.  Time arithmetic works on
``timestamp_ntz`` fields only, so results never depend on the session time
zone (trap T6).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_date() -> Column:
    return F.lit("1970-01-01").cast("date")


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# Fixed value: raw token amounts are integers in units of 10^-18.
TOKEN_DECIMALS = 18


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scale_tokens(c: str | Column, decimals: int = TOKEN_DECIMALS) -> Column:
    """Integer amount text -> double, divided by 10**decimals.

    Bad text fails loudly under ANSI mode (trap T2), as in the source job.
    """
    return _col(c).cast("double") / F.lit(float(10**decimals))


def to_double(c: str | Column) -> Column:
    """Cast only (``price_per_share``)."""
    return _col(c).cast("double")


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz``, zone-free.

    Built from calendar fields instead of ``unix_micros``/``timestampdiff``,
    which convert through the session zone.
    """
    t = _col(ts)
    return (
        F.date_diff(F.to_date(t), _epoch_date()).cast("bigint") * F.lit(86_400_000_000)
        + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(t).cast("bigint") * F.lit(60_000_000)
        + (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint")
    )


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a ``timestamp_ntz`` (floor)."""
    return F.floor(epoch_micros(ts) / F.lit(1_000_000)).cast("bigint")


def epoch_to_ts(seconds: str | Column) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` (UTC wall clock)."""
    return F.timestamp_add("SECOND", _col(seconds).cast("bigint"), _epoch_ntz())


def to_date(ts: str | Column) -> Column:
    """Date of a ``timestamp_ntz``; zone-free."""
    return F.to_date(_col(ts))


def null_to_zero_int(c: str | Column) -> Column:
    """Null -> 0, as bigint (``closed_at_block``)."""
    return F.coalesce(_col(c).cast("bigint"), F.lit(0).cast("bigint"))


def strip_suffix(c: str | Column, n: int = 2) -> Column:
    """Drop the last ``n`` characters; null or empty text gives null.

    ``x-10`` keeps a dash (``x-``) and text of length <= n gives ``''``, as
    the source's slice does.
    """
    v = _col(c)
    return F.when(v != F.lit(""), v.substr(F.lit(1), F.length(v) - F.lit(n)))


def block_number(c: str | Column) -> Column:
    """Block text -> bigint; unparsable text becomes null (A3)."""
    return _col(c).try_cast("bigint")
