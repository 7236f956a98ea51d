"""Scalar column helpers shared by the operators.

Spark 4 runs with ANSI mode on: plain division by zero throws.  Every ratio
here goes through ``try_divide`` so a zero denominator gives NULL, which the
operators then treat as the reference's NaN (dropped or filled).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3600 * MICROS_PER_SECOND


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def pct_change(base, new) -> Column:
    """(new - base) / base * 100, NULL for a zero base."""
    return safe_div(col(new) - col(base), col(base)) * F.lit(100.0)


def micros_of_day(ts) -> Column:
    """Microseconds since midnight of a TIMESTAMP_NTZ (time-zone free)."""
    ts = col(ts)
    return (
        (F.hour(ts).cast("long") * 3600 + F.minute(ts).cast("long") * 60) * MICROS_PER_SECOND
        + (F.date_part(F.lit("SECOND"), ts) * MICROS_PER_SECOND).cast("long")
    )


def abs_micros_from_clock(ts, hour: int, minute: int = 0) -> Column:
    """|ts - (same date at hour:minute)| in microseconds."""
    target = (hour * 3600 + minute * 60) * MICROS_PER_SECOND
    return F.abs(micros_of_day(ts) - F.lit(target))


def round6(c) -> Column:
    """Output rounding used by every driver query (6 decimal places)."""
    return F.round(col(c), 6)


def predicted_direction(pred) -> Column:
    """BUY when the prediction is strictly positive, else SELL (0 -> SELL)."""
    return F.when(col(pred) > 0, F.lit("BUY")).otherwise(F.lit("SELL"))


def confidence(pred, scale: float = 0.5) -> Column:
    """min(|p| / scale, 1)."""
    return F.least(F.abs(col(pred)) / F.lit(scale), F.lit(1.0))
