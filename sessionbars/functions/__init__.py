"""Column-expression helpers (all JVM-side built-ins)."""

from sessionbars.functions.columns import (
    abs_micros_from_clock,
    confidence,
    micros_of_day,
    pct_change,
    predicted_direction,
    round6,
    safe_div,
)

__all__ = [
    "abs_micros_from_clock", "confidence", "micros_of_day", "pct_change",
    "predicted_direction", "round6", "safe_div",
]
