"""Chronological split, backtest slice and expanding time-series folds.

All work on the daily feature rows of each symbol (one row per trading day:
the per-symbol window is bounded by the calendar).  Split sizes follow the
published rules of the common scikit-learn helpers the reference calls:
``test = ceil(f * n)``, unshuffled, test at the end; expanding folds with
``t = n // (k + 1)`` rows per test fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the reference's split rule.
TEST_FRACTION = 0.15
VAL_FRACTION = 0.176
BACKTEST_FROM = 0.85


def chrono_index(df: DataFrame, key: str = "symbol", order: str = "datetime") -> DataFrame:
    """0-based position ``_idx`` and row count ``_n`` per symbol."""
    w = Window.partitionBy(key).orderBy(order)
    return (df.withColumn("_idx", (F.row_number().over(w) - 1).cast("long"))
              .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key))))


def chronological_split(df: DataFrame, key: str = "symbol", order: str = "datetime",
                        test: float = TEST_FRACTION, val: float = VAL_FRACTION) -> DataFrame:
    """Add ``split`` in {train, val, test}."""
    d = chrono_index(df, key, order)
    n_test = F.ceil(F.lit(test) * F.col("_n"))
    n_temp = F.col("_n") - n_test
    n_val = F.ceil(F.lit(val) * n_temp)
    split = (F.when(F.col("_idx") >= n_temp, F.lit("test"))
              .when(F.col("_idx") >= n_temp - n_val, F.lit("val"))
              .otherwise(F.lit("train")))
    return d.withColumn("split", split).drop("_idx", "_n")


def backtest_slice(df: DataFrame, key: str = "symbol", order: str = "datetime",
                   start: float = BACKTEST_FROM) -> DataFrame:
    """Rows at positions >= int(start * n)."""
    d = chrono_index(df, key, order)
    return d.filter(F.col("_idx") >= F.floor(F.lit(start) * F.col("_n"))).drop("_idx", "_n")


def time_series_folds(df: DataFrame, k: int = 3, key: str = "symbol",
                      order: str = "datetime") -> DataFrame:
    """One row per (row, fold) membership with ``role`` train/test.

    Fold i (0-based) tests rows [n-(k-i)t, n-(k-i-1)t) and trains on every
    earlier row, t = n // (k+1).  Rows after a fold's test block are not in it.
    """
    d = chrono_index(df, key, order)
    t = F.floor(F.col("_n") / F.lit(k + 1))
    memberships = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.struct(
        i.alias("fold"),
        F.when(F.col("_idx") < F.col("_n") - (F.lit(k) - i) * t, F.lit("train"))
         .when(F.col("_idx") < F.col("_n") - (F.lit(k - 1) - i) * t, F.lit("test")).alias("role")))
    out = d.withColumn("_m", F.explode(F.filter(memberships, lambda m: m["role"].isNotNull())))
    return (out.withColumn("fold", F.col("_m.fold")).withColumn("role", F.col("_m.role"))
               .drop("_m", "_idx", "_n"))
