"""Performance summary, drawdown summary, regression metrics, chart
data (histograms, correct/wrong split), data profile and worst trades.

Each summary is one ``groupBy(symbol)`` with conditional aggregates over the
ledger (partial aggregation map-side, one small shuffle).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.operators.backtest import DOLLARS_PER_PCT, INITIAL_CAPITAL

TRADING_DAYS = 250


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def daily_returns(ledger: DataFrame, key: str = "symbol", order: str = "datetime") -> DataFrame:
    """daily_pnl / previous equity * 100; first row, +-inf and NaN -> 0."""
    w = Window.partitionBy(key).orderBy(order)
    r = F.try_divide(F.col("daily_pnl"), F.lag("equity").over(w)) * F.lit(100.0)
    return ledger.withColumn("daily_returns", _zero(r))


def intra_dd_aggs() -> list[Column]:
    dd = F.col("max_intra_drawdown_pct")
    dd_d = F.col("max_intra_drawdown_dollars")
    has = dd < 0
    n_dd = F.count(F.when(has, F.lit(1)))
    return [
        _zero(F.min(F.when(has, dd))).alias("max_intra_dd_pct"),
        _zero(F.min(F.when(has, dd_d))).alias("max_intra_dd_dollars"),
        _zero(F.avg(F.when(has, dd))).alias("avg_intra_dd_pct"),
        _zero(F.avg(F.when(has, dd_d))).alias("avg_intra_dd_dollars"),
        n_dd.cast("long").alias("trades_with_dd"),
        (n_dd / F.count(F.lit(1)) * F.lit(100.0)).alias("pct_trades_with_dd"),
        _zero(F.stddev_samp(F.when(has, dd))).alias("dd_std"),
    ]


def intra_dd_summary(ledger: DataFrame, key: str = "symbol") -> DataFrame:
    """Statistics over trades whose intra-trade drawdown is < 0 (none -> 0)."""
    return ledger.groupBy(key).agg(*intra_dd_aggs())


def performance_summary(ledger: DataFrame, key: str = "symbol", order: str = "datetime",
                        capital: float = INITIAL_CAPITAL) -> DataFrame:
    """The 31 returned scalars of the reference, one row per symbol."""
    d = daily_returns(ledger, key, order)
    ret, pnl = F.col("returns"), F.col("pnl_dollars")
    n = F.count(F.lit(1))
    agg = d.groupBy(key).agg(
        n.cast("long").alias("total_trades"),
        F.count(F.when(F.col("win_trade"), 1)).cast("long").alias("winning_trades"),
        F.count(F.when(F.col("loss_trade"), 1)).cast("long").alias("losing_trades"),
        F.count(F.when(ret == 0, 1)).cast("long").alias("break_even_trades"),
        F.max_by("cumulative_pnl", order).alias("total_pnl"),
        F.max_by("equity", order).alias("final_equity"),
        (F.avg(F.col("correct_direction").cast("double")) * F.lit(100.0)).alias("accuracy"),
        _zero(F.sum(F.when(pnl > 0, pnl))).alias("_gp"),
        F.abs(_zero(F.sum(F.when(pnl < 0, pnl)))).alias("_gl"),
        _zero(F.avg(F.when(ret > 0, ret))).alias("avg_win_pct"),
        _zero(F.avg(F.when(ret < 0, ret))).alias("avg_loss_pct"),
        _zero(F.avg(F.when(pnl > 0, pnl))).alias("avg_win_dollars"),
        _zero(F.avg(F.when(pnl < 0, pnl))).alias("avg_loss_dollars"),
        F.min("portfolio_drawdown").alias("max_drawdown"),
        (F.min("equity") - F.lit(capital)).alias("max_drawdown_dollars"),
        F.stddev_samp("daily_returns").alias("_sd"),
        F.avg("daily_returns").alias("_mr"),
        F.max("win_streak").cast("long").alias("max_win_streak"),
        F.max("loss_streak").cast("long").alias("max_loss_streak"),
        *intra_dd_aggs(),
    )
    wr = F.col("winning_trades") / F.col("total_trades") * F.lit(100.0)
    vol = F.when(F.col("total_trades") > 1, F.col("_sd") * F.lit(math.sqrt(TRADING_DAYS))).otherwise(F.lit(0.0))
    total_return = F.col("total_pnl") / F.lit(capital) * F.lit(100.0)
    mdd = F.col("max_drawdown")
    out = (agg.withColumn("win_rate", wr)
              .withColumn("total_return", total_return)
              .withColumn("profit_factor", F.when(F.col("_gl") > 0, F.col("_gp") / F.col("_gl"))
                                            .otherwise(F.lit(float("inf"))))
              .withColumn("volatility", _zero(vol))
              .withColumn("sharpe_ratio", F.when(F.col("volatility") > 0,
                                                 F.col("_mr") * F.lit(float(TRADING_DAYS)) / F.col("volatility"))
                                           .otherwise(F.lit(0.0)))
              .withColumn("annual_return", F.col("total_return") / F.col("total_trades") * F.lit(float(TRADING_DAYS)))
              .withColumn("calmar_ratio", F.when(mdd != 0, F.col("annual_return") / F.abs(mdd)).otherwise(F.lit(0.0)))
              .withColumn("recovery_factor", F.when(mdd != 0, F.col("total_return") / F.abs(mdd)).otherwise(F.lit(0.0)))
              .withColumn("expectancy_dollars", F.col("win_rate") / 100 * F.col("avg_win_dollars")
                          + (F.lit(1.0) - F.col("win_rate") / 100) * F.col("avg_loss_dollars"))
              .withColumn("expectancy_pct", F.col("win_rate") / 100 * F.col("avg_win_pct")
                          + (F.lit(1.0) - F.col("win_rate") / 100) * F.col("avg_loss_pct"))
              .withColumn("initial_capital", F.lit(capital)))
    return out.select(key, *SUMMARY_COLUMNS)


SUMMARY_COLUMNS = [
    "total_return", "total_pnl", "annual_return", "accuracy", "win_rate", "profit_factor",
    "max_drawdown", "max_drawdown_dollars", "max_intra_dd_pct", "max_intra_dd_dollars",
    "avg_intra_dd_pct", "avg_intra_dd_dollars", "trades_with_dd", "pct_trades_with_dd",
    "sharpe_ratio", "calmar_ratio", "volatility", "total_trades", "winning_trades",
    "losing_trades", "avg_win_pct", "avg_loss_pct", "avg_win_dollars", "avg_loss_dollars",
    "max_win_streak", "max_loss_streak", "expectancy_pct", "expectancy_dollars",
    "recovery_factor", "final_equity", "initial_capital",
]


def regression_metrics(df: DataFrame, pred: str, actual: str = "target", key: str = "symbol") -> DataFrame:
    """MAE and R^2 = 1 - SSE/SST per symbol (SST = 0 -> NULL)."""
    err = F.col(actual) - F.col(pred)
    agg = df.groupBy(key).agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(actual) * F.count(actual)).alias("_sst"),
        F.count(F.lit(1)).cast("long").alias("n"))
    return agg.select(key, "mae", (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"), "n")


def histogram(df: DataFrame, value: str, bins: int, key: str = "symbol") -> DataFrame:
    """Equal-width bins over [min, max] per symbol, last edge inclusive,
    every bin listed (zero counts included).  min == max: the single value
    sits in the middle bin of [v-0.5, v+0.5].

    The input is read once: the range is a window over the symbol's rows
    (histograms are chart data over trades, one row per trading day), and all
    bins are counted in one aggregate (one conditional count per bin)."""
    w = Window.partitionBy(key)
    lo0, hi0 = F.min(value).over(w), F.max(value).over(w)
    d = df.select(key, F.col(value).alias("_v"), lo0.alias("_lo0"), hi0.alias("_hi0"))
    flat = F.col("_lo0") == F.col("_hi0")
    d = d.withColumns({"_lo": F.when(flat, F.col("_lo0") - 0.5).otherwise(F.col("_lo0")),
                       "_hi": F.when(flat, F.col("_hi0") + 0.5).otherwise(F.col("_hi0"))})
    b = F.least(F.floor((F.col("_v") - F.col("_lo")) * F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1))
    d = d.withColumn("_bin", b)
    agg = d.groupBy(key).agg(F.min("_lo").alias("_lo"), F.min("_hi").alias("_hi"),
                             F.array(*[F.count(F.when(F.col("_bin") == i, 1)) for i in range(bins)]).alias("_c"))
    out = agg.select(key, "_lo", "_hi", F.posexplode("_c").alias("bin", "count"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return out.select(key, F.col("bin").cast("long").alias("bin"),
                      (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                      F.col("count").cast("long").alias("count"))


def correct_wrong_split(ledger: DataFrame, key: str = "symbol") -> DataFrame:
    """Scatter chart data — count and mean (actual, predicted) per class."""
    return ledger.groupBy(key, "correct_direction").agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg("actual_change").alias("avg_actual"),
        F.avg("predictions").alias("avg_predicted"))


def bar_profile(raw: DataFrame, kept, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """Rows in, rows kept, first / last kept timestamp and the kept share.

    ``kept`` is the keep condition (a Column: one pass over ``raw``) or the
    kept DataFrame (two aggregates joined on the symbol)."""
    if isinstance(kept, Column):
        agg = raw.groupBy(key).agg(
            F.count(F.lit(1)).cast("long").alias("rows_in"),
            F.count(F.when(kept, 1)).cast("long").alias("rows_out"),
            F.min(F.when(kept, F.col(ts))).alias("first_ts"),
            F.max(F.when(kept, F.col(ts))).alias("last_ts"))
    else:
        a = raw.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("rows_in"))
        b = kept.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("rows_out"),
                                  F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
        agg = a.join(b, key, "left").withColumn("rows_out", F.coalesce("rows_out", F.lit(0)).cast("long"))
    return agg.select(key, "rows_in", "rows_out", "first_ts", "last_ts",
                      (F.col("rows_out") / F.col("rows_in") * F.lit(100.0)).alias("kept_pct"))


def worst_trades(ledger: DataFrame, k: int = 5, key: str = "symbol",
                 col: str = "max_intra_drawdown_pct", order: str = "datetime") -> DataFrame:
    """The k trades with the deepest intra-trade drawdown per symbol
    (top-k per group: row_number is planned as a window group limit)."""
    w = Window.partitionBy(key).orderBy(F.col(col).asc(), F.col(order).asc())
    return (ledger.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= k)
                  .withColumn("rank", F.col("rank").cast("long")))


__all__ = ["DOLLARS_PER_PCT"]
