"""Backtest any prediction column into the reference's trade ledger.

Ledger rows are trading days (one per symbol-day), so the running windows
below partition by symbol over a calendar-bounded row set.  The intra-trade
drawdown (A05) — a per-trade rescan of all bars in the reference, O(trades x
bars) — is one aggregate over the bars instead: for a trade held from the
entry price e with position p, the floating P&L ``(c - e) / e * 100 * p`` is
monotone in the bar close c, so its minimum sits at the lowest close (long)
or the highest close (short).  One ``groupBy(symbol, date)`` over the 20-23h
bars gives, per day, the entry pick and both extremes; a join of two
day-level tables finishes the job.  ``trade_path`` keeps the literal
per-bar join form as the test twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.functions.columns import pct_change, predicted_direction
from sessionbars.operators.sessions import in_hours, nearest_pick
from sessionbars.operators.splits import backtest_slice

# Fixed values of the reference's trading arithmetic.
INITIAL_CAPITAL = 100_000.0
DOLLARS_PER_PCT = 5_000.0       # $500 per 0.1 % move
TRADE_HOURS = (20, 23)
TRADE_CLOCK = (20, 0)

LEDGER_COLUMNS = [
    "datetime", "day_close_current", "predictions", "actual_change", "predicted_direction",
    "actual_direction", "correct_direction", "position", "returns", "pnl_dollars",
    "cumulative_pnl", "equity", "daily_pnl", "max_intra_drawdown_pct",
    "max_intra_drawdown_dollars", "time_of_max_drawdown", "win_trade", "loss_trade",
    "portfolio_drawdown", "day_of_week",
]


def trade_direction(df: DataFrame, pred: str = "predictions", actual: str = "actual_change") -> DataFrame:
    """BUY/SELL, UP/DOWN, strict direction match, position +1/-1 (0 -> -1)."""
    p, a = F.col(pred), F.col(actual)
    correct = ((p > 0) & (a > 0)) | ((p < 0) & (a < 0))
    return (df.withColumn("predicted_direction", predicted_direction(pred))
              .withColumn("actual_direction", F.when(a > 0, F.lit("UP")).otherwise(F.lit("DOWN")))
              .withColumn("correct_direction", F.coalesce(correct, F.lit(False)))
              .withColumn("position", F.when(p > 0, F.lit(1)).otherwise(F.lit(-1))))


def equity_curve(df: DataFrame, key: str = "symbol", order: str = "datetime",
                 capital: float = INITIAL_CAPITAL) -> DataFrame:
    """Returns, $ P&L, running sums, equity, daily P&L (first 0)."""
    w = Window.partitionBy(key).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("returns", F.col("position") * F.col("actual_change"))
              .withColumn("cumulative_returns", F.sum("returns").over(run))
              .withColumn("pnl_dollars", F.col("returns") * F.lit(DOLLARS_PER_PCT))
              .withColumn("cumulative_pnl", F.sum("pnl_dollars").over(run))
              .withColumn("equity", F.lit(capital) + F.col("cumulative_pnl"))
              .withColumn("daily_pnl", F.coalesce(F.col("equity") - F.lag("equity").over(w), F.lit(0.0))))


def streaks(df: DataFrame, key: str = "symbol", order: str = "datetime") -> DataFrame:
    """win/loss flags and the length of the current run (0 elsewhere).

    Run length = position - position of the last row that broke the run,
    a single running ``max`` (no second partitioning by island)."""
    w = Window.partitionBy(key).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    idx = F.row_number().over(w)
    d = (df.withColumn("win_trade", F.col("returns") > 0)
           .withColumn("loss_trade", F.col("returns") < 0)
           .withColumn("break_even_trade", F.col("returns") == 0)
           .withColumn("_i", idx))
    for flag, out in (("win_trade", "win_streak"), ("loss_trade", "loss_streak")):
        last_break = F.coalesce(F.max(F.when(~F.col(flag), F.col("_i"))).over(run), F.lit(0))
        d = d.withColumn(out, F.when(F.col(flag), F.col("_i") - last_break).otherwise(F.lit(0)))
    return d.drop("_i")


def portfolio_drawdown(df: DataFrame, key: str = "symbol", order: str = "datetime") -> DataFrame:
    """Running max of equity (from the first equity) and % drawdown."""
    run = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("running_max", F.max("equity").over(run))
              .withColumn("portfolio_drawdown",
                          (F.try_divide(F.col("equity"), F.col("running_max")) - F.lit(1.0)) * F.lit(100.0)))


def path_aggs(ts: str = "ts", tie: str = "id", hours: tuple[int, int] = TRADE_HOURS) -> list:
    """Aggregates over the trade hours of a day: entry close nearest 20:00 and
    the lowest / highest close with their first time.  Usable inside any
    ``groupBy(symbol, date)`` over bars (F01 adds them to its own aggregate)."""
    inside = in_hours(ts, *hours)
    lo = F.struct(F.col("close").alias("c"), F.col(ts).alias("t"), F.col(tie).alias("i"))
    hi = F.struct((-F.col("close")).alias("c"), F.col(ts).alias("t"), F.col(tie).alias("i"))
    return [nearest_pick(ts, tie, TRADE_CLOCK, hours, ["close"])["close"].alias("path_entry"),
            F.min(F.when(inside, lo)).alias("path_lo"),
            F.min(F.when(inside, hi)).alias("path_hi")]


PATH_COLUMNS = ["path_entry", "path_lo", "path_hi"]


def trade_path_stats(bars: DataFrame, key: str = "symbol", ts: str = "ts", tie: str = "id",
                     hours: tuple[int, int] = TRADE_HOURS) -> DataFrame:
    """Per (symbol, date): ``path_aggs`` over the bars of the trade hours."""
    b = bars.filter(in_hours(ts, *hours)).withColumn("date", F.to_date(F.col(ts)))
    return b.groupBy(key, "date").agg(*path_aggs(ts, tie, hours))


def intra_trade_drawdown(trades: DataFrame, bars: DataFrame | None, key: str = "symbol",
                         ts: str = "ts", tie: str = "id") -> DataFrame:
    """Worst floating P&L of each trade during 20-23h of its own date.

    Adds max_intra_drawdown_pct / _dollars / time_of_max_drawdown; a trade
    with no bars, or whose floating P&L never goes below 0, gets 0, 0, NULL.
    With ``bars=None`` the trades must already carry ``PATH_COLUMNS`` (as
    ``build_features(with_path=True)`` gives them: no further bar scan)."""
    if bars is None:
        j = trades
    else:
        path = trade_path_stats(bars, key, ts, tie)
        t = trades.withColumn("date", F.to_date(F.col("datetime")))
        j = t.join(path, [key, "date"], "left").drop("date")
    e = F.col("path_entry")
    pos = F.col("position")
    long_side = F.try_divide(pos.cast("double"), e) > 0
    worst_close = F.when(long_side, F.col("path_lo.c")).otherwise(-F.col("path_hi.c"))
    worst_time = F.when(long_side, F.col("path_lo.t")).otherwise(F.col("path_hi.t"))
    pnl = pct_change(e, worst_close) * pos
    neg = F.coalesce(pnl < 0, F.lit(False))
    return (j.withColumn("max_intra_drawdown_pct", F.when(neg, pnl).otherwise(F.lit(0.0)))
             .withColumn("max_intra_drawdown_dollars",
                         F.when(neg, pnl * F.lit(DOLLARS_PER_PCT)).otherwise(F.lit(0.0)))
             .withColumn("time_of_max_drawdown", F.when(neg, worst_time))
             .drop(*PATH_COLUMNS))


def trade_path(trades: DataFrame, bars: DataFrame, key: str = "symbol", ts: str = "ts",
               tie: str = "id") -> DataFrame:
    """Each trade joined to the bars of its date in 20-23h (equi-join on
    (symbol, date) + hour filter), with the floating P&L of every bar."""
    b = (bars.filter(in_hours(ts, *TRADE_HOURS))
             .withColumn("date", F.to_date(F.col(ts)))
             .select(key, "date", F.col(ts).alias("bar_ts"), F.col(tie).alias("bar_id"),
                     F.col("close").alias("bar_close")))
    # the entry price per day is an aggregate (partial, map-side), joined back:
    # no window over a whole (symbol, day), however many ticks it holds
    entry = trade_path_stats(bars, key, ts, tie).select(key, "date", F.col("path_entry").alias("entry_price"))
    t = trades.withColumn("date", F.to_date(F.col("datetime")))
    j = t.join(b, [key, "date"], "inner").join(entry, [key, "date"], "inner")
    return j.withColumn("pnl_pct", pct_change("entry_price", "bar_close") * F.col("position"))


def backtest(features: DataFrame, bars: DataFrame | None = None, prediction: str = "prediction",
             key: str = "symbol", capital: float = INITIAL_CAPITAL, slice_from: float | None = 0.85,
             ts: str = "ts", tie: str = "id") -> DataFrame:
    """Feature rows with a prediction column -> full trade ledger.

    ``slice_from`` keeps rows at positions >= int(f*n) (None = all rows).
    ``bars`` feeds the intra-trade drawdown; without bars it comes from the
    features' path columns when present, else it is 0 / NULL."""
    d = features
    if slice_from is not None:
        d = backtest_slice(d, key, start=slice_from)
    d = (d.withColumn("predictions", F.col(prediction).cast("double"))
          .withColumn("actual_change", F.col("target")))
    d = trade_direction(d)
    d = equity_curve(d, key, capital=capital)
    if bars is not None or all(c in features.columns for c in PATH_COLUMNS):
        d = intra_trade_drawdown(d, bars, key, ts, tie)
    else:
        d = (d.withColumn("max_intra_drawdown_pct", F.lit(0.0))
              .withColumn("max_intra_drawdown_dollars", F.lit(0.0))
              .withColumn("time_of_max_drawdown", F.lit(None).cast("timestamp_ntz")))
    d = streaks(d, key)
    d = portfolio_drawdown(d, key)
    return d


def ledger_export(ledger: DataFrame, key: str = "symbol") -> DataFrame:
    """S08 projection: the 20 exported ledger columns (plus the symbol key)."""
    return ledger.select(key, *LEDGER_COLUMNS)
