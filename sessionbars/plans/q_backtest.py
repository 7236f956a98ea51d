"""Driver queries: splits, ledger pieces, full backtest, metrics and chart data.

Two inputs: the events-based session features (30 days, bars available for
the intra-trade path; rule prediction = MACD at entry) and the orders-based
daily series (thousands of days per symbol; rule prediction = previous
day's change).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionbars.operators import backtest as bt
from sessionbars.operators import metrics as mt
from sessionbars.operators import splits
from sessionbars.operators.features import build_features
from sessionbars.plans.adapters import event_bars, order_daily
from sessionbars.plans.q_sessions import session_bars
from sessionbars.plans.registry import register
from sessionbars.plans.sqlparts import (
    EVENT_BARS, LEDGER_KINDS, ORDER_DAILY, SUMMARY_CTES, SUMMARY_KINDS, feature_ctes,
    indicator_ctes, ledger_ctes, normalized_select, us_from, with_ctes,
)


def session_feature_rows(spark, sf_dir):
    """F01 rows (with the intra-trade path aggregates) + the MACD-sign rule."""
    f = build_features(event_bars(spark, sf_dir), with_path=True)
    return f.withColumn("prediction", F.col("current_macd"))


_EV_FEAT = [EVENT_BARS, indicator_ctes(), feature_ctes(),
            "src AS (SELECT *, current_macd AS prediction FROM feat)"]
_EV_PATH_BARS = "sbars AS (SELECT * FROM bars WHERE hour(ts) BETWEEN 9 AND 23)"


def _orders_ledger(spark, sf_dir, sliced=True):
    return bt.backtest(order_daily(spark, sf_dir), None, slice_from=0.85 if sliced else None)


# --- X01-X03 -------------------------------------------------------------------

@register("chrono_split", with_ctes(ORDER_DAILY, """sp AS (
  SELECT symbol, datetime, row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS idx,
         count(*) OVER (PARTITION BY symbol) AS n FROM od),
sp2 AS (SELECT *, n - ceil(0.15 * n) AS n_temp FROM sp),
sp3 AS (SELECT symbol, datetime,
          CASE WHEN idx >= n_temp THEN 'test' WHEN idx >= n_temp - ceil(0.176 * n_temp) THEN 'val'
               ELSE 'train' END AS split FROM sp2)""") + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("split", "s")], "sp3"))
def q_chrono_split(spark, sf_dir):
    return splits.chronological_split(order_daily(spark, sf_dir)).select("symbol", "datetime", "split")


@register("backtest_slice", with_ctes(ORDER_DAILY, """s AS (
  SELECT * FROM (SELECT symbol, datetime, target, row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS idx,
                        count(*) OVER (PARTITION BY symbol) AS n FROM od) WHERE idx >= floor(0.85 * n))""") + "\n" +
          normalized_select([("symbol", "s"), ("datetime", "t"), ("target", "d")], "s"))
def q_backtest_slice(spark, sf_dir):
    return splits.backtest_slice(order_daily(spark, sf_dir)).select("symbol", "datetime", "target")


@register("ts_folds", with_ctes(ORDER_DAILY, """sp AS (
  SELECT symbol, datetime, row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS idx,
         count(*) OVER (PARTITION BY symbol) AS n FROM od),
tr AS (
  SELECT symbol, datetime FROM (SELECT *, n - ceil(0.15 * n) AS n_temp FROM sp)
  WHERE idx < n_temp - ceil(0.176 * n_temp)),
ti AS (
  SELECT symbol, datetime, row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS idx,
         count(*) OVER (PARTITION BY symbol) AS n FROM tr),
f AS (SELECT * FROM ti CROSS JOIN (SELECT unnest([0, 1, 2]) AS fold)),
fr AS (
  SELECT symbol, datetime, fold,
         CASE WHEN idx < n - (3 - fold) * (n // 4) THEN 'train'
              WHEN idx < n - (2 - fold) * (n // 4) THEN 'test' END AS role FROM f)""") + "\n" +
          normalized_select([("symbol", "s"), ("datetime", "t"), ("fold", "i"), ("role", "s")],
                            "fr WHERE role IS NOT NULL"))
def q_ts_folds(spark, sf_dir):
    sp = splits.chronological_split(order_daily(spark, sf_dir))
    train = sp.filter(F.col("split") == "train")
    return splits.time_series_folds(train, 3).select("symbol", "datetime", "fold", "role")


# --- ledger pieces on the orders series (no intraday path) ------------------------

_OD_LEDGER = with_ctes(ORDER_DAILY, "src AS (SELECT * FROM od)", ledger_ctes("src", None))


@register("trade_direction", _OD_LEDGER + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("predicted_direction", "s"), ("actual_direction", "s"),
     ("correct_direction", "s"), ("position", "i")], "led"))
def q_trade_direction(spark, sf_dir):
    return _orders_ledger(spark, sf_dir).select(
        "symbol", "datetime", "predicted_direction", "actual_direction", "correct_direction", "position")


@register("equity_curve", _OD_LEDGER + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("returns", "d"), ("pnl_dollars", "d"), ("cumulative_pnl", "d"),
     ("equity", "d"), ("daily_pnl", "d")], "led"))
def q_equity_curve(spark, sf_dir):
    return _orders_ledger(spark, sf_dir).select(
        "symbol", "datetime", "returns", "pnl_dollars", "cumulative_pnl", "equity", "daily_pnl")


@register("streaks", _OD_LEDGER + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("win_trade", "s"), ("loss_trade", "s"), ("win_streak", "i"),
     ("loss_streak", "i")], "led"))
def q_streaks(spark, sf_dir):
    return _orders_ledger(spark, sf_dir).select(
        "symbol", "datetime", "win_trade", "loss_trade", "win_streak", "loss_streak")


@register("portfolio_drawdown", _OD_LEDGER + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("running_max", "d"), ("portfolio_drawdown", "d")], "led"))
def q_portfolio_drawdown(spark, sf_dir):
    return _orders_ledger(spark, sf_dir).select("symbol", "datetime", "running_max", "portfolio_drawdown")


@register("daily_returns", _OD_LEDGER + """,
dr AS (SELECT *, coalesce(daily_pnl / nullif(lag(equity) OVER (PARTITION BY symbol ORDER BY datetime), 0) * 100, 0.0)
                 AS daily_returns FROM led)
""" + normalized_select([("symbol", "s"), ("datetime", "t"), ("daily_returns", "d")], "dr"))
def q_daily_returns(spark, sf_dir):
    return mt.daily_returns(_orders_ledger(spark, sf_dir)).select("symbol", "datetime", "daily_returns")


@register("performance_summary", _OD_LEDGER + ",\n" + SUMMARY_CTES + "\n" + normalized_select(SUMMARY_KINDS, "summ2"))
def q_performance_summary(spark, sf_dir):
    """A06 over the orders series (about 260 trades per symbol at sf0.01)."""
    return mt.performance_summary(_orders_ledger(spark, sf_dir))


@register("regression_metrics", with_ctes(ORDER_DAILY, """m AS (
  SELECT symbol, avg(abs(target - prediction)) AS mae,
         1 - sum((target - prediction) * (target - prediction))
             / nullif(sum((target - t_mean) * (target - t_mean)), 0) AS r2,
         count(*) AS n
  FROM (SELECT *, avg(target) OVER (PARTITION BY symbol) AS t_mean FROM od
        WHERE prediction IS NOT NULL AND target IS NOT NULL)
  GROUP BY symbol)""") + "\n" + normalized_select([("symbol", "s"), ("mae", "d"), ("r2", "d"), ("n", "i")], "m"))
def q_regression_metrics(spark, sf_dir):
    d = order_daily(spark, sf_dir).dropna(subset=["prediction", "target"])
    return mt.regression_metrics(d, "prediction")


def _hist_sql(src_ctes: str, src: str, value: str, bins: int, where: str = "TRUE") -> str:
    return src_ctes + f""",
hv AS (SELECT symbol, {value} AS v FROM {src} WHERE {where}),
hr0 AS (SELECT symbol, min(v) AS lo, max(v) AS hi FROM hv GROUP BY symbol),
hr AS (SELECT symbol, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
              CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM hr0),
hb AS (SELECT hv.symbol, CAST(least(floor((v - lo) * {float(bins)} / (hi - lo)), {bins - 1}) AS BIGINT) AS bin
       FROM hv JOIN hr ON hv.symbol = hr.symbol),
hc AS (SELECT symbol, bin, count(*) AS cnt FROM hb GROUP BY symbol, bin),
hg AS (SELECT hr.symbol, b.bin, hr.lo, hr.hi FROM hr CROSS JOIN (SELECT CAST(range AS BIGINT) AS bin FROM range({bins})) b),
h AS (SELECT hg.symbol, hg.bin, lo + hg.bin * ((hi - lo) / {float(bins)}) AS bin_lo,
             lo + (hg.bin + 1) * ((hi - lo) / {float(bins)}) AS bin_hi, coalesce(hc.cnt, 0) AS count
      FROM hg LEFT JOIN hc ON hg.symbol = hc.symbol AND hg.bin = hc.bin)
""" + normalized_select([("symbol", "s"), ("bin", "i"), ("bin_lo", "d"), ("bin_hi", "d"), ("count", "i")], "h")


@register("pnl_histogram", _hist_sql(_OD_LEDGER, "led", "pnl_dollars", 30))
def q_pnl_histogram(spark, sf_dir):
    return mt.histogram(_orders_ledger(spark, sf_dir), "pnl_dollars", 30)


@register("correct_wrong_split", _OD_LEDGER + """,
cw AS (SELECT symbol, correct_direction, count(*) AS n, avg(actual_change) AS avg_actual,
              avg(predictions) AS avg_predicted FROM led GROUP BY symbol, correct_direction)
""" + normalized_select([("symbol", "s"), ("correct_direction", "s"), ("n", "i"), ("avg_actual", "d"),
                         ("avg_predicted", "d")], "cw"))
def q_correct_wrong_split(spark, sf_dir):
    return mt.correct_wrong_split(_orders_ledger(spark, sf_dir))


# --- session backtest: events features + bars for the intra-trade path ------------

_EV_LEDGER = with_ctes(*_EV_FEAT, _EV_PATH_BARS, ledger_ctes("src", "sbars"))
_EV_ALL_TRADES = with_ctes(*_EV_FEAT, _EV_PATH_BARS, ledger_ctes("src", "sbars", sliced=False))


@register("backtest_ledger", _EV_LEDGER + "\n" + normalized_select(LEDGER_KINDS, "led"))
def q_backtest_ledger(spark, sf_dir):
    """Session features -> MACD-sign trades -> 20-column ledger."""
    led = bt.backtest(session_feature_rows(spark, sf_dir))
    return bt.ledger_export(led)


@register("intra_trade_drawdown", _EV_ALL_TRADES + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("position", "i"), ("max_intra_drawdown_pct", "d"),
     ("max_intra_drawdown_dollars", "d"), ("time_of_max_drawdown", "t")], "led"))
def q_intra_trade_drawdown(spark, sf_dir):
    """A05 over every feature day (150 trades at sf0.01), not just the slice."""
    led = bt.backtest(session_feature_rows(spark, sf_dir), slice_from=None)
    return led.select("symbol", "datetime", "position", "max_intra_drawdown_pct",
                      "max_intra_drawdown_dollars", "time_of_max_drawdown")


@register("trade_path", _EV_ALL_TRADES + f""",
tp AS (
  SELECT t.symbol, t.datetime, pb.ts AS bar_ts, pb.id AS bar_id, pb.close AS bar_close, pe.entry AS entry_price,
         (pb.close - pe.entry) / nullif(pe.entry, 0) * 100 * t.position AS pnl_pct
  FROM led t JOIN pb ON t.symbol = pb.symbol AND CAST(t.datetime AS DATE) = pb.date
             JOIN pe ON t.symbol = pe.symbol AND CAST(t.datetime AS DATE) = pe.date)
""" + normalized_select([("symbol", "s"), ("datetime", "t"), ("bar_ts", "t"), ("bar_id", "i"),
                         ("bar_close", "d"), ("entry_price", "d"), ("pnl_pct", "d")], "tp"))
def q_trade_path(spark, sf_dir):
    """J03 literal form: every trade x its 20-23h bars with floating P&L."""
    trades = bt.trade_direction(session_feature_rows(spark, sf_dir)
                                .withColumn("predictions", F.col("prediction"))
                                .withColumn("actual_change", F.col("target")))
    return bt.trade_path(trades, session_bars(spark, sf_dir)).select(
        "symbol", "datetime", "bar_ts", "bar_id", "bar_close", "entry_price", "pnl_pct")


@register("intra_dd_summary", _EV_ALL_TRADES + """,
ids AS (SELECT symbol,
    coalesce(min(max_intra_drawdown_pct) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS max_intra_dd_pct,
    coalesce(min(max_intra_drawdown_dollars) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS max_intra_dd_dollars,
    coalesce(avg(max_intra_drawdown_pct) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS avg_intra_dd_pct,
    coalesce(avg(max_intra_drawdown_dollars) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS avg_intra_dd_dollars,
    count(*) FILTER (WHERE max_intra_drawdown_pct < 0) AS trades_with_dd,
    count(*) FILTER (WHERE max_intra_drawdown_pct < 0) / count(*) * 100 AS pct_trades_with_dd,
    coalesce(stddev_samp(max_intra_drawdown_pct) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS dd_std
  FROM led GROUP BY symbol)
""" + normalized_select([("symbol", "s"), ("max_intra_dd_pct", "d"), ("max_intra_dd_dollars", "d"),
                         ("avg_intra_dd_pct", "d"), ("avg_intra_dd_dollars", "d"), ("trades_with_dd", "i"),
                         ("pct_trades_with_dd", "d"), ("dd_std", "d")], "ids"))
def q_intra_dd_summary(spark, sf_dir):
    led = bt.backtest(session_feature_rows(spark, sf_dir), slice_from=None)
    return mt.intra_dd_summary(led)


@register("dd_histogram", _hist_sql(_EV_ALL_TRADES, "led", "max_intra_drawdown_pct", 20,
                                    "max_intra_drawdown_pct < 0"))
def q_dd_histogram(spark, sf_dir):
    led = bt.backtest(session_feature_rows(spark, sf_dir), slice_from=None)
    return mt.histogram(led.filter(F.col("max_intra_drawdown_pct") < 0), "max_intra_drawdown_pct", 20)


@register("worst_trades", _EV_ALL_TRADES + """,
wt AS (SELECT * FROM (SELECT symbol, datetime, max_intra_drawdown_pct, time_of_max_drawdown,
          row_number() OVER (PARTITION BY symbol ORDER BY max_intra_drawdown_pct, datetime) AS rank FROM led)
       WHERE rank <= 5)
""" + normalized_select([("symbol", "s"), ("datetime", "t"), ("max_intra_drawdown_pct", "d"),
                         ("time_of_max_drawdown", "t"), ("rank", "i")], "wt"))
def q_worst_trades(spark, sf_dir):
    led = bt.backtest(session_feature_rows(spark, sf_dir), slice_from=None)
    return mt.worst_trades(led, 5).select("symbol", "datetime", "max_intra_drawdown_pct",
                                          "time_of_max_drawdown", "rank")


@register("performance_summary_sessions", _EV_LEDGER + ",\n" + SUMMARY_CTES + "\n" +
          normalized_select(SUMMARY_KINDS, "summ2"))
def q_performance_summary_sessions(spark, sf_dir):
    """A06 on the session backtest (5 trades per symbol at sf0.01)."""
    led = bt.backtest(session_feature_rows(spark, sf_dir))
    return mt.performance_summary(led)


__all__ = ["us_from"]


# --- W04 / W05 / P10 as their own queries ----------------------------------------

_WEEK_SQL = with_ctes(ORDER_DAILY, """wk AS (
  SELECT symbol, datetime, day_close_current,
    avg(day_close_current) OVER (PARTITION BY symbol ORDER BY datetime
                                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS week_avg_close,
    coalesce(stddev_samp(day_close_current) OVER (PARTITION BY symbol ORDER BY datetime
                                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0.0) AS week_volatility,
    coalesce(CAST(day_close_current > lag(day_close_current, 7) OVER (PARTITION BY symbol ORDER BY datetime)
                  AS INTEGER), 0) AS week_trend
  FROM od)""")


@register("week_stats", _WEEK_SQL + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("week_avg_close", "d"), ("week_volatility", "d")], "wk"))
def q_week_stats(spark, sf_dir):
    """7-row mean and sample std of the daily close (orders series)."""
    from sessionbars.operators.features import week_features
    return week_features(order_daily(spark, sf_dir)).select("symbol", "datetime", "week_avg_close",
                                                            "week_volatility")


@register("week_trend", _WEEK_SQL + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("week_trend", "i")], "wk"))
def q_week_trend(spark, sf_dir):
    """Close above the close 7 rows earlier (orders series)."""
    from sessionbars.operators.features import week_features
    return week_features(order_daily(spark, sf_dir)).select("symbol", "datetime", "week_trend")


@register("feature_fill", with_ctes(EVENT_BARS, indicator_ctes(), feature_ctes()) + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("current_sma_15", "d"), ("current_sma_30", "d"),
     ("current_rsi", "d"), ("current_macd", "d"), ("week_trend", "i")],
    "feat1 WHERE target IS NOT NULL AND daily_variation IS NOT NULL"))
def q_feature_fill(spark, sf_dir):
    """P10: the unfilled feature rows, then SMA -> close, RSI -> 50, MACD -> 0."""
    from sessionbars.operators.filters import fill_features
    raw = build_features(event_bars(spark, sf_dir), raw=True)
    f = fill_features(raw).filter(F.col("target").isNotNull() & F.col("daily_variation").isNotNull())
    return f.select("symbol", "datetime", "current_sma_15", "current_sma_30", "current_rsi", "current_macd",
                    "week_trend")
