"""Driver queries: indicators, session picks, daily stats and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionbars.operators import filters
from sessionbars.operators.features import build_features
from sessionbars.operators.indicators import ewm_mean, with_indicators
from sessionbars.operators.sessions import (
    ENTRY_CLOCK, ENTRY_HOURS, EXIT_CLOCK, EXIT_HOURS, daily_stats, nearest_bar, session_target,
)
from sessionbars.plans.adapters import event_bars
from sessionbars.plans.registry import register
from sessionbars.plans.sqlparts import (
    EVENT_BARS, FEATURE_KINDS, feature_ctes, indicator_ctes, normalized_select, us_from, with_ctes,
)


def session_bars(spark, sf_dir):
    return filters.session_filter(event_bars(spark, sf_dir), 9, 23)


# --- W01-W03: indicators over every session bar ---------------------------------

_IND_SQL = with_ctes(EVENT_BARS, indicator_ctes(outer_where="TRUE"))


@register("sma", _IND_SQL + "\n" + normalized_select(
    [("symbol", "s"), ("ts", "t"), ("id", "i"), ("close", "d"), ("sma_15", "d"), ("sma_30", "d")], "ind"))
def q_sma(spark, sf_dir):
    ind = with_indicators(session_bars(spark, sf_dir), rsi=None, macd=None)
    return ind.select("symbol", "ts", "id", "close", "sma_15", "sma_30")


@register("rsi", _IND_SQL + "\n" + normalized_select(
    [("symbol", "s"), ("ts", "t"), ("id", "i"), ("rsi", "d")], "ind"))
def q_rsi(spark, sf_dir):
    ind = with_indicators(session_bars(spark, sf_dir), sma=(), macd=None)
    return ind.select("symbol", "ts", "id", "rsi")


@register("macd", _IND_SQL + "\n" + normalized_select(
    [("symbol", "s"), ("ts", "t"), ("id", "i"), ("macd", "d")], "ind"))
def q_macd(spark, sf_dir):
    ind = with_indicators(session_bars(spark, sf_dir), sma=(), rsi=None)
    return ind.select("symbol", "ts", "id", "macd")


@register("ewm_span26", with_ctes(EVENT_BARS, f"""seq AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, id) - 1 AS g FROM bars),
e AS (
  SELECT a.symbol, a.ts, a.id,
         sum(pow(25.0/27.0, a.g - b.g) * b.close) / sum(pow(25.0/27.0, a.g - b.g)) AS ewm
  FROM seq a JOIN seq b ON a.symbol = b.symbol AND b.g BETWEEN a.g - 700 AND a.g
  GROUP BY a.symbol, a.ts, a.id)""") + "\n" + normalized_select(
    [("symbol", "s"), ("ts", "t"), ("id", "i"), ("ewm", "d")], "e"))
def q_ewm_span26(spark, sf_dir):
    """Generic EWM (adjust=True) over all ticks, no session filter."""
    return ewm_mean(event_bars(spark, sf_dir), "close", span=26).select("symbol", "ts", "id", "ewm")


# --- A01-A04, J01: session picks and daily stats ----------------------------------

_PICK_COLS = [("symbol", "s"), ("date", "t"), ("ts", "t"), ("id", "i"),
              ("seconds_from_target", "d"), ("close", "d")]


def _pick_sql(hour: int, lo: int, hi: int) -> str:
    return with_ctes(EVENT_BARS, f"""p AS (
  SELECT symbol, CAST(ts AS DATE) AS date, ts, id, {us_from('ts', hour)} / 1e6 AS seconds_from_target, close,
         row_number() OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY {us_from('ts', hour)}, ts, id) AS rn
  FROM bars WHERE hour(ts) BETWEEN {lo} AND {hi}),
pk AS (SELECT * FROM p WHERE rn = 1)""") + "\n" + normalized_select(_PICK_COLS, "pk")


@register("nearest_entry", _pick_sql(20, 19, 21))
def q_nearest_entry(spark, sf_dir):
    return nearest_bar(session_bars(spark, sf_dir), ENTRY_CLOCK, ENTRY_HOURS)


@register("nearest_exit", _pick_sql(23, 22, 23))
def q_nearest_exit(spark, sf_dir):
    return nearest_bar(session_bars(spark, sf_dir), EXIT_CLOCK, EXIT_HOURS)


_TARGET_SQL = with_ctes(EVENT_BARS, f"""ev AS (
  SELECT *, CAST(ts AS DATE) AS date FROM bars WHERE hour(ts) BETWEEN 17 AND 23),
ent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY {us_from('ts', 20)}, ts, id) AS rn
        FROM ev WHERE hour(ts) BETWEEN 19 AND 21) WHERE rn = 1),
ext AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY {us_from('ts', 23)}, ts, id) AS rn
        FROM ev WHERE hour(ts) BETWEEN 22 AND 23) WHERE rn = 1),
t AS (SELECT e.symbol, e.date, e.ts AS entry_ts, e.close AS entry_close, x.ts AS exit_ts, x.close AS exit_close,
             (x.close - e.close) / nullif(e.close, 0) * 100 AS target
      FROM ent e JOIN ext x ON e.symbol = x.symbol AND e.date = x.date)""") + "\n" + normalized_select(
    [("symbol", "s"), ("date", "t"), ("entry_ts", "t"), ("entry_close", "d"), ("exit_ts", "t"),
     ("exit_close", "d"), ("target", "d")], "t")


@register("session_target", _TARGET_SQL)
def q_session_target(spark, sf_dir):
    return session_target(session_bars(spark, sf_dir))


def _daily_sql(cutoff_us: int | None) -> str:
    keep = "TRUE" if cutoff_us is None else f"(epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))) <= {cutoff_us}"
    return with_ctes(EVENT_BARS, f"""ev AS (
  SELECT *, CAST(ts AS DATE) AS date FROM bars WHERE hour(ts) BETWEEN 17 AND 23 AND {keep}),
d AS (SELECT symbol, date, first(open ORDER BY ts, id) AS day_open, max(high) AS day_high, min(low) AS day_low,
             first(close ORDER BY ts, id) AS day_close_first, last(close ORDER BY ts, id) AS day_close_last,
             sum(volume) AS day_volume FROM ev GROUP BY symbol, date),
dv AS (SELECT *, (day_close_last - day_open) / nullif(day_open, 0) * 100 AS daily_variation FROM d)""") + "\n" + \
        normalized_select([("symbol", "s"), ("date", "t"), ("day_open", "d"), ("day_high", "d"), ("day_low", "d"),
                           ("day_close_first", "d"), ("day_close_last", "d"), ("day_volume", "i"),
                           ("daily_variation", "d")], "dv")


@register("daily_stats", _daily_sql(None))
def q_daily_stats(spark, sf_dir):
    return daily_stats(session_bars(spark, sf_dir))


@register("daily_stats_asof", _daily_sql(20 * 3600 * 1_000_000))
def q_daily_stats_asof(spark, sf_dir):
    return daily_stats(session_bars(spark, sf_dir), cutoff="20:00")


# --- F01: the feature table (flagship) --------------------------------------------

SESSION_FEATURES_SQL = with_ctes(EVENT_BARS, indicator_ctes(), feature_ctes()) + "\n" + \
    normalized_select(FEATURE_KINDS, "feat")


@register("session_features", SESSION_FEATURES_SQL)
def q_session_features(spark, sf_dir):
    return build_features(event_bars(spark, sf_dir))


_ASOF_FEATURES_SQL = with_ctes(
    EVENT_BARS, indicator_ctes(),
    feature_ctes(daily_where="(epoch_us(ts) - epoch_us(CAST(date AS TIMESTAMP))) <= 72000000000")) + "\n" + \
    normalized_select(FEATURE_KINDS, "feat")


@register("session_features_asof", _ASOF_FEATURES_SQL)
def q_session_features_asof(spark, sf_dir):
    """F01 with the look-ahead-free daily stats (bars up to 20:00 only)."""
    return build_features(event_bars(spark, sf_dir), cutoff="20:00")


__all__ = ["SESSION_FEATURES_SQL", "session_bars", "F"]


@register("macd_hourly_blocks", _IND_SQL + "\n" + normalized_select(
    [("symbol", "s"), ("ts", "t"), ("id", "i"), ("macd", "d")], "ind"))
def q_macd_hourly_blocks(spark, sf_dir):
    """W03 with the hot-day layout: blocks cut by clock hour and every 64 rows
    (what a dense tick day uses); the result must not change."""
    ind = with_indicators(session_bars(spark, sf_dir), sma=(), rsi=None, slice_minutes=60, sub_rows=64)
    return ind.select("symbol", "ts", "id", "macd")
