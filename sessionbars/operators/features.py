"""the reference's daily feature table, built in one bar-level pass.

Plan shape: bars -> hour filter 9-23 (below the indicators, as the reference
does) -> blocked indicator scan -> hour filter 17-23 (above the indicators) ->
ONE groupBy(symbol, date) that yields the daily stats, the entry bar nearest
20:00 with its indicator values and the exit bar nearest 23:00 -> 7-row
windows over the daily rows of each symbol (one row per trading day, so the
window partition is bounded by the calendar, not by data volume).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.functions.columns import pct_change
from sessionbars.operators import filters
from sessionbars.operators.indicators import with_indicators
from sessionbars.operators.sessions import (
    ENTRY_CLOCK, ENTRY_HOURS, EVENING_HOURS, EXIT_CLOCK, EXIT_HOURS, daily_stat_aggs,
    in_hours, nearest_pick,
)

# Output order of the reference's feature table (datetime first, target last).
FEATURE_COLUMNS = [
    "datetime", "day_of_week", "day_open", "day_close_current", "day_high", "day_low",
    "day_volume", "daily_variation", "current_sma_15", "current_sma_30", "current_rsi",
    "current_macd", "week_avg_close", "week_volatility", "week_trend", "target",
]
MODEL_FEATURES = [c for c in FEATURE_COLUMNS if c not in ("datetime", "target")]


def week_features(daily: DataFrame, key: str = "symbol", order: str = "datetime",
                  value: str = "day_close_current", rows: int = 7) -> DataFrame:
    """7-row mean and sample std (single row -> 0) and the trend flag
    close > close 7 rows earlier (no earlier row -> 0)."""
    w = Window.partitionBy(key).orderBy(order)
    frame = w.rowsBetween(-(rows - 1), 0)
    return daily.withColumns({
        "week_avg_close": F.avg(value).over(frame),
        "week_volatility": F.coalesce(F.stddev_samp(value).over(frame), F.lit(0.0)),
        "week_trend": F.coalesce((F.col(value) > F.lag(value, rows).over(w)).cast("int"), F.lit(0))})


def build_features(bars: DataFrame, key: str = "symbol", ts: str = "ts", tie: str = "id",
                   cutoff: str | None = None, left_exit: bool = False,
                   session_hours: tuple[int, int] | None = (9, 23),
                   slice_minutes: int | str | None = None, raw: bool = False,
                   with_path: bool = False) -> DataFrame:
    """Bars (symbol, ts, id, open, high, low, close, volume) -> one feature row
    per (symbol, trading day) that has an entry bar and an exit bar.

    cutoff:     'HH:MM' restricts the daily stats to bars up to that time
                (the reference aggregates the whole evening: look-ahead).
    left_exit:  keep days without an exit bar (target NULL) — used to score
                today's row live; the reference drops them.
    raw:        stop before the fills and the NULL filter (P10/P11).
    with_path:  also return the day's 20-23h path aggregates (entry close and
                close extremes) for the backtest's intra-trade drawdown, from
                the same aggregate (no second pass over the bars).
    """
    from sessionbars.operators.backtest import PATH_COLUMNS, path_aggs
    if session_hours:
        bars = filters.session_filter(bars, *session_hours, ts=ts)
    ind = with_indicators(bars.drop("date") if "date" in bars.columns else bars, key=key, ts=ts, tie=tie,
                          slice_minutes=slice_minutes, keep_date=True)
    ev = ind.filter(in_hours(ts, *EVENING_HOURS))
    entry_fields = ["close", "sma_15", "sma_30", "rsi", "macd"]
    daily = ev.groupBy(key, "date").agg(
        *daily_stat_aggs(ts, tie, cutoff),
        nearest_pick(ts, tie, ENTRY_CLOCK, ENTRY_HOURS, entry_fields).alias("e"),
        nearest_pick(ts, tie, EXIT_CLOCK, EXIT_HOURS, ["close"]).alias("x"),
        *(path_aggs(ts, tie) if with_path else []),
    )
    keep = F.col("e").isNotNull()
    if not left_exit:
        keep = keep & F.col("x").isNotNull()
    daily = daily.filter(keep).select(
        key,
        F.col("e.ts").alias("datetime"),
        F.weekday(F.col("e.ts")).alias("day_of_week"),
        "day_open",
        F.col("e.close").alias("day_close_current"),
        "day_high", "day_low", "day_volume",
        pct_change("day_open", "day_close_last").alias("daily_variation"),
        F.col("e.sma_15").alias("current_sma_15"),
        F.col("e.sma_30").alias("current_sma_30"),
        F.col("e.rsi").alias("current_rsi"),
        F.col("e.macd").alias("current_macd"),
        pct_change(F.col("e.close"), F.col("x.close")).alias("target"),
        *(PATH_COLUMNS if with_path else []),
    )
    daily = week_features(daily, key)
    if raw:
        return daily.select(key, *FEATURE_COLUMNS, *(PATH_COLUMNS if with_path else []))
    daily = filters.fill_features(daily)
    cols = [key] + FEATURE_COLUMNS
    daily = daily.select(*cols, *(PATH_COLUMNS if with_path else []))
    if left_exit:
        return daily.dropna(subset=[c for c in cols if c != "target"])
    return daily.dropna(subset=cols)
