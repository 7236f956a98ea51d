"""Projections, filters and gates.

All are row-local expressions: they fuse into the scan's whole-stage
codegen span and never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Time-zone aliases accepted by the reference's configuration
# helper, and the zone it falls back to.
TZ_ALIASES = {
    "utc+3": "Europe/Moscow",
    "moscow": "Europe/Moscow",
    "eastern": "US/Eastern",
    "utc": "UTC",
    "london": "Europe/London",
    "tokyo": "Asia/Tokyo",
    "sydney": "Australia/Sydney",
}
DEFAULT_TZ = "Europe/Moscow"


def session_filter(bars: DataFrame, lo: int = 9, hi: int = 23, ts: str = "ts") -> DataFrame:
    """Keep bars whose hour is in [lo, hi] (applied before indicators)."""
    h = F.hour(F.col(ts))
    return bars.filter((h >= lo) & (h <= hi))


def evening_filter(bars: DataFrame, lo: int = 17, hi: int = 23, ts: str = "ts") -> DataFrame:
    """The same predicate, applied after the indicators."""
    return session_filter(bars, lo, hi, ts)


def time_parts(bars: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour, minute, weekday (Monday = 0) and date."""
    return (bars.withColumn("hour", F.hour(F.col(ts)))
                .withColumn("minute", F.minute(F.col(ts)))
                .withColumn("day_of_week", F.weekday(F.col(ts)))
                .withColumn("date", F.to_date(F.col(ts))))


def fill_features(df: DataFrame) -> DataFrame:
    """P10: SMA -> close, RSI -> 50, MACD -> 0, trend -> 0."""
    return df.withColumns({
        "current_sma_15": F.coalesce("current_sma_15", "day_close_current"),
        "current_sma_30": F.coalesce("current_sma_30", "day_close_current"),
        "current_rsi": F.coalesce(F.col("current_rsi"), F.lit(50.0)),
        "current_macd": F.coalesce(F.col("current_macd"), F.lit(0.0)),
        "week_trend": F.coalesce(F.col("week_trend"), F.lit(0))})


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with any NULL."""
    return df.dropna()


def resolve_tz(name: str) -> str:
    """P08 (driver-side, one string): alias -> zone name; unknown -> default."""
    from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

    tz = TZ_ALIASES.get(name.lower(), name)
    try:
        ZoneInfo(tz)
        return tz
    except (ZoneInfoNotFoundError, ValueError):
        return DEFAULT_TZ


def tz_name_column(name_col) -> Column:
    """P08 as a column: alias map applied row-wise (for per-instrument configs);
    a name that is no known zone falls back to the default, like ``resolve_tz``."""
    from zoneinfo import available_timezones

    c = F.col(name_col) if isinstance(name_col, str) else name_col
    mapping = F.create_map(*[x for kv in TZ_ALIASES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    known = F.when(c.isin(sorted(available_timezones())), c)
    return F.coalesce(F.try_element_at(mapping, F.lower(c)), known, F.lit(DEFAULT_TZ))


def to_trading_tz(df: DataFrame, ts: str = "ts", tz_col: str | None = None, tz: str = DEFAULT_TZ,
                  source_tz: str = "UTC", out: str = "local_ts") -> DataFrame:
    """Convert a wall-clock UTC timestamp to the instrument's trading zone."""
    target = tz_name_column(tz_col) if tz_col else F.lit(resolve_tz(tz))
    return df.withColumn(out, F.convert_timezone(F.lit(source_tz), target, F.col(ts)))


def local_time(signals: DataFrame, cfg: DataFrame, key: str = "symbol", ts: str = "datetime",
               out: str = "local_ts") -> DataFrame:
    """P08 by instrument: ``ts`` (UTC wall clock) on the clock of the zone that the
    instrument's config names; without a config, that of the default zone."""
    zones = cfg.select(F.col(key).alias("_zone_of"), F.col("timezone").alias("_zone"))
    j = signals.join(zones, signals[key] == zones["_zone_of"], "left")
    return to_trading_tz(j, ts, tz_col="_zone", out=out).drop("_zone_of", "_zone")


def trading_time_gate(df: DataFrame, ts: str = "local_ts", start: str | Column = "20:00",
                      end: str | Column = "23:00", out: str = "in_session") -> DataFrame:
    """Monday-Friday and start <= time-of-day <= end (end inclusive to the
    microsecond: 23:00:00.4 is after an end of 23:00)."""
    return df.withColumn(out, in_trading_time(ts, start, end))


def in_trading_time(ts: str, start: str | Column, end: str | Column) -> Column:
    """P06 as a condition; start and end are HH:MM or HH:MM:SS."""
    def full(x):
        c = x if isinstance(x, Column) else F.lit(x)
        return F.concat(F.when(F.length(c) == 5, F.concat(c, F.lit(":00"))).otherwise(c), F.lit(".000000"))
    tod = F.date_format(F.col(ts), "HH:mm:ss.SSSSSS")
    return (F.weekday(F.col(ts)) < 5) & (tod >= full(start)) & (tod <= full(end))


def entry_minute_gate(df: DataFrame, ts: str = "local_ts", start: str | Column = "20:00",
                      out: str = "is_entry_minute") -> DataFrame:
    """Only the first minute of the session opens positions."""
    s = F.lit(start) if isinstance(start, str) else start
    hh = F.split(s, ":").getItem(0).cast("int")
    mm = F.split(s, ":").getItem(1).cast("int")
    return df.withColumn(out, (F.hour(F.col(ts)) == hh) & (F.minute(F.col(ts)) == mm))


def min_history_gate(bars: DataFrame, n: int = 100, key: str = "symbol") -> DataFrame:
    """Symbols with fewer than ``n`` bars give no prediction.

    Counted with an aggregate + semi-join (the per-symbol count is a partial
    aggregate, no window over a whole symbol)."""
    ok = bars.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n).select(key)
    return bars.join(ok, key, "left_semi")


def with_history(signals: DataFrame, bars: DataFrame, key: str = "symbol", ts: str = "datetime",
                 bar_ts: str = "ts", out: str = "history_bars") -> DataFrame:
    """P09 per signal: the number of its key's bars at or before ``ts``.

    Earlier days come from a running sum over daily counts, the day itself from
    a join on (key, date) that is aggregated again; no window over bars."""
    s = signals.withColumns({"_d": F.to_date(F.col(ts)), "_sid": F.monotonically_increasing_id()})
    b = bars.select(F.col(key).alias("_k"), F.to_date(F.col(bar_ts)).alias("_bd"), F.col(bar_ts).alias("_bt"))
    on_day = (F.col(key) == F.col("_k")) & (F.col("_d") == F.col("_bd")) & (F.col("_bt") <= F.col(ts))
    today = s.join(b, on_day, "left").groupBy(*s.columns).agg(F.count("_bt").alias("_today"))
    asked = signals.select(F.col(key).alias("_k"), F.to_date(F.col(ts)).alias("_bd"), F.lit(0).cast("long").alias("_n"))
    days = b.groupBy("_k", "_bd").agg(F.count(F.lit(1)).alias("_n")).unionByName(asked)
    days = days.groupBy("_k", "_bd").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy("_k").orderBy("_bd").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    j = today.join(days, (F.col(key) == F.col("_k")) & (F.col("_d") == F.col("_bd")), "left")
    return j.select(*signals.columns, (F.col("_today") + F.coalesce("_before", F.lit(0))).alias(out))


__all__ = [
    "session_filter", "evening_filter", "time_parts", "fill_features", "drop_incomplete",
    "resolve_tz", "tz_name_column", "to_trading_tz", "trading_time_gate", "entry_minute_gate",
    "min_history_gate", "with_history", "local_time",
]
