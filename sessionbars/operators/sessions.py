"""Per-day session operators: daily OHLCV stats, nearest bar to a clock time,
and the entry/exit target.

Everything here is one ``groupBy(symbol, date)`` with conditional aggregates:
the nearest-bar picks are ``min(struct(distance, ts, id, ...))`` (a total
order, so no order-dependent ``first``/``last``), and the entry/exit "join"
of the reference becomes two conditional picks in the same aggregate — one
shuffle, partial aggregation on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionbars.functions.columns import abs_micros_from_clock, micros_of_day, pct_change

# Fixed values of the reference's session rules (hours are inclusive bounds).
EVENING_HOURS = (17, 23)
ENTRY_CLOCK = (20, 0)
ENTRY_HOURS = (19, 21)
EXIT_CLOCK = (23, 0)
EXIT_HOURS = (22, 23)


def in_hours(ts: str, lo: int, hi: int) -> Column:
    h = F.hour(F.col(ts))
    return (h >= lo) & (h <= hi)


def nearest_pick(ts: str, tie: str, clock: tuple[int, int], hours: tuple[int, int],
                 fields: list[str]) -> Column:
    """Aggregate: the bar closest to ``clock`` among bars in ``hours``;
    a tie in distance goes to the earlier bar (then the lower tie id)."""
    dist = abs_micros_from_clock(ts, *clock)
    row = F.struct(dist.alias("dist"), F.col(ts).alias("ts"), F.col(tie).alias("tie"),
                   *[F.col(f).alias(f) for f in fields])
    return F.min(F.when(in_hours(ts, *hours), row))


def first_by_time(ts: str, tie: str, value: str) -> Column:
    return F.min(F.struct(F.col(ts), F.col(tie), F.col(value).alias("v")))["v"]


def last_by_time(ts: str, tie: str, value: str) -> Column:
    return F.max(F.struct(F.col(ts), F.col(tie), F.col(value).alias("v")))["v"]


def daily_stat_aggs(ts: str = "ts", tie: str = "id", cutoff: str | None = None) -> list[Column]:
    """Aggregates of the reference's daily table.  ``cutoff='HH:MM'`` keeps only
    bars at or before that clock time (the look-ahead-free variant)."""
    keep = None
    if cutoff:
        hh, mm = (int(x) for x in cutoff.split(":"))
        keep = micros_of_day(ts) <= F.lit((hh * 3600 + mm * 60) * 1_000_000)

    def c(name: str) -> Column:
        return F.col(name) if keep is None else F.when(keep, F.col(name))

    def stamp(name: str) -> Column:
        s = F.struct(F.col(ts), F.col(tie), F.col(name).alias("v"))
        return s if keep is None else F.when(keep, s)

    return [
        F.min(stamp("open"))["v"].alias("day_open"),
        F.max(c("high")).alias("day_high"),
        F.min(c("low")).alias("day_low"),
        F.min(stamp("close"))["v"].alias("day_close_first"),
        F.max(stamp("close"))["v"].alias("day_close_last"),
        F.sum(c("volume")).cast("long").alias("day_volume"),
    ]


def daily_stats(bars: DataFrame, key: str = "symbol", ts: str = "ts", tie: str = "id",
                cutoff: str | None = None, hours: tuple[int, int] = EVENING_HOURS) -> DataFrame:
    """Per (symbol, date) over the evening hours."""
    ev = bars.filter(in_hours(ts, *hours)).withColumn("date", F.to_date(F.col(ts)))
    out = ev.groupBy(key, "date").agg(*daily_stat_aggs(ts, tie, cutoff))
    if cutoff:
        out = out.filter(F.col("day_open").isNotNull())
    return out.withColumn("daily_variation", pct_change("day_open", "day_close_last"))


def nearest_bar(bars: DataFrame, clock: tuple[int, int], hours: tuple[int, int],
                fields: tuple[str, ...] = ("close",), key: str = "symbol", ts: str = "ts",
                tie: str = "id") -> DataFrame:
    """One row per (symbol, date) that has a bar in ``hours``."""
    pick = nearest_pick(ts, tie, clock, hours, list(fields)).alias("p")
    out = (bars.filter(in_hours(ts, *hours))
               .withColumn("date", F.to_date(F.col(ts)))
               .groupBy(key, "date").agg(pick))
    return out.select(key, "date", F.col("p.ts").alias(ts), F.col("p.tie").alias(tie),
                      (F.col("p.dist") / F.lit(1_000_000.0)).alias("seconds_from_target"),
                      *[F.col(f"p.{f}").alias(f) for f in fields])


def session_target(bars: DataFrame, key: str = "symbol", ts: str = "ts", tie: str = "id",
                   value: str = "close") -> DataFrame:
    """entry = bar nearest 20:00 (19-21h), exit = bar nearest 23:00
    (22-23h), both on the same date; target = % change entry -> exit.
    Days missing either side are dropped (inner-join semantics)."""
    ev = bars.filter(in_hours(ts, *EVENING_HOURS)).withColumn("date", F.to_date(F.col(ts)))
    agg = ev.groupBy(key, "date").agg(
        nearest_pick(ts, tie, ENTRY_CLOCK, ENTRY_HOURS, [value]).alias("e"),
        nearest_pick(ts, tie, EXIT_CLOCK, EXIT_HOURS, [value]).alias("x"))
    agg = agg.filter(F.col("e").isNotNull() & F.col("x").isNotNull())
    return agg.select(key, "date",
                      F.col("e.ts").alias("entry_ts"), F.col(f"e.{value}").alias("entry_close"),
                      F.col("x.ts").alias("exit_ts"), F.col(f"x.{value}").alias("exit_close"),
                      pct_change(F.col(f"e.{value}"), F.col(f"x.{value}")).alias("target"))


def session_target_join(bars: DataFrame, key: str = "symbol", ts: str = "ts", tie: str = "id",
                        value: str = "close") -> DataFrame:
    """Test twin of ``session_target`` written as the reference's equi-join."""
    ent = nearest_bar(bars, ENTRY_CLOCK, ENTRY_HOURS, (value,), key, ts, tie)
    ext = nearest_bar(bars, EXIT_CLOCK, EXIT_HOURS, (value,), key, ts, tie)
    j = ent.alias("e").join(ext.alias("x"), [key, "date"], "inner")
    return j.select(key, "date", F.col(f"e.{ts}").alias("entry_ts"), F.col(f"e.{value}").alias("entry_close"),
                    F.col(f"x.{ts}").alias("exit_ts"), F.col(f"x.{value}").alias("exit_close"),
                    pct_change(F.col(f"e.{value}"), F.col(f"x.{value}")).alias("target"))
