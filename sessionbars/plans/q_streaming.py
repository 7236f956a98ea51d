"""Driver queries for the streaming jobs.

Each query runs its stream with ``availableNow`` over the driver table (a
file source), into an upsert log under the shared checkpoint folder, and
returns the log's newest rows as a batch DataFrame.  All have exact SQL twins
(stream = batch).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionbars.operators import execution as ex
from sessionbars.plans.adapters import table
from sessionbars.plans.q_desks import _EXITS, _POSITIONS, desk_bars, desk_positions
from sessionbars.plans.q_execution import (_BARRIER_KINDS, _BARRIER_SQL, _ORDERS_SQL, _POS_SQL, BALANCE, barrier, instrument_table,
                                           positions, trades)
from sessionbars.plans.q_sources import _ohlcv_sql
from sessionbars.plans.registry import register
from sessionbars.plans.sqlparts import normalized_select, with_ctes
from sessionbars.session import scratch_path
from sessionbars.streaming import jobs


def event_tick_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # a file source needs a directory or a glob: the glob names the one table file
    ev = jobs.tick_stream(spark, f"{sf_dir.rstrip('/')}/event[s].parquet", schema)
    px = F.col("value").cast("double")
    return ev.select(F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("id"),
                     px.alias("open"), px.alias("high"), px.alias("low"), px.alias("close"),
                     F.lit(1).cast("long").alias("volume"))


@register("stream_bars", _ohlcv_sql("1 minute"))
def q_stream_bars(spark, sf_dir):
    """Streaming M1 bars equal the batch resample (ohlcv_m1)."""
    out, ck = scratch_path(spark, "stream-bars"), scratch_path(spark, "stream-bars-ckpt")
    jobs.run_upsert_log(jobs.stream_bars(event_tick_stream(spark, sf_dir)), out, ck)
    return jobs.read_latest(spark, out, ["symbol", "ts"])


@register("stream_daily_summary", with_ctes(*_BARRIER_SQL, """sds AS (
  SELECT symbol, date_trunc('day', exit_ts - INTERVAL 1 MINUTE) + INTERVAL 1 MINUTE AS day_start,
         count(*) AS trades, count(*) FILTER (WHERE profit > 0) AS wins,
         count(*) FILTER (WHERE NOT (profit > 0) OR profit IS NULL) AS losses,
         coalesce(sum(profit), 0.0) AS pnl,
         count(*) FILTER (WHERE profit > 0) / greatest(count(*), 1) * 100 AS win_rate
  FROM bx2 GROUP BY 1, 2)""") + "\n" + normalized_select(
    [("symbol", "s"), ("day_start", "t"), ("trades", "i"), ("wins", "i"), ("losses", "i"), ("pnl", "d"),
     ("win_rate", "d")], "sds"))
def q_stream_daily_summary(spark, sf_dir):
    """Closed trades streamed into days that start at 00:01."""
    closed_path = scratch_path(spark, "closed-trades")
    b = barrier(spark, sf_dir)
    b.select("symbol", "exit_ts", "profit").write.mode("overwrite").parquet(closed_path)
    schema = spark.read.parquet(closed_path).schema
    stream = jobs.tick_stream(spark, closed_path, schema)
    out, ck = scratch_path(spark, "stream-daily"), scratch_path(spark, "stream-daily-ckpt")
    jobs.run_upsert_log(jobs.stream_daily_summary(stream), out, ck)
    return jobs.read_latest(spark, out, ["symbol", "day_start"])


# the batch twin scores every day with an entry bar: the exit bar is not known at entry
_STREAM_ORDERS_SQL = [c.replace("JOIN ext x", "LEFT JOIN ext x").replace(" AND target IS NOT NULL", "")
                      for c in _ORDERS_SQL] + ["""so AS (
  SELECT *, CASE WHEN volume IS NULL THEN 'invalid volume' WHEN NOT success THEN 'insufficient margin' END AS error
  FROM ord)"""]


@register("stream_signals", with_ctes(*_STREAM_ORDERS_SQL) + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("direction", "s"), ("confidence", "d"), ("volume", "d"),
     ("entry_price", "d"), ("stop_loss", "d"), ("take_profit", "d"), ("success", "s"), ("error", "s")], "so"))
def q_stream_signals(spark, sf_dir):
    """The orders of every (symbol, date), each from the 1,440 bars up to its entry bar."""
    cfg = instrument_table(spark, sf_dir)
    bars, out, ck = (scratch_path(spark, "sig-bars"), scratch_path(spark, "sig-out"),
                     scratch_path(spark, "sig-ckpt"))
    jobs.stream_signals(spark, event_tick_stream(spark, sf_dir), cfg, bars, out, ck, 100_000.0)
    return jobs.read_signals(spark, out)


@register("stream_mtm", with_ctes(*_POS_SQL, """sm AS (
  SELECT p.symbol, q.ts, q.id, p.open_time, p.type,
         CASE WHEN p.type = 'LONG' THEN q.bid ELSE q.ask END AS current_price,
         CASE WHEN p.type = 'LONG' THEN q.bid - p.open_price ELSE p.open_price - q.ask END * 5.0 * p.volume AS profit
  FROM pos p JOIN q ON p.symbol = q.symbol AND q.ts BETWEEN p.open_time AND p.mark_ts)""") + "\n" + normalized_select(
    [("symbol", "s"), ("ts", "t"), ("id", "i"), ("open_time", "t"), ("type", "s"), ("current_price", "d"),
     ("profit", "d")], "sm"))
def q_stream_mtm(spark, sf_dir):
    """Quotes stream joined to the static book of positions."""
    quotes = ex.quotes_from_mid(event_tick_stream(spark, sf_dir), "close", 2.0)
    book, out, ck = (scratch_path(spark, n) for n in ("mtm-book", "mtm", "mtm-ckpt"))
    positions(spark, sf_dir).write.mode("overwrite").parquet(book)
    pos = spark.read.parquet(book)
    jobs.run_upsert_log(jobs.stream_mark_to_market(quotes, pos), out, ck, mode="append")
    return spark.read.parquet(out).drop("batch_id")


@register("stream_positions", with_ctes(*_BARRIER_SQL) + "\n" + normalized_select(_BARRIER_KINDS, "bx2"))
def q_stream_positions(spark, sf_dir):
    """Exits of open positions over a tick stream; equals barrier_exit."""
    names = ("pos-trades", "pos-ticks", "pos-out", "pos-ckpt")
    src, ticks, out, ck = (scratch_path(spark, n) for n in names)
    trades(spark, sf_dir).write.mode("overwrite").parquet(src)
    jobs.stream_positions(spark, event_tick_stream(spark, sf_dir), spark.read.parquet(src), ticks, out, ck)
    b = jobs.read_latest(spark, out, ["symbol", "entry_ts"]).withColumnRenamed("entry_ts", "open_time")
    return b.select(*[c for c, _ in _BARRIER_KINDS])


# a minute is out once the watermark, 5 minutes behind the newest quote, passes its end
_ACCOUNT_SQL = [*_POSITIONS, _POS_SQL[len(_ORDERS_SQL) + 1], """lm AS (
  SELECT p.symbol, p.open_time, p.volume, p.open_price, time_bucket(INTERVAL '1 minute', q.ts) AS ts,
         last(CASE WHEN p.type = 'LONG' THEN q.bid - p.open_price ELSE p.open_price - q.ask END * 5.0 * p.volume
              ORDER BY q.ts, q.id) AS profit
  FROM pos p JOIN q ON p.symbol = q.symbol AND q.ts BETWEEN p.open_time AND p.mark_ts GROUP BY ALL)""", """sa AS (
  SELECT symbol, ts, coalesce(sum(profit), 0.0) AS profit, sum(volume * open_price * 0.2) AS margin, count(*) AS open_positions,
         100000.0 + coalesce(sum(profit), 0.0) AS equity,
         100000.0 + coalesce(sum(profit), 0.0) - sum(volume * open_price * 0.2) AS free_margin
  FROM lm WHERE ts + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM q) - INTERVAL 5 MINUTE GROUP BY symbol, ts)"""]
_ACCOUNT_KINDS = [("symbol", "s"), ("ts", "t"), ("profit", "d"), ("margin", "d"), ("open_positions", "i"), ("equity", "d"),
                  ("free_margin", "d")]


@register("stream_account", with_ctes(*_ACCOUNT_SQL) + "\n" + normalized_select(_ACCOUNT_KINDS, "sa"))
def q_stream_account(spark, sf_dir):
    """A09 on R05: every desk's account by the minute, as far as the watermark has closed."""
    quotes = ex.quotes_from_mid(desk_bars(spark, sf_dir, event_tick_stream(spark, sf_dir)), "close", 2.0)
    book, out, ck = (scratch_path(spark, n) for n in ("account-book", "account", "account-ckpt"))
    desk_positions(spark, sf_dir).write.mode("overwrite").parquet(book)
    jobs.run_upsert_log(jobs.stream_account(quotes, spark.read.parquet(book), BALANCE), out, ck, mode="append")
    return spark.read.parquet(out).select(*[c for c, _ in _ACCOUNT_KINDS])


@register("stream_exits", with_ctes(*_EXITS, """se AS (
  SELECT * FROM bx2 JOIN (SELECT symbol, open_time, session_end FROM pos) USING (symbol, open_time)
  WHERE session_end <= least((SELECT max(ts) FROM bars), (SELECT max(session_end) FROM pos)) - INTERVAL 7 HOUR)""") + "\n" +
          normalized_select(_BARRIER_KINDS, "se"))
def q_stream_exits(spark, sf_dir):
    """R03 as an interval join of the desks' trades and ticks, up to the watermark
    (1 hour behind) less the longest session (6 hours)."""
    src, out, ck = (scratch_path(spark, n) for n in ("exit-trades", "exits", "exits-ckpt"))
    t = desk_positions(spark, sf_dir).withColumnsRenamed({"open_time": "entry_ts", "type": "position_type", "open_price": "entry_price"}).drop("mark_ts")
    t.write.mode("overwrite").parquet(src)
    stream = jobs.stream_exits(desk_bars(spark, sf_dir, event_tick_stream(spark, sf_dir)), jobs.tick_stream(spark, src, t.schema), longest="6 hours")
    jobs.run_upsert_log(stream, out, ck, mode="append")
    return spark.read.parquet(out).withColumnRenamed("entry_ts", "open_time").select(*[c for c, _ in _BARRIER_KINDS])
