"""The order chain on instruments that differ.

A desk trades one event type on one zone's clock: three desks an event type,
each with its own zone, trading hours, confidence, stop, target and limits,
read from config files.  One of them opens before midnight UTC and closes
after it.  Signals are hourly bars with the MACD as rule prediction, so most
desks have a bar in their session's first minute on every weekday.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionbars.operators import execution as ex
from sessionbars.operators import filters
from sessionbars.operators.indicators import with_indicators
from sessionbars.plans.adapters import event_bars, table
from sessionbars.plans.q_execution import _BARRIER_KINDS, _BARRIER_SQL, _ORDER_KINDS, _ORDERS_SQL, _POS_SQL, _TRACK_KINDS, BALANCE, SPREAD
from sessionbars.plans.registry import register
from sessionbars.plans.sqlparts import indicator_ctes, normalized_select, with_ctes
from sessionbars.session import scratch_path
from sessionbars.sources import instruments
from sessionbars.sources.bars import resample_bars

#: zone, start, end, min_confidence, stop_loss_pct, take_profit_pct, max_positions, risk_per_trade
DESKS = [
    ("America/New_York", "18:00", "22:00", 0.1, 2.0, 3.0, 1, 1.0),
    ("Asia/Tokyo", "12:00", "15:00", 0.5, 20.0, 40.0, 2, 0.5),
    ("UTC", "09:00", "13:30", 0.3, 90.0, 400.0, 1, 2.0),
]


def desk_bars(spark, sf_dir, ticks=None):
    zones = F.explode(F.array(*[F.lit(d[0]) for d in DESKS]))
    b = (event_bars(spark, sf_dir) if ticks is None else ticks).withColumn("_z", zones)
    return b.withColumn("symbol", F.concat_ws("/", "symbol", "_z")).drop("_z")


def desk_configs(spark, sf_dir):
    """One config file line per desk, read back with the defaults under it."""
    kinds = "zone string, start string, end string, min_confidence double, stop_loss_pct double, take_profit_pct double, max_positions int, risk_per_trade double"
    desks = F.explode(F.array(*[F.struct(*[F.lit(v).alias(c.split()[0]) for v, c in zip(d, kinds.split(", "))]) for d in DESKS]))
    types = table(spark, sf_dir, "events").select("event_type").distinct().withColumn("d", desks)
    cfg = types.select(F.concat_ws("/", "event_type", "d.zone").alias("symbol"), F.col("d.zone").alias("timezone"),
                       F.struct(F.col("d.start").alias("start"), F.col("d.end").alias("end")).alias("trading_hours"),
                       *[f"d.{c}" for c in ("min_confidence", "stop_loss_pct", "take_profit_pct", "max_positions", "risk_per_trade")])
    path = scratch_path(spark, "desks")
    instruments.write_instruments(cfg, path)
    return instruments.load_instruments(spark, path, multiline=False)


def desk_orders(spark, sf_dir):
    ticks, cfg = desk_bars(spark, sf_dir), desk_configs(spark, sf_dir)
    hours = with_indicators(resample_bars(ticks, "H1"), sma=(), rsi=None)
    sig = ex.quotes_from_mid(hours, "close", SPREAD).select("symbol", F.col("ts").alias("datetime"), F.col("macd").alias("prediction"), "bid", "ask")
    sig = filters.with_history(filters.local_time(sig, cfg), ticks)
    return ex.order_signals(sig, cfg, BALANCE)


_ROWS = ", ".join(f"('{z}', TIME '{a}:00', TIME '{b}:00', {c}, {sl}, {tp}, {n}, {r})" for z, a, b, c, sl, tp, n, r in DESKS)
_ORDERS = [f"""desks(zone, hours_start, hours_end, min_confidence, stop_loss_pct, take_profit_pct, max_positions, risk_per_trade) AS (
  VALUES {_ROWS})""", """bars AS (
  SELECT event_type || '/' || zone AS symbol, ts, event_id AS id, value AS open, value AS high, value AS low,
         value AS close, CAST(1 AS BIGINT) AS volume, zone FROM events, desks)""", """hb AS (
  SELECT symbol, time_bucket(INTERVAL '1 hour', ts) AS ts, min(id) AS id, first(open ORDER BY ts, id) AS open,
         max(high) AS high, min(low) AS low, last(close ORDER BY ts, id) AS close, sum(volume) AS volume
  FROM bars GROUP BY 1, 2)""", indicator_ctes("hb", "TRUE", ""), """sig AS (
  SELECT i.symbol, i.ts AS datetime, i.macd AS prediction, round(i.close - 1.0, 2) AS bid, round(i.close + 1.0, 2) AS ask,
         CASE WHEN i.macd > 0 THEN 'BUY' ELSE 'SELL' END AS direction, least(abs(i.macd) / 0.5, 1.0) AS confidence,
         timezone(d.zone, i.ts AT TIME ZONE 'UTC') AS local_ts, d.*, 5 AS max_daily_trades, 1.0 AS max_volume
  FROM ind i JOIN desks d ON string_split(i.symbol, '/')[2:] = string_split(d.zone, '/'))""", """g AS (
  SELECT * FROM sig WHERE isodow(local_ts) <= 5 AND hour(local_ts) = hour(hours_start) AND minute(local_ts) = minute(hours_start)
    AND CAST(local_ts AS TIME) BETWEEN hours_start AND hours_end AND confidence >= min_confidence
    AND (SELECT count(*) FROM bars b WHERE b.symbol = sig.symbol AND b.ts <= sig.datetime) >= 100)""", """g2 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, CAST(local_ts AS DATE) ORDER BY datetime) AS order_of_day FROM g)
  WHERE order_of_day <= least(max_positions, max_daily_trades))""", "g3 AS (" + _ORDERS_SQL[-1].split("g3 AS (", 1)[1]]
_POSITIONS = [*_ORDERS, """pos AS (
  SELECT symbol, datetime AS open_time, position_type AS type, volume, entry_price AS open_price, stop_loss, take_profit,
         datetime + INTERVAL 3 HOUR AS mark_ts, datetime + ((CAST(local_ts AS DATE) + hours_end) - local_ts) AS session_end
  FROM ord WHERE success)"""]
_MARKED = [*_POSITIONS, *_POS_SQL[len(_ORDERS_SQL) + 1 :]]
_EXITS = [*_POSITIONS, """bj AS (
  SELECT p.*, b.ts AS bts, b.id AS bid_, b.close,
    CASE WHEN type = 'LONG' THEN b.low <= p.stop_loss ELSE b.high >= p.stop_loss END AS sl_hit,
    CASE WHEN type = 'LONG' THEN b.high >= p.take_profit ELSE b.low <= p.take_profit END AS tp_hit
  FROM pos p JOIN bars b ON p.symbol = b.symbol AND b.ts > p.open_time AND b.ts <= p.session_end)""", *_BARRIER_SQL[len(_POS_SQL) + 2 :]]
_LISTED = "bo AS (SELECT symbol, open_time FROM bx2 WHERE exit_ts > open_time + INTERVAL 1 HOUR)"


def desk_positions(spark, sf_dir):
    o = desk_orders(spark, sf_dir).filter(F.col("success"))
    return o.select("symbol", F.col("datetime").alias("open_time"), F.col("position_type").alias("type"), "volume",
                    F.col("entry_price").alias("open_price"), "stop_loss", "take_profit",
                    (F.col("datetime") + F.expr("INTERVAL 3 HOURS")).alias("mark_ts"), "session_end")


def desk_exits(spark, sf_dir):
    p = desk_positions(spark, sf_dir)
    t = p.withColumnsRenamed({"open_time": "entry_ts", "type": "position_type", "open_price": "entry_price"})
    return ex.barrier_exit(t.drop("mark_ts"), desk_bars(spark, sf_dir), hours=(0, 23), until="session_end")


def desk_marks(spark, sf_dir):
    quotes = ex.quotes_from_mid(desk_bars(spark, sf_dir), "close", SPREAD)
    return ex.mark_to_market(desk_positions(spark, sf_dir), quotes)


def _listed(exits):
    return exits.filter(F.col("exit_ts") > F.col("entry_ts") + F.expr("INTERVAL 1 HOUR")).select("symbol", F.col("entry_ts").alias("open_time"))


@register("order_signals_desks", with_ctes(*_ORDERS) + "\n" + normalized_select(_ORDER_KINDS + [("local_ts", "t")], "ord"))
def q_order_signals_desks(spark, sf_dir):
    """X14 with S10's files: each desk's own zone, hours and risk decide its orders."""
    return desk_orders(spark, sf_dir).select(*[c for c, _ in _ORDER_KINDS], "local_ts")


@register("mark_to_market_desks", with_ctes(*_MARKED) + "\n" + normalized_select(
    [("symbol", "s"), ("open_time", "t"), ("type", "s"), ("mark_ts", "t"), ("q_asof_ts", "t"), ("current_price", "d"), ("profit_points", "d"), ("profit", "d")], "mk"))
def q_mark_to_market_desks(spark, sf_dir):
    """J06 over the desks' positions."""
    return desk_marks(spark, sf_dir).select("symbol", "open_time", "type", "mark_ts", "q_asof_ts", "current_price", "profit_points", "profit")


@register("account_summary_desks", with_ctes(*_MARKED, """acc AS (
  SELECT symbol, coalesce(sum(profit), 0.0) AS profit, sum(volume * open_price * 0.2) AS margin, count(*) AS open_positions,
         100000.0 + coalesce(sum(profit), 0.0) AS equity, 100000.0 + coalesce(sum(profit), 0.0) - sum(volume * open_price * 0.2) AS free_margin
  FROM mk GROUP BY symbol)""") + "\n" + normalized_select(
    [("symbol", "s"), ("profit", "d"), ("margin", "d"), ("open_positions", "i"), ("equity", "d"), ("free_margin", "d")], "acc"))
def q_account_summary_desks(spark, sf_dir):
    """A09, one account a desk."""
    return ex.account_summary(desk_marks(spark, sf_dir), BALANCE).select("symbol", "profit", "margin", "open_positions", "equity", "free_margin")


@register("barrier_exit_desks", with_ctes(*_EXITS) + "\n" + normalized_select(_BARRIER_KINDS, "bx2"))
def q_barrier_exit_desks(spark, sf_dir):
    """J07 up to each desk's session end, past midnight where the session is."""
    return desk_exits(spark, sf_dir).withColumnRenamed("entry_ts", "open_time").select(*[c for c, _ in _BARRIER_KINDS])


@register("closed_positions_desks", with_ctes(*_EXITS, _LISTED, "cp AS (SELECT pos.*, 'loss' AS booked_as FROM pos ANTI JOIN bo USING (symbol, open_time))") + "\n" +
          normalized_select(_TRACK_KINDS + [("booked_as", "s")], "cp"))
def q_closed_positions_desks(spark, sf_dir):
    """J04 one hour after entry."""
    gone = ex.closed_positions(desk_positions(spark, sf_dir), _listed(desk_exits(spark, sf_dir)), ["symbol", "open_time"])
    return gone.select(*[c for c, _ in _TRACK_KINDS], "booked_as")


@register("open_positions_desks", with_ctes(*_EXITS, _LISTED, "op AS (SELECT pos.* FROM pos SEMI JOIN bo USING (symbol, open_time))") + "\n" + normalized_select(_TRACK_KINDS, "op"))
def q_open_positions_desks(spark, sf_dir):
    """J05 one hour after entry."""
    held = ex.open_positions(desk_positions(spark, sf_dir), _listed(desk_exits(spark, sf_dir)), ["symbol", "open_time"])
    return held.select(*[c for c, _ in _TRACK_KINDS])


@register("daily_trading_summary_desks", with_ctes(*_EXITS, """dts AS (
  SELECT symbol, CAST(exit_ts AS DATE) AS date, count(*) AS trades, count(*) FILTER (WHERE profit > 0) AS wins,
         count(*) FILTER (WHERE NOT (profit > 0) OR profit IS NULL) AS losses, coalesce(sum(profit), 0.0) AS pnl,
         count(*) FILTER (WHERE profit > 0) / greatest(count(*), 1) * 100 AS win_rate
  FROM bx2 GROUP BY 1, 2)""") + "\n" + normalized_select(
    [("symbol", "s"), ("date", "t"), ("trades", "i"), ("wins", "i"), ("losses", "i"), ("pnl", "d"), ("win_rate", "d")], "dts"))
def q_daily_trading_summary_desks(spark, sf_dir):
    """A10 over the desks' closed trades."""
    return ex.daily_trading_summary(desk_exits(spark, sf_dir))
