"""Driver queries for the live-trading arithmetic (P01-P17, J04-J08, A09, A10,
W12, X12, X14).  Signals are the session feature rows with a rule
prediction (MACD at entry); quotes are the event prices with a 2-point
spread; instrument configs are derived from the events (see q_sources)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionbars.operators import execution as ex
from sessionbars.operators import filters
from sessionbars.operators.asof import asof_join
from sessionbars.plans.adapters import event_bars, table
from sessionbars.plans.q_backtest import _EV_FEAT, session_feature_rows
from sessionbars.plans.q_sessions import session_bars
from sessionbars.plans.q_sources import CFG_SQL_CTE, instrument_table
from sessionbars.plans.registry import register
from sessionbars.plans.sqlparts import EVENT_BARS, normalized_select, with_ctes

BALANCE = 100_000.0
SPREAD = 2.0


def signal_rows(spark, sf_dir):
    f = session_feature_rows(spark, sf_dir)
    f = ex.quotes_from_mid(f, "day_close_current", SPREAD)
    return f.withColumn("local_ts", F.col("datetime"))  # derived configs trade in UTC


_SIG_SQL = _EV_FEAT + ["""sig AS (
  SELECT *, round(day_close_current - 1.0, 2) AS bid, round(day_close_current + 1.0, 2) AS ask,
         CASE WHEN prediction > 0 THEN 'BUY' ELSE 'SELL' END AS direction,
         least(abs(prediction) / 0.5, 1.0) AS confidence
  FROM src)"""]


@register("quotes_from_mid", with_ctes(EVENT_BARS, """q AS (
  SELECT symbol, ts, id, round(close - 1.0, 2) AS bid, round(close + 1.0, 2) AS ask,
         round(close + 1.0, 2) - round(close - 1.0, 2) AS spread FROM bars)""") + "\n" +
          normalized_select([("symbol", "s"), ("ts", "t"), ("id", "i"), ("bid", "d"), ("ask", "d"),
                             ("spread", "d")], "q"))
def q_quotes_from_mid(spark, sf_dir):
    """bid/ask around the tick price."""
    return ex.quotes_from_mid(event_bars(spark, sf_dir), "close", SPREAD).select(
        "symbol", "ts", "id", "bid", "ask", "spread")


@register("confidence_gate", with_ctes(*_SIG_SQL) + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("direction", "s"), ("confidence", "d"), ("tradable", "s")],
    "(SELECT *, confidence >= 0.5 AS tradable FROM sig)"))
def q_confidence_gate(spark, sf_dir):
    """P14."""
    return ex.confidence_gate(signal_rows(spark, sf_dir)).select(
        "symbol", "datetime", "direction", "confidence", "tradable")


_LEVELS = """lv AS (
  SELECT *, CASE WHEN direction = 'BUY' THEN ask ELSE bid END AS entry_price FROM sig),
lv2 AS (
  SELECT *, CASE WHEN direction = 'BUY' THEN entry_price * (1 - 2.0 / 100) ELSE entry_price * (1 + 2.0 / 100) END
              AS stop_loss,
            CASE WHEN direction = 'BUY' THEN entry_price * (1 + 3.0 / 100) ELSE entry_price * (1 - 3.0 / 100) END
              AS take_profit
  FROM lv)"""


@register("sl_tp_levels", with_ctes(*_SIG_SQL, _LEVELS) + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("direction", "s"), ("entry_price", "d"), ("stop_loss", "d"),
     ("take_profit", "d")], "lv2"))
def q_sl_tp_levels(spark, sf_dir):
    """P15 with the default 2 % stop and 3 % target."""
    s = ex.confidence_gate(signal_rows(spark, sf_dir))
    return ex.sl_tp_levels(s).select("symbol", "datetime", "direction", "entry_price", "stop_loss", "take_profit")


@register("position_size", with_ctes(*_SIG_SQL, """ps AS (
  SELECT *, 1000.0 * (1.0 / 100) AS risk_amount,
         least(round_even(greatest(1000.0 * (1.0 / 100) / nullif(ask * (2.0 / 100) * 5.0, 0), 0.1), 1), 1.0) AS volume
  FROM sig)""") + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("ask", "d"), ("risk_amount", "d"), ("volume", "d")], "ps"))
def q_position_size(spark, sf_dir):
    """P16 for a 1,000 account (so the 0.1 floor, the rounding and the 1.0
    cap all occur at event prices)."""
    return ex.position_size(signal_rows(spark, sf_dir), 1000.0).select(
        "symbol", "datetime", "ask", "risk_amount", "volume")


@register("margin_check", with_ctes(*_SIG_SQL, _LEVELS, """mc AS (
  SELECT *, least(round_even(greatest(1000.0 * (1.0 / 100) / nullif(ask * (2.0 / 100) * 5.0, 0), 0.1), 1), 1.0)
              AS volume FROM lv2),
mc2 AS (
  SELECT *, volume * entry_price * 0.2 AS required_margin,
         NOT (volume * entry_price * 0.2 > 50.0) AS success,
         CASE WHEN volume * entry_price * 0.2 > 50.0 THEN 'insufficient margin' END AS error,
         CASE WHEN direction = 'BUY' THEN 'LONG' ELSE 'SHORT' END AS position_type
  FROM mc)""") + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("volume", "d"), ("required_margin", "d"), ("success", "s"),
     ("error", "s"), ("position_type", "s")], "mc2"))
def q_margin_check(spark, sf_dir):
    """Orders sized for a 1,000 account, margin checked against 50."""
    s = ex.sl_tp_levels(ex.confidence_gate(signal_rows(spark, sf_dir)))
    s = ex.position_size(s, 1000.0)
    return ex.margin_check(s, 50.0).select("symbol", "datetime", "volume", "required_margin", "success",
                                           "error", "position_type")


_ORDERS_SQL = _SIG_SQL + [CFG_SQL_CTE, """known AS (
  SELECT s.symbol, s.datetime, count(b.ts) AS history
  FROM (SELECT DISTINCT symbol, datetime FROM sig) s JOIN bars b ON s.symbol = b.symbol AND b.ts <= s.datetime
  GROUP BY ALL),
g AS (
  SELECT s.*, c.min_confidence, c.max_positions, c.max_daily_trades, c.stop_loss_pct, c.take_profit_pct,
         c.risk_per_trade, c.max_volume
  FROM sig s LEFT JOIN cfg c ON s.symbol = c.symbol
       JOIN known k ON s.symbol = k.symbol AND s.datetime = k.datetime
  WHERE hour(s.datetime) = 20 AND minute(s.datetime) = 0 AND k.history >= 100 AND isodow(s.datetime) <= 5 AND CAST(s.datetime AS TIME) BETWEEN TIME '20:00:00' AND TIME '23:00:00'
    AND s.confidence >= c.min_confidence),
g2 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, CAST(datetime AS DATE) ORDER BY datetime)
                   AS order_of_day FROM g)
  WHERE order_of_day <= least(max_positions, max_daily_trades)),
g3 AS (
  SELECT *, least(round_even(greatest(100000.0 * (risk_per_trade / 100) / nullif(ask * (stop_loss_pct / 100) * 5.0, 0),
                                      0.1), 1), max_volume) AS volume,
         CASE WHEN direction = 'BUY' THEN ask ELSE bid END AS entry_price
  FROM g2),
ord AS (
  SELECT *, CASE WHEN direction = 'BUY' THEN entry_price * (1 - stop_loss_pct / 100)
                 ELSE entry_price * (1 + stop_loss_pct / 100) END AS stop_loss,
            CASE WHEN direction = 'BUY' THEN entry_price * (1 + take_profit_pct / 100)
                 ELSE entry_price * (1 - take_profit_pct / 100) END AS take_profit,
            NOT (volume * entry_price * 0.2 > 100000.0) AS success,
            CASE WHEN direction = 'BUY' THEN 'LONG' ELSE 'SHORT' END AS position_type
  FROM g3)"""]

_ORDER_KINDS = [("symbol", "s"), ("datetime", "t"), ("direction", "s"), ("confidence", "d"), ("volume", "d"),
                ("entry_price", "d"), ("stop_loss", "d"), ("take_profit", "d"), ("success", "s"),
                ("position_type", "s")]


def orders(spark, sf_dir):
    sig = filters.with_history(signal_rows(spark, sf_dir), event_bars(spark, sf_dir))
    return ex.order_signals(sig, instrument_table(spark, sf_dir), BALANCE)


@register("order_signals", with_ctes(*_ORDERS_SQL) + "\n" + normalized_select(_ORDER_KINDS, "ord"))
def q_order_signals(spark, sf_dir):
    """Gates, limits, sizing, levels and margin for every signal row."""
    return orders(spark, sf_dir).select(*[c for c, _ in _ORDER_KINDS])


def positions(spark, sf_dir):
    o = orders(spark, sf_dir).filter(F.col("success"))
    return o.select("symbol", F.col("datetime").alias("open_time"), F.col("position_type").alias("type"),
                    "volume", F.col("entry_price").alias("open_price"), "stop_loss", "take_profit",
                    (F.col("datetime") + F.expr("INTERVAL 3 HOURS")).alias("mark_ts"), "session_end")


_POS_SQL = _ORDERS_SQL + ["""pos AS (
  SELECT symbol, datetime AS open_time, position_type AS type, volume, entry_price AS open_price, stop_loss,
         take_profit, datetime + INTERVAL 3 HOUR AS mark_ts,
         CAST(CAST(datetime AS DATE) AS TIMESTAMP) + INTERVAL 23 HOUR AS session_end FROM ord WHERE success)""",
                          """q AS (SELECT symbol, ts, id, round(close - 1.0, 2) AS bid, round(close + 1.0, 2) AS ask
                                   FROM bars)""",
                          """m AS (
  SELECT p.*, q.bid AS q_bid, q.ask AS q_ask, q.ts AS q_asof_ts
  FROM pos p ASOF LEFT JOIN q ON p.symbol = q.symbol AND p.mark_ts >= q.ts)""",
                          """mk AS (
  SELECT *, CASE WHEN type = 'LONG' THEN q_bid ELSE q_ask END AS current_price,
         CASE WHEN type = 'LONG' THEN q_bid - open_price ELSE open_price - q_ask END AS profit_points,
         CASE WHEN type = 'LONG' THEN q_bid - open_price ELSE open_price - q_ask END * 5.0 * volume AS profit
  FROM m)"""]


def marked(spark, sf_dir):
    quotes = ex.quotes_from_mid(event_bars(spark, sf_dir), "close", SPREAD)
    return ex.mark_to_market(positions(spark, sf_dir), quotes)


@register("mark_to_market", with_ctes(*_POS_SQL) + "\n" + normalized_select(
    [("symbol", "s"), ("open_time", "t"), ("type", "s"), ("mark_ts", "t"), ("q_asof_ts", "t"),
     ("current_price", "d"), ("profit_points", "d"), ("profit", "d")], "mk"))
def q_mark_to_market(spark, sf_dir):
    """Positions priced 3 hours after entry at the latest quote."""
    return marked(spark, sf_dir).select("symbol", "open_time", "type", "mark_ts", "q_asof_ts",
                                        "current_price", "profit_points", "profit")


@register("asof_last_view", """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view'),
a AS (SELECT p.event_id, p.user_id, p.ts, v.value AS v_value, v.ts AS v_asof_ts
      FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts)
""" + normalized_select([("event_id", "i"), ("user_id", "i"), ("ts", "t"), ("v_value", "d"),
                         ("v_asof_ts", "t")], "a"))
def q_asof_last_view(spark, sf_dir):
    """J06 primitive on many keys: each purchase gets the user's latest view."""
    ev = table(spark, sf_dir, "events")
    p = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = ev.filter(F.col("event_type") == "view").select("user_id", "ts", "value", "event_id")
    return asof_join(p, v, "user_id", "ts", "ts", ["value"], right_tie="event_id", prefix="v_")


@register("account_summary", with_ctes(*_POS_SQL, """acc AS (
  SELECT symbol, coalesce(sum(profit), 0.0) AS profit, sum(volume * open_price * 0.2) AS margin,
         count(*) AS open_positions, 100000.0 AS balance, 100000.0 + coalesce(sum(profit), 0.0) AS equity,
         100000.0 + coalesce(sum(profit), 0.0) - sum(volume * open_price * 0.2) AS free_margin,
         5 AS leverage, 'USD' AS currency
  FROM mk GROUP BY symbol)""") + "\n" + normalized_select(
    [("symbol", "s"), ("profit", "d"), ("margin", "d"), ("open_positions", "i"), ("balance", "d"),
     ("equity", "d"), ("free_margin", "d"), ("leverage", "i"), ("currency", "s")], "acc"))
def q_account_summary(spark, sf_dir):
    """A09 over the marked positions (one account per instrument)."""
    return ex.account_summary(marked(spark, sf_dir), BALANCE)


_BARRIER_SQL = _POS_SQL + ["""bb AS (
  SELECT symbol, ts, id, high, low, close FROM bars WHERE hour(ts) BETWEEN 20 AND 23)""", """bj AS (
  SELECT p.*, b.ts AS bts, b.id AS bid_, b.close,
    CASE WHEN type = 'LONG' THEN b.low <= p.stop_loss ELSE b.high >= p.stop_loss END AS sl_hit,
    CASE WHEN type = 'LONG' THEN b.high >= p.take_profit ELSE b.low <= p.take_profit END AS tp_hit
  FROM pos p JOIN bb b ON p.symbol = b.symbol AND CAST(p.open_time AS DATE) = CAST(b.ts AS DATE)
  WHERE b.ts > p.open_time AND b.ts <= p.session_end)""", """hit AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY bts, bid_) AS rn
                 FROM bj WHERE sl_hit OR tp_hit) WHERE rn = 1)""", """lst AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY bts DESC, bid_ DESC) AS rn
                 FROM bj) WHERE rn = 1)""", """bx AS (
  SELECT p.symbol, p.open_time, p.type, p.volume, p.open_price,
         coalesce(h.bts, l.bts, p.open_time) AS exit_ts,
         CASE WHEN h.sl_hit THEN 'SL' WHEN h.tp_hit THEN 'TP' WHEN l.bts IS NULL THEN 'NO_BAR' ELSE 'SESSION_END' END AS exit_reason,
         CASE WHEN h.sl_hit THEN h.stop_loss WHEN h.tp_hit THEN h.take_profit ELSE coalesce(l.close, p.open_price) END AS exit_price
  FROM pos p LEFT JOIN lst l ON p.symbol = l.symbol AND p.open_time = l.open_time
             LEFT JOIN hit h ON p.symbol = h.symbol AND p.open_time = h.open_time)""", """bx2 AS (
  SELECT *, CASE WHEN type = 'LONG' THEN exit_price - open_price ELSE open_price - exit_price END * 5.0 * volume
              AS profit FROM bx)"""]


def trades(spark, sf_dir):
    return positions(spark, sf_dir).select(
        "symbol", F.col("open_time").alias("entry_ts"), F.col("type").alias("position_type"), "volume",
        F.col("open_price").alias("entry_price"), "stop_loss", "take_profit", "session_end")


def barrier(spark, sf_dir):
    return ex.barrier_exit(trades(spark, sf_dir), event_bars(spark, sf_dir), until="session_end")


_BARRIER_KINDS = [("symbol", "s"), ("open_time", "t"), ("exit_ts", "t"), ("exit_reason", "s"),
                  ("exit_price", "d"), ("profit", "d")]


@register("barrier_exit", with_ctes(*_BARRIER_SQL) + "\n" + normalized_select(_BARRIER_KINDS, "bx2"))
def q_barrier_exit(spark, sf_dir):
    """First stop / target touch after entry, else the session-end close."""
    b = barrier(spark, sf_dir)
    return b.select("symbol", F.col("entry_ts").alias("open_time"), "exit_ts", "exit_reason", "exit_price", "profit")


def _broker_open(b):
    return b.filter(F.col("exit_ts") > F.col("entry_ts") + F.expr("INTERVAL 1 HOUR")).select(
        "symbol", F.col("entry_ts").alias("open_time"))


_TRACK_KINDS = [("symbol", "s"), ("open_time", "t"), ("type", "s"), ("volume", "d"), ("open_price", "d")]


@register("closed_positions", with_ctes(*_BARRIER_SQL, """bo AS (
  SELECT symbol, open_time FROM bx2 WHERE exit_ts > open_time + INTERVAL 1 HOUR),
cp AS (SELECT p.*, 'loss' AS booked_as FROM pos p
       WHERE NOT EXISTS (SELECT 1 FROM bo WHERE bo.symbol = p.symbol AND bo.open_time = p.open_time))""") + "\n" +
          normalized_select(_TRACK_KINDS + [("booked_as", "s")], "cp"))
def q_closed_positions(spark, sf_dir):
    """Positions the broker no longer lists one hour after entry."""
    b = barrier(spark, sf_dir)
    tracked = positions(spark, sf_dir)
    return ex.closed_positions(tracked, _broker_open(b), ["symbol", "open_time"]).select(
        *[c for c, _ in _TRACK_KINDS], "booked_as")


@register("open_positions", with_ctes(*_BARRIER_SQL, """bo AS (
  SELECT symbol, open_time FROM bx2 WHERE exit_ts > open_time + INTERVAL 1 HOUR),
op AS (SELECT p.* FROM pos p
       WHERE EXISTS (SELECT 1 FROM bo WHERE bo.symbol = p.symbol AND bo.open_time = p.open_time))""") + "\n" +
          normalized_select(_TRACK_KINDS, "op"))
def q_open_positions(spark, sf_dir):
    """Positions still listed one hour after entry."""
    b = barrier(spark, sf_dir)
    tracked = positions(spark, sf_dir)
    return ex.open_positions(tracked, _broker_open(b), ["symbol", "open_time"]).select(*[c for c, _ in _TRACK_KINDS])


@register("daily_trading_summary", with_ctes(*_BARRIER_SQL, """dts AS (
  SELECT symbol, CAST(exit_ts AS DATE) AS date, count(*) AS trades,
         count(*) FILTER (WHERE profit > 0) AS wins,
         count(*) FILTER (WHERE NOT (profit > 0) OR profit IS NULL) AS losses,
         coalesce(sum(profit), 0.0) AS pnl,
         count(*) FILTER (WHERE profit > 0) / greatest(count(*), 1) * 100 AS win_rate
  FROM bx2 GROUP BY 1, 2)""") + "\n" + normalized_select(
    [("symbol", "s"), ("date", "t"), ("trades", "i"), ("wins", "i"), ("losses", "i"), ("pnl", "d"),
     ("win_rate", "d")], "dts"))
def q_daily_trading_summary(spark, sf_dir):
    """A10 over the closed trades."""
    return ex.daily_trading_summary(barrier(spark, sf_dir))


@register("instrument_join", with_ctes(*_EV_FEAT, CFG_SQL_CTE, """ij AS (
  SELECT f.symbol, f.datetime, c.stop_loss_pct, c.take_profit_pct, c.min_confidence, c.timezone
  FROM src f LEFT JOIN cfg c ON f.symbol = c.symbol)""") + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("stop_loss_pct", "d"), ("take_profit_pct", "d"),
     ("min_confidence", "d"), ("timezone", "s")], "ij"))
def q_instrument_join(spark, sf_dir):
    """Feature rows + instrument parameters (AQE picks the join)."""
    j = ex.instrument_join(session_feature_rows(spark, sf_dir), instrument_table(spark, sf_dir))
    return j.select("symbol", "datetime", "stop_loss_pct", "take_profit_pct", "min_confidence", "timezone")


# --- P01-P03, P06-P09: filters and gates over bars ----------------------------------

_MSK = "timezone('Europe/Moscow', ts AT TIME ZONE 'UTC')"


@register("tz_convert", with_ctes(EVENT_BARS, f"""t AS (SELECT symbol, id, ts, {_MSK} AS local_ts FROM bars)""") +
          "\n" + normalized_select([("symbol", "s"), ("id", "i"), ("ts", "t"), ("local_ts", "t")], "t"))
def q_tz_convert(spark, sf_dir):
    """The 'moscow' alias resolves to Europe/Moscow."""
    b = event_bars(spark, sf_dir).withColumn("tz", F.lit("moscow"))
    return filters.to_trading_tz(b, tz_col="tz").select("symbol", "id", "ts", "local_ts")


@register("session_gate", with_ctes(EVENT_BARS, f"""t AS (SELECT symbol, id, ts, {_MSK} AS local_ts FROM bars),
g AS (SELECT *, isodow(local_ts) <= 5 AND CAST(local_ts AS TIME) BETWEEN TIME '20:00:00' AND TIME '23:00:00'
                AS in_session FROM t)""") + "\n" + normalized_select(
    [("symbol", "s"), ("id", "i"), ("local_ts", "t"), ("in_session", "s")], "g"))
def q_session_gate(spark, sf_dir):
    """Monday-Friday, 20:00:00 <= local time <= 23:00:00 (Moscow)."""
    b = filters.to_trading_tz(event_bars(spark, sf_dir), tz="Europe/Moscow")
    return filters.trading_time_gate(b).select("symbol", "id", "local_ts", "in_session")


@register("entry_minute", with_ctes(EVENT_BARS, f"""t AS (SELECT symbol, id, ts, {_MSK} AS local_ts FROM bars)""") +
          "\n" + normalized_select([("symbol", "s"), ("id", "i"), ("local_ts", "t")],
                                   "t WHERE hour(local_ts) = 20 AND minute(local_ts) = 0"))
def q_entry_minute(spark, sf_dir):
    """Bars in the first minute of the session (20:00 Moscow)."""
    b = filters.entry_minute_gate(filters.to_trading_tz(event_bars(spark, sf_dir), tz="Europe/Moscow"))
    return b.filter(F.col("is_entry_minute")).select("symbol", "id", "local_ts")


@register("min_history", """WITH n AS (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 70),
k AS (SELECT e.user_id, e.event_id, e.ts FROM events e JOIN n ON e.user_id = n.user_id)
""" + normalized_select([("user_id", "i"), ("event_id", "i"), ("ts", "t")], "k"))
def q_min_history(spark, sf_dir):
    """P09 on the many-key variant: users (as instruments) with enough ticks.
    The threshold is 70 here (the operator default is the reference's 100) so
    that both outcomes occur: users average about 67 events in these tables."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return filters.min_history_gate(ev, 70, key="user_id")


@register("session_filter", with_ctes(EVENT_BARS) + "\n" + normalized_select(
    [("symbol", "s"), ("id", "i"), ("ts", "t")], "bars WHERE hour(ts) BETWEEN 9 AND 23"))
def q_session_filter(spark, sf_dir):
    """P01."""
    return session_bars(spark, sf_dir).select("symbol", "id", "ts")


@register("evening_filter", with_ctes(EVENT_BARS) + "\n" + normalized_select(
    [("symbol", "s"), ("id", "i"), ("ts", "t")], "bars WHERE hour(ts) BETWEEN 17 AND 23"))
def q_evening_filter(spark, sf_dir):
    """P03."""
    return filters.evening_filter(event_bars(spark, sf_dir)).select("symbol", "id", "ts")


@register("time_parts", with_ctes(EVENT_BARS) + "\n" + normalized_select(
    [("symbol", "s"), ("id", "i"), ("hour", "i"), ("minute", "i"), ("day_of_week", "i"), ("date", "t")],
    "(SELECT symbol, id, hour(ts) AS hour, minute(ts) AS minute, isodow(ts) - 1 AS day_of_week, "
    "CAST(ts AS DATE) AS date FROM bars)"))
def q_time_parts(spark, sf_dir):
    """Hour, minute, weekday (Monday = 0), date."""
    return filters.time_parts(event_bars(spark, sf_dir)).select("symbol", "id", "hour", "minute", "day_of_week",
                                                                "date")


# --- W12 / X12: newest feature row and its signal ----------------------------------

@register("latest_features", with_ctes(*_EV_FEAT, """lf AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) AS rn FROM src)
  WHERE rn = 1)""") + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("day_close_current", "d"), ("current_macd", "d"), ("target", "d")], "lf"))
def q_latest_features(spark, sf_dir):
    """Newest feature row per symbol (top-1 per group)."""
    f = session_feature_rows(spark, sf_dir)
    w = Window.partitionBy("symbol").orderBy(F.col("datetime").desc())
    return (f.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
             .select("symbol", "datetime", "day_close_current", "current_macd", "target"))


@register("latest_signal", with_ctes(*_SIG_SQL, """ls AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) AS rn FROM sig)
  WHERE rn = 1)""") + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("prediction", "d"), ("direction", "s"), ("confidence", "d")], "ls"))
def q_latest_signal(spark, sf_dir):
    """X12 with the rule predictor: prediction, direction and confidence of
    the newest feature row."""
    from sessionbars.operators.ml import score_latest
    return score_latest(session_feature_rows(spark, sf_dir), "prediction").select(
        "symbol", "datetime", "prediction", "direction", "confidence")
