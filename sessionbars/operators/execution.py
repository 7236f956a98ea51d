"""Live-trading arithmetic as DataFrame operators.

The reference runs these one order at a time against a broker object; here
they are column expressions and joins over tables of signals, quotes and
positions, so a whole book of instruments is priced in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.functions.columns import confidence as confidence_col
from sessionbars.functions.columns import predicted_direction
from sessionbars.operators.asof import asof_join
from sessionbars.operators.filters import entry_minute_gate, in_trading_time
from sessionbars.operators.sessions import in_hours

# Fixed values of the reference's broker and sizing arithmetic.
POINT_VALUE = 5.0          # dollars per point per lot
MARGIN_RATE = 0.2          # 20 % margin (5:1)
MIN_VOLUME = 0.1
DEFAULT_MAX_VOLUME = 1.0
CONFIDENCE_SCALE = 0.5
MIN_HISTORY = 100          # bars below which there is no prediction


def confidence_gate(df: DataFrame, pred: str = "prediction", min_confidence: Column | float = 0.5) -> DataFrame:
    """confidence = min(|p| / 0.5, 1); ``tradable`` when >= min_confidence."""
    mc = min_confidence if isinstance(min_confidence, Column) else F.lit(min_confidence)
    return (df.withColumn("direction", predicted_direction(pred))
              .withColumn("confidence", confidence_col(pred, CONFIDENCE_SCALE))
              .withColumn("tradable", F.col("confidence") >= mc))


def sl_tp_levels(df: DataFrame, direction: str = "direction", bid: str = "bid", ask: str = "ask",
                 sl_pct: Column | float = 2.0, tp_pct: Column | float = 3.0) -> DataFrame:
    """entry = ask (BUY) / bid (SELL); stop and target at +-pct of entry."""
    sl = sl_pct if isinstance(sl_pct, Column) else F.lit(sl_pct)
    tp = tp_pct if isinstance(tp_pct, Column) else F.lit(tp_pct)
    buy = F.col(direction) == "BUY"
    e = F.when(buy, F.col(ask)).otherwise(F.col(bid))
    return (df.withColumn("entry_price", e)
              .withColumn("stop_loss", F.when(buy, e * (1 - sl / 100)).otherwise(e * (1 + sl / 100)))
              .withColumn("take_profit", F.when(buy, e * (1 + tp / 100)).otherwise(e * (1 - tp / 100))))


def position_size(df: DataFrame, balance: Column | float, ask: str = "ask",
                  risk_pct: Column | float = 1.0, sl_pct: Column | float = 2.0,
                  max_volume: Column | float = DEFAULT_MAX_VOLUME) -> DataFrame:
    """volume = risk$ / (ask * sl% * point value), at least 0.1, rounded
    to one decimal (half-even, as Python's round), capped at max_volume."""
    def c(x):
        return x if isinstance(x, Column) else F.lit(x)
    risk = c(balance) * (c(risk_pct) / 100)
    raw = F.try_divide(risk, F.col(ask) * (c(sl_pct) / 100) * F.lit(POINT_VALUE))
    # without a price there is no size (greatest would skip the null), and margin_check rejects it
    vol = F.when(raw.isNotNull(), F.bround(F.greatest(raw, F.lit(MIN_VOLUME)), 1))
    return (df.withColumn("risk_amount", risk)
              .withColumn("volume", F.when(vol.isNotNull(), F.least(vol, c(max_volume)))))


def margin_check(df: DataFrame, balance: Column | float, order_type: str = "direction",
                 volume: str = "volume", price: str = "entry_price") -> DataFrame:
    """Reject unknown sides (case-insensitive BUY/SELL) and orders whose
    margin (notional * 0.2) exceeds the balance."""
    bal = balance if isinstance(balance, Column) else F.lit(balance)
    side = F.upper(F.col(order_type))
    known = side.isin("BUY", "SELL")
    margin = F.col(volume) * F.col(price) * F.lit(MARGIN_RATE)
    err = (F.when(~known, F.lit("invalid order type"))
            .when(F.col(volume).isNull(), F.lit("invalid volume"))
            .when(margin > bal, F.lit("insufficient margin")))
    return (df.withColumn("required_margin", margin)
              .withColumn("success", err.isNull())
              .withColumn("error", err)
              .withColumn("position_type", F.when(side == "BUY", F.lit("LONG"))
                                             .when(side == "SELL", F.lit("SHORT"))))


def quotes_from_mid(df: DataFrame, mid: str = "close", spread: float = 2.0) -> DataFrame:
    """bid/ask at mid -+ spread/2, rounded to cents; spread = ask - bid."""
    return (df.withColumn("bid", F.round(F.col(mid) - F.lit(spread / 2), 2))
              .withColumn("ask", F.round(F.col(mid) + F.lit(spread / 2), 2))
              .withColumn("spread", F.col("ask") - F.col("bid")))


def mark_to_market(positions: DataFrame, quotes: DataFrame, at: str = "mark_ts", key: str = "symbol",
                   quote_ts: str = "ts", quote_tie: str | None = "id") -> DataFrame:
    """Price each position at ``at`` with the latest quote at or before it.
    LONG closes at the bid, SHORT at the ask; profit = points * 5 * volume."""
    j = asof_join(positions, quotes, key, at, quote_ts, ["bid", "ask"], right_tie=quote_tie, prefix="q_")
    long_ = F.col("type") == "LONG"
    px = F.when(long_, F.col("q_bid")).otherwise(F.col("q_ask"))
    pts = F.when(long_, px - F.col("open_price")).otherwise(F.col("open_price") - px)
    return (j.withColumn("current_price", px)
             .withColumn("profit_points", pts)
             .withColumn("profit", pts * F.lit(POINT_VALUE) * F.col("volume")))


def account_summary(marked: DataFrame, balance: Column | float, account: str | list[str] = "symbol") -> DataFrame:
    """Floating P&L, equity, margin in use and free margin per account
    (or per account and time, with a list of columns)."""
    bal = balance if isinstance(balance, Column) else F.lit(balance)
    agg = marked.groupBy(account).agg(
        F.coalesce(F.sum("profit"), F.lit(0.0)).alias("profit"),
        F.sum(F.col("volume") * F.col("open_price") * F.lit(MARGIN_RATE)).alias("margin"),
        F.count(F.lit(1)).cast("long").alias("open_positions"))
    return (agg.withColumn("balance", bal)
               .withColumn("equity", F.col("balance") + F.col("profit"))
               .withColumn("free_margin", F.col("equity") - F.col("margin"))
               .withColumn("leverage", F.lit(5).cast("long"))
               .withColumn("currency", F.lit("USD")))


def closed_positions(tracked: DataFrame, broker_open: DataFrame, keys: list[str]) -> DataFrame:
    """Tracked positions the broker no longer lists (left anti join);
    the reference books each of them as a loss."""
    return tracked.join(broker_open.select(*keys), keys, "left_anti").withColumn("booked_as", F.lit("loss"))


def open_positions(tracked: DataFrame, broker_open: DataFrame, keys: list[str]) -> DataFrame:
    """Tracked positions still open at the broker (left semi join)."""
    return tracked.join(broker_open.select(*keys), keys, "left_semi")


def barrier_exit(trades: DataFrame, bars: DataFrame, key: str = "symbol", entry_ts: str = "entry_ts",
                 ts: str = "ts", tie: str = "id", hours: tuple[int, int] = (20, 23),
                 until: str | None = None) -> DataFrame:
    """The first bar after entry (same date, within ``hours``) whose low
    reaches the stop (long) / whose high reaches it (short), or that reaches
    the target; both in one bar -> stop first.  No hit -> the last bar's close
    (session end).  A trade without a later bar is closed where it was opened
    (NO_BAR).  Trades need: key, entry_ts, position_type, entry_price,
    stop_loss, take_profit, volume; equal trades stay separate.  ``until`` names
    the trades' column with their session end: later bars do not count, and a
    session that crosses midnight takes the bars of both dates.

    One trade per (symbol, date) in the callers, so the equi-join on
    (symbol, date) is linear in the bars; the first hit is a min(struct)."""
    b = (bars.filter(in_hours(ts, *hours)).withColumn("_d", F.to_date(F.col(ts)))
             .select(key, "_d", F.col(ts).alias("_bt"), F.col(tie).alias("_bi"), "high", "low", "close"))
    # an id only has to be unique within one run of the aggregate below
    t = trades.withColumns({"_whole": F.struct(*trades.columns), "_trade": F.monotonically_increasing_id()})
    first = F.to_date(F.col(entry_ts))
    last = F.greatest(first, F.to_date(F.col(until))) if until else first
    t = t.withColumn("_d", F.explode(F.sequence(first, last)))
    later = (t[key] == b[key]) & (t["_d"] == b["_d"]) & (F.col("_bt") > F.col(entry_ts))
    if until:
        later &= F.col("_bt") <= F.col(until)
    j = t.join(b, later, "left").drop(b[key], b["_d"])
    agg = j.groupBy(key, "_trade").agg(F.first("_whole").alias("_whole"), *exit_picks())  # _whole: one value a trade
    return settle_exits(agg.select(*[F.col(f"_whole.{c}").alias(c) for c in trades.columns], "_hit", "_end"), entry_ts)


def exit_picks(ts: str = "_bt", tie: str = "_bi") -> list[Column]:
    """The aggregates of a trade's later bars: ``_hit``, the first touch of the
    stop or the target, and ``_end``, the last close."""
    long_ = F.col("position_type") == "LONG"
    sl_hit = F.when(long_, F.col("low") <= F.col("stop_loss")).otherwise(F.col("high") >= F.col("stop_loss"))
    tp_hit = F.when(long_, F.col("high") >= F.col("take_profit")).otherwise(F.col("low") <= F.col("take_profit"))
    reason = F.when(sl_hit, F.lit("SL")).when(tp_hit, F.lit("TP"))
    level = F.when(sl_hit, F.col("stop_loss")).when(tp_hit, F.col("take_profit"))
    at = (F.col(ts).alias("t"), F.col(tie).alias("i"))
    return [F.min(F.when(reason.isNotNull(), F.struct(*at, reason.alias("reason"), level.alias("price")))).alias("_hit"),
            F.max(F.when(F.col(ts).isNotNull(), F.struct(*at, F.col("close").alias("price")))).alias("_end")]


def settle_exits(agg: DataFrame, entry_ts: str = "entry_ts") -> DataFrame:
    """exit_ts, exit_reason, exit_price and profit of trades from ``exit_picks``."""
    px = F.coalesce(F.col("_hit.price"), F.col("_end.price"), F.col("entry_price"))
    pts = F.when(F.col("position_type") == "LONG", px - F.col("entry_price")).otherwise(F.col("entry_price") - px)
    ended = F.when(F.col("_end").isNull(), F.lit("NO_BAR")).otherwise(F.lit("SESSION_END"))
    return (agg.withColumn("exit_ts", F.coalesce(F.col("_hit.t"), F.col("_end.t"), F.col(entry_ts)))
               .withColumn("exit_reason", F.coalesce(F.col("_hit.reason"), ended))
               .withColumn("exit_price", px)
               .withColumn("profit", pts * F.lit(POINT_VALUE) * F.col("volume"))
               .drop("_hit", "_end"))


def instrument_join(df: DataFrame, cfg: DataFrame, key: str = "symbol") -> DataFrame:
    """Attach per-instrument parameters (config table is one row per
    instrument).  AQE broadcasts it by its measured bytes; no hint, no job here."""
    return df.join(cfg, key, "left")


def daily_trading_summary(closed: DataFrame, key: str = "symbol", ts: str = "exit_ts") -> DataFrame:
    """A10: per symbol and day: trades, wins (profit > 0), losses (otherwise),
    P&L and win rate = wins / max(trades, 1) * 100."""
    d = closed.withColumn("date", F.to_date(F.col(ts)))
    agg = d.groupBy(key, "date").agg(
        F.count(F.lit(1)).cast("long").alias("trades"),
        F.count(F.when(F.col("profit") > 0, 1)).cast("long").alias("wins"),
        F.count(F.when(~(F.col("profit") > 0) | F.col("profit").isNull(), 1)).cast("long").alias("losses"),
        F.coalesce(F.sum("profit"), F.lit(0.0)).alias("pnl"))
    return agg.withColumn("win_rate", F.col("wins") / F.greatest(F.col("trades"), F.lit(1)) * F.lit(100.0))


def position_limits(orders: DataFrame, day: str, ts: str = "entry_ts", exit_ts: str = "exit_ts", key: str = "symbol",
                    max_positions: str = "max_positions", max_daily_trades: str = "max_daily_trades") -> DataFrame:
    """X14's two limits as two rules, swept over each (symbol, day) in time order:
    an order is taken if fewer than ``max_positions`` of the orders taken before
    are still open at its time (one that exits at that very moment is not) and
    fewer than ``max_daily_trades`` were taken that day.  ``exit_ts`` is when
    the order's position ends if it is taken (``barrier_exit``); it does not
    depend on the others, so the sweep is one fold per symbol and day, whose
    orders are bounded by the session's first minute.  Equal times go by exit."""
    whole = F.struct(F.col(ts).alias("_t"), F.col(exit_ts).alias("_x"), F.monotonically_increasing_id().alias("_i"),
                     F.col(max_positions).cast("int").alias("_p"), F.col(max_daily_trades).cast("int").alias("_n"),
                     F.struct(*orders.columns).alias("_o"))
    rows = orders.select(F.col(key).alias("_k"), F.col(day).alias("_day"), whole.alias("_w"))
    day_rows = rows.groupBy("_k", "_day").agg(F.array_sort(F.collect_list("_w")).alias("_w"))

    def take(taken: Column, x: Column) -> Column:
        open_ = F.size(F.filter(taken, lambda y: y["_x"] > x["_t"]))
        return F.when((open_ < x["_p"]) & (F.size(taken) < x["_n"]), F.concat(taken, F.array(x))).otherwise(taken)

    kept = F.aggregate("_w", F.slice(F.col("_w"), 1, 0), take)
    return day_rows.select(F.explode(kept).alias("_w")).select(*[F.col(f"_w._o.{c}").alias(c) for c in orders.columns])


def order_signals(signals: DataFrame, cfg: DataFrame, balance: float, key: str = "symbol",
                  ts: str = "datetime", pred: str = "prediction", local_ts: str = "local_ts",
                  history: str = "history_bars", min_history: int = MIN_HISTORY,
                  bars: DataFrame | None = None) -> DataFrame:
    """Gate -> size -> levels -> margin for prediction rows.

    ``signals`` needs key, ts, prediction, bid, ask, ``local_ts`` (time in the
    instrument zone) and ``history`` (bars known by then, see
    ``filters.with_history``).  ``cfg`` is the instrument table of
    ``load_instruments``.  Gates: Monday-Friday inside trading hours, the first
    minute of the session (later minutes only watch), at least ``min_history``
    bars, confidence >= min_confidence, and at most min(max_positions,
    max_daily_trades) orders per symbol-day (all of a day's orders fall in that
    minute, so all count as open).  ``session_end`` is that day's end of the
    trading hours on the clock of ``ts``.

    With ``bars`` the limits are two rules (``position_limits``): each order that
    would succeed is followed to its exit over the bars, an early stop makes room
    for a later order, and ``exit_ts`` comes with the rows; orders that fail
    their margin check are returned and count as nothing."""
    s = instrument_join(signals, cfg, key)
    start, end = F.col("trading_hours.start"), F.col("trading_hours.end")

    s = s.withColumn("in_session", in_trading_time(local_ts, start, end))
    s = entry_minute_gate(s, local_ts, start)
    s = confidence_gate(s, pred, F.col("min_confidence"))
    s = s.filter(F.col("in_session") & F.col("is_entry_minute") & (F.col(history) >= min_history) & F.col("tradable"))
    local_end = F.concat_ws(" ", F.to_date(F.col(local_ts)).cast("string"), end).cast("timestamp_ntz")
    s = s.withColumn("session_end", F.col(ts) + (local_end - F.col(local_ts)))
    if bars is None:
        w = Window.partitionBy(key, F.to_date(F.col(local_ts))).orderBy(F.col(ts))
        limit = F.least(F.col("max_positions"), F.col("max_daily_trades"))
        s = s.withColumn("order_of_day", F.row_number().over(w)).filter(F.col("order_of_day") <= limit)
    s = position_size(s, balance, "ask", F.col("risk_per_trade"), F.col("stop_loss_pct"), F.col("max_volume"))
    s = sl_tp_levels(s, "direction", "bid", "ask", F.col("stop_loss_pct"), F.col("take_profit_pct"))
    s = margin_check(s, balance)
    if bars is None:
        return s
    s = s.withColumn("_day", F.to_date(F.col(local_ts)))
    ended = barrier_exit(s.filter("success"), bars, key, ts, hours=(0, 23), until="session_end")
    ended = ended.drop("exit_reason", "exit_price", "profit")
    taken = position_limits(ended, "_day", ts, key=key)
    return taken.unionByName(s.filter("not success"), allowMissingColumns=True).drop("_day")
