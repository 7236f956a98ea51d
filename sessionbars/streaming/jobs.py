"""Streaming versions of the bar, signal, position and summary operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionbars.operators import execution as ex
from sessionbars.operators.features import build_features
from sessionbars.operators.sessions import ENTRY_CLOCK, ENTRY_HOURS, nearest_pick
from sessionbars.sources.bars import TIMEFRAMES, last_n_bars

# ----------------------------------------------------------------------------
# plumbing: sources and the upsert-log sink
# ----------------------------------------------------------------------------


def tick_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A file stream of tick/bar rows (parquet), with an explicit schema."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def run_upsert_log(stream: DataFrame, path: str, checkpoint: str, mode: str = "update",
                   transform: Callable[[DataFrame, int], DataFrame] | None = None) -> None:
    """Run a stream to completion on what is available (availableNow) into an
    upsert log at ``path``: batch N overwrites ``batch_id=N`` (idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        if out is None:
            return
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    q = (stream.writeStream.outputMode(mode).foreachBatch(write)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of each key in an upsert log."""
    df = spark.read.parquet(path)
    payload = [c for c in df.columns if c not in keys and c != "batch_id"]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), "batch_id").alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in payload])


def _event_time(df: DataFrame, ts: str = "ts", out: str = "ets") -> DataFrame:
    # Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session zone is UTC.
    return df.withColumn(out, F.col(ts).cast("timestamp"))


# ----------------------------------------------------------------------------
# Windowed aggregates
# ----------------------------------------------------------------------------


def stream_bars(ticks: DataFrame, timeframe: str = "M1", watermark: str = "5 minutes",
                key: str = "symbol") -> DataFrame:
    """Ticks -> OHLCV bars in tumbling event-time windows.  Ticks later
    than the watermark are dropped; state of closed windows is evicted."""
    t = _event_time(ticks).withWatermark("ets", watermark)
    g = t.groupBy(key, F.window("ets", TIMEFRAMES[timeframe]).alias("_w")).agg(
        F.min(F.struct("ets", "id", F.col("open").alias("v")))["v"].alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max(F.struct("ets", "id", F.col("close").alias("v")))["v"].alias("close"),
        F.sum("volume").cast("long").alias("volume"),
        F.count(F.lit(1)).cast("long").alias("ticks"),
        F.min("id").alias("id"))
    return g.select(key, F.col("_w.start").cast("timestamp_ntz").alias("ts"), "id", "open", "high", "low",
                    "close", "volume", "ticks")


def stream_daily_summary(closed: DataFrame, watermark: str = "1 hour", key: str = "symbol",
                         ts: str = "exit_ts") -> DataFrame:
    """Per symbol and trading day (days start at 00:01, the reference's
    reset time): trades, wins, losses, P&L and win rate."""
    t = _event_time(closed, ts, "ets").withWatermark("ets", watermark)
    g = t.groupBy(key, F.window("ets", "1 day", startTime="1 minute").alias("_w")).agg(
        F.count(F.lit(1)).cast("long").alias("trades"),
        F.count(F.when(F.col("profit") > 0, 1)).cast("long").alias("wins"),
        F.count(F.when(~(F.col("profit") > 0) | F.col("profit").isNull(), 1)).cast("long").alias("losses"),
        F.coalesce(F.sum("profit"), F.lit(0.0)).alias("pnl"))
    return g.select(key, F.col("_w.start").cast("timestamp_ntz").alias("day_start"), "trades", "wins", "losses",
                    "pnl", (F.col("wins") / F.greatest(F.col("trades"), F.lit(1)) * 100.0).alias("win_rate"))


# ----------------------------------------------------------------------------
# Signals per micro-batch over the bar history
# ----------------------------------------------------------------------------


def _signal_windows(stored: DataFrame, counts: DataFrame, brought: DataFrame, since, lookback: int) -> DataFrame:
    """(symbol, day, entry_ts, date): the dates that hold the ``lookback`` bars
    up to the entry bar of ``day``, for every day that ``brought`` (symbol,
    date) can change.  ``counts`` (symbol, date, n) has the bars of each date
    by batch, so bars from before ``since`` are not read for it.  Days meet earlier dates by their bar count in steps of
    ``lookback``, so the join is linear in the dates."""
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = counts.groupBy("symbol", "date").agg(F.sum("n").alias("_n")).withColumn("_upto", F.sum("_n").over(w))
    days = days.join(brought.withColumn("_new", F.lit(True)), ["symbol", "date"], "left")
    entry = nearest_pick("ts", "id", ENTRY_CLOCK, ENTRY_HOURS, [])
    entries = stored.filter(F.col("date") >= F.lit(since)).groupBy("symbol", "date").agg(entry.alias("_e"))
    targets = entries.filter(F.col("_e").isNotNull()).join(days, ["symbol", "date"])
    targets = targets.select("symbol", F.col("date").alias("day"), F.col("_e.ts").alias("entry_ts"),
                             (F.col("_upto") - F.col("_n")).alias("_before"), "_new")
    own = targets.select("symbol", "day", "entry_ts", F.col("day").alias("date"), "_new")
    step = F.floor(F.col("_before") / F.lit(lookback))
    steps = targets.drop("_new").withColumn("_step", F.explode(F.array(step - 1, step)))
    earlier = steps.join(days.withColumn("_step", F.floor(F.col("_upto") / F.lit(lookback))), ["symbol", "_step"])
    earlier = earlier.filter((F.col("date") < F.col("day")) & (F.col("_before") - F.col("_upto") < lookback))
    spans = own.unionByName(earlier.select(own.columns))
    changed = spans.filter("_new").select("symbol", "day").distinct()
    return spans.join(changed, ["symbol", "day"], "left_semi").drop("_new")


def stream_signals(spark: SparkSession, ticks: DataFrame, cfg: DataFrame, bar_table: str, out: str,
                   checkpoint: str, balance: float, lookback: int = 1440) -> None:
    """Each micro-batch appends its bars to ``bar_table`` (partitioned by
    date) and their number per (symbol, date) to ``<bar_table>_counts``, and scores every (symbol, date) with an entry bar that the batch can
    change: the features are rebuilt on the ``lookback`` bars up to that entry bar
    and scored with the rule predictor (MACD at entry).

    One row per (symbol, date) scored, without ``datetime`` where there is no
    order; a later batch replaces it (``read_latest``), so the result does not
    depend on where the batches are cut."""
    cols = ["datetime", "direction", "confidence", "volume", "entry_price", "stop_loss", "take_profit",
            "success", "error"]

    def step(batch: DataFrame, batch_id: int) -> DataFrame | None:
        dated = batch.withColumn("date", F.to_date("ts"))
        dated.write.mode("overwrite").partitionBy("date").parquet(f"{bar_table}/batch_id={batch_id}")
        since = dated.agg(F.min("date")).first()[0]     # one scalar per micro-batch
        if since is None:
            return None
        dated.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{bar_table}_counts/batch_id={batch_id}")
        stored, counts = spark.read.parquet(bar_table), spark.read.parquet(f"{bar_table}_counts")
        brought = counts.filter(F.col("batch_id") == batch_id).select("symbol", "date")
        spans = _signal_windows(stored, counts, brought, since, lookback).persist()
        oldest = spans.agg(F.min("date")).first()[0]    # one scalar: prunes partitions
        bars = stored.filter(F.col("date") >= F.lit(oldest)).join(spans, ["symbol", "date"])
        bars = bars.filter(F.col("ts") <= F.col("entry_ts")).withColumn("_w", F.concat("symbol", F.lit("@"), F.col("day").cast("string")))
        recent = last_n_bars(bars.drop("batch_id", "date", "entry_ts"), lookback, key="_w")
        known = recent.groupBy("_w", "symbol", "day").agg(F.count(F.lit(1)).alias("history_bars"))
        feats = build_features(recent.drop("symbol", "day"), key="_w", left_exit=True).join(known, "_w")
        feats = feats.filter(F.to_date("datetime") == F.col("day")).withColumn("prediction", F.col("current_macd"))
        sig = ex.quotes_from_mid(feats, "day_close_current").withColumn("local_ts", F.col("datetime"))
        orders = ex.order_signals(sig, cfg, balance).select("symbol", F.to_date("datetime").alias("date"), *cols)
        scored = spans.select("symbol", F.col("day").alias("date")).distinct()
        return scored.join(orders, ["symbol", "date"], "left")

    run_upsert_log(ticks, out, checkpoint, mode="append", transform=step)


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """The orders of the newest scoring of each (symbol, date)."""
    return read_latest(spark, path, ["symbol", "date"]).filter(F.col("datetime").isNotNull()).drop("date")


# ----------------------------------------------------------------------------
# Stream-static mark to market
# ----------------------------------------------------------------------------


def stream_mark_to_market(quotes: DataFrame, positions: DataFrame, key: str = "symbol", carry: tuple[str, ...] = ()) -> DataFrame:
    """Every quote marks the positions of its symbol that are open at
    that moment (open_time <= quote time <= mark_ts): a stream-static join on
    (symbol, date), a position standing on each date of its span, so a quote
    meets the day's positions and never the whole book.  ``carry`` names further
    columns to hand on, of the quotes (``q.``) or the positions (``p.``)."""
    q = quotes.withColumn("_d", F.to_date("ts")).alias("q")
    span = F.sequence(F.to_date("open_time"), F.to_date("mark_ts"))
    p = positions.withColumn("_d", F.explode(span)).alias("p")
    same = (F.col(f"q.{key}") == F.col(f"p.{key}")) & (F.col("q._d") == F.col("p._d"))
    j = q.join(p, same & (F.col("q.ts") >= F.col("p.open_time"))
               & (F.col("q.ts") <= F.col("p.mark_ts")), "inner")
    long_ = F.col("p.type") == "LONG"
    px = F.when(long_, F.col("q.bid")).otherwise(F.col("q.ask"))
    pts = F.when(long_, px - F.col("p.open_price")).otherwise(F.col("p.open_price") - px)
    return j.select(F.col(f"q.{key}").alias(key), F.col("q.ts").alias("ts"), F.col("q.id").alias("id"),
                    F.col("p.open_time").alias("open_time"), F.col("p.type").alias("type"),
                    px.alias("current_price"), (pts * F.lit(ex.POINT_VALUE) * F.col("p.volume")).alias("profit"), *carry)


def stream_account(quotes: DataFrame, positions: DataFrame, balance: float, timeframe: str = "M1",
                   watermark: str = "5 minutes", key: str = "symbol") -> DataFrame:
    """A09 on top of R05, in append mode: two chained aggregates over event time.
    The first keeps each open position's last mark of a window, the second sums
    the marks of an account's positions into floating P&L, margin and equity.
    Both let go of a window once the watermark passes its end, and only then is
    its row out, so it is final; quotes later than that are dropped.  A position
    counts in the windows that bring it a quote; equal positions all count."""
    same = ["open_time", "mark_ts", "type", "volume", "open_price"]
    book = positions.groupBy(key, *same).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    timed = _event_time(quotes).withWatermark("ets", watermark)
    marks = stream_mark_to_market(timed, book, key, ("q.ets", "p.mark_ts", "p.volume", "p.open_price", "p._copies"))
    last = marks.groupBy(key, *same, "_copies", F.window("ets", TIMEFRAMES[timeframe]).alias("_w")).agg(
        F.max(F.struct("ts", "id", "profit"))["profit"].alias("profit"))
    each = last.select(key, "volume", "open_price", "profit", F.window_time("_w").alias("ets"), F.explode(F.array_repeat(F.lit(1), F.col("_copies"))))
    each = each.withColumn("_w", F.window("ets", TIMEFRAMES[timeframe]))
    return ex.account_summary(each, balance, [key, "_w"]).withColumn("ts", F.col("_w.start").cast("timestamp_ntz")).drop("_w")


# ----------------------------------------------------------------------------
# Exits of open positions
# ----------------------------------------------------------------------------


def stream_positions(spark: SparkSession, ticks: DataFrame, trades: DataFrame, tick_table: str, out: str,
                     checkpoint: str) -> None:
    """Each micro-batch appends its ticks to ``tick_table`` (partitioned by
    date) and settles the trades of the dates it touched by ``barrier_exit`` over
    all ticks of those dates.  A trade that is still open has its latest price as
    SESSION_END, and a later batch replaces the row (``read_latest``); late ticks
    are taken in alike.  Only the tables are state, so nothing has to be released."""
    def step(batch: DataFrame, batch_id: int) -> DataFrame | None:
        dated = batch.withColumn("date", F.to_date("ts"))
        dated.write.mode("overwrite").partitionBy("date").parquet(f"{tick_table}/batch_id={batch_id}")
        since = dated.agg(F.min("date")).first()[0]     # one scalar: prunes partitions
        if since is None:
            return None
        touched = dated.select("date").distinct()
        stored = spark.read.parquet(tick_table).filter(F.col("date") >= F.lit(since))
        bars = stored.join(touched, "date", "left_semi").drop("batch_id", "date")
        mine = trades.withColumn("date", F.to_date("entry_ts")).join(touched, "date", "left_semi").drop("date")
        return ex.barrier_exit(mine, bars, until="session_end")

    run_upsert_log(ticks, out, checkpoint, mode="append", transform=step)


def stream_exits(ticks: DataFrame, trades: DataFrame, watermark: str = "1 hour", longest: str = "1 day",
                 key: str = "symbol") -> DataFrame:
    """R03 without stored ticks, in append mode: an outer interval join of the
    trade stream with the tick stream, then J07's picks per trade.

    A trade's event time is its ``session_end``, at most ``longest`` after its
    entry.  Ticks wait in state until no trade that is still to come can ask for
    them.  Once the watermark, the lesser of both streams', is ``longest`` past a
    session end, the trade's one row is out and its state is freed.  What comes
    later than ``watermark`` may be dropped, and is if it is ``longest`` later
    still: where late ticks must count, take ``stream_positions``.  Trades that are equal in all columns give one row."""
    b = _event_time(ticks).withWatermark("ets", watermark)
    b = b.select(F.col(key).alias("_k"), "ets", F.col("ts").alias("_bt"), F.col("id").alias("_bi"), "high", "low", "close")
    t = trades.withColumns({"send": F.col("session_end").cast("timestamp"), "_entry": F.col("entry_ts").cast("timestamp")}).withWatermark("send", watermark)
    near = (F.col("ets") > F.col("_entry")) & (F.col("ets") <= F.col("send")) & (F.col("ets") >= F.col("send") - F.expr(f"INTERVAL {longest}"))
    j = t.join(b, (F.col(key) == F.col("_k")) & near, "left_outer").drop("ets", "_k", "_entry")
    return ex.settle_exits(j.groupBy(*trades.columns, "send").agg(*ex.exit_picks())).drop("send")
