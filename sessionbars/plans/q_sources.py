"""Driver queries for scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionbars.operators import backtest as bt
from sessionbars.operators import metrics as mt
from sessionbars.session import scratch_path
from sessionbars.sources import bars as src
from sessionbars.sources import instruments, sinks
from sessionbars.plans.adapters import event_bars, table
from sessionbars.plans.q_backtest import _EV_LEDGER, session_feature_rows
from sessionbars.plans.registry import register
from sessionbars.plans.sqlparts import EVENT_BARS, LEDGER_KINDS, normalized_select, with_ctes

_BAR_KINDS = [("symbol", "s"), ("ts", "t"), ("open", "d"), ("high", "d"), ("low", "d"), ("close", "d"),
              ("volume", "i")]


@register("bars_csv_roundtrip", with_ctes(EVENT_BARS, """rt AS (
  SELECT symbol, date_trunc('second', ts) AS ts, CAST(CAST(open AS FLOAT) AS DOUBLE) AS open,
         CAST(CAST(high AS FLOAT) AS DOUBLE) AS high, CAST(CAST(low AS FLOAT) AS DOUBLE) AS low,
         CAST(CAST(close AS FLOAT) AS DOUBLE) AS close, volume FROM bars)""") + "\n" +
          normalized_select(_BAR_KINDS, "rt"))
def q_bars_csv_roundtrip(spark, sf_dir):
    """Write bars in the reference file layout, scan them back typed."""
    path = scratch_path(spark, "bars-csv")
    src.write_bars_csv(event_bars(spark, sf_dir), path)
    return src.read_bars_csv(spark, path).select("symbol", "ts", "open", "high", "low", "close", "volume")


@register("bars_parquet_window", with_ctes(EVENT_BARS) + "\n" + normalized_select(
    [("id", "i")] + _BAR_KINDS,
    "bars WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' "
    "AND symbol IN ('click', 'view')"))
def q_bars_parquet_window(spark, sf_dir):
    """Bar store: written partitioned by date, read back for two weeks of two
    symbols (partition pruning on date, pushed filter on symbol)."""
    path = scratch_path(spark, "bar-store")
    src.write_bars_parquet(event_bars(spark, sf_dir), path)
    return src.read_bars_parquet(spark, path, "2024-01-08", "2024-01-21", ["click", "view"])


@register("ts_assembly", with_ctes(EVENT_BARS, """a AS (
  SELECT symbol, id, date_trunc('second', ts) AS ts FROM bars)""") + "\n" +
          normalized_select([("symbol", "s"), ("id", "i"), ("ts", "t")], "a"))
def q_ts_assembly(spark, sf_dir):
    """Date int + one-or-two-digit-hour Time string -> timestamp."""
    b = event_bars(spark, sf_dir)
    raw = b.select("symbol", "id", F.date_format("ts", "yyyyMMdd").cast("int").alias("Date"),
                   F.date_format("ts", "H:mm:ss").alias("Time"))
    return src.assemble_ts(raw).select("symbol", "id", "ts")


@register("bars_normalised", with_ctes(EVENT_BARS, """n AS (
  SELECT symbol, ts, id, CAST(CAST(open AS FLOAT) AS DOUBLE) AS open, CAST(CAST(high AS FLOAT) AS DOUBLE) AS high,
         CAST(CAST(low AS FLOAT) AS DOUBLE) AS low, CAST(CAST(close AS FLOAT) AS DOUBLE) AS close, volume FROM bars)""")
          + "\n" + normalized_select([("id", "i")] + _BAR_KINDS, "n"))
def q_bars_normalised(spark, sf_dir):
    """Reference-typed frame (capitalised names, float32 prices, int
    volume) -> Bar schema."""
    b = event_bars(spark, sf_dir)
    raw = b.select("symbol", "ts", "id", F.col("open").cast("float").alias("Open"),
                   F.col("high").cast("float").alias("High"), F.col("low").cast("float").alias("Low"),
                   F.col("close").cast("float").alias("Close"), F.col("volume").cast("int").alias("Volume"))
    return src.normalise_bars(raw)


@register("bars_epoch", with_ctes(EVENT_BARS, """e AS (
  SELECT symbol, make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000) AS ts, id,
         open, high, low, close, volume FROM bars)""") + "\n" + normalized_select([("id", "i")] + _BAR_KINDS, "e"))
def q_bars_epoch(spark, sf_dir):
    """Broker layout (epoch seconds, tick_volume) -> Bar schema."""
    b = event_bars(spark, sf_dir)
    raw = b.select("symbol", "id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
                   "open", "high", "low", "close", F.col("volume").alias("tick_volume"))
    return src.bars_from_epoch(raw)


@register("last_n_bars", with_ctes(EVENT_BARS, """l AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, id DESC) AS rn FROM bars)
  WHERE rn <= 100)""") + "\n" + normalized_select([("id", "i")] + _BAR_KINDS, "l"))
def q_last_n_bars(spark, sf_dir):
    return src.last_n_bars(event_bars(spark, sf_dir), 100)


def _ohlcv_sql(width: str) -> str:
    return with_ctes(EVENT_BARS, f"""o AS (
  SELECT symbol, time_bucket(INTERVAL '{width}', ts) AS ts, min(id) AS id,
         first(open ORDER BY ts, id) AS open, max(high) AS high, min(low) AS low,
         last(close ORDER BY ts, id) AS close, sum(volume) AS volume, count(*) AS ticks
  FROM bars GROUP BY 1, 2)""") + "\n" + normalized_select(
        [("id", "i")] + _BAR_KINDS + [("ticks", "i")], "o")


def _ohlcv(tf):
    def q(spark, sf_dir):
        return src.resample_bars(event_bars(spark, sf_dir), tf)
    q.__doc__ = f"S06: ticks -> {tf} OHLCV bars."
    return q


for _tf, _w in (("m1", "1 minute"), ("m5", "5 minutes"), ("m15", "15 minutes"), ("h1", "1 hour"),
                ("d1", "1 day")):
    register(f"ohlcv_{_tf}", _ohlcv_sql(_w))(_ohlcv(_tf.upper()))


@register("bars_union", with_ctes(EVENT_BARS) + "\n" + normalized_select([("id", "i")] + _BAR_KINDS, "bars"))
def q_bars_union(spark, sf_dir):
    """Per-symbol frames (e.g. one file each) unioned by name."""
    b = event_bars(spark, sf_dir)
    first = b.filter(F.col("symbol") < "m")
    rest = b.filter(~(F.col("symbol") < "m")).select(*reversed(b.columns))
    return first.unionByName(rest)


@register("bar_profile", with_ctes(EVENT_BARS, """i AS (SELECT symbol, count(*) AS rows_in FROM bars GROUP BY 1),
k AS (SELECT symbol, count(*) AS rows_out, min(ts) AS first_ts, max(ts) AS last_ts FROM bars
      WHERE hour(ts) BETWEEN 9 AND 23 GROUP BY 1),
p AS (SELECT i.symbol, rows_in, coalesce(rows_out, 0) AS rows_out, first_ts, last_ts,
             coalesce(rows_out, 0) / rows_in * 100 AS kept_pct FROM i LEFT JOIN k ON i.symbol = k.symbol)""") + "\n" +
          normalized_select([("symbol", "s"), ("rows_in", "i"), ("rows_out", "i"), ("first_ts", "t"),
                             ("last_ts", "t"), ("kept_pct", "d")], "p"))
def q_bar_profile(spark, sf_dir):
    """Rows before / after the session filter, time range, kept share."""
    hour = F.hour("ts")
    return mt.bar_profile(event_bars(spark, sf_dir), (hour >= 9) & (hour <= 23))


@register("ledger_export", _EV_LEDGER + "\n" + normalized_select(LEDGER_KINDS, "led"))
def q_ledger_export(spark, sf_dir):
    """The session ledger written as CSV and read back with its schema."""
    led = bt.backtest(session_feature_rows(spark, sf_dir))
    path = scratch_path(spark, "ledger")
    sinks.write_ledger(led, path)
    return sinks.read_ledger(spark, path)


_CFG_KINDS = [("symbol", "s"), ("broker_type", "s"), ("volume", "d"), ("max_positions", "i"),
              ("max_daily_trades", "i"), ("stop_loss_pct", "d"), ("take_profit_pct", "d"),
              ("hours_start", "s"), ("hours_end", "s"), ("timezone", "s"), ("model_path", "s"),
              ("min_confidence", "d"), ("risk_per_trade", "d"), ("data_lookback", "i"),
              ("initial_balance", "d"), ("max_volume", "d")]


def derived_configs(spark, sf_dir):
    """One config per instrument seen in the events: the symbol and the data's
    time zone are set; every other key is left out, so it takes the default."""
    syms = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    return syms.select("symbol", F.lit("simulator").alias("broker_type"), F.lit("UTC").alias("timezone"))


def instrument_table(spark, sf_dir):
    """The configs with their defaults, without the way through files."""
    return instruments.with_defaults(derived_configs(spark, sf_dir))


def instrument_files(spark, sf_dir):
    path = scratch_path(spark, "instruments")
    instruments.write_instruments(derived_configs(spark, sf_dir), path)
    return instruments.load_instruments(spark, path, multiline=False)


CFG_SQL_CTE = """cfg AS (
  SELECT DISTINCT event_type AS symbol, 'simulator' AS broker_type, 0.1 AS volume, 1 AS max_positions,
         5 AS max_daily_trades, 2.0 AS stop_loss_pct, 3.0 AS take_profit_pct, '20:00' AS hours_start,
         '23:00' AS hours_end, 'UTC' AS timezone, 'trained_model.pkl' AS model_path, 0.5 AS min_confidence,
         1.0 AS risk_per_trade, 1440 AS data_lookback, 100000.0 AS initial_balance, 1.0 AS max_volume
  FROM events)"""


@register("instrument_config", with_ctes(CFG_SQL_CTE) + "\n" + normalized_select(_CFG_KINDS, "cfg"))
def q_instrument_config(spark, sf_dir):
    """Config files overlaid on the defaults (shallow: whole keys)."""
    c = instrument_files(spark, sf_dir)
    return c.select("symbol", "broker_type", "volume", "max_positions", "max_daily_trades", "stop_loss_pct",
                    "take_profit_pct", F.col("trading_hours.start").alias("hours_start"),
                    F.col("trading_hours.end").alias("hours_end"), "timezone", "model_path", "min_confidence",
                    "risk_per_trade", "data_lookback", "initial_balance", "max_volume")
