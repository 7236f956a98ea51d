"""Hand-made edge fixtures (ties, gaps, bad timestamps, duplicates, zero
prices, short histories, one-sided ledgers, sizing, session gates)."""

import os
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sessionbars.operators import backtest as bt
from sessionbars.operators import execution as ex
from sessionbars.operators import filters
from sessionbars.operators import metrics as mt
from sessionbars.operators.features import build_features, week_features
from sessionbars.operators.sessions import nearest_bar, session_target
from sessionbars.sources.bars import read_bars_csv

BAR_SCHEMA = ("symbol string, ts timestamp_ntz, id long, open double, high double, low double, "
              "close double, volume long")


def bars_df(spark, rows):
    return spark.createDataFrame(
        [(s, datetime.fromisoformat(t), i, c, c, c, c, 1) for i, (s, t, c) in enumerate(rows)], BAR_SCHEMA)


def test_nearest_tie_goes_to_earlier_bar(spark):
    df = bars_df(spark, [("X", "2024-01-02 19:59:30", 10.0), ("X", "2024-01-02 20:00:30", 11.0)])
    r = nearest_bar(df, (20, 0), (19, 21)).first()
    assert r["close"] == 10.0


def test_gaps_drop_days_without_both_windows(spark):
    rows = [("X", "2024-01-02 20:00:00", 10.0), ("X", "2024-01-02 23:00:00", 11.0),   # complete
            ("X", "2024-01-03 18:00:00", 10.0), ("X", "2024-01-03 22:30:00", 11.0),   # no 19-21h bar
            ("X", "2024-01-04 20:00:00", 10.0), ("X", "2024-01-04 21:30:00", 11.0)]   # no 22-23h bar
    got = session_target(bars_df(spark, rows)).collect()
    assert [str(r["date"]) for r in got] == ["2024-01-02"]
    assert abs(got[0]["target"] - 10.0) < 1e-12


def test_bad_timestamps_are_dropped(spark):
    d = tempfile.mkdtemp(prefix="bars-")
    with open(os.path.join(d, "US30.csv"), "w") as f:
        f.write("Date,Time,Open,High,Low,Close,Volume\n")
        f.write("20130231,17:34:00,1,1,1,1,1\n")     # no such date
        f.write("20130930,7:34:00,2,2,2,2,2\n")      # one-digit hour: kept
        f.write("20130930,xx,3,3,3,3,3\n")           # unparsable
    got = read_bars_csv(spark, d).collect()
    assert len(got) == 1 and got[0]["symbol"] == "US30"
    assert str(got[0]["ts"]) == "2013-09-30 07:34:00"


def test_duplicate_timestamp_uses_id_order(spark):
    df = bars_df(spark, [("X", "2024-01-02 20:00:00", 10.0), ("X", "2024-01-02 20:00:00", 12.0),
                         ("X", "2024-01-02 23:00:00", 11.0)])
    got = session_target(df).first()
    assert got["entry_close"] == 10.0


def test_zero_price_gives_null_target_and_dropped_row(spark):
    rows = []
    for day in range(2, 5):
        px = 0.0 if day == 3 else 10.0
        rows += [("X", f"2024-01-0{day} 20:00:00", px), ("X", f"2024-01-0{day} 23:00:00", 11.0)]
    f = build_features(bars_df(spark, rows)).collect()
    assert sorted(str(r["datetime"].date()) for r in f) == ["2024-01-02", "2024-01-04"]


def test_short_history_week_features(spark):
    df = spark.createDataFrame([("X", datetime(2024, 1, 2, 20, 0), 10.0)],
                               "symbol string, datetime timestamp_ntz, day_close_current double")
    r = week_features(df).first()
    assert r["week_volatility"] == 0.0 and r["week_trend"] == 0 and r["week_avg_close"] == 10.0


def _ledger(spark, preds, actuals):
    rows = [("X", datetime(2024, 1, 1) + timedelta(days=i), p, a, 100.0, 0)
            for i, (p, a) in enumerate(zip(preds, actuals))]
    f = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, prediction double, target double, "
                                    "day_close_current double, day_of_week int")
    return bt.backtest(f, None, slice_from=None)


def test_all_wins_profit_factor_inf(spark):
    s = mt.performance_summary(_ledger(spark, [1.0] * 5, [0.5] * 5)).first()
    assert s["profit_factor"] == float("inf") and s["avg_loss_dollars"] == 0.0
    assert s["max_win_streak"] == 5 and s["max_loss_streak"] == 0


def test_all_losses(spark):
    s = mt.performance_summary(_ledger(spark, [1.0] * 5, [-0.5] * 5)).first()
    assert s["profit_factor"] == 0.0 and s["avg_win_dollars"] == 0.0 and s["max_loss_streak"] == 5


def test_zero_prediction_is_sell_and_never_correct(spark):
    led = _ledger(spark, [0.0] * 5, [0.3, -0.3, 0.0, 0.1, -0.1]).orderBy("datetime").collect()
    assert all(r["position"] == -1 and r["predicted_direction"] == "SELL" for r in led)
    assert not any(r["correct_direction"] for r in led)


def test_streaks_and_drawdown_identities(spark):
    led = _ledger(spark, [1.0] * 8, [1.0, 1.0, -1.0, -1.0, -1.0, 1.0, 0.0, 1.0]).orderBy("datetime").toPandas()
    assert list(led["win_streak"]) == [1, 2, 0, 0, 0, 1, 0, 1]
    assert list(led["loss_streak"]) == [0, 0, 1, 2, 3, 0, 0, 0]
    assert (led["portfolio_drawdown"] <= 0).all()
    assert abs(led["daily_pnl"].sum() - (led["equity"].iloc[-1] - led["equity"].iloc[0])) < 1e-6


def test_position_sizing_fixture(spark):
    df = spark.createDataFrame([(34500.0,)], "ask double")
    r = ex.position_size(df, 100000.0).first()
    assert r["volume"] == 0.3


def test_session_gate_inclusive_end_and_weekend(spark):
    rows = [(datetime(2024, 1, 5, 23, 0, 0),), (datetime(2024, 1, 5, 23, 0, 1),),
            (datetime(2024, 1, 6, 20, 0, 0),)]
    df = spark.createDataFrame(rows, "local_ts timestamp_ntz")
    got = [r["in_session"] for r in filters.trading_time_gate(df).orderBy("local_ts").collect()]
    assert got == [True, False, False]


def test_margin_rejects_unknown_side(spark):
    df = spark.createDataFrame([("hold", 1.0, 10.0), ("buy", 1.0, 10.0)],
                               "direction string, volume double, entry_price double")
    got = {r["direction"]: (r["success"], r["error"]) for r in ex.margin_check(df, 1000.0).collect()}
    assert got["hold"] == (False, "invalid order type") and got["buy"] == (True, None)


def test_resolve_tz_aliases():
    assert filters.resolve_tz("UTC+3") == "Europe/Moscow"
    assert filters.resolve_tz("Nowhere/City") == "Europe/Moscow"
    assert filters.resolve_tz("Asia/Tokyo") == "Asia/Tokyo"


@pytest.mark.parametrize("bins", [30, 20])
def test_histogram_counts_every_row(spark, bins):
    df = spark.range(0, 97).select(F.lit("X").alias("symbol"), (F.col("id") * 1.7).alias("v"))
    h = mt.histogram(df, "v", bins).toPandas()
    assert len(h) == bins and h["count"].sum() == 97


def test_instrument_files_overlay_defaults_shallowly(spark):
    import json

    from sessionbars.sources.instruments import load_instruments
    d = tempfile.mkdtemp(prefix="cfg-")
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump({"symbol": "GER40", "volume": 20.0, "trading_hours": {"start": "19:00"}}, f, indent=2)
    with open(os.path.join(d, "b.json"), "w") as f:
        json.dump({"symbol": "US30", "timezone": "US/Eastern"}, f, indent=4)
    got = {r["symbol"]: r for r in load_instruments(spark, d).collect()}
    assert got["GER40"]["volume"] == 20.0 and got["GER40"]["max_daily_trades"] == 5
    # a user trading_hours replaces the whole default struct (no key merge)
    assert got["GER40"]["trading_hours"]["start"] == "19:00" and got["GER40"]["trading_hours"]["end"] is None
    assert got["US30"]["trading_hours"]["end"] == "23:00" and got["US30"]["timezone"] == "US/Eastern"


def test_intra_trade_drawdown_gap_days(spark):
    bars = bars_df(spark, [
        ("X", "2024-01-02 20:00:00", 100.0), ("X", "2024-01-02 21:00:00", 98.0),   # long: dips -2 %
        ("X", "2024-01-02 22:00:00", 99.0),
        ("X", "2024-01-03 20:00:00", 100.0), ("X", "2024-01-03 21:00:00", 101.0),  # long: never below entry
        ("X", "2024-01-05 20:00:30", 50.0), ("X", "2024-01-05 23:10:00", 55.0),    # short: worst at 55
    ])
    trades = spark.createDataFrame(
        [("X", datetime(2024, 1, 2, 20), 1), ("X", datetime(2024, 1, 3, 20), 1),
         ("X", datetime(2024, 1, 4, 20), 1), ("X", datetime(2024, 1, 5, 20), -1)],
        "symbol string, datetime timestamp_ntz, position int")
    got = {str(r["datetime"].date()): r for r in bt.intra_trade_drawdown(trades, bars).collect()}
    d2 = got["2024-01-02"]
    assert abs(d2["max_intra_drawdown_pct"] + 2.0) < 1e-12 and abs(d2["max_intra_drawdown_dollars"] + 10000.0) < 1e-6
    assert str(d2["time_of_max_drawdown"]) == "2024-01-02 21:00:00"
    for day in ("2024-01-03", "2024-01-04"):        # never negative / no bars that day
        r = got[day]
        assert (r["max_intra_drawdown_pct"], r["max_intra_drawdown_dollars"], r["time_of_max_drawdown"]) == (0.0, 0.0, None)
    d5 = got["2024-01-05"]
    assert abs(d5["max_intra_drawdown_pct"] + 10.0) < 1e-12 and str(d5["time_of_max_drawdown"]) == "2024-01-05 23:10:00"


def test_order_gates(spark):
    """A late entry, a short history and a weekend give no order."""
    from datetime import datetime

    from sessionbars.operators import execution as ex
    from sessionbars.sources.instruments import with_defaults
    rows = [(datetime(2024, 1, 3, 20, 0, 30), 100), (datetime(2024, 1, 4, 20, 1, 0), 100),
            (datetime(2024, 1, 5, 20, 0, 0), 99), (datetime(2024, 1, 6, 20, 0, 0), 100)]
    sig = spark.createDataFrame([("x", t, t, n, 1.0, 99.0, 101.0) for t, n in rows],
                                "symbol string, datetime timestamp_ntz, local_ts timestamp_ntz, history_bars long, "
                                "prediction double, bid double, ask double")
    cfg = with_defaults(spark.createDataFrame([("x",)], "symbol string"))
    got = ex.order_signals(sig, cfg, 100_000.0).collect()
    assert [(r["datetime"], r["session_end"]) for r in got] == [(rows[0][0], datetime(2024, 1, 3, 23, 0))]


def test_history_counts_bars_up_to_the_signal(spark):
    from datetime import datetime, timedelta

    from sessionbars.operators.filters import with_history
    t0 = datetime(2024, 1, 3, 10, 0)
    bars = spark.createDataFrame([("x", t0 + timedelta(hours=i)) for i in range(30)], "symbol string, ts timestamp_ntz")
    ask = [("x", t0), ("x", t0), ("x", t0 + timedelta(hours=20)), ("x", t0 + timedelta(days=9)), ("y", t0)]
    got = with_history(spark.createDataFrame(ask, "symbol string, datetime timestamp_ntz"), bars).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted((k, t, n) for (k, t), n in zip(ask, [1, 1, 21, 30, 0]))
