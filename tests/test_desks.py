"""Order limits as two rules, sessions past midnight, and instruments whose configs differ."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF01
from sessionbars.operators import execution as ex
from sessionbars.plans import q_desks
from sessionbars.sources import instruments

T0 = datetime(2024, 1, 2, 20, 0)
SIGNAL = "symbol string, datetime timestamp_ntz, prediction double, bid double, ask double, local_ts timestamp_ntz, history_bars long"
BAR = "symbol string, ts timestamp_ntz, id long, open double, high double, low double, close double"


def config(spark, **keys):
    hours = keys.pop("hours", ("20:00", "23:00"))
    row = spark.createDataFrame([("X", hours)], "symbol string, trading_hours struct<start:string,end:string>")
    return instruments.with_defaults(row.select("*", *[F.lit(v).alias(k) for k, v in keys.items()]))


def signals(spark, seconds):
    rows = [("X", T0 + timedelta(seconds=s), 1.0, 99.0, 100.0, T0 + timedelta(seconds=s), 500) for s in seconds]
    return spark.createDataFrame(rows, SIGNAL)


def bars(spark, prices):
    return spark.createDataFrame([("X", T0 + timedelta(seconds=s), i, p, p, p, p) for i, (s, p) in enumerate(prices)], BAR)


def taken(df):
    return sorted((r["datetime"] - T0).seconds for r in df.collect())


def test_an_early_stop_makes_room_for_a_second_order(spark):
    """One position at a time: the first is stopped out after 15 s, so the order at 20 s is taken, that at 10 s is not."""
    path = bars(spark, [(5, 100.0), (15, 90.0), (40, 100.0), (100, 100.0)])
    asked = signals(spark, [0, 10, 20, 30])
    assert taken(ex.order_signals(asked, config(spark, max_positions=1, max_daily_trades=5), 1e5)) == [0]
    assert taken(ex.order_signals(asked, config(spark, max_positions=1, max_daily_trades=5), 1e5, bars=path)) == [0, 20]
    assert taken(ex.order_signals(asked, config(spark, max_positions=2, max_daily_trades=5), 1e5, bars=path)) == [0, 10, 20, 30]
    # the day's limit counts closed trades as well
    assert taken(ex.order_signals(asked, config(spark, max_positions=2, max_daily_trades=3), 1e5, bars=path)) == [0, 10, 20]
    assert taken(ex.order_signals(asked, config(spark, max_positions=1, max_daily_trades=1), 1e5, bars=path)) == [0]


def test_an_exit_at_the_moment_of_an_order_frees_its_place(spark):
    path = bars(spark, [(20, 90.0), (40, 100.0)])
    got = ex.order_signals(signals(spark, [0, 19, 20]), config(spark, max_positions=1), 1e5, bars=path)
    assert taken(got) == [0, 20] and {r["exit_ts"] for r in got.collect()} == {T0 + timedelta(seconds=20), T0 + timedelta(seconds=40)}


def test_failed_orders_hold_no_place(spark):
    """An order without the margin is reported and neither open nor a trade of the day."""
    path = bars(spark, [(50, 100.0)])
    got = ex.order_signals(signals(spark, [0, 10]), config(spark, max_positions=1), 1.0, bars=path).collect()
    assert len(got) == 2 and not any(r["success"] for r in got) and all(r["exit_ts"] is None for r in got)


def sweep(rows, most, daily):
    kept = []
    for t, x in sorted(rows):
        if sum(y > t for _, y in kept) < most and len(kept) < daily:
            kept.append((t, x))
    return kept


def test_limits_equal_a_loop(spark):
    import random

    rnd = random.Random(3)
    rows = [(f"s{rnd.randrange(4)}", rnd.randrange(3), i, i + rnd.randrange(1, 40), 1 + rnd.randrange(3)) for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, d int, entry_ts long, exit_ts long, tag int").repartition(5)
    df = df.withColumns({"max_positions": F.lit(2), "max_daily_trades": F.lit(9)})
    got = sorted((r["symbol"], r["d"], r["entry_ts"], r["exit_ts"]) for r in ex.position_limits(df, "d").collect())
    want = []
    for key in {(s, d) for s, d, *_ in rows}:
        want += [(*key, t, x) for t, x in sweep([(t, x) for s, d, t, x, _ in rows if (s, d) == key], 2, 9)]
    assert got == sorted(want)


def test_a_session_past_midnight_takes_both_dates(spark):
    entry = datetime(2024, 1, 2, 23, 30)
    trades = spark.createDataFrame([("X", entry, "LONG", 100.0, 90.0, 120.0, 1.0, entry + timedelta(hours=3)),
                                    ("X", entry, "LONG", 100.0, 50.0, 999.0, 1.0, entry + timedelta(hours=3))],
                                   "symbol string, entry_ts timestamp_ntz, position_type string, entry_price double, stop_loss double, take_profit double, volume double, session_end timestamp_ntz")
    path = [(entry + timedelta(minutes=m), p) for m, p in [(10, 101.0), (60, 89.0), (170, 130.0), (200, 40.0)]]
    b = spark.createDataFrame([("X", t, i, p, p, p, p) for i, (t, p) in enumerate(path)], BAR)
    got = sorted((r["exit_reason"], r["exit_price"], r["exit_ts"]) for r in ex.barrier_exit(trades, b, hours=(0, 23), until="session_end").collect())
    assert got == [("SESSION_END", 130.0, entry + timedelta(minutes=170)), ("SL", 90.0, entry + timedelta(minutes=60))]


def test_desks_trade_in_their_own_hours(spark):
    """Every order stands in its desk's first minute, Monday to Friday, on the desk's own clock."""
    from zoneinfo import ZoneInfo

    starts = {z: start for z, start, *_ in q_desks.DESKS}
    got = q_desks.q_order_signals_desks(spark, SF01).collect()
    assert len(got) >= 100 and {r["symbol"].split("/", 1)[1] for r in got} == set(starts)
    crossing = 0
    for r in got:
        zone = r["symbol"].split("/", 1)[1]
        local = r["datetime"].replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(zone)).replace(tzinfo=None)
        assert local == r["local_ts"] and local.strftime("%H:%M") == starts[zone] and local.weekday() < 5
        crossing += local.date() != (r["datetime"] + timedelta(hours=4)).date()
    assert crossing
    assert q_desks.q_open_positions_desks(spark, SF01).count() > 0
