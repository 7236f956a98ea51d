"""Streams over several micro-batches, with late data and after a restart."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sessionbars.operators import execution as ex
from sessionbars.session import stream_path
from sessionbars.sources.bars import resample_bars
from sessionbars.streaming import jobs

T0 = datetime(2024, 3, 4)
TICKS = "symbol string, ts timestamp_ntz, id long, open double, high double, low double, close double, volume long"
TRADES = ("symbol string, entry_ts timestamp_ntz, position_type string, volume double, entry_price double, stop_loss double, "
          "take_profit double, session_end timestamp_ntz")


def at(day, hour, minute=0):
    return T0 + timedelta(days=day, hours=hour, minutes=minute)


def tick(symbol, ts, i, px):
    return (symbol, ts, i, px, px, px, px, 1)


def files(spark, path, batches, schema):
    """One file a batch, in this order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def trade(symbol, day):
    return (symbol, at(day, 10), "LONG", 1.0, 100.0, 90.0, 110.0, at(day, 12))


def test_exits_over_batches_with_late_ticks(spark, tmp_path):
    """A tick late by less than the watermark decides an exit, one later by over a day does not."""
    days = [[tick("a", at(d, 10, 30), 10 * d, 101.0), tick("a", at(d, 11, 45), 10 * d + 1, 102.0), tick("b", at(d, 11, 45), 10 * d + 2, 103.0)] for d in range(4)]
    days[1].append(tick("a", at(0, 11), 90, 89.0))    # 45 minutes behind the newest tick before it
    days[3].append(tick("b", at(0, 11), 91, 89.0))    # over two days behind
    flush = [tick("z", at(30, 12), 99, 1.0)]
    trades = [[trade("a", d), trade("b", d), trade("none", d)] for d in range(4)] + [[trade("z", 30)]]
    ticks = jobs.tick_stream(spark, files(spark, tmp_path / "ticks", [*days, flush], TICKS), spark.createDataFrame([], TICKS).schema, 1)
    live = jobs.tick_stream(spark, files(spark, tmp_path / "trades", trades, TRADES), spark.createDataFrame([], TRADES).schema, 1)
    out = str(tmp_path / "out")
    jobs.run_upsert_log(jobs.stream_exits(ticks, live), out, str(tmp_path / "ck"), mode="append")
    rows = spark.read.parquet(out).collect()
    got = {(r["symbol"], r["entry_ts"]): (r["exit_reason"], r["exit_price"], r["exit_ts"]) for r in rows}
    assert len(rows) == len(got) == 12
    for d in range(4):
        assert got["a", at(d, 10)] == (("SL", 90.0, at(0, 11)) if d == 0 else ("SESSION_END", 102.0, at(d, 11, 45)))
        assert got["b", at(d, 10)] == ("SESSION_END", 103.0, at(d, 11, 45))
        assert got["none", at(d, 10)] == ("NO_BAR", 100.0, at(d, 10))


def test_exits_equal_the_batch_operator(spark, tmp_path):
    """Stops, targets and session ends alike, on ticks that come in any order within a batch."""
    ticks = [tick("ab"[i % 2], at(i // 60, 10, i * 7 % 150), i, 100.0 + (i * 37 % 41 - 20) * (1 + i // 60 % 3) / 4) for i in range(360)]
    trades = [trade(s, d) for d in range(6) for s in "ab"]
    src = files(spark, tmp_path / "ticks", [ticks[i : i + 60] for i in range(0, 360, 60)] + [[tick("z", at(30, 0), 999, 1.0)]], TICKS)
    live = files(spark, tmp_path / "trades", [trades, [trade("z", 30)]], TRADES)
    stream = jobs.stream_exits(jobs.tick_stream(spark, src, spark.read.parquet(src).schema, 1), jobs.tick_stream(spark, live, spark.read.parquet(live).schema))
    out = str(tmp_path / "out")
    jobs.run_upsert_log(stream, out, str(tmp_path / "ck"), mode="append")
    want = ex.barrier_exit(spark.createDataFrame(trades, TRADES), spark.read.parquet(src), hours=(0, 23), until="session_end")
    got = spark.read.parquet(out).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert want.select("exit_reason").distinct().count() >= 2


@pytest.mark.parametrize("max_files", [None, 1])
def test_account_by_the_minute(spark, tmp_path, max_files):
    """Totals of the last marks of each minute; a minute is out once and late quotes change nothing."""
    book = [("a", at(0, 10), "LONG", 1.0, 100.0, at(0, 13)), ("a", at(0, 10), "LONG", 1.0, 100.0, at(0, 13)),
            ("a", at(0, 11, 30), "SHORT", 2.0, 105.0, at(0, 13)), ("b", at(0, 10), "LONG", 1.0, 50.0, at(0, 13))]
    positions = spark.createDataFrame(book, "symbol string, open_time timestamp_ntz, type string, volume double, open_price double, mark_ts timestamp_ntz")
    quotes = [[("a", at(0, 10, 5), 1, 101.0), ("a", at(0, 10, 5) + timedelta(seconds=30), 2, 104.0)],
              [("a", at(0, 12), 3, 110.0), ("b", at(0, 12), 4, 49.0)], [("z", at(1, 0), 5, 1.0)], [("a", at(0, 12), 6, 999.0)][: 1 if max_files else 0]]
    kinds = "symbol string, ts timestamp_ntz, id long, bid double"
    src = files(spark, tmp_path / "quotes", [q for q in quotes if q], kinds)
    stream = jobs.tick_stream(spark, src, spark.createDataFrame([], kinds).schema, max_files).withColumn("ask", F.col("bid") + 1.0)
    out = str(tmp_path / "out")
    jobs.run_upsert_log(jobs.stream_account(stream, positions, 1000.0), out, str(tmp_path / "ck"), mode="append")
    got = {(r["symbol"], r["ts"]): (r["open_positions"], r["profit"], r["margin"], r["equity"]) for r in spark.read.parquet(out).collect()}
    assert got == {("a", at(0, 10, 5)): (2, 40.0, 40.0, 1040.0), ("a", at(0, 12)): (3, 100.0 - 60.0, 40.0 + 42.0, 1040.0), ("b", at(0, 12)): (1, -5.0, 10.0, 995.0)}


def test_streams_go_on_after_a_failure(spark, tmp_path):
    """A job that dies between batches resumes from its named folder: no bar and no trade is lost or counted twice."""
    ticks = [[tick("a", at(d, 10, m % 7), 100 * d + m, float(m)) for m in range(30)] for d in range(4)]
    src = files(spark, tmp_path / "ticks", ticks, TICKS)
    name = f"restart-{tmp_path.name}-{datetime.now().timestamp()}"
    folders = [stream_path(spark, f"{name}/{x}") for x in ("out", "ck")]
    assert folders == [stream_path(spark, f"{name}/{x}") for x in ("out", "ck")]

    def run(fail_at=None):
        def step(batch, batch_id):
            if batch_id == fail_at:
                raise RuntimeError("lost driver")
            return batch

        bars = jobs.stream_bars(jobs.tick_stream(spark, src, spark.read.parquet(src).schema, 1))
        jobs.run_upsert_log(bars, folders[0], folders[1], transform=step)

    with pytest.raises(Exception, match="lost driver"):
        run(fail_at=2)
    done = {r["batch_id"] for r in spark.read.parquet(folders[0]).select("batch_id").distinct().collect()}
    assert done == {0, 1}
    run()
    got = jobs.read_latest(spark, folders[0], ["symbol", "ts"])
    want = resample_bars(spark.read.parquet(src), "M1").select(got.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0

    closed = [[("a", at(d, 15), float(d % 2) - 0.5), ("a", at(d, 16), 2.0)] for d in range(3)]
    kinds, path, where = "symbol string, exit_ts timestamp_ntz, profit double", tmp_path / "closed", [stream_path(spark, f"{name}/{x}") for x in ("days", "days-ck")]
    for n in (2, 3):   # the second run finds one more file
        files(spark, path, closed[:2] if n == 2 else closed[2:], kinds)
        jobs.run_upsert_log(jobs.stream_daily_summary(jobs.tick_stream(spark, str(path), spark.read.parquet(str(path)).schema, 1)), *where)
        days = jobs.read_latest(spark, where[0], ["symbol", "day_start"])
        assert [r["trades"] for r in days.orderBy("day_start").collect()] == [2] * n


def test_signals_read_no_old_bars_for_their_counts(spark, tmp_path, monkeypatch):
    """The bars of each date are counted once, when their batch comes."""
    bars = [[tick("a", at(d, 9 + m // 60, m % 60), 1000 * d + m, 100.0) for m in range(0, 240, 4)] for d in range(3)]
    src = files(spark, tmp_path / "bars", bars, TICKS)
    seen = []
    windows = jobs._signal_windows
    monkeypatch.setattr(jobs, "_signal_windows", lambda stored, counts, *a: seen.append(counts.groupBy("date").agg(F.sum("n").alias("n")).count()) or windows(stored, counts, *a))
    cfg = spark.createDataFrame([], "symbol string, trading_hours struct<start:string,end:string>, min_confidence double, max_positions int, max_daily_trades int, "
                                    "stop_loss_pct double, take_profit_pct double, risk_per_trade double, max_volume double")
    jobs.stream_signals(spark, jobs.tick_stream(spark, src, spark.read.parquet(src).schema, 1), cfg, *[str(tmp_path / x) for x in ("table", "out", "ck")], 1000.0)
    assert seen == [1, 2, 3]
    counted = spark.read.parquet(str(tmp_path / "table_counts"))
    assert counted.agg(F.sum("n")).first()[0] == 180 and counted.count() == 3
