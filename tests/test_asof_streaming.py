"""As-of join vs brute force, and streaming jobs vs their batch twins."""

import random
from datetime import datetime, timedelta

import pytest

from conftest import SF01
from sessionbars.operators.asof import asof_join
from sessionbars.plans import q_execution, q_streaming


@pytest.mark.parametrize("bucket", ["day", "hour", "measured", 7])
def test_asof_matches_brute_force(spark, bucket):
    rnd = random.Random(7)
    t0 = datetime(2024, 1, 1)
    left, right = [], []
    for k in ("hot", "a", "b"):
        n_r = 3000 if k == "hot" else 40
        for i in range(n_r):
            # right rows on a few days only (gaps of several days), many equal timestamps
            day = rnd.choice([0, 1, 5, 9]) if k != "b" else 3
            right.append((k, t0 + timedelta(days=day, minutes=rnd.randrange(0, 1440)), i, float(i)))
        for i in range(200):
            left.append((k, t0 + timedelta(days=rnd.randrange(0, 12), minutes=rnd.randrange(0, 1440)), i))
    L = spark.createDataFrame(left, "k string, t timestamp_ntz, lid long")
    R = spark.createDataFrame(right, "k string, rt timestamp_ntz, rid long, v double")
    got = {(r["k"], r["lid"]): (r["v"], r["asof_ts"])
           for r in asof_join(L, R, "k", "t", "rt", ["v"], right_tie="rid", bucket=bucket).collect()}
    assert len(got) == len(left)
    for k, t, lid in left:
        cands = [(rt, rid, v) for (rk, rt, rid, v) in right if rk == k and rt <= t]
        want = (max(cands)[2], max(cands)[0]) if cands else (None, None)
        assert got[(k, lid)] == want, (k, t, lid)


def test_asof_nulls_match_nothing(spark):
    t = datetime(2024, 1, 1, 12)
    left = spark.createDataFrame([(None, t, 1), ("a", None, 2), ("a", t, 3), ("z", t, 4)], "k string, t timestamp_ntz, lid long")
    right = spark.createDataFrame([(None, t, 1.0), ("a", None, 2.0), ("a", t - timedelta(days=400), 3.0), ("y", t, 4.0)], "k string, rt timestamp_ntz, v double")
    got = {r["lid"]: r["v"] for r in asof_join(left, right, "k", "t", "rt", ["v"]).collect()}
    assert got == {1: None, 2: None, 3: 3.0, 4: None}


def test_asof_reads_the_right_side_twice_and_prunes_it(spark, tmp_path):
    """Two scans of the quotes, no calendar, and only rows of asked buckets are sorted."""
    t0 = datetime(2024, 1, 1)
    quotes = [("a" if i % 2 else "b", t0 + timedelta(hours=i), i, float(i)) for i in range(2000)]
    spark.createDataFrame(quotes, "k string, rt timestamp_ntz, rid long, v double").write.parquet(f"{tmp_path}/quotes")
    right = spark.read.parquet(f"{tmp_path}/quotes")
    left = spark.createDataFrame([("a", t0 + timedelta(days=40, hours=5), 1)], "k string, t timestamp_ntz, lid long")
    j = asof_join(left, right, "k", "t", "rt", ["v"], right_tie="rid")
    assert [r["v"] for r in j.collect()] == [965.0]
    p = j._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("parquet") == 2 and "sequence(" not in p and p.count("Join LeftSemi") == 2


def test_stream_positions_equal_barrier_twin(spark):
    stream = q_streaming.q_stream_positions(spark, SF01).toPandas()
    batch = q_execution.barrier(spark, SF01).toPandas()
    # the stream closes a session-end position once event time passes the
    # session end; the last day's open positions are still open in state
    last_day = batch["entry_ts"].max().normalize()
    batch = batch[batch["entry_ts"] < last_day]
    stream = stream[stream["open_time"] < last_day]
    b = {(r.symbol, r.entry_ts): (r.exit_reason, round(r.exit_price, 6), r.exit_ts) for r in batch.itertuples()}
    s = {(r.symbol, r.open_time): (r.exit_reason, round(r.exit_price, 6), r.exit_ts) for r in stream.itertuples()}
    assert b == s


def test_stream_bars_equal_batch_resample(spark):
    from sessionbars.plans.adapters import event_bars
    from sessionbars.sources.bars import resample_bars
    s = q_streaming.q_stream_bars(spark, SF01)
    b = resample_bars(event_bars(spark, SF01), "M1")
    cols = ["symbol", "ts", "id", "open", "high", "low", "close", "volume", "ticks"]
    assert s.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(s.select(*cols)).count() == 0


def test_stream_signals_do_not_depend_on_the_batches(spark, tmp_path):
    """Every day's orders come, whether a batch brings one day, a piece of a day or all."""
    from pyspark.sql import functions as F

    from sessionbars.plans.adapters import event_bars
    from sessionbars.plans.q_sources import instrument_table
    from sessionbars.streaming import jobs

    # ten weekdays of five-minute bars with a first minute at 20:00, and a price that swings
    t0, rows = datetime(2024, 3, 4), []
    symbol = event_bars(spark, SF01).select("symbol").orderBy("symbol").first()[0]
    days = [d for d in range(14) if d % 7 < 5]
    for d in days:
        for m in range(9 * 60, 21 * 60 + 30, 5):
            px = 100.0 + (d % 3 - 1) * (m - 900) / 20.0
            rows.append((symbol, t0 + timedelta(days=d, minutes=m), len(rows), px, px, px, px, 1))
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, id long, open double, high double, low double, "
                                       "close double, volume long")
    cfg, got = instrument_table(spark, SF01).persist(), {}
    for name, cuts in {"one": [len(rows)], "many": [100, 431, 700, 1111, len(rows)]}.items():
        src, lo = str(tmp_path / name), 0
        for hi in cuts:
            bars.filter((F.col("id") >= lo) & (F.col("id") < hi)).coalesce(1).write.mode("append").parquet(src)
            lo = hi
        paths = [str(tmp_path / f"{name}-{x}") for x in ("bars", "out", "ck")]
        stream = jobs.tick_stream(spark, src, bars.schema, max_files=1 if name == "many" else None)
        jobs.stream_signals(spark, stream, cfg, paths[0], paths[1], paths[2], 100_000.0)
        got[name] = sorted(tuple(r) for r in jobs.read_signals(spark, paths[1]).drop("error").collect())
    assert got["one"] == got["many"]
    assert len(got["one"]) > 3 and len({r[1].date() for r in got["one"]}) == len(got["one"])
