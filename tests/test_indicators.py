"""Indicator scan vs short pandas definitions, and block-layout invariance."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from sessionbars.operators.indicators import ewm_mean, with_indicators
from sessionbars.plans.adapters import event_bars


def pandas_indicators(pdf: pd.DataFrame) -> pd.DataFrame:
    """Textbook definitions, one symbol at a time (test twin only)."""
    out = []
    for _, g in pdf.sort_values(["symbol", "ts", "id"]).groupby("symbol", sort=False):
        c = g["close"].astype(float)
        g = g.copy()
        g["sma_15"] = c.rolling(15, min_periods=1).mean()
        g["sma_30"] = c.rolling(30, min_periods=1).mean()
        d = c.diff()
        up = d.where(d > 0, 0.0)
        dn = -d.where(d < 0, 0.0)
        eu = up.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
        ed = dn.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
        g["rsi"] = np.where(ed == 0, 100.0, 100 - 100 / (1 + eu / ed))
        g.loc[ed.isna(), "rsi"] = np.nan
        g["macd"] = c.ewm(span=12).mean() - c.ewm(span=26).mean()
        out.append(g)
    return pd.concat(out)


@pytest.fixture(scope="module")
def bars(spark):
    b = event_bars(spark, SF01).filter(F.hour("ts").between(9, 23)).cache()
    yield b
    b.unpersist()


def _merge(spark_df, ref):
    got = spark_df.toPandas()
    return got.merge(ref, on=["symbol", "id"], suffixes=("", "_ref"))


def test_indicators_match_pandas(spark, bars):
    ref = pandas_indicators(bars.toPandas())
    m = _merge(with_indicators(bars), ref[["symbol", "id", "sma_15", "sma_30", "rsi", "macd"]])
    assert len(m) == bars.count()
    for c in ("sma_15", "sma_30", "macd"):
        assert np.allclose(m[c], m[c + "_ref"], rtol=1e-9, atol=1e-9), c
    both = m["rsi"].notna() & m["rsi_ref"].notna()
    assert (m["rsi"].isna() == m["rsi_ref"].isna()).all()
    assert np.allclose(m.loc[both, "rsi"], m.loc[both, "rsi_ref"], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("slice_minutes,sub_rows", [(60, 512), (None, 8), (30, 3)])
def test_block_layout_does_not_change_results(spark, bars, slice_minutes, sub_rows):
    base = with_indicators(bars).select("symbol", "id", "sma_15", "sma_30", "rsi", "macd")
    alt = with_indicators(bars, slice_minutes=slice_minutes, sub_rows=sub_rows).select(
        "symbol", "id", *[F.col(c).alias(c + "_alt") for c in ("sma_15", "sma_30", "rsi", "macd")])
    m = base.join(alt, ["symbol", "id"]).toPandas()
    assert len(m) == bars.count()
    for c in ("sma_15", "sma_30", "rsi", "macd"):
        a, b = m[c], m[c + "_alt"]
        assert (a.isna() == b.isna()).all(), c
        ok = a.notna()
        assert np.allclose(a[ok], b[ok], rtol=1e-9, atol=1e-9), c


def test_ewm_adjust_false_matches_pandas(spark, bars):
    got = ewm_mean(bars, "close", alpha=0.3, adjust=False, out="e").toPandas()
    ref = bars.toPandas().sort_values(["symbol", "ts", "id"])
    ref["e_ref"] = ref.groupby("symbol")["close"].transform(lambda s: s.ewm(alpha=0.3, adjust=False).mean())
    m = got.merge(ref[["symbol", "id", "e_ref"]], on=["symbol", "id"])
    assert np.allclose(m["e"], m["e_ref"], rtol=1e-9, atol=1e-9)


def test_constant_series(spark):
    from datetime import datetime, timedelta
    rows = [("X", datetime(2024, 1, 2, 10, 0) + timedelta(minutes=i), i, 5.0, 5.0, 5.0, 5.0, 1)
            for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, id long, open double, high double, "
                                     "low double, close double, volume long")
    got = with_indicators(df).orderBy("id").toPandas()
    assert np.allclose(got["sma_15"], 5.0) and np.allclose(got["sma_30"], 5.0)
    assert np.allclose(got["macd"], 0.0, atol=1e-12)
    assert got["rsi"].iloc[:13].isna().all()
    assert (got["rsi"].iloc[13:] == 100.0).all()


def test_days_of_few_and_of_many_blocks(spark):
    """Carries over days with one row, over a day longer than the horizon, and over gaps."""
    from datetime import datetime, timedelta

    rng, rows, t0 = np.random.default_rng(5), [], datetime(2024, 1, 1)
    for day, n in enumerate([1, 1, 2, 1500, 1, 3, 1400, 1, 1, 40]):
        for i in range(n):
            rows.append(("X", t0 + timedelta(days=2 * day, seconds=i), len(rows), float(rng.normal(100, 5))))
    rows += [("Y", t0 + timedelta(days=i), len(rows) + i, float(rng.normal(50, 5))) for i in range(900)]
    pdf = pd.DataFrame(rows, columns=["symbol", "ts", "id", "close"])
    ref = pandas_indicators(pdf)[["symbol", "id", "sma_15", "sma_30", "rsi", "macd"]]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, id long, close double").repartition(3)
    for how in ({}, {"sub_rows": 16}, {"sub_rows": 7, "slice_minutes": 5}):
        m = _merge(with_indicators(df, **how), ref)
        assert len(m) == len(rows)
        for c in ("sma_15", "sma_30", "rsi", "macd"):
            assert (m[c].isna() == m[c + "_ref"].isna()).all(), (c, how)
            ok = m[c].notna()
            assert np.allclose(m.loc[ok, c], m.loc[ok, c + "_ref"], rtol=1e-9, atol=1e-9), (c, how)
    e = ewm_mean(df, "close", alpha=0.2, adjust=False, out="e", sub_rows=16).toPandas().merge(pdf[["id", "symbol", "close"]], on=["symbol", "id"])
    e = e.sort_values(["symbol", "id"])
    assert np.allclose(e["e"], e.groupby("symbol")["close_x"].transform(lambda s: s.ewm(alpha=0.2, adjust=False).mean()), rtol=1e-9)


def test_measured_slices(spark):
    from datetime import datetime, timedelta

    from sessionbars.operators.indicators import measured_slices
    rows = [("X", datetime(2024, 1, 1, 10) + timedelta(seconds=10 * i), i, 1.0 + i % 7) for i in range(720)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, id long, close double")
    assert [measured_slices(df, rows=n) for n in (720, 360, 90, 30, 6, 1)] == [None, 60, 15, 5, 1, 1]
    assert measured_slices(df.limit(0)) is None
    a, b = (with_indicators(df, slice_minutes=w).orderBy("id").toPandas() for w in (None, "measured"))
    assert a.equals(b)


def test_windows_on_a_symbol_see_days_only(spark, bars):
    """Every window on the symbol alone stands on the aggregate of (symbol, date)."""
    import re
    p = with_indicators(bars, slice_minutes=60, sub_rows=64)._jdf.queryExecution().optimizedPlan().toString()
    lines = p.splitlines()
    alone = [n for n, x in enumerate(lines) if re.search(r"Window \[.*\], \[symbol#\d+\],", x)]
    assert alone
    for n in alone:
        below = next(x for x in lines[n + 1 :] if "Aggregate" in x)
        assert re.search(r"Aggregate \[symbol#\d+, _date#\d+\],", below), below
