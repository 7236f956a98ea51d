"""Property tests (hypothesis): the blocked scan equals the textbook
definitions for any series and any block layout; resampling composes."""

from datetime import datetime, timedelta

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF01
from sessionbars.operators.indicators import with_indicators
from sessionbars.plans.adapters import event_bars
from sessionbars.sources.bars import resample_bars
from test_indicators import pandas_indicators

SCHEMA = ("symbol string, ts timestamp_ntz, id long, open double, high double, low double, "
          "close double, volume long")


@st.composite
def series(draw):
    rows, rid = [], 0
    for sym in ("A", "B")[: draw(st.integers(1, 2))]:
        n = draw(st.integers(1, 120))
        gaps = draw(st.lists(st.integers(0, 400), min_size=n, max_size=n))   # minutes, 0 = same time
        prices = draw(st.lists(st.floats(1.0, 500.0, allow_nan=False), min_size=n, max_size=n))
        t = datetime(2024, 1, 1, 9)
        for g, p in zip(gaps, prices):
            t += timedelta(minutes=g)
            rows.append((sym, t, rid, p, p, p, round(p, 2), 1))
            rid += 1
    return rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=series(), sub_rows=st.sampled_from([2, 5, 64, 512]), slice_minutes=st.sampled_from([None, 60, 240]))
def test_blocked_scan_equals_definitions(spark, rows, sub_rows, slice_minutes):
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_indicators(df, slice_minutes=slice_minutes, sub_rows=sub_rows).toPandas()
    ref = pandas_indicators(df.toPandas())
    m = got.merge(ref[["symbol", "id", "sma_15", "sma_30", "rsi", "macd"]], on=["symbol", "id"],
                  suffixes=("", "_ref"))
    assert len(m) == len(rows)
    for c in ("sma_15", "sma_30", "rsi", "macd"):
        a, b = m[c].astype(float), m[c + "_ref"].astype(float)
        assert (a.isna() == b.isna()).all(), c
        ok = a.notna()
        assert np.allclose(a[ok], b[ok], rtol=1e-9, atol=1e-7), c


def test_resample_composes(spark):
    bars = event_bars(spark, SF01)
    direct = resample_bars(bars, "H1")
    via = resample_bars(resample_bars(resample_bars(bars, "M1"), "M15"), "H1")
    cols = ["symbol", "ts", "open", "high", "low", "close", "volume"]
    assert direct.select(*cols).exceptAll(via.select(*cols)).count() == 0
    assert via.select(*cols).exceptAll(direct.select(*cols)).count() == 0
    assert via.agg(F.sum("volume")).first()[0] == bars.count()
