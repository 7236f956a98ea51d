"""Plan-shape checks: no cartesian products, no Python evaluation in the
batch operators, no single-partition exchanges, pushdown and pruning."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from sessionbars.operators import backtest as bt
from sessionbars.operators.features import build_features
from sessionbars.plans.adapters import event_bars
from sessionbars.plans.q_sessions import session_bars


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def feature_plan(spark):
    spark.catalog.clearCache()
    return plan(build_features(event_bars(spark, SF01)))


def test_features_plan_is_jvm_only(feature_plan):
    assert "CartesianProduct" not in feature_plan
    assert "BatchEvalPython" not in feature_plan and "ArrowEvalPython" not in feature_plan
    assert "SinglePartition" not in feature_plan


def test_features_scan_prunes_columns(feature_plan):
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in feature_plan


def test_backtest_plan(spark):
    f = build_features(event_bars(spark, SF01)).withColumn("prediction", F.col("current_macd"))
    p = plan(bt.backtest(f, session_bars(spark, SF01)))
    assert "CartesianProduct" not in p and "BatchEvalPython" not in p


def test_last_n_limits_before_the_shuffle(spark):
    from sessionbars.sources.bars import last_n_bars
    p = plan(last_n_bars(event_bars(spark, SF01), 100))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_block_join_back_keeps_bar_partitioning(spark):
    """Without broadcast (as at 100 TB), the sort-merge join-back must shuffle
    only the block table: no exchange of the bars on the sub-block key."""
    import re
    spark.catalog.clearCache()
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        p = build_features(event_bars(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in p
    assert not re.search(r"Exchange hashpartitioning\(symbol#\d+, _date#\d+, _sub#\d+", p)
    # one hash exchange of the bars per branch on (symbol, _date); the daily aggregate reuses it
    assert not re.search(r"Exchange hashpartitioning\(symbol#\d+, date#\d+", p)


def test_bar_store_prunes_dates_and_pushes_symbols(spark):
    import tempfile

    from sessionbars.sources.bars import read_bars_parquet, write_bars_parquet
    path = tempfile.mkdtemp(prefix="bar-store-")
    write_bars_parquet(event_bars(spark, SF01), path)
    df = read_bars_parquet(spark, path, "2024-01-08", "2024-01-09", ["click"])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in p and "2024-01-08" in p
    assert "PushedFilters: [In(symbol" in p or "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,click)" in p
    assert df.count() == event_bars(spark, SF01).filter(
        (F.to_date("ts").between("2024-01-08", "2024-01-09")) & (F.col("symbol") == "click")).count()
