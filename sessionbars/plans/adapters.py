"""Map the driver's generic tables onto the bar / daily-series model.

* ``events``  -> ticks: symbol = event_type, price = value, id = event_id
                 (degenerate bars: open = high = low = close = value, volume 1).
* ``orders``  -> daily series: symbol = o_orderpriority, one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BAR_COLUMNS = ["symbol", "ts", "id", "open", "high", "low", "close", "volume"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    px = F.col("value").cast("double")
    return ev.select(F.col("event_type").alias("symbol"), F.col("ts"), F.col("event_id").alias("id"),
                     px.alias("open"), px.alias("high"), px.alias("low"), px.alias("close"),
                     F.lit(1).cast("long").alias("volume"))


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bars: one bar per order at its (midnight) date, ordered by key."""
    o = table(spark, sf_dir, "orders")
    px = F.col("o_totalprice").cast("double")
    return o.select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("ts"),
                    F.col("o_orderkey").alias("id"), px.alias("open"), px.alias("high"),
                    px.alias("low"), px.alias("close"), F.lit(1).cast("long").alias("volume"))


def order_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a daily price series per priority, shaped like feature rows:
    datetime (midnight), day_of_week, day_open (first order by key),
    day_close_current (last order), target = % change open -> close, and a
    rule prediction = the previous day's change (no model needed, so the
    backtest has an exact SQL twin)."""
    from pyspark.sql import Window

    b = order_bars(spark, sf_dir).withColumn("date", F.to_date("ts"))
    d = b.groupBy("symbol", "date").agg(
        F.min(F.struct("ts", "id", "close"))["close"].alias("day_open"),
        F.max(F.struct("ts", "id", "close"))["close"].alias("day_close_current"),
        F.count(F.lit(1)).cast("long").alias("day_volume"))
    d = (d.withColumn("datetime", F.col("date").cast("timestamp_ntz"))
          .withColumn("day_of_week", F.weekday("date"))
          .withColumn("target", F.try_divide(F.col("day_close_current") - F.col("day_open"),
                                             F.col("day_open")) * F.lit(100.0)))
    w = Window.partitionBy("symbol").orderBy("datetime")
    return (d.withColumn("prediction", F.lag("target").over(w))
             .select("symbol", "datetime", "day_of_week", "day_open", "day_close_current",
                     "day_volume", "target", "prediction"))
