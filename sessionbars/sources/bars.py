"""Bar scans.

Minute-bar files have the reference layout ``Date,Time,Open,High,Low,Close,Volume``
(Date as yyyymmdd, Time as H:MM:SS).  They are read with an explicit schema
(no inference pass), the timestamp is assembled with ``try_to_timestamp`` so a
bad cell becomes NULL and the row is dropped, and the result is the common
Bar schema ``symbol, ts, id, open, high, low, close, volume``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_BAR_SCHEMA = T.StructType([
    T.StructField("Date", T.IntegerType()),
    T.StructField("Time", T.StringType()),
    T.StructField("Open", T.FloatType()),
    T.StructField("High", T.FloatType()),
    T.StructField("Low", T.FloatType()),
    T.StructField("Close", T.FloatType()),
    T.StructField("Volume", T.IntegerType()),
])

# Fixed value: accepts one- or two-digit hours, as the reference's parser does.
TS_PATTERN = "yyyyMMdd H:mm:ss"

TIMEFRAMES = {"M1": "1 minute", "M5": "5 minutes", "M15": "15 minutes", "H1": "1 hour", "D1": "1 day"}


def read_bars_csv(spark: SparkSession, paths: str | list[str], symbol: str | None = None) -> DataFrame:
    """Typed CSV scan.  ``symbol`` names the instrument; without it the
    file name (without extension) is used, so one call reads many instruments."""
    raw = (spark.read.schema(RAW_BAR_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
           .csv(paths))
    if symbol:
        sym = F.lit(symbol)
    else:
        path = F.input_file_name()
        folder = F.regexp_extract(path, r"symbol=([^/]+)/", 1)
        stem = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
        sym = F.when(folder != "", F.url_decode(folder)).otherwise(stem)
    return normalise_bars(assemble_ts(raw.withColumn("symbol", sym)))


def assemble_ts(raw: DataFrame, date: str = "Date", time: str = "Time", out: str = "ts") -> DataFrame:
    """Yyyymmdd + H:MM:SS -> TIMESTAMP_NTZ; unparsable rows are dropped."""
    s = F.concat_ws(" ", F.col(date).cast("string"), F.col(time))
    ts = F.try_to_timestamp(s, F.lit(TS_PATTERN)).cast("timestamp_ntz")
    return raw.withColumn(out, ts).filter(F.col(out).isNotNull())


def normalise_bars(df: DataFrame) -> DataFrame:
    """Lower-case names, doubles for prices, bigint volume, and a row id
    (scan order) that breaks ties between equal timestamps."""
    lower = {c: c.lower() for c in df.columns}
    d = df.select(*[F.col(c).alias(lower[c]) for c in df.columns])
    if "id" not in d.columns:
        d = d.withColumn("id", F.monotonically_increasing_id())
    return d.select("symbol", "ts", F.col("id").cast("long").alias("id"),
                    *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                    F.col("volume").cast("long").alias("volume"))


def bars_from_epoch(df: DataFrame, time: str = "time", volume: str = "tick_volume") -> DataFrame:
    """Broker bars (epoch seconds, tick_volume) -> Bar schema."""
    return (df.withColumn("ts", F.timestamp_seconds(F.col(time)).cast("timestamp_ntz"))
              .withColumnRenamed(volume, "volume")
              .select("symbol", "ts", F.col("id").cast("long").alias("id"),
                      *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                      F.col("volume").cast("long").alias("volume")))


def write_bars_csv(bars: DataFrame, path: str) -> None:
    """Write bars in the reference's file layout, one folder per symbol."""
    out = bars.select(
        "symbol",
        F.date_format("ts", "yyyyMMdd").cast("int").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
        F.col("close").alias("Close"), F.col("volume").cast("int").alias("Volume"))
    out.write.mode("overwrite").option("header", True).partitionBy("symbol").csv(path)


def last_n_bars(bars: DataFrame, n: int, key: str = "symbol", ts: str = "ts", tie: str = "id") -> DataFrame:
    """Newest n bars per symbol.  ``row_number <= n`` is planned as a
    window group limit, applied map-side before the shuffle (at most n rows
    per symbol per task cross the network)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc(), F.col(tie).desc())
    return bars.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def resample_bars(bars: DataFrame, timeframe: str = "M1", key: str = "symbol", ts: str = "ts",
                  tie: str = "id") -> DataFrame:
    """OHLCV bars at M1/M5/M15/H1/D1 (window start as ``ts``).  First and
    last are ordered picks (min/max of (ts, id, price)), not scan order."""
    width = TIMEFRAMES[timeframe]
    g = bars.groupBy(key, F.window(F.col(ts), width).alias("_w")).agg(
        F.min(F.struct(F.col(ts), F.col(tie), F.col("open").alias("v")))["v"].alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max(F.struct(F.col(ts), F.col(tie), F.col("close").alias("v")))["v"].alias("close"),
        F.sum("volume").cast("long").alias("volume"),
        F.count(F.lit(1)).cast("long").alias("ticks"),
        F.min(F.col(tie)).alias("id"))
    return g.select(key, F.col("_w.start").alias(ts), "id", "open", "high", "low", "close", "volume", "ticks")


def write_bars_parquet(bars: DataFrame, path: str, files_per_day: int | None = None) -> None:
    """Store bars as Parquet partitioned by ``date`` and sorted by (symbol, ts)
    inside each file, so date ranges prune whole folders and symbol / time
    predicates skip row groups by their min/max statistics.

    ``files_per_day`` spreads each day over that many files by a hash of the
    symbol (a hot day is not one file); default: one hash spread of the
    session's shuffle partitions."""
    d = bars.withColumn("date", F.to_date("ts"))
    if files_per_day:
        d = d.repartition(files_per_day, "date", "symbol")
    d = d.sortWithinPartitions("date", "symbol", "ts", "id")
    d.write.mode("overwrite").partitionBy("date").parquet(path)


def read_bars_parquet(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                      symbols: list[str] | None = None) -> DataFrame:
    """Scan stored bars; ``start``/``end`` (inclusive dates) prune partitions,
    ``symbols`` is pushed to the Parquet reader."""
    df = spark.read.parquet(path)
    if start:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    if symbols:
        df = df.filter(F.col("symbol").isin(list(symbols)))
    return df.select("symbol", "ts", "id", "open", "high", "low", "close", "volume")
