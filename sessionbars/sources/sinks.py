"""Trade-ledger export and read-back with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sessionbars.operators.backtest import LEDGER_COLUMNS

LEDGER_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType())]
    + [T.StructField(c, {
        "datetime": T.TimestampNTZType(), "time_of_max_drawdown": T.TimestampNTZType(),
        "predicted_direction": T.StringType(), "actual_direction": T.StringType(),
        "correct_direction": T.BooleanType(), "win_trade": T.BooleanType(), "loss_trade": T.BooleanType(),
        "position": T.IntegerType(), "day_of_week": T.IntegerType(),
    }.get(c, T.DoubleType())) for c in LEDGER_COLUMNS])

NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_ledger(ledger: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the 20 exported columns, partitioned by symbol."""
    out = ledger.select("symbol", *LEDGER_COLUMNS)
    w = out.write.mode("overwrite").partitionBy("symbol")
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", NTZ_FORMAT).csv(path)
    else:
        w.format(fmt).save(path)


def read_ledger(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        df = (spark.read.schema(LEDGER_SCHEMA).option("header", True)
              .option("timestampNTZFormat", NTZ_FORMAT).csv(path))
    else:
        df = spark.read.format(fmt).load(path)
    return df.select("symbol", *LEDGER_COLUMNS)
