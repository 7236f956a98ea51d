"""Per-instrument parameters from JSON config files.

A user file replaces a default key as a whole (a user ``trading_hours``
replaces both start and end) — the reference's shallow dictionary update.
The result is one row per instrument, small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reference's default live-trading configuration.
DEFAULT_CONFIG = {
    "broker_type": "simulator",
    "symbol": "US30",
    "volume": 0.1,
    "max_positions": 1,
    "max_daily_trades": 5,
    "stop_loss_pct": 2.0,
    "take_profit_pct": 3.0,
    "trading_hours": {"start": "20:00", "end": "23:00"},
    "timezone": "Europe/Moscow",
    "model_path": "trained_model.pkl",
    "min_confidence": 0.5,
    "risk_per_trade": 1.0,
    "data_lookback": 1440,
    "initial_balance": 100000.0,
    "max_volume": 1.0,
}

HOURS_TYPE = T.StructType([T.StructField("start", T.StringType()), T.StructField("end", T.StringType())])
CONFIG_SCHEMA = T.StructType([
    T.StructField("broker_type", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("max_positions", T.IntegerType()),
    T.StructField("max_daily_trades", T.IntegerType()),
    T.StructField("stop_loss_pct", T.DoubleType()),
    T.StructField("take_profit_pct", T.DoubleType()),
    T.StructField("trading_hours", HOURS_TYPE),
    T.StructField("timezone", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("min_confidence", T.DoubleType()),
    T.StructField("risk_per_trade", T.DoubleType()),
    T.StructField("data_lookback", T.IntegerType()),
    T.StructField("initial_balance", T.DoubleType()),
    T.StructField("max_volume", T.DoubleType()),
])


def _default(name: str, dtype: T.DataType):
    v = DEFAULT_CONFIG[name]
    if isinstance(dtype, T.StructType):
        return F.struct(*[F.lit(v[f.name]).cast(f.dataType).alias(f.name) for f in dtype.fields])
    return F.lit(v).cast(dtype)


def load_instruments(spark: SparkSession, paths: str | list[str], multiline: bool = True) -> DataFrame:
    """Read config files (explicit schema), overlay them on the defaults."""
    raw = spark.read.schema(CONFIG_SCHEMA).option("multiLine", multiline).json(paths)
    return with_defaults(raw)


def with_defaults(raw: DataFrame) -> DataFrame:
    cols = []
    for f in CONFIG_SCHEMA.fields:
        c = F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType)
        cols.append(F.coalesce(c, _default(f.name, f.dataType)).alias(f.name))
    return raw.select(*cols)


def write_instruments(cfg: DataFrame, path: str) -> None:
    """Write configs as JSON lines; NULL keys are omitted (so they default)."""
    cfg.write.mode("overwrite").json(path)
