"""As-of join: each left row gets the latest right row at or before its time.

Spark has no native as-of join.  The plan is a bucketed two-pass scan, so a
hot key (one instrument with a third of all quotes) is still spread over
many tasks:

1. both sides get a time bucket: a day, or fewer minutes where a day holds too
   many rows (``bucket="measured"`` counts them and chooses);
2. the right side's keys that the left side asks for are reduced to their last
   row per (key, bucket), a partial aggregate; a window over these rows and
   the buckets in which left rows stand carries the last right row of any
   *earlier* bucket to each of the latter.  Only buckets that exist are rows
   here: no calendar is laid out;
3. right rows in a bucket without left rows can be nobody's in-bucket match
   and go no further (a semi join).  Inside each remaining (key, bucket) the
   two sides are unioned and ordered by time (right before left on equal time);
   ``last(..., ignorenulls)`` over the running frame gives the in-bucket match,
   and a left row without one takes what was carried to its bucket.

No pairs are generated, a left row travels through the union whole (as a
struct), and the right side is read twice: once for the aggregate, once,
pruned, for the union.  A null key or time matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.functions.columns import micros_of_day
from sessionbars.operators.indicators import measured_slices

_MINUTES = {"day": 1440, "hour": 60}


def _bucket(ts: Column, minutes: int) -> Column:
    """The number of the clock slice a time is in; rises with time."""
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return day * F.lit(-(-1440 // minutes)) + F.floor(micros_of_day(ts) / F.lit(minutes * 60_000_000)).cast("long")


def asof_join(left: DataFrame, right: DataFrame, by: list[str] | str, left_ts: str, right_ts: str,
              right_cols: list[str], right_tie: str | None = None, bucket: str | int = "day",
              prefix: str = "") -> DataFrame:
    """LEFT as-of join on ``by`` with ``right_ts <= left_ts`` (inclusive).

    Returns every left row plus ``right_cols`` (prefixed) and the matched
    right timestamp ``<prefix>asof_ts`` (NULL when nothing precedes).  Equal
    right timestamps are ordered by ``right_tie`` (the highest wins).
    ``bucket``: "day", "hour", a number of minutes, or "measured"."""
    by = [by] if isinstance(by, str) else list(by)
    minutes = _MINUTES.get(bucket, bucket)
    if bucket == "measured":
        minutes = measured_slices(right, by, right_ts) or 1440
    out_cols = [f"{prefix}{c}" for c in right_cols] + [f"{prefix}asof_ts"]
    tie = F.col(right_tie).cast("long") if right_tie else F.lit(0).cast("long")
    r = (right.select(*by, F.col(right_ts).alias("_t"), tie.alias("_tie"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in right_cols])
              .withColumns({f"{prefix}asof_ts": F.col("_t"), "_b": _bucket(F.col("_t"), minutes)})
              .withColumn("_p", F.struct(*[F.col(c) for c in out_cols])))
    p_type = r.schema["_p"].dataType
    asked = left.select(*by, _bucket(F.col(left_ts), minutes).alias("_b")).distinct()

    # pass 1: the last right row of each bucket, carried to the later buckets that are asked for
    last_in_bucket = (r.join(asked.select(*by).distinct(), by, "left_semi").groupBy(*by, "_b")
                       .agg(F.max(F.struct("_t", "_tie", "_p")).alias("_m")).withColumn("_left", F.lit(False)))
    m_type = last_in_bucket.schema["_m"].dataType
    both = last_in_bucket.unionByName(asked.withColumns({"_m": F.lit(None).cast(m_type), "_left": F.lit(True)}))
    earlier = Window.partitionBy(*by).orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)
    carry = (both.withColumn("_c", F.max("_m").over(earlier)).filter("_left")
                 .select(*by, "_b", F.col("_c._p").alias("_carry")))

    # pass 2: in-bucket union ordered by (time, right-before-left, tie)
    l_struct = F.struct(*[F.col(c) for c in left.columns])
    lside = left.select(*by, _bucket(F.col(left_ts), minutes).alias("_b"), F.col(left_ts).alias("_t"),
                        F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_tie"), l_struct.alias("_l"),
                        F.lit(None).cast(p_type).alias("_p"))
    rside = r.join(asked, [*by, "_b"], "left_semi").select(
        *by, "_b", "_t", F.lit(0).alias("_side"), "_tie",
        F.lit(None).cast(lside.schema["_l"].dataType).alias("_l"), "_p")
    w = Window.partitionBy(*by, "_b").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    matched = (lside.unionByName(rside)
                    .withColumn("_m", F.last("_p", ignorenulls=True).over(w))
                    .filter(F.col("_side") == 1)
                    .join(carry, [*by, "_b"], "left")
                    .withColumn("_m", F.coalesce("_m", "_carry")))
    return matched.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns],
                          *[F.col(f"_m.{c}").alias(c) for c in out_cols])
