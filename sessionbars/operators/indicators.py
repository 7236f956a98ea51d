"""Technical indicators over ordered bars: SMA, EWM, RSI, MACD.

Scale design
------------
An indicator is a scan over the bars of one symbol in time order.  A window
``partitionBy(symbol)`` would put a whole instrument in one task, so the scan
runs in *blocks* and is a classic two-phase parallel scan:

* a block is ``(symbol, date, slice, sub)``: the bars of one day (optionally
  cut into clock slices for tick data), cut again every ``sub_rows`` rows.
  The only bar-level shuffle is the hash on ``(symbol, date[, slice])``; all
  later bar-level windows and the block aggregate reuse that partitioning;
* phase 1, inside each block: running sums ``sum(w_i x_i q^-i)`` (so that the
  local EWM at row j is ``q^j`` times the running sum), the in-block lag, and
  a block table row: row count, first value, the last ``halo`` values and the
  block's EWM sums;
* phase 2 has two levels.  Within a day, windows on ``(symbol, date)`` over the
  block table give each block its row offset in the day, the values just
  before it (the halo for rolling means and lags) and the EWM carry
  ``C <- C*q^n + s`` folded over the day's earlier blocks.  Then a day is one
  row: its blocks (scalars and a halo each), its row count, last values and
  EWM sums.  Windows on ``symbol`` see these day rows alone and carry offset,
  halo and EWM state across days; the blocks are unfolded from the day rows
  again and take the day's carry over, decayed by their offset.  Folds go back
  to H rows (a range frame on the row offset): rows further back weigh
  <= q^H, and H makes that < 2^-57 (below double precision): exact in doubles;
* one join brings the block context back to the bars.

Values that depend on the previous row (the RSI's price change) are exact
inside a block; the first row of a block gets its term from the block table
(the previous block's last value), as a per-block correction.  The term of a
day's first block is known at day level only and, an EWM being linear, enters
the day's later blocks as one decayed addend.

So the longest window on a symbol alone has one row per trading day, whatever
the ticks.  ``slice_minutes="measured"`` counts the rows first and cuts days
into clock slices of at most ``SLICE_ROWS`` rows where one has more.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.functions.columns import micros_of_day

BLOCK_ORDER = ["_date", "_slice", "_sub"]
_UNB = Window.unboundedPreceding
_UNF = Window.unboundedFollowing


#: Rows of a clock slice that one window task sorts, when slices are measured.
SLICE_ROWS = 2_000_000
_SLICES = (1440, 240, 60, 15, 5, 1)


def measured_slices(bars: DataFrame, key: str | list[str] = "symbol", ts: str = "ts", rows: int = SLICE_ROWS) -> int | None:
    """The longest of the slice lengths (minutes) of which no (key, day, slice) has
    more than ``rows`` rows; None for whole days, one minute if even that has more.
    One job: counts by minute, folded to every length."""
    minute = F.floor(micros_of_day(ts) / F.lit(60_000_000)).cast("int")
    keys = [key] if isinstance(key, str) else list(key)
    by_minute = bars.groupBy(*keys, F.to_date(F.col(ts)).alias("_date"), minute.alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    w = by_minute.withColumn("_w", F.explode(F.array(*map(F.lit, _SLICES))))
    most = w.groupBy(*keys, "_date", "_w", F.floor(F.col("_m") / F.col("_w"))).agg(F.sum("_n").alias("_n")).groupBy("_w").agg(F.max("_n").alias("_n"))
    fit = [r["_w"] for r in most.collect() if r["_n"] <= rows]
    chosen = max(fit, default=1)
    return None if chosen == 1440 or by_minute.isEmpty() else chosen


def _block_keys(key: str) -> list[str]:
    return [key] + BLOCK_ORDER


def add_blocks(bars: DataFrame, key: str = "symbol", ts: str = "ts", tie: str = "id",
               slice_minutes: int | str | None = None, sub_rows: int = 512) -> DataFrame:
    """Tag each bar with its block and its 0-based position ``_jj`` in it.

    Rows are ordered by ``(ts, tie)``: duplicate timestamps get a total order.
    ``slice_minutes``: clock slices of so many minutes, None for whole days, or
    ``"measured"`` (see ``measured_slices``).
    """
    if slice_minutes == "measured":
        slice_minutes = measured_slices(bars, key, ts)
    df = bars.withColumn("_date", F.to_date(F.col(ts)))
    part = [key, "_date"]
    if slice_minutes:
        df = df.withColumn(
            "_slice", F.floor(micros_of_day(ts) / F.lit(slice_minutes * 60_000_000)).cast("int"))
        part.append("_slice")
    else:
        df = df.withColumn("_slice", F.lit(0))
    w = Window.partitionBy(*part).orderBy(F.col(ts), F.col(tie))
    j = F.row_number().over(w) - 1
    return df.withColumns({"_sub": F.floor(j / F.lit(sub_rows)).cast("int"),
                           "_jj": (j % F.lit(sub_rows)).cast("int")})


def _sub_window(key: str) -> Window:
    return Window.partitionBy(*_block_keys(key)).orderBy("_jj")


@dataclass(frozen=True)
class Ewm:
    """One exponentially weighted mean ``y_t`` over rows ``0..t`` of a symbol.

    adjust=True:  y = sum q^(t-i) x_i / sum q^(t-i)
    adjust=False: y_0 = x_0, y_t = q*y_(t-1) + alpha*x_t
    Rows with index < min_periods-1 are NULL.

    ``value`` is evaluated per row and may use ``_lag`` (the previous row's
    value inside the block; NULL on the block's first row).  ``first``, when
    given, supplies the first row's value of every block from the block-table
    columns ``_first`` (the block's first value) and ``_before`` (the last
    value of the previous block; NULL for the symbol's first block).
    """

    out: str
    value: Column
    alpha: float
    adjust: bool
    min_periods: int = 0
    first: Callable[[], Column] | None = None

    @property
    def q(self) -> float:
        return 1.0 - self.alpha

    @staticmethod
    def span(out: str, value: Column, span: float, adjust: bool = True, min_periods: int = 0) -> "Ewm":
        return Ewm(out, value, 2.0 / (span + 1.0), adjust, min_periods)


def carry_blocks(q: float) -> int:
    """Rows of history after which a weight q^rows is below 2^-57."""
    return int(math.ceil(40.0 / -math.log(q))) + 1


def blocked_scan(df: DataFrame, value: str, halo: int, specs: list[Ewm], key: str = "symbol",
                 sub_rows: int = 512) -> DataFrame:
    """Add ``_g`` (row index in the symbol), ``_prev`` (previous row's value),
    ``_hs`` (suffix sums of the ``halo`` values before the block) and one
    column per EWM spec.  ``df`` comes from ``add_blocks``."""
    for s in specs:
        if not 0.0 < s.alpha < 1.0:
            raise ValueError(f"alpha must be in (0, 1): {s.alpha}")
        if (sub_rows - 1) * -math.log(s.q) > 650:
            raise ValueError(f"sub_rows={sub_rows} too large for alpha={s.alpha}; lower it")
    halo = max(int(halo), 1)
    bk = _block_keys(key)
    wsub = _sub_window(key)
    jj = F.col("_jj")
    first_row = jj == 0

    # phase 1 (bar level, in-block): lag, block size, EWM terms
    df = df.withColumns({"_lag": F.lag(value).over(wsub),
                         "_cnt": F.count(F.lit(1)).over(wsub.rowsBetween(_UNB, _UNF))})
    terms = {}
    for i, s in enumerate(specs):
        x = s.value.cast("double")
        if s.first is not None:
            x = F.when(first_row, F.lit(0.0)).otherwise(x)   # the block table supplies it
        w = F.lit(1.0) if s.adjust else F.lit(s.alpha)
        terms[f"_r{i}"] = w * x * F.pow(F.lit(s.q), -jj)
    if terms:
        df = df.withColumns(terms)
    tail = F.when(jj >= F.col("_cnt") - F.lit(halo), F.struct("_jj", F.col(value).cast("double").alias("v")))
    aggs = [F.count(F.lit(1)).alias("_n"),
            F.array_sort(F.collect_list(tail)).alias("_tail"),
            F.min_by(F.col(value).cast("double"), jj).alias("_first")]
    for i, s in enumerate(specs):
        aggs.append(F.sum(f"_r{i}").alias(f"_s{i}"))
        if not s.adjust and s.first is None:
            aggs.append(F.min_by(s.value.cast("double"), jj).alias(f"_x0{i}"))
    blk = df.groupBy(*bk).agg(*aggs).withColumn("_tail", F.transform("_tail", lambda t: t["v"]))

    # phase 2, level 1 (block table, within a day): offsets, halo, EWM carry of the day
    ks = range(len(specs))
    wd = Window.partitionBy(key, "_date").orderBy("_slice", "_sub")

    def last_values(arrays: Column) -> Column:
        flat = F.flatten(arrays)
        return F.slice(flat, F.greatest(F.size(flat) - F.lit(halo) + 1, F.lit(1)), F.lit(halo)).cast("array<double>")

    blk = blk.withColumns({"_o": F.coalesce(F.sum("_n").over(wd.rowsBetween(_UNB, -1)), F.lit(0)).cast("long"),
                           "_halo": last_values(F.collect_list("_tail").over(wd.rowsBetween(-halo, -1)))})
    blk = blk.withColumn("_before", F.try_element_at(F.col("_halo"), F.lit(-1)))
    opens = F.col("_o") == 0      # a day's first block: its first term is known at day level
    horizon = max([carry_blocks(s.q) for s in specs] + [0]) + sub_rows

    def fold(q: float, field: str):
        return lambda acc, e: acc * F.pow(F.lit(q), e["_n"]) + e[field]

    def first_term(s: Ewm, w0: Column) -> Column:
        return w0 * F.coalesce(s.first().cast("double"), F.lit(0.0))

    if specs:
        own = {f"_f{i}": F.when(opens | F.lit(s.first is None), F.lit(0.0))
                          .otherwise(first_term(s, F.lit(1.0 if s.adjust else s.alpha)) if s.first else F.lit(0.0))
               for i, s in enumerate(specs)}
        blk = blk.withColumns(own)
        blk = blk.withColumns({f"_s{i}": (F.col(f"_s{i}") + F.col(f"_f{i}")) * F.pow(F.lit(s.q), F.col("_n") - 1)
                               for i, s in enumerate(specs)})
        # every block that holds a row within `horizon` rows of this block's
        # start begins at most horizon + sub_rows rows earlier (blocks have at
        # most sub_rows rows): a range frame on the row offset, so small
        # blocks (clock slices) do not inflate the fold
        by_offset = Window.partitionBy(key, "_date").orderBy("_o").rangeBetween(-horizon, -1)
        blk = blk.withColumn("_hist", F.collect_list(F.struct("_n", *[f"_s{i}" for i in ks])).over(by_offset))
        blk = blk.withColumns({f"_c{i}": F.aggregate("_hist", F.lit(0.0), fold(s.q, f"_s{i}"))
                               for i, s in enumerate(specs)})

    # phase 2, level 2 (one row per symbol and day): the same across days
    place = F.struct("_slice", "_sub")
    per_block = F.struct("_slice", "_sub", "_o", "_halo", *[f"_{x}{i}" for i in ks for x in "cf"])
    day_aggs = [F.collect_list(per_block).alias("_blocks"), F.sum("_n").alias("_dn"),
                F.max_by(last_values(F.array("_halo", "_tail")), place).alias("_dtail"),
                F.min_by("_first", place).alias("_first")]
    for i, s in enumerate(specs):
        day_aggs.append(F.max_by(F.col(f"_c{i}") * F.pow(F.lit(s.q), F.col("_n")) + F.col(f"_s{i}"), place).alias(f"_ds{i}"))
        if not s.adjust and s.first is None:
            day_aggs.append(F.min_by(f"_x0{i}", place).alias(f"_x0{i}"))
    day = blk.groupBy(key, "_date").agg(*day_aggs)
    wk = Window.partitionBy(key).orderBy("_date")
    day = day.withColumns({"_dg": F.coalesce(F.sum("_dn").over(wk.rowsBetween(_UNB, -1)), F.lit(0)).cast("long"),
                           "_dhalo": last_values(F.collect_list("_dtail").over(wk.rowsBetween(-halo, -1)))})
    day = day.withColumn("_before", F.try_element_at(F.col("_dhalo"), F.lit(-1)))
    if specs:
        first_day = F.col("_dg") == 0
        terms = {}
        for i, s in enumerate(specs):
            f = F.lit(0.0)
            if s.first is not None:
                f = first_term(s, F.lit(1.0) if s.adjust else F.when(first_day, F.lit(1.0)).otherwise(F.lit(s.alpha)))
            elif not s.adjust:
                # adjust=False gives the symbol's very first row weight 1, not alpha
                f = F.when(first_day, F.lit(1.0 - s.alpha) * F.col(f"_x0{i}")).otherwise(F.lit(0.0))
            terms[f"_df{i}"] = f
        day = day.withColumns(terms)
        day = day.withColumns({f"_ds{i}": F.col(f"_ds{i}") + F.col(f"_df{i}") * F.pow(F.lit(s.q), F.col("_dn") - 1)
                               for i, s in enumerate(specs)})
        # a day's start is its predecessor's end: each row hands on the day before
        # it, so the frame holds every day that ends within the horizon, however long
        handed = F.when(F.lag("_dn").over(wk).isNotNull(), F.struct(
            F.lag("_dn").over(wk).alias("_n"), *[F.lag(f"_ds{i}").over(wk).alias(f"_ds{i}") for i in ks]))
        by_start = Window.partitionBy(key).orderBy("_dg").rangeBetween(-horizon, 0)
        day = day.withColumn("_last", handed).withColumn("_hist", F.collect_list("_last").over(by_start))
        day = day.withColumns({f"_dc{i}": F.aggregate("_hist", F.lit(0.0), fold(s.q, f"_ds{i}"))
                               for i, s in enumerate(specs)})
    day = day.select(key, "_date", "_dg", "_dhalo", F.explode("_blocks").alias("_b"),
                     *[f"_d{x}{i}" for i in ks for x in "cf"])
    o = F.col("_b._o")
    context = {"_g0": F.col("_dg") + o}
    for i, s in enumerate(specs):
        opened = F.col(f"_df{i}") * F.pow(F.lit(s.q), F.greatest(o - 1, F.lit(0)))
        context[f"_c{i}"] = (F.col(f"_b._c{i}") + F.col(f"_dc{i}") * F.pow(F.lit(s.q), o)
                             + F.when(o > 0, opened).otherwise(F.lit(0.0)))
        context[f"_f{i}"] = F.when(o == 0, F.col(f"_df{i}")).otherwise(F.col(f"_b._f{i}"))
    blk = day.select(key, "_date", "_b._slice", "_b._sub", last_values(F.array("_dhalo", F.col("_b._halo"))).alias("_halo"),
                     *[c.alias(n) for n, c in context.items()])
    suffix = F.aggregate(
        F.reverse(F.col("_halo")), F.array().cast("array<double>"),
        lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + x)))
    blk = blk.withColumns({"_hs": suffix, "_before": F.try_element_at(F.col("_halo"), F.lit(-1))})
    keep = [*bk, "_g0", "_hs", "_before"] + [c for i in ks for c in (f"_c{i}", f"_f{i}")]
    out = df.join(blk.select(*keep), bk)

    # back at bar level: global index, previous value, EWM values
    g = F.col("_g0") + jj
    cols = {"_g": g, "_prev": F.when(first_row, F.col("_before")).otherwise(F.col("_lag"))}
    run = wsub.rowsBetween(_UNB, 0)
    for i, s in enumerate(specs):
        q = s.q
        local = F.pow(F.lit(q), jj) * (F.sum(f"_r{i}").over(run) + F.col(f"_f{i}"))
        total = F.col(f"_c{i}") * F.pow(F.lit(q), jj + 1) + local
        if s.adjust:
            total = total / ((F.lit(1.0) - F.pow(F.lit(q), g + 1)) / F.lit(1.0 - q))
        if s.min_periods and s.min_periods > 1:
            total = F.when(g + 1 >= F.lit(s.min_periods), total)
        cols[s.out] = total
    return out.withColumns(cols)


def rolling_mean(value: str, n: int, key: str = "symbol") -> Column:
    """Mean of the last ``n`` rows (min_periods=1) using the block halo."""
    wsub = _sub_window(key)
    frame = wsub.rowsBetween(-(n - 1), 0)
    in_sum = F.sum(value).over(frame)
    in_cnt = F.count(value).over(frame)
    need = F.lit(n - 1) - F.col("_jj")
    take = F.least(need, F.size("_hs"))
    use = (F.col("_jj") < F.lit(n - 1)) & (take > 0)
    halo_sum = F.when(use, F.try_element_at(F.col("_hs"), take)).otherwise(F.lit(0.0))
    halo_cnt = F.when(use, take).otherwise(F.lit(0))
    return (in_sum + halo_sum) / (in_cnt + halo_cnt)


def rsi_specs(value: str = "close", window: int = 14) -> tuple[list[Ewm], Column]:
    """Wilder RSI as published for the common ``ta`` package: diff -> up/down
    moves (first row 0) -> EWM alpha=1/window, adjust=False, min_periods=window;
    100 when the down average is 0."""
    delta = F.coalesce(F.col(value) - F.col("_lag"), F.lit(0.0))

    def first_delta() -> Column:
        return F.coalesce(F.col("_first") - F.col("_before"), F.lit(0.0))

    specs = [Ewm("_rsi_up", F.greatest(delta, F.lit(0.0)), 1.0 / window, False, window,
                 lambda: F.greatest(first_delta(), F.lit(0.0))),
             Ewm("_rsi_dn", F.greatest(-delta, F.lit(0.0)), 1.0 / window, False, window,
                 lambda: F.greatest(-first_delta(), F.lit(0.0)))]
    up_c, dn_c = F.col("_rsi_up"), F.col("_rsi_dn")
    rsi = (F.when(dn_c.isNull(), F.lit(None).cast("double"))
             .when(dn_c == 0, F.lit(100.0))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(up_c, dn_c))))
    return specs, rsi


def with_indicators(bars: DataFrame, key: str = "symbol", ts: str = "ts", tie: str = "id",
                    value: str = "close", sma: tuple[int, ...] = (15, 30), rsi: int | None = 14,
                    macd: tuple[int, int] | None = (12, 26), slice_minutes: int | str | None = None,
                    sub_rows: int = 512, keep_date: bool = False) -> DataFrame:
    """Bars + ``sma_<n>`` columns, ``rsi`` and ``macd`` (EWM span fast - slow,
    adjust=True, no signal line).  Indicators cross day borders.

    ``keep_date`` also returns the block date as ``date``: the output is
    hash-partitioned on (symbol, date), so a following per-day aggregate
    needs no further shuffle."""
    halo = max([n - 1 for n in sma] + [1])
    specs: list[Ewm] = []
    rsi_col = None
    if rsi:
        r_specs, rsi_col = rsi_specs(value, rsi)
        specs += r_specs
    if macd:
        fast, slow = macd
        specs += [Ewm.span("_ema_fast", F.col(value), fast), Ewm.span("_ema_slow", F.col(value), slow)]
    df = add_blocks(bars, key, ts, tie, slice_minutes, sub_rows)
    df = blocked_scan(df, value, halo, specs, key, sub_rows)
    cols = {f"sma_{n}": rolling_mean(value, n, key) for n in sma}
    if rsi:
        cols["rsi"] = rsi_col
    if macd:
        cols["macd"] = F.col("_ema_fast") - F.col("_ema_slow")
    df = df.withColumns(cols) if cols else df
    extra = [F.col("_date").alias("date")] if keep_date else []
    return df.select(*bars.columns, *cols, *extra)


def ewm_mean(bars: DataFrame, value: str, alpha: float | None = None, span: float | None = None,
             adjust: bool = True, min_periods: int = 0, out: str = "ewm", key: str = "symbol",
             ts: str = "ts", tie: str = "id", slice_minutes: int | None = None,
             sub_rows: int = 512) -> DataFrame:
    """Generic exponentially weighted mean of one column per symbol."""
    if alpha is None:
        alpha = 2.0 / (span + 1.0)
    df = add_blocks(bars, key, ts, tie, slice_minutes, sub_rows)
    df = blocked_scan(df, value, 1, [Ewm(out, F.col(value), alpha, adjust, min_periods)], key, sub_rows)
    return df.select(*bars.columns, out)
