"""Reusable DuckDB SQL fragments for the oracle twins of the driver queries.

The oracle states each query's *meaning* in plain SQL: bars as views of the
driver tables, exponentially weighted sums as a bounded self-join (weights
older than 700 rows are below double precision), nearest bars as
``row_number`` picks, rolling features as SQL windows.
"""

from __future__ import annotations

EVENT_BARS = """bars AS (
  SELECT event_type AS symbol, ts, event_id AS id, value AS open, value AS high,
         value AS low, value AS close, CAST(1 AS BIGINT) AS volume
  FROM events)"""

ORDER_BARS = """bars AS (
  SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey AS id,
         o_totalprice AS open, o_totalprice AS high, o_totalprice AS low,
         o_totalprice AS close, CAST(1 AS BIGINT) AS volume
  FROM orders)"""

EWM_HORIZON = 700


def us_from(ts: str, hour: int, minute: int = 0) -> str:
    """|ts - same date at hour:minute| in microseconds."""
    return (f"abs(epoch_us({ts}) - epoch_us(CAST(CAST({ts} AS DATE) AS TIMESTAMP) "
            f"+ INTERVAL {hour * 60 + minute} MINUTE))")


def indicator_ctes(src: str = "bars", outer_where: str = "hour(a.ts) BETWEEN 17 AND 23",
                   session: str = "hour(ts) BETWEEN 9 AND 23") -> str:
    """CTEs ``seq`` and ``ind``: bars (9-23h) + sma_15, sma_30, rsi, macd."""
    q12, q26, q14 = "(11.0/13.0)", "(25.0/27.0)", "(13.0/14.0)"
    sess = f"WHERE {session}" if session else ""
    return f"""seq AS (
  SELECT *, row_number() OVER w - 1 AS g, close - lag(close) OVER w AS d
  FROM {src} {sess}
  WINDOW w AS (PARTITION BY symbol ORDER BY ts, id)),
ind0 AS (
  SELECT a.symbol, a.ts, a.id, a.open, a.high, a.low, a.close, a.volume, a.g,
    avg(b.close) FILTER (WHERE a.g - b.g < 15) AS sma_15,
    avg(b.close) FILTER (WHERE a.g - b.g < 30) AS sma_30,
    sum(pow({q12}, a.g - b.g) * b.close) / sum(pow({q12}, a.g - b.g))
      - sum(pow({q26}, a.g - b.g) * b.close) / sum(pow({q26}, a.g - b.g)) AS macd,
    sum(CASE WHEN b.g = 0 THEN 1.0 ELSE 1.0/14.0 END * pow({q14}, a.g - b.g)
        * greatest(coalesce(b.d, 0.0), 0.0)) AS up,
    sum(CASE WHEN b.g = 0 THEN 1.0 ELSE 1.0/14.0 END * pow({q14}, a.g - b.g)
        * greatest(-coalesce(b.d, 0.0), 0.0)) AS dn
  FROM seq a JOIN seq b
    ON a.symbol = b.symbol AND b.g BETWEEN a.g - {EWM_HORIZON} AND a.g
  WHERE {outer_where}
  GROUP BY a.symbol, a.ts, a.id, a.open, a.high, a.low, a.close, a.volume, a.g),
ind AS (
  SELECT * EXCLUDE (up, dn),
    CASE WHEN g < 13 THEN NULL WHEN dn = 0 THEN 100.0
         ELSE 100.0 - 100.0 / (1.0 + up / dn) END AS rsi
  FROM ind0)"""


def feature_ctes(src: str = "ind", daily_where: str = "") -> str:
    """CTEs ``ev``, ``ent``, ``ext``, ``dly``, ``feat0``, ``feat`` over indicator bars."""
    dw = f"AND {daily_where}" if daily_where else ""
    return f"""ev AS (
  SELECT *, CAST(ts AS DATE) AS date, hour(ts) AS h,
         {us_from('ts', 20)} AS d20, {us_from('ts', 23)} AS d23
  FROM {src} WHERE hour(ts) BETWEEN 17 AND 23),
ent AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY d20, ts, id) AS rn
                 FROM ev WHERE h BETWEEN 19 AND 21) WHERE rn = 1),
ext AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY d23, ts, id) AS rn
                 FROM ev WHERE h BETWEEN 22 AND 23) WHERE rn = 1),
dly AS (
  SELECT symbol, date,
         first(open ORDER BY ts, id) AS day_open, max(high) AS day_high, min(low) AS day_low,
         first(close ORDER BY ts, id) AS day_close_first, last(close ORDER BY ts, id) AS day_close_last,
         CAST(sum(volume) AS BIGINT) AS day_volume
  FROM ev WHERE TRUE {dw} GROUP BY symbol, date),
feat0 AS (
  SELECT e.symbol, e.date, e.ts AS datetime, isodow(e.ts) - 1 AS day_of_week,
         d.day_open, e.close AS day_close_current, d.day_high, d.day_low, d.day_volume,
         (d.day_close_last - d.day_open) / nullif(d.day_open, 0) * 100 AS daily_variation,
         coalesce(e.sma_15, e.close) AS current_sma_15, coalesce(e.sma_30, e.close) AS current_sma_30,
         coalesce(e.rsi, 50.0) AS current_rsi, coalesce(e.macd, 0.0) AS current_macd,
         (x.close - e.close) / nullif(e.close, 0) * 100 AS target
  FROM ent e JOIN ext x ON e.symbol = x.symbol AND e.date = x.date
             LEFT JOIN dly d ON e.symbol = d.symbol AND e.date = d.date),
feat1 AS (
  SELECT *,
    avg(day_close_current) OVER (PARTITION BY symbol ORDER BY datetime
                                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS week_avg_close,
    coalesce(stddev_samp(day_close_current) OVER (PARTITION BY symbol ORDER BY datetime
                                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0.0) AS week_volatility,
    coalesce(CAST(day_close_current > lag(day_close_current, 7) OVER (PARTITION BY symbol ORDER BY datetime)
                  AS INTEGER), 0) AS week_trend
  FROM feat0),
feat AS (
  SELECT * FROM feat1
  WHERE day_open IS NOT NULL AND day_high IS NOT NULL AND day_low IS NOT NULL
    AND day_volume IS NOT NULL AND daily_variation IS NOT NULL AND target IS NOT NULL
    AND day_close_current IS NOT NULL)"""


FEATURE_KINDS = [
    ("symbol", "s"), ("datetime", "t"), ("day_of_week", "i"), ("day_open", "d"),
    ("day_close_current", "d"), ("day_high", "d"), ("day_low", "d"), ("day_volume", "i"),
    ("daily_variation", "d"), ("current_sma_15", "d"), ("current_sma_30", "d"),
    ("current_rsi", "d"), ("current_macd", "d"), ("week_avg_close", "d"),
    ("week_volatility", "d"), ("week_trend", "i"), ("target", "d"),
]


def normalized_select(cols: list[tuple[str, str]], src: str) -> str:
    """Final projection with the output typing every query shares:
    doubles rounded to 6 dp (cents from 1e4 up), integers as BIGINT."""
    parts = []
    for name, kind in cols:
        if kind == "d":
            parts.append(f"CASE WHEN abs(CAST({name} AS DOUBLE)) >= 1e4 THEN round(CAST({name} AS DOUBLE), 2) "
                         f"ELSE round(CAST({name} AS DOUBLE), 6) END + 0.0 AS {name}")
        elif kind == "i":
            parts.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            parts.append(name)
    return f"SELECT {', '.join(parts)} FROM {src}"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


ORDER_DAILY = """od0 AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS day_open,
         last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS day_close_current,
         count(*) AS day_volume
  FROM orders GROUP BY 1, 2),
od AS (
  SELECT symbol, CAST(date AS TIMESTAMP) AS datetime, isodow(date) - 1 AS day_of_week, day_open,
         day_close_current, day_volume,
         (day_close_current - day_open) / nullif(day_open, 0) * 100 AS target,
         lag((day_close_current - day_open) / nullif(day_open, 0) * 100)
           OVER (PARTITION BY symbol ORDER BY date) AS prediction
  FROM od0)"""


def ledger_ctes(src: str, path_bars: str | None, sliced: bool = True) -> str:
    """CTEs down to ``led``: slice, directions, equity, intra-trade drawdown
    (per-bar brute force over ``path_bars``), streaks (gaps and islands),
    running max and drawdown.  ``src`` needs symbol, datetime, target,
    prediction, day_close_current, day_of_week."""
    w = "PARTITION BY symbol ORDER BY datetime"
    slice_where = "WHERE idx >= floor(0.85 * n)" if sliced else ""
    parts = [f"""sl AS (
  SELECT * FROM (SELECT *, row_number() OVER ({w}) - 1 AS idx, count(*) OVER (PARTITION BY symbol) AS n
                 FROM {src}) {slice_where}),
dir AS (
  SELECT *, prediction AS predictions, target AS actual_change,
         CASE WHEN prediction > 0 THEN 'BUY' ELSE 'SELL' END AS predicted_direction,
         CASE WHEN target > 0 THEN 'UP' ELSE 'DOWN' END AS actual_direction,
         coalesce((prediction > 0 AND target > 0) OR (prediction < 0 AND target < 0), FALSE) AS correct_direction,
         CASE WHEN prediction > 0 THEN 1 ELSE -1 END AS position
  FROM sl),
eq0 AS (
  SELECT *, position * actual_change AS returns, position * actual_change * 5000.0 AS pnl_dollars FROM dir),
eq AS (
  SELECT *, sum(pnl_dollars) OVER ({w} ROWS UNBOUNDED PRECEDING) AS cumulative_pnl,
         100000.0 + sum(pnl_dollars) OVER ({w} ROWS UNBOUNDED PRECEDING) AS equity
  FROM eq0),
eq2 AS (
  SELECT *, coalesce(equity - lag(equity) OVER ({w}), 0.0) AS daily_pnl FROM eq)"""]
    if path_bars:
        parts.append(f"""pb AS (
  SELECT symbol, CAST(ts AS DATE) AS date, ts, id, close FROM {path_bars} WHERE hour(ts) BETWEEN 20 AND 23),
pe AS (
  SELECT symbol, date, close AS entry FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY {us_from('ts', 20)}, ts, id) AS rn FROM pb)
  WHERE rn = 1),
pp AS (
  SELECT t.symbol, t.datetime, pb.ts, pb.id,
         (pb.close - pe.entry) / nullif(pe.entry, 0) * 100 * t.position AS pnl
  FROM eq2 t JOIN pe ON t.symbol = pe.symbol AND CAST(t.datetime AS DATE) = pe.date
             JOIN pb ON t.symbol = pb.symbol AND CAST(t.datetime AS DATE) = pb.date),
pm AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, datetime ORDER BY pnl, ts, id) AS rn
                 FROM pp WHERE pnl IS NOT NULL) WHERE rn = 1),
dd AS (
  SELECT t.*, CASE WHEN pm.pnl < 0 THEN pm.pnl ELSE 0.0 END AS max_intra_drawdown_pct,
         CASE WHEN pm.pnl < 0 THEN pm.pnl * 5000.0 ELSE 0.0 END AS max_intra_drawdown_dollars,
         CASE WHEN pm.pnl < 0 THEN pm.ts END AS time_of_max_drawdown
  FROM eq2 t LEFT JOIN pm ON t.symbol = pm.symbol AND t.datetime = pm.datetime)""")
    else:
        parts.append("""dd AS (
  SELECT *, 0.0 AS max_intra_drawdown_pct, 0.0 AS max_intra_drawdown_dollars,
         CAST(NULL AS TIMESTAMP) AS time_of_max_drawdown FROM eq2)""")
    parts.append(f"""s1 AS (
  SELECT *, returns > 0 AS win_trade, returns < 0 AS loss_trade,
         CASE WHEN (returns > 0) IS DISTINCT FROM lag(returns > 0) OVER ({w}) THEN 1 ELSE 0 END AS wchg,
         CASE WHEN (returns < 0) IS DISTINCT FROM lag(returns < 0) OVER ({w}) THEN 1 ELSE 0 END AS lchg
  FROM dd),
s2 AS (
  SELECT *, sum(wchg) OVER ({w} ROWS UNBOUNDED PRECEDING) AS wg,
            sum(lchg) OVER ({w} ROWS UNBOUNDED PRECEDING) AS lg
  FROM s1),
led AS (
  SELECT *,
    CASE WHEN win_trade THEN row_number() OVER (PARTITION BY symbol, wg ORDER BY datetime) ELSE 0 END AS win_streak,
    CASE WHEN loss_trade THEN row_number() OVER (PARTITION BY symbol, lg ORDER BY datetime) ELSE 0 END AS loss_streak,
    max(equity) OVER ({w} ROWS UNBOUNDED PRECEDING) AS running_max,
    (equity / max(equity) OVER ({w} ROWS UNBOUNDED PRECEDING) - 1) * 100 AS portfolio_drawdown
  FROM s2)""")
    return ",\n".join(parts)


LEDGER_KINDS = [
    ("symbol", "s"), ("datetime", "t"), ("day_close_current", "d"), ("predictions", "d"),
    ("actual_change", "d"), ("predicted_direction", "s"), ("actual_direction", "s"),
    ("correct_direction", "s"), ("position", "i"), ("returns", "d"), ("pnl_dollars", "d"),
    ("cumulative_pnl", "d"), ("equity", "d"), ("daily_pnl", "d"), ("max_intra_drawdown_pct", "d"),
    ("max_intra_drawdown_dollars", "d"), ("time_of_max_drawdown", "t"), ("win_trade", "s"),
    ("loss_trade", "s"), ("portfolio_drawdown", "d"), ("day_of_week", "i"),
]


SUMMARY_CTES = """dr AS (
  SELECT *, coalesce(daily_pnl / nullif(lag(equity) OVER (PARTITION BY symbol ORDER BY datetime), 0) * 100, 0.0)
              AS daily_returns
  FROM led),
agg AS (
  SELECT symbol, count(*) AS total_trades,
    count(*) FILTER (WHERE win_trade) AS winning_trades,
    count(*) FILTER (WHERE loss_trade) AS losing_trades,
    arg_max(cumulative_pnl, datetime) AS total_pnl, arg_max(equity, datetime) AS final_equity,
    avg(CASE WHEN correct_direction THEN 1.0 ELSE 0.0 END) * 100 AS accuracy,
    coalesce(sum(pnl_dollars) FILTER (WHERE pnl_dollars > 0), 0.0) AS gp,
    abs(coalesce(sum(pnl_dollars) FILTER (WHERE pnl_dollars < 0), 0.0)) AS gl,
    coalesce(avg(returns) FILTER (WHERE returns > 0), 0.0) AS avg_win_pct,
    coalesce(avg(returns) FILTER (WHERE returns < 0), 0.0) AS avg_loss_pct,
    coalesce(avg(pnl_dollars) FILTER (WHERE pnl_dollars > 0), 0.0) AS avg_win_dollars,
    coalesce(avg(pnl_dollars) FILTER (WHERE pnl_dollars < 0), 0.0) AS avg_loss_dollars,
    min(portfolio_drawdown) AS max_drawdown, min(equity) - 100000.0 AS max_drawdown_dollars,
    stddev_samp(daily_returns) AS sd, avg(daily_returns) AS mr,
    max(win_streak) AS max_win_streak, max(loss_streak) AS max_loss_streak,
    coalesce(min(max_intra_drawdown_pct) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS max_intra_dd_pct,
    coalesce(min(max_intra_drawdown_dollars) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS max_intra_dd_dollars,
    coalesce(avg(max_intra_drawdown_pct) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS avg_intra_dd_pct,
    coalesce(avg(max_intra_drawdown_dollars) FILTER (WHERE max_intra_drawdown_pct < 0), 0.0) AS avg_intra_dd_dollars,
    count(*) FILTER (WHERE max_intra_drawdown_pct < 0) AS trades_with_dd
  FROM dr GROUP BY symbol),
summ AS (
  SELECT *,
    total_pnl / 100000.0 * 100 AS total_return,
    total_pnl / 100000.0 * 100 / total_trades * 250 AS annual_return,
    winning_trades / total_trades * 100 AS win_rate,
    CASE WHEN gl > 0 THEN gp / gl ELSE CAST('inf' AS DOUBLE) END AS profit_factor,
    trades_with_dd / total_trades * 100 AS pct_trades_with_dd,
    CASE WHEN total_trades > 1 THEN coalesce(sd, 0.0) * sqrt(250) ELSE 0.0 END AS volatility,
    CASE WHEN max_drawdown <> 0 THEN total_pnl / 100000.0 * 100 / total_trades * 250 / abs(max_drawdown)
         ELSE 0.0 END AS calmar_ratio,
    CASE WHEN max_drawdown <> 0 THEN total_pnl / 100000.0 * 100 / abs(max_drawdown) ELSE 0.0 END AS recovery_factor,
    winning_trades / total_trades * avg_win_dollars
      + (1 - winning_trades / total_trades) * avg_loss_dollars AS expectancy_dollars,
    winning_trades / total_trades * avg_win_pct
      + (1 - winning_trades / total_trades) * avg_loss_pct AS expectancy_pct,
    100000.0 AS initial_capital
  FROM agg),
summ2 AS (
  SELECT *, CASE WHEN volatility > 0 THEN mr * 250 / volatility ELSE 0.0 END AS sharpe_ratio FROM summ)"""

SUMMARY_KINDS = [("symbol", "s")] + [
    (c, "i" if c in ("trades_with_dd", "total_trades", "winning_trades", "losing_trades",
                     "max_win_streak", "max_loss_streak") else "d")
    for c in ["total_return", "total_pnl", "annual_return", "accuracy", "win_rate", "profit_factor",
              "max_drawdown", "max_drawdown_dollars", "max_intra_dd_pct", "max_intra_dd_dollars",
              "avg_intra_dd_pct", "avg_intra_dd_dollars", "trades_with_dd", "pct_trades_with_dd",
              "sharpe_ratio", "calmar_ratio", "volatility", "total_trades", "winning_trades",
              "losing_trades", "avg_win_pct", "avg_loss_pct", "avg_win_dollars", "avg_loss_dollars",
              "max_win_streak", "max_loss_streak", "expectancy_pct", "expectancy_dollars",
              "recovery_factor", "final_equity", "initial_capital"]]
