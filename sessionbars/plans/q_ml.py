"""Driver queries for the model layer.

Model fits cannot be stated in SQL (and a different tree library would not
give the reference's numbers anyway): those are rows-only checks.  The
ensemble average and the model choice are checked exactly on rule-based
member predictions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionbars.operators import backtest as bt
from sessionbars.operators import metrics as mt
from sessionbars.operators import ml
from sessionbars.operators.features import build_features
from sessionbars.operators.splits import chronological_split
from sessionbars.plans.adapters import event_bars
from sessionbars.plans.q_backtest import _EV_FEAT
from sessionbars.plans.registry import register, register_model
from sessionbars.plans.sqlparts import normalized_select, with_ctes
from sessionbars.session import checkpoint_root, scratch_path


def _features(spark, sf_dir):
    return build_features(event_bars(spark, sf_dir))


def _split(spark, sf_dir):
    sp = chronological_split(_features(spark, sf_dir))
    return sp.filter(F.col("split") == "train"), sp.filter(F.col("split") != "train")


def _fit_query(make, col):
    def q(spark, sf_dir):
        train, rest = _split(spark, sf_dir)
        model = ml.fit(make(), train)
        return model.transform(rest).select("symbol", "datetime", "split", "target", col)
    return q


register("gbt_fit")(_fit_query(lambda: ml.gbt(), "pred_gbt"))
register("rf_fit")(_fit_query(lambda: ml.random_forest(), "pred_rf"))
register("gbt2_fit")(_fit_query(lambda: ml.gbt_second(), "pred_gbt2"))
register("enet_fit")(_fit_query(ml.elastic_net, "pred_enet"))


def _ensemble(spark, sf_dir, grid=None, sizes=None):
    """The ensemble of the table's feature rows, trained once and shared by the queries below."""
    feats = _features(spark, sf_dir)
    return ml.trained_on(feats, f"{checkpoint_root(spark)}/sessionbars/models", grid or ml.REFERENCE_GRID, sizes)


@register_model("grid_search")
def q_grid_search(spark, sf_dir, grid=None):
    """Mean fold MAE per combination of the full grid (108 fits; see README)."""
    grid = grid or ml.REFERENCE_GRID
    feats = _features(spark, sf_dir)
    train = chronological_split(feats).filter(F.col("split") == "train").drop("split")
    root = f"{checkpoint_root(spark)}/sessionbars/models"
    store = f"{root}/{ml.fingerprint(feats, grid, None, ml.SEED, ml.ENSEMBLE_WEIGHTS)}/search"
    return ml.grid_search(train, grid, store=store, rows_per_partition=ml.ROWS_PER_PARTITION)[1]


@register_model("model_evaluate")
def q_model_evaluate(spark, sf_dir, grid=None, sizes=None):
    """X11: MAE and R2 of the chosen fitted model on the test rows, which took no part in fit or choice."""
    trained = _ensemble(spark, sf_dir, grid, sizes)
    test = chronological_split(_features(spark, sf_dir)).filter(F.col("split") == "test")
    return mt.regression_metrics(ml.predict_chosen(trained, test), "prediction")


@register_model("model_backtest")
def q_model_backtest(spark, sf_dir, grid=None, sizes=None):
    """The ledger of the slice after training, traded by the chosen fitted model."""
    feats = build_features(event_bars(spark, sf_dir), with_path=True)
    return bt.ledger_export(bt.backtest(ml.predict_chosen(_ensemble(spark, sf_dir, grid, sizes), feats)))


@register_model("latest_signal_model")
def q_latest_signal_model(spark, sf_dir, grid=None, sizes=None):
    """The newest feature row per symbol, today's included, scored by the chosen fitted model."""
    feats = build_features(event_bars(spark, sf_dir), left_exit=True)
    return ml.score_latest(ml.predict_chosen(_ensemble(spark, sf_dir, grid, sizes), feats)).select(
        "symbol", "datetime", "prediction", "direction", "confidence")


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Fit, save to the shared folder, load, score; ``same`` compares
    the reloaded model's prediction with the in-memory one."""
    train, rest = _split(spark, sf_dir)
    model = ml.fit(ml.elastic_net(), train)
    path = scratch_path(spark, "model")
    ml.save_model(model, path)
    again = ml.load_model(path)
    a = model.transform(rest).select("symbol", "datetime", F.col("pred_enet").alias("p_mem"))
    b = again.transform(rest).select("symbol", "datetime", F.col("pred_enet").alias("p_disk"))
    return a.join(b, ["symbol", "datetime"]).withColumn("same", F.col("p_mem") == F.col("p_disk"))


def rule_members(df):
    """Four SQL-expressible stand-ins for the member models."""
    return (df.withColumn("pred_gbt", F.col("current_macd"))
              .withColumn("pred_rf", F.col("daily_variation"))
              .withColumn("pred_gbt2", F.try_divide(F.col("week_avg_close") - F.col("day_close_current"),
                                                    F.col("day_close_current")) * F.lit(100.0))
              .withColumn("pred_enet", F.col("week_trend").cast("double")))


_RULES_SQL = """rm AS (
  SELECT *, current_macd AS pred_gbt, daily_variation AS pred_rf,
         (week_avg_close - day_close_current) / nullif(day_close_current, 0) * 100 AS pred_gbt2,
         CAST(week_trend AS DOUBLE) AS pred_enet FROM feat),
ens AS (
  SELECT *, (pred_gbt * 0.4 + pred_rf * 0.25 + pred_gbt2 * 0.25 + pred_enet * 0.1) / 1.0 AS pred_ensemble FROM rm)"""


@register("ensemble_average", with_ctes(*_EV_FEAT, _RULES_SQL) + "\n" + normalized_select(
    [("symbol", "s"), ("datetime", "t"), ("pred_ensemble", "d")], "ens"))
def q_ensemble_average(spark, sf_dir):
    """0.4 / 0.25 / 0.25 / 0.1 weighted average of member outputs."""
    return ml.ensemble_average(rule_members(_features(spark, sf_dir))).select("symbol", "datetime", "pred_ensemble")


@register("model_select", with_ctes(*_EV_FEAT, _RULES_SQL, """sp AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS idx,
         count(*) OVER (PARTITION BY symbol) AS n FROM ens),
sp2 AS (SELECT *, n - ceil(0.15 * n) AS n_temp FROM sp),
val AS (SELECT * FROM sp2 WHERE idx < n_temp AND idx >= n_temp - ceil(0.176 * n_temp)),
ms AS (SELECT symbol, avg(abs(target - pred_gbt)) AS mae_primary, avg(abs(target - pred_ensemble)) AS mae_ensemble
       FROM val GROUP BY symbol),
ms2 AS (SELECT *, CASE WHEN mae_ensemble < mae_primary THEN 'ensemble' ELSE 'primary' END AS chosen FROM ms)""") +
          "\n" + normalized_select([("symbol", "s"), ("mae_primary", "d"), ("mae_ensemble", "d"), ("chosen", "s")],
                                   "ms2"))
def q_model_select(spark, sf_dir):
    """Validation MAE of the primary member vs the ensemble."""
    f = ml.ensemble_average(rule_members(_features(spark, sf_dir)))
    val = chronological_split(f).filter(F.col("split") == "val")
    return ml.select_model(val)
