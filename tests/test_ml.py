"""Model layer: the whole train-and-choose path runs and is deterministic."""

from pyspark.sql import functions as F

from conftest import SF01
from sessionbars.operators import ml
from sessionbars.operators.features import build_features
from sessionbars.plans.adapters import event_bars

TINY = {"maxDepth": [2, 3], "stepSize": [0.1], "maxIter": [3], "subsamplingRate": [0.8],
        "featureSubsetStrategy": ["0.8"]}


def test_train_ensemble_end_to_end(spark):
    feats = build_features(event_bars(spark, SF01)).cache()
    res = ml.train_ensemble(feats, grid=TINY, sizes={"rf": {"numTrees": 20}, "gbt2": {"maxIter": 20}})
    assert res["chosen"] in ("ensemble", "primary")
    assert res["grid"].count() == 2
    assert res["best_params"]["maxDepth"] in (2, 3)
    test = res["split"].filter(F.col("split") == "test")
    scored = ml.ensemble_average(ml.predict_members(res["members"], test))
    rows = scored.select("pred_gbt", "pred_rf", "pred_gbt2", "pred_enet", "pred_ensemble").collect()
    assert rows and all(all(v is not None for v in r) for r in rows)
    again = ml.ensemble_average(ml.predict_members(res["members"], test)).select("pred_ensemble").collect()
    assert sorted(r["pred_ensemble"] for r in rows) == sorted(r["pred_ensemble"] for r in again)
    res["split"].unpersist()
    feats.unpersist()


def test_grid_query_searches_the_full_grid(spark, monkeypatch):
    from sessionbars.plans import q_ml

    asked = []
    monkeypatch.setattr(q_ml.ml, "grid_search", lambda train, grid, **kw: (asked.append(grid), (None, train))[1])
    q_ml.q_grid_search(spark, SF01)
    assert [len(ml.param_grid(g)) for g in asked] == [108] and min(asked[0]["maxIter"]) == 100
    fits = ml.nested_fits(ml.REFERENCE_GRID)
    assert len(fits) == 36 and all(p["maxIter"] == 300 and sorted(m.values()) == [100, 200, 300] for p, m in fits)
    assert sorted(ci for _, m in fits for ci in m) == list(range(108))


def train_rows(spark):
    feats = build_features(event_bars(spark, SF01))
    return ml.chronological_split(feats).filter(F.col("split") == "train").drop("split").cache()


def test_prefix_of_a_fit_is_the_shorter_fit(spark):
    """Rounds 1 to n of a longer boosting are the boosting of n rounds, tree by tree and in its errors."""
    from pyspark.ml import Pipeline

    train = train_rows(spark)
    rows = Pipeline(stages=ml.feature_stages()).fit(train).transform(train).select("features", "target").coalesce(1).cache()
    long_ = ml.gbt(maxDepth=4, maxIter=9).fit(rows)
    errors = long_.evaluateEachIteration(rows, "absolute")
    for n in (1, 4, 9):
        short = ml.gbt(maxDepth=4, maxIter=n).fit(rows)
        assert [t.toDebugString.split("\n", 1)[1] for t in short.trees] == [t.toDebugString.split("\n", 1)[1] for t in long_.trees[:n]]
        scored = short.transform(rows)
        assert abs(scored.agg(ml.mae(scored, "pred_gbt")).first()[0] - errors[n - 1]) < 1e-9


def test_a_search_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    train, grid, store = train_rows(spark), {**TINY, "maxIter": [1, 2]}, str(tmp_path / "search")
    want = sorted(map(tuple, ml.grid_search(train, grid, k=2)[1].collect()))
    made, gbt = [], ml.gbt

    def cut(*a, **kw):
        made.append(kw)
        if len(made) > 2:
            raise RuntimeError("lost")
        return gbt(*a, **kw)

    monkeypatch.setattr(ml, "PARALLEL_FITS", 1)
    monkeypatch.setattr(ml, "gbt", cut)
    try:
        ml.grid_search(train, grid, k=2, store=store)
        raise AssertionError("the search was not cut")
    except RuntimeError:
        pass
    made.clear()
    monkeypatch.setattr(ml, "gbt", lambda *a, **kw: (made.append(kw), gbt(*a, **kw))[1])
    assert sorted(map(tuple, ml.grid_search(train, grid, k=2, store=store)[1].collect())) == want
    assert len(made) == 2  # of two fits in two folds, two were there


def test_parallel_grid_equals_single_fits(spark):
    from sessionbars.operators.splits import chronological_split, time_series_folds

    feats = build_features(event_bars(spark, SF01))
    train = chronological_split(feats).filter(F.col("split") == "train").drop("split").cache()
    best, table = ml.grid_search(train, TINY, k=2)
    got = {r["combo"]: r["mean_mae"] for r in table.collect()}
    folds = time_series_folds(train, 2).cache()
    for ci, params in enumerate(ml.param_grid(TINY)):
        scores = []
        for f in range(2):
            tr, te = (folds.filter((F.col("fold") == f) & (F.col("role") == x)) for x in ("train", "test"))
            scored = ml.fit(ml.gbt(**params), tr).transform(te)
            scores.append(scored.agg(ml.mae(scored, "pred_gbt")).first()[0])
        assert abs(got[ci] - sum(scores) / 2) < 1e-9
    assert best == ml.param_grid(TINY)[min(got, key=lambda c: (got[c], c))]


def test_fits_of_the_search_do_not_carry_the_lineage_of_their_rows(spark, monkeypatch):
    """Each boosting job sends the lineage of its rows with its tasks: it must end at stored vectors."""
    plans, gbt = [], ml.gbt

    class Seen:
        def __init__(self, est):
            self.est = est

        def fit(self, rows):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return self.est.fit(rows)

    monkeypatch.setattr(ml, "gbt", lambda *a, **kw: Seen(gbt(*a, **kw)))
    ml.grid_search(train_rows(spark), {**TINY, "maxDepth": [2], "maxIter": [1]}, k=2)
    assert len(plans) == 2 and all("ExistingRDD" in p and "Window" not in p and "InMemory" not in p for p in plans), plans


def test_model_queries_use_the_stored_model(spark, monkeypatch):
    """Search, test rows, ledger and signal come from one artefact, trained once and read back."""
    import duckdb
    from oracle_harness import _canon

    from sessionbars.operators.splits import chronological_split
    from sessionbars.plans import q_ml
    from sessionbars.plans.q_backtest import _EV_PATH_BARS, EVENT_BARS, LEDGER_KINDS, feature_ctes, indicator_ctes, ledger_ctes, normalized_select, with_ctes

    import __spark_entry__ as E

    assert {"grid_search", "model_evaluate", "model_backtest", "latest_signal_model"} <= set(E.queries())
    grid, sizes = {**TINY, "maxDepth": [2]}, {"rf": {"numTrees": 5}, "gbt2": {"maxIter": 3}}
    trained = q_ml._ensemble(spark, SF01, grid, sizes)
    monkeypatch.setattr(ml, "train_ensemble", lambda *a, **kw: 1 / 0)  # from here on it is only loaded
    assert set(trained["members"]) == set(ml.ENSEMBLE_WEIGHTS) and trained["chosen"] in ("ensemble", "primary")
    feats = build_features(event_bars(spark, SF01))
    col = "pred_ensemble" if trained["chosen"] == "ensemble" else "pred_gbt"
    scored = ml.ensemble_average(ml.predict_members(trained["members"], feats)).toPandas()
    want = {(r["symbol"], r["datetime"].to_pydatetime()): r[col] for _, r in scored.iterrows()}

    led = q_ml.q_model_backtest(spark, SF01, grid, sizes)
    assert all(abs(r["predictions"] - want[r["symbol"], r["datetime"]]) < 1e-9 for r in led.collect())
    sig = q_ml.q_latest_signal_model(spark, SF01, grid, sizes).collect()
    assert len(sig) == len({s for s, _ in want}) and all(abs(r["prediction"] - want[r["symbol"], r["datetime"]]) < 1e-9 for r in sig if (r["symbol"], r["datetime"]) in want)

    # the ledger of these predictions by the SQL twin
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF01}/events.parquet')")
    con.register("scored", scored[["symbol", "datetime", col]].rename(columns={col: "prediction"}))
    sql = with_ctes(EVENT_BARS, indicator_ctes(), feature_ctes(), "src AS (SELECT feat.*, scored.prediction FROM feat JOIN scored USING (symbol, datetime))", _EV_PATH_BARS, ledger_ctes("src", "sbars"))
    twin = con.execute(sql + "\n" + normalized_select(LEDGER_KINDS, "led"))
    names = [d[0] for d in twin.description]
    rows = sorted((tuple(map(_canon, r)) for r in twin.fetchall()), key=repr)
    from sessionbars.plans.registry import normalize
    assert sorted((tuple(_canon(r[c]) for c in names) for r in normalize(led).collect()), key=repr) == rows and rows

    # held-out rows by hand
    test = chronological_split(feats).filter(F.col("split") == "test").toPandas()
    test["p"] = [want[s, t.to_pydatetime()] for s, t in zip(test["symbol"], test["datetime"])]
    for r in q_ml.q_model_evaluate(spark, SF01, grid, sizes).collect():
        g = test[test["symbol"] == r["symbol"]]
        assert r["n"] == len(g) and abs(r["mae"] - (g["target"] - g["p"]).abs().mean()) < 1e-6
        assert abs(r["r2"] - (1 - ((g["target"] - g["p"]) ** 2).sum() / ((g["target"] - g["target"].mean()) ** 2).sum())) < 1e-6


def test_fingerprints_follow_rows_and_settings(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "x int, y double")
    assert ml.fingerprint(a, 1) == ml.fingerprint(a.orderBy(F.desc("x")), 1) != ml.fingerprint(a, 2)
    assert ml.fingerprint(a, 1) != ml.fingerprint(a.limit(1), 1)


def test_elastic_net_by_hand(spark):
    """One feature: the coefficient is the soft-thresholded least-squares one, x and y centred."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    x = rng.normal(1.0, 2.0, 60)
    y = 0.7 * x + rng.normal(0, 0.3, 60) + 5
    df = spark.createDataFrame([(Vectors.dense([a]), float(b)) for a, b in zip(x, y)], ["features", "target"])
    model = ml.elastic_net().fit(df)
    xc, yc, lam, ratio = x - x.mean(), y - y.mean(), 0.1, 0.5
    sy = y.std(ddof=1)  # the library penalises on the scale of the label's deviation
    for want in [(xc @ yc / 60 - lam * ratio) / (xc @ xc / 60 + lam * (1 - ratio)), np.sign(xc @ yc) * max(abs(xc @ yc) / 60 - lam * ratio, 0) / (xc @ xc / 60 + lam * (1 - ratio) / sy)]:
        if abs(model.coefficients[0] - want) < 1e-3:
            break
    else:
        raise AssertionError((model.coefficients, want))
    assert abs(model.intercept - (y.mean() - model.coefficients[0] * x.mean())) < 1e-6


def test_trees_refit_alike(spark):
    train = train_rows(spark)
    for make in (lambda: ml.random_forest(numTrees=4, maxDepth=4), lambda: ml.gbt_second(maxIter=3, maxDepth=3)):
        a, b = (ml.fit(make(), train).stages[-1].toDebugString.split("\n", 1)[1] for _ in range(2))
        assert a == b
