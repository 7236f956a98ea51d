"""Models with Spark ML.

The reference fits a boosted-tree grid search, a random forest, a second
boosted model and an elastic net on one instrument, averages them with fixed
weights and keeps the ensemble only if it wins on validation.  Here:

* one model is fitted over all instruments at once, with the instrument as
  a one-hot feature (``by_symbol=True``), so a thousand symbols are one fit,
  not a thousand driver round trips;
* the grid search walks the expanding time-ordered folds of ``splits`` —
  Spark's ``CrossValidator`` folds are not time-ordered (they train on later
  rows), so the fold loop is ours while each fit is a distributed job;
* the ensemble is a weighted column expression over the members' outputs.

The tree library differs from the reference's, so predictions are not
expected to equal it; the structure, the selection rule and determinism are.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.functions.columns import confidence, predicted_direction
from sessionbars.operators import trees
from sessionbars.operators.features import MODEL_FEATURES
from sessionbars.operators.splits import chronological_split, time_series_folds
from sessionbars.session import checkpoint_root

# The reference's search space and ensemble weights.
REFERENCE_GRID = {
    "maxDepth": [4, 6, 8],
    "stepSize": [0.05, 0.1, 0.15],
    "maxIter": [100, 200, 300],
    "subsamplingRate": [0.8, 0.9],
    "featureSubsetStrategy": ["0.8", "0.9"],
}
ENSEMBLE_WEIGHTS = {"gbt": 0.4, "rf": 0.25, "gbt2": 0.25, "enet": 0.1}
SEED = 42
# Fits of the grid that run at a time.
PARALLEL_FITS = 8
# Rows of a fold that one partition holds.
ROWS_PER_PARTITION = 50_000


def feature_stages(features: list[str] = MODEL_FEATURES, by_symbol: bool = True, key: str = "symbol"):
    stages, cols = [], list(features)
    if by_symbol:
        stages += [StringIndexer(inputCol=key, outputCol="_sym_idx", handleInvalid="keep"),
                   OneHotEncoder(inputCols=["_sym_idx"], outputCols=["_sym_vec"], handleInvalid="keep")]
        cols.append("_sym_vec")
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"))
    return stages


def gbt(label: str = "target", pred: str = "pred_gbt", **params) -> GBTRegressor:
    """Squared-error boosted trees, seed 42."""
    p = {"maxDepth": 6, "stepSize": 0.1, "maxIter": 100, "subsamplingRate": 0.8,
         "featureSubsetStrategy": "0.8"}
    p.update(params)
    return GBTRegressor(labelCol=label, predictionCol=pred, lossType="squared", seed=SEED, **p)


def random_forest(label: str = "target", pred: str = "pred_rf", **params) -> RandomForestRegressor:
    """200 trees, depth 10, at least 2 rows per leaf, all features per split."""
    p = {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 2, "featureSubsetStrategy": "all"}
    p.update(params)
    return RandomForestRegressor(labelCol=label, predictionCol=pred, seed=SEED, **p)


def gbt_second(label: str = "target", pred: str = "pred_gbt2", **params) -> GBTRegressor:
    """200 rounds, learning rate 0.1, depth 6."""
    p = {"maxIter": 200, "stepSize": 0.1, "maxDepth": 6}
    p.update(params)
    return GBTRegressor(labelCol=label, predictionCol=pred, lossType="squared", seed=SEED, **p)


def elastic_net(label: str = "target", pred: str = "pred_enet", **params) -> LinearRegression:
    """Alpha 0.1, l1 ratio 0.5, unstandardised features."""
    p = {"regParam": 0.1, "elasticNetParam": 0.5, "standardization": False}
    p.update(params)
    return LinearRegression(labelCol=label, predictionCol=pred, **p)


def fit(estimator, train: DataFrame, by_symbol: bool = True) -> PipelineModel:
    return Pipeline(stages=feature_stages(by_symbol=by_symbol) + [estimator]).fit(train)


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there.  Boosting runs thousands
    of small jobs, and each sends its tasks the whole lineage of the rows, even of
    persisted ones; this cuts it, partitions and order staying as they are."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def mae(df: DataFrame, pred: str, label: str = "target") -> Column:
    return F.avg(F.abs(F.col(label) - F.col(pred)))


def param_grid(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def nested_fits(grid: dict) -> list[tuple[dict, dict[int, int]]]:
    """The fits a grid needs: (params with the most rounds, {combination: its rounds}).

    Boosting is sequential and every round has its own seed, so the first 100
    rounds of a 300-round fit are the 100-round fit: combinations that differ in
    ``maxIter`` alone are one fit."""
    out: dict[tuple, tuple[dict, dict[int, int]]] = {}
    for ci, params in enumerate(param_grid(grid)):
        rounds = params["maxIter"]
        rest = tuple((k, v) for k, v in params.items() if k != "maxIter")
        fit_params, members = out.setdefault(rest, (dict(params), {}))
        fit_params["maxIter"] = max(fit_params["maxIter"], rounds)
        members[ci] = rounds
    return list(out.values())


def fingerprint(df: DataFrame, *salt) -> str:
    """A name for the rows of df (in any order) and the settings: what is fitted on
    them can be found again under it."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    n, a, b = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.sum(F.xxhash64(row).cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((df.columns, n, str(a), str(b), salt)).encode()).hexdigest()[:24]


def _read_scores(spark, store: str) -> dict[tuple[int, int], list[float]]:
    """Scores of earlier fits, by (fit, fold)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return {}
    rows = spark.read.schema("fit int, fold int, errors array<double>").json(f"{store}/*").filter("errors is not null").collect()
    return {(r["fit"], r["fold"]): r["errors"] for r in rows}


def grid_search(train: DataFrame, grid: dict = REFERENCE_GRID, k: int = 3, label: str = "target",
                by_symbol: bool = True, store: str | None = None,
                rows_per_partition: int | None = None) -> tuple[dict, DataFrame]:
    """Mean MAE of each combination over the expanding time folds.

    Returns (best params, one row per combination with its mean MAE).  Every fit
    is a distributed job over its fold's vectors, which are assembled and
    ``stored`` once, ``rows_per_partition`` in a partition where it is given (a
    boosting round costs a few tasks for each, however few the rows); a fold that
    one task can boost (``trees.fits_in_a_task``) is then boosted there, with the
    same trees. ``PARALLEL_FITS`` are submitted at a time.  One fit of the most rounds serves
    all combinations nested in it (``nested_fits``), scored round by round.

    With ``store``, a folder that outlives the session, each finished fit, or group
    of fits that run in one task each, leaves its errors there and a search that was cut off goes on where it stood."""
    folds = time_series_folds(train, k).cache()
    spark = train.sparkSession
    data = []
    for f in range(k):
        tr = folds.filter((F.col("fold") == f) & (F.col("role") == "train"))
        te = folds.filter((F.col("fold") == f) & (F.col("role") == "test"))
        vectors = Pipeline(stages=feature_stages(by_symbol=by_symbol)).fit(tr)
        sides, sizes = [], []
        for x in (tr, te):
            v = vectors.transform(x).select("features", label)
            if rows_per_partition:
                sizes.append(x.count())
                parts = -(-sizes[-1] // rows_per_partition)
                v = v.coalesce(1) if parts <= 1 else v.repartition(parts)
            sides.append(stored(v))
        small = sizes and max(sizes) <= rows_per_partition and all(trees.all_finite(v, label) for v in sides)
        data.append((sides, sizes[0] if small else None, trees.arities(sides[0])))
    combos, fits = param_grid(grid), nested_fits(grid)
    errors = _read_scores(spark, store) if store else {}

    def keep(name: str, found: dict) -> None:
        if store:
            rows = spark.createDataFrame([(*job, e) for job, e in found.items()], "fit int, fold int, errors array<double>")
            rows.coalesce(1).write.mode("overwrite").json(f"{store}/{name}")

    def score(job: tuple[int, int]) -> tuple[tuple[int, int], list[float]]:
        i, f = job
        model = gbt(label, **fits[i][0]).fit(data[f][0][0])
        found = list(model.evaluateEachIteration(data[f][0][1], "absolute"))
        keep(f"fit-{i}-fold-{f}", {job: found})
        return job, found

    todo = [(i, f) for i in range(len(fits)) for f in range(k) if (i, f) not in errors]
    # fits of small folds go to one task each, two rounds of tasks at a time
    few = {(i, f): p for i, f in todo if data[f][1] and (p := trees.fits_in_a_task(gbt(label, **fits[i][0]), *data[f][1:]))}
    if few:
        sides = {f: tuple(trees.matrix(v, label, len(data[f][2])) for v in data[f][0]) + (data[f][2],) for f in {f for _, f in few}}
        shared, wave = spark.sparkContext.broadcast(sides), max(PARALLEL_FITS, 2 * spark.sparkContext.defaultParallelism)
        for lo in range(0, len(few), wave):
            some = list(few)[lo : lo + wave]
            found = trees.boosting_errors(spark, {job: (job[1], few[job]) for job in some}, shared)
            keep(f"fits-{uuid.uuid4().hex[:12]}", found)
            errors |= found
        shared.unpersist()
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        errors |= dict(pool.map(inheritable_thread_target(spark)(score), [job for job in todo if job not in few]))
    folds.unpersist()
    mean = {ci: sum(errors[i, f][rounds - 1] for f in range(k)) / k for i, (_, members) in enumerate(fits) for ci, rounds in members.items()}
    rows = [(ci, str(params), float(mean[ci])) for ci, params in enumerate(combos)]
    res = spark.createDataFrame(rows, "combo long, params string, mean_mae double")
    best = combos[min(rows, key=lambda r: (r[2], r[0]))[0]]
    return best, res


def ensemble_average(df: DataFrame, cols: dict[str, str] | None = None, out: str = "pred_ensemble",
                     weights: dict[str, float] = ENSEMBLE_WEIGHTS) -> DataFrame:
    """Weighted average of member predictions (weights sum to 1)."""
    cols = cols or {m: f"pred_{m}" for m in weights}
    total = sum(weights[m] for m in cols)
    expr = sum(F.col(c) * F.lit(weights[m]) for m, c in cols.items()) / F.lit(total)
    return df.withColumn(out, expr)


def select_model(val: DataFrame, primary: str = "pred_gbt", ensemble: str = "pred_ensemble",
                 label: str = "target", key: str | None = "symbol") -> DataFrame:
    """Validation MAE of both; the ensemble is chosen only if strictly lower."""
    g = val.groupBy(key) if key else val.groupBy()
    agg = g.agg(mae(val, primary, label).alias("mae_primary"), mae(val, ensemble, label).alias("mae_ensemble"))
    return agg.withColumn("chosen", F.when(F.col("mae_ensemble") < F.col("mae_primary"), F.lit("ensemble"))
                                     .otherwise(F.lit("primary")))


def train_ensemble(features: DataFrame, grid: dict = REFERENCE_GRID, sizes: dict | None = None,
                   by_symbol: bool = True, store: str | None = None) -> dict:
    """E1 in one call: split, search, fit the four members, pick the model."""
    sp = chronological_split(features).cache()
    train = sp.filter(F.col("split") == "train").drop("split")
    val = sp.filter(F.col("split") == "val").drop("split")
    best, table = grid_search(train, grid, by_symbol=by_symbol, store=store, rows_per_partition=ROWS_PER_PARTITION)
    sizes = sizes or {}    # overrides per member, e.g. {"rf": {"numTrees": 20}}
    # the library's boosting runs a task and writes shuffle files per partition and level of a tree, however few the rows
    rows = stored(train.coalesce(1) if train.count() <= ROWS_PER_PARTITION else train)
    estimators = {"gbt": gbt(**best), "rf": random_forest(**sizes.get("rf", {})), "gbt2": gbt_second(**sizes.get("gbt2", {})), "enet": elastic_net()}
    run = inheritable_thread_target(features.sparkSession)(lambda est: fit(est, rows, by_symbol))
    with ThreadPoolExecutor(len(estimators)) as pool:
        members = dict(zip(estimators, pool.map(run, estimators.values())))
    scored = predict_members(members, val)
    choice = select_model(ensemble_average(scored), key=None).first()["chosen"]
    return {"members": members, "best_params": best, "grid": table, "chosen": choice, "split": sp}


def predict_members(members: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Score every member; each model adds its own prediction column."""
    out = df
    for name, model in members.items():
        out = model.transform(out).drop("_sym_idx", "_sym_vec", "features")
    return out


def predict_chosen(trained: dict, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Score ``df`` with the model that ``train_ensemble`` chose."""
    scored = ensemble_average(predict_members(trained["members"], df), weights=trained.get("weights", ENSEMBLE_WEIGHTS))
    return scored.withColumn(out, F.col("pred_ensemble" if trained["chosen"] == "ensemble" else "pred_gbt"))


def save_ensemble(trained: dict, path: str) -> None:
    """The ensemble as one artefact: the members, and, written last, what it takes to
    use them (weights, choice, feature list, search results)."""
    spark = trained["split"].sparkSession
    for name, model in trained["members"].items():
        save_model(model, f"{path}/{name}")
    trained["grid"].coalesce(1).write.mode("overwrite").parquet(f"{path}/grid")
    about = {"members": list(trained["members"]), "weights": ENSEMBLE_WEIGHTS, "chosen": trained["chosen"],
             "features": MODEL_FEATURES, "best_params": trained["best_params"]}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_ensemble(spark, path: str) -> dict | None:
    """The artefact at ``path`` as ``predict_chosen`` takes it; None where there is none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/about/_SUCCESS")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    if about["features"] != MODEL_FEATURES:
        raise ValueError("the stored model was fitted on other features")
    return {**about, "members": {m: load_model(f"{path}/{m}") for m in about["members"]}, "grid": spark.read.parquet(f"{path}/grid")}


def trained_on(features: DataFrame, root: str, grid: dict = REFERENCE_GRID, sizes: dict | None = None) -> dict:
    """The ensemble of these features and settings: loaded from ``root`` if it is
    there, else trained (the search going on where an earlier one stopped) and
    saved.  What comes back was read from the artefact either way."""
    spark = features.sparkSession
    path = f"{root}/{fingerprint(features, grid, sizes, SEED, ENSEMBLE_WEIGHTS)}"
    if load_ensemble(spark, path) is None:
        save_ensemble(train_ensemble(features, grid, sizes, store=f"{path}/search"), path)
    return load_ensemble(spark, path)


def score_latest(features: DataFrame, pred: str = "prediction", key: str = "symbol",
                 order: str = "datetime") -> DataFrame:
    """Newest feature row per symbol with direction and confidence."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    f = features.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return (f.withColumn("direction", predicted_direction(pred))
             .withColumn("confidence", confidence(pred)))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (features + estimator)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
