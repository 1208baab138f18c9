"""Training flows: hold-out evaluation, tuning, config grid, scoring, backtest,
attribution (M6, M7, M10, M11, M13, with A8, T3 and P9/P10).

Candidates, configs and days are independent fits over much the same rows, so
they train together: rows are packed once, every fit names its rows by a
condition on their key (fold, side of the split, day), and each Spark job
serves all of them (``boosting.train``, ``mlp.fit_networks``).
"""

from __future__ import annotations

import datetime
import itertools
import random

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round_half_even
from ..operators import report as RP
from ..operators import stats as ST
from ..session import materialize
from . import boosting as BO
from . import estimators as ES
from . import mlp as NN
from .blocks import pack
from .mlp import MlpRegressor

LABEL = "temperature"


# --------------------------------------------------------------------------- splits
def split_by_year(df: DataFrame, train_end: int, test_start: int, ts: str = "datetime"):
    """Train <= train_end, test >= test_start."""
    y = F.year(ts)
    return df.where(y <= train_end), df.where(y >= test_start)


def day_fold(df: DataFrame, day: str, ts: str = "datetime"):
    """Train strictly before ``day``, test in [day, day + 1) (P10)."""
    d = F.lit(day).cast("timestamp_ntz")
    return df.where(F.col(ts) < d), df.where((F.col(ts) >= d) & (F.col(ts) < d + F.expr("INTERVAL 1 DAY")))


# --------------------------------------------------------------------------- hold-out evaluation
def fit_models(train: DataFrame, feature_cols: list[str], gbt_params: dict | None = None,
               hidden=(128, 64, 32), mlp_iter: int = 500, mlp_lr: float = 1e-3, forest: bool = True):
    """Fit scaler + network, boosted trees and (optionally) the forest on ``train``."""
    tr = ES.training_frame(ES.assemble(train, feature_cols))
    sc = ES.scaler(tr)
    models = {"scaler": sc,
              "xgb": ES.fit_gbt(tr, LABEL, gbt_params),
              "nn": MlpRegressor(hidden=hidden, max_iter=mlp_iter, learning_rate=mlp_lr).fit(sc.transform(tr))}
    if forest:
        models["rf"] = ES.fit_forest(tr, LABEL)
    tr.unpersist()
    return models


def predict(df: DataFrame, models: dict, feature_cols: list[str]) -> DataFrame:
    """All fitted models' predictions on one frame (M9)."""
    x = ES.assemble(df, feature_cols)
    return ES.score(x, [models[k] for k in ("scaler", "xgb", "nn", "rf") if k in models])


def evaluate(df: DataFrame, models: dict, feature_cols: list[str], stage: str) -> DataFrame:
    """(stage, model, mae, rmse, r2) for every fitted model."""
    p = predict(df, models, feature_cols)
    preds = {m: f"{m}_pred" for m in ("xgb", "nn", "rf") if m in models}
    return ST.regression_metrics(p, LABEL, preds).withColumn("stage", F.lit(stage))


# --------------------------------------------------------------------------- M6
def _inputs(feature_cols: list[str]):
    return F.array(*[F.col(c).cast("double") for c in feature_cols])


def tune(train: DataFrame, feature_cols: list[str], n_candidates: int = 5, folds: int = 3,
         seed: int = 42, space: dict | None = None) -> dict:
    """Random search: ``n_candidates`` of the 12-point grid, k-fold CV on MAE (M6).

    A row's fold is a hash of its inputs and label, so folds do not depend on
    partitioning.  All candidates and folds train together.
    """
    sp = space or S.TUNE_GRID
    grid = list(itertools.product(sp["n_estimators"], sp["max_depth"], sp["learning_rate"]))
    pick = random.Random(seed).sample(grid, min(n_candidates, len(grid)))
    params = [{"n_estimators": n, "max_depth": d, "learning_rate": lr} for n, d, lr in pick]
    fold = F.pmod(F.xxhash64(*feature_cols, LABEL, F.lit(seed)), F.lit(folds))
    x = _inputs(feature_cols)
    blocks = pack(train, x, F.col(LABEL), fold)
    cases = [(i, f) for i in range(len(params)) for f in range(folds)]
    fitted = BO.train(blocks, BO.bin_edges(train, x, len(feature_cols)),
                      [BO.spec_of(params[i], ("not", f), seed) for i, f in cases])
    mae = {r.model: r.mae for r in fitted.errors([("equal", f) for _, f in cases]).collect()}     # one row a fit
    score = [[mae[m] for m, (j, _) in enumerate(cases) if j == i and m in mae] for i in range(len(params))]
    means = [sum(v) / len(v) if v else float("inf") for v in score]
    best = min(range(len(params)), key=means.__getitem__)
    return {**params[best], "cv_mae": float(means[best])}


# --------------------------------------------------------------------------- M7 + T3
GRID_CONFIGS = S.TREE_CONFIGS + S.NETWORK_CONFIGS


def grid(spark: SparkSession, train: DataFrame, test: DataFrame, feature_cols: list[str],
         configs: list[dict], baseline_mae: float) -> DataFrame:
    """Fit every config on ``train``, score on the fixed ``test`` hold-out, rank.

    A config that fails is a row with its ``error``, without metrics and rank.  Tree configs: ``{"name", "params"}``;
    network configs: ``{"name", "hidden", "alpha", "iter"}``.  The trees of all configs grow together, then
    the networks.
    """
    x, train_side, test_side = _inputs(feature_cols), ("equal", 0), ("equal", 1)
    both = train.withColumn("_side", F.lit(0)).unionByName(test.withColumn("_side", F.lit(1)))
    blocks = pack(both, x, F.col(LABEL), F.col("_side"))
    trees, networks, rows, failed = [], [], [], []
    for cfg in configs:
        try:
            if "params" in cfg:
                trees.append((cfg["name"], BO.spec_of({**S.DEFAULT_GBT_PARAMS, **cfg["params"]}, train_side)))
            else:
                networks.append((cfg["name"], NN.NetworkSpec(
                    tuple(cfg.get("hidden", (64,))), cfg.get("alpha", 1e-3), cfg.get("lr", 1e-2), cfg.get("iter", 50), rows=train_side)))
        except (ValueError, TypeError) as e:
            failed.append((cfg["name"], f"{type(e).__name__}: {e}"[:500]))

    def fit_trees(specs):
        return BO.train(blocks, BO.bin_edges(train, x, len(feature_cols)), specs).errors([test_side] * len(specs))

    def fit_networks(specs):
        return NN.fit_networks(blocks, len(feature_cols), specs).errors(blocks, [test_side] * len(specs))
    for named, fit in ((trees, fit_trees), (networks, fit_networks)):
        if not named:
            continue
        try:
            found = {r.model: r for r in fit([spec for _, spec in named]).collect()}       # one row a config
        except Exception as e:  # noqa: BLE001 - the other kind goes on, as in the source
            failed += [(name, f"{type(e).__name__}: {e}"[:500]) for name, _ in named]
            continue
        for i, (name, _) in enumerate(named):
            if i in found:
                rows.append((name, found[i].mae, found[i].rmse, found[i].r2))
            else:
                failed.append((name, "no rows to fit or to score"))
    res = spark.createDataFrame(rows, "name string, mae double, rmse double, r2 double")
    board = RP.leaderboard(res, baseline_mae).withColumn("error", F.lit(None).cast("string"))
    return board.unionByName(spark.createDataFrame(failed, "name string, error string"), allowMissingColumns=True)


# --------------------------------------------------------------------------- M10
def score_requests(requests: DataFrame, features: DataFrame, models: dict, feature_cols: list[str]) -> DataFrame:
    """(region, date) requests -> both models' predictions, 2 dp half-even.

    Latest feature row per region (W6, an aggregate) joined to the requests
    (J3, unknown regions drop), requested time injected (P22), scored (M9).
    A missing tree model falls back to the network's prediction; a request whose
    date does not parse is answered with NULL predictions.
    """
    req = requests.withColumn("target_datetime", F.col("date").cast("string").try_cast("timestamp_ntz"))
    attached = RP.attach_latest(req, features)
    unread = attached.where(F.col("target_datetime").isNull())
    j = RP.inject_datetime(attached.where(F.col("target_datetime").isNotNull()))
    p = predict(j, models, feature_cols)
    xgb = F.col("xgb_pred") if "xgb" in models else F.col("nn_pred")
    none = F.lit(None).cast("double")
    return p.select("region", F.col("date").cast("string").alias("date"),
                    round_half_even(F.col("nn_pred"), 2).alias("nn_pred"),
                    round_half_even(xgb, 2).alias("xgb_pred")).unionByName(
        unread.select("region", F.col("date").cast("string").alias("date"), none.alias("nn_pred"), none.alias("xgb_pred")))


def live_scorer(models: dict, feature_cols: list[str]):
    """Fitted or loaded models as the ``score`` of ``report.live_error``."""
    def score(df: DataFrame) -> DataFrame:
        p = predict(df, models, feature_cols)
        return p.withColumns({RP.PRED_COLS["nn"]: F.col("nn_pred"),
                              RP.PRED_COLS["xgb"]: F.col("xgb_pred" if "xgb" in models else "nn_pred")})
    return score


# --------------------------------------------------------------------------- M11
EPOCH = datetime.date(1970, 1, 1)
TOGETHER = 16                   # days whose fits share their jobs, and whose rows are written together


def backtest(features: DataFrame, days: list[str], feature_cols: list[str], gbt_params: dict | None = None,
             hidden=(150,), mlp_iter: int = 500, every: int = 1, sink=None,
             save_to: str | None = None, together: int = TOGETHER) -> DataFrame | None:
    """Expanding-window daily backtest -> (date, xgb_mae, nn_mae).

    For each day (every ``every``-th): train on all rows before it, test on
    that day; an empty side skips the day.  The features are computed and
    packed once, with the day as the rows' key.  ``together`` days train in the
    same jobs; ``sink(rows_df)`` receives their rows (e.g. ``sinks.append_drift``)
    before the next ones start, so a run that is cut short repeats these days
    at most.  Bins are made from the rows before the first of them.
    ``save_to`` keeps the latest day's models there, for scoring from disk.
    """
    spark = features.sparkSession
    features = materialize(features.select("datetime", LABEL, *feature_cols))
    day = F.unix_date(F.to_date("datetime"))
    held = [r.d for r in features.select(day.alias("d")).where("d IS NOT NULL").distinct().collect()]     # calendar-sized
    numbers = {d: (datetime.date.fromisoformat(d) - EPOCH).days for d in days[::every]}
    wanted = [d for d, n in numbers.items() if n in set(held) and min(held) < n]
    if not wanted:
        return None
    x, out = _inputs(feature_cols), []
    blocks = pack(features.where(day.isNotNull()), x, F.col(LABEL), day)
    params = {**S.DEFAULT_GBT_PARAMS, **(gbt_params or {})}
    for start in range(0, len(wanted), together):
        now = wanted[start:start + together]
        before = [("below", numbers[d]) for d in now]
        test = [("equal", numbers[d]) for d in now]
        edges = BO.bin_edges(features.where(day < numbers[now[0]]), x, len(feature_cols))
        trees = BO.train(blocks, edges, [BO.spec_of(params, rows, ES.SEED) for rows in before])
        networks = NN.fit_networks(blocks, len(feature_cols), [
            NN.NetworkSpec(tuple(hidden), learning_rate=1e-2, max_iter=mlp_iter, rows=rows) for rows in before])
        xgb, nn = ({r.model: r.mae for r in e.collect()} for e in (trees.errors(test), networks.errors(blocks, test)))
        rows = [(d, xgb.get(i), nn.get(i)) for i, d in enumerate(now)]
        if save_to is not None:
            models = {"xgb": BO.models_of(trees)[-1], "nn": networks.models[-1]}
            ES.save_models(spark, {k: m for k, m in models.items() if m is not None}, save_to, {"day": now[-1], "features": feature_cols})
        if sink is not None:
            sink(spark.createDataFrame(rows, "date string, xgb_mae double, nn_mae double"))
        out += rows
    return spark.createDataFrame(out, "date string, xgb_mae double, nn_mae double")


# --------------------------------------------------------------------------- M13
def attribution(model, df: DataFrame, feature_cols: list[str], n: int = 500, permutations: int = 8,
                seed: int = 42, key: list[str] = ("region", "datetime")) -> DataFrame:
    """Global attribution by sampled Shapley values (M13) -> (feature, mean_abs_shap).

    ``n`` rows (seeded, exact count) x ``permutations`` feature orders x
    (features + 1) prefixes are generated with ``explode`` (no join); each
    prefix vector takes the row's values for the features already "added"
    and the background mean for the rest.  One ``transform`` scores all of
    them; successive differences are the marginal contributions.
    """
    k = len(feature_cols)
    rng = random.Random(seed)
    perms = [rng.sample(range(k), k) for _ in range(permutations)]
    rows = ES.sample_n(df, n, list(key), seed).withColumn("_row", F.monotonically_increasing_id())
    x = ES.assemble(rows, feature_cols, "_x").withColumn("_xa", vector_to_array("_x"))
    # background = feature means: k numbers (model-sized), carried as literals
    means = df.agg(*[F.avg(c) for c in feature_cols]).first()
    bg = F.array(*[F.lit(float(v) if v is not None else 0.0) for v in means])
    perm_arr = F.array(*[F.array(*[F.lit(i) for i in p]) for p in perms])
    t = (x.withColumn("_bg", bg)
         .select("_row", "_xa", "_bg", F.posexplode(perm_arr).alias("_p", "_perm"))
         .select("*", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("_step")))
    # feature i is "in" when its rank in the permutation is below the step
    rank = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.array_position(F.col("_perm"), i) - 1)
    mixed = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                        lambda i: F.when(F.element_at(rank, i + 1) < F.col("_step"), F.element_at("_xa", i + 1))
                        .otherwise(F.element_at("_bg", i + 1)))
    t = t.withColumn("features", array_to_vector(mixed))
    pred_col = model.pred if isinstance(model, BO.BoostedModel) else model.getOrDefault("predictionCol")
    scored = model.transform(t)
    w = Window.partitionBy("_row", "_p").orderBy("_step")      # groups of k + 1 rows
    contrib = (scored.withColumn("_d", F.col(pred_col) - F.lag(pred_col).over(w))
               .where(F.col("_step") > 0)
               .withColumn("_f", F.element_at("_perm", F.col("_step"))))
    per_row = contrib.groupBy("_row", "_f").agg(F.avg("_d").alias("_phi"))
    names = F.array(*[F.lit(c) for c in feature_cols])
    return (per_row.groupBy("_f").agg(F.avg(F.abs("_phi")).alias("mean_abs_shap"))
            .select(F.element_at(names, F.col("_f") + 1).alias("feature"), "mean_abs_shap"))
