"""Model operators: network regressor, reuse, sampling, scoring, backtest, attribution."""

import os

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationlab.models import blocks as BL
from stationlab.models import boosting as BO
from stationlab.models import estimators as ES
from stationlab.models import mlp as NN
from stationlab.models import training as TR
from stationlab.models.mlp import MlpRegressor
from stationlab.operators import stats as ST
from stationlab.sources import testbed as TB
from stationlab.streaming import catch_up as CU


def _linear(spark):
    e = TB.table(spark, SF_SMALL, "events")
    return e.select((F.col("value") / 100.0).alias("a"), ((F.col("user_id") % 40) / 40.0).alias("b"),
                    (F.col("value") / 50.0 + (F.col("user_id") % 40) / 40.0).alias("temperature"))


def test_network_regressor_learns_a_linear_map(spark):
    df = ES.assemble(_linear(spark), ["a", "b"], "scaled")
    model = MlpRegressor(hidden=(16,), max_iter=300, learning_rate=0.02, patience=30).fit(df)
    m = ST.regression_metrics(model.transform(df), "temperature", {"nn": "nn_pred"}).first()
    assert m.r2 > 0.95, m


def test_network_regressor_full_batch_solver(spark):
    df = ES.assemble(_linear(spark), ["a", "b"], "scaled")
    model = MlpRegressor(hidden=(16,), max_iter=300, learning_rate=0.02, patience=30, solver="full").fit(df)
    m = ST.regression_metrics(model.transform(df), "temperature", {"nn": "nn_pred"}).first()
    assert m.r2 > 0.95, m


def test_sample_n_is_exact_and_stable(spark):
    h = TB.hourly_from_events(spark, SF_SMALL)
    a = ES.sample_n(h, 50, ["region", "datetime"]).collect()
    b = ES.sample_n(h.repartition(5), 50, ["region", "datetime"]).collect()
    assert len(a) == 50 and sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_load_or_fit_reuses_matching_signature(spark, tmp_out):
    df = ES.assemble(_linear(spark), ["a", "b"])
    calls = []

    def fit():
        calls.append(1)
        return {"xgb": ES.fit_gbt(df, "temperature", {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3})}
    path = os.path.join(tmp_out, "model")
    sig = {"features": ["a", "b"], "params": [3, 2, 0.3]}
    ES.load_or_fit(spark, path, sig, fit)
    ES.load_or_fit(spark, path, sig, fit)
    assert len(calls) == 1
    ES.load_or_fit(spark, path, {**sig, "features": ["a"]}, fit)
    assert len(calls) == 2
    ES.load_or_fit(spark, path, {**sig, "features": ["a"]}, fit, force=True)
    assert len(calls) == 3
    ES._write_signature(spark, f"{path}/signature", {}, sig)       # a save cut short
    assert ES.load_models(spark, path) is None


def test_ensure_skips_existing(spark, tmp_out):
    path = os.path.join(tmp_out, "stage")
    n = []

    def compute():
        n.append(1)
        return spark.range(3)
    ES.ensure(spark, path, compute)
    ES.ensure(spark, path, compute)
    assert len(n) == 1
    ES.ensure(spark, path, compute, force=True)
    assert len(n) == 2


def test_ensure_recomputes_under_another_signature(spark, tmp_out):
    path = os.path.join(tmp_out, "stage")
    for sig, rows in (({"p": 1}, 3), ({"p": 1}, 4), ({"p": 2}, 5)):
        n = ES.ensure(spark, path, lambda rows=rows: spark.range(rows), signature=sig).count()
        assert n == (3 if sig["p"] == 1 else 5)


def test_score_requests_and_fallback(spark, tmp_out):
    from stationlab.operators import features as FE
    feat = FE.feature_table(TB.hourly_from_events(spark, SF_SMALL))
    cols = FE.feature_columns(feat)
    models = TR.fit_models(feat, cols, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3},
                           hidden=(8,), mlp_iter=3, mlp_lr=1e-2, forest=False)
    req = spark.createDataFrame([("view", "2024-02-01"), ("Nowhere", "2024-02-01")], "region string, date string")
    out = TR.score_requests(req, feat, models, cols).collect()
    assert [r.region for r in out] == ["view"]
    path = os.path.join(tmp_out, "models")
    assert ES.load_models(spark, path) is None
    ES.save_models(spark, models, path, {"features": cols})
    assert ES.load_models(spark, path, {"features": cols[1:]}) is None
    saved = ES.load_models(spark, path, {"features": cols})
    assert TR.score_requests(req, feat, saved, cols).collect() == out
    no_tree = {k: v for k, v in models.items() if k != "xgb"}
    out = TR.score_requests(req, feat, no_tree, cols).collect()
    assert out[0].xgb_pred == out[0].nn_pred


def test_backtest_skips_empty_days(spark):
    from stationlab.operators import features as FE
    feat = FE.feature_table(TB.hourly_from_events(spark, SF_SMALL))
    cols = FE.feature_columns(feat)
    res = TR.backtest(feat, ["2023-12-01", "2024-01-29"], cols,
                      {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3}, hidden=(8,), mlp_iter=3)
    assert [r.date for r in res.collect()] == ["2024-01-29"]


def test_model_queries_run_the_whole_job(spark, monkeypatch):
    from stationlab.operators import features as FE
    from stationlab.registry import QUERIES
    asked = {}

    def note(name):
        def call(*args, **kwargs):
            asked[name] = (args, kwargs)
            return {"cv_mae": 0.0} if name == "tune" else spark.range(1)
        return call
    for name in ("backtest", "tune", "grid", "fit_models", "evaluate"):
        monkeypatch.setattr(TR, name, note(name))
    monkeypatch.setattr(ES, "fit_gbt", note("fit_gbt"))
    monkeypatch.setattr(ES, "top_importance", note("top"))
    for name in ("backtest", "tuning", "grid_leaderboard", "ml_holdout_metrics", "importances"):
        QUERIES[name](spark, SF_SMALL)
    feat = FE.feature_table(TB.hourly_from_events(spark, SF_SMALL))
    days = {str(r.d) for r in feat.select(F.to_date("datetime").alias("d")).distinct().collect()}
    assert len(days) > 20
    (_, planned, *rest), kwargs = asked["backtest"]
    assert planned == sorted(days)[1:] and len(rest) == 1 and not kwargs
    assert len(asked["tune"][0]) == 2 and not asked["tune"][1]
    configs = asked["grid"][0][4]
    assert len(configs) == len({c["name"] for c in configs}) == 22 and sum("params" in c for c in configs) == 7
    assert len(asked["fit_models"][0]) == 2 and not asked["fit_models"][1]
    assert len(asked["fit_gbt"][0]) == 2 and not asked["fit_gbt"][1]


def test_grid_returns_failed_configs_as_rows(spark):
    df = _linear(spark)
    configs = [{"name": "good", "params": {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3}},
               {"name": "bad", "params": {"n_estimators": 2, "grow_policy": 0.1}}]
    got = {r["name"]: r for r in TR.grid(spark, df, df, ["a", "b"], configs, baseline_mae=1.0).collect()}
    assert (got["good"]["rank"], got["good"]["error"]) == (1, None) and got["good"]["mae"] is not None
    assert (got["bad"]["rank"], got["bad"]["mae"]) == (None, None) and "grow_policy" in got["bad"]["error"]


def test_attribution_finds_the_driving_feature(spark):
    df = _linear(spark).withColumn("region", F.lit("r")).withColumn("datetime", F.monotonically_increasing_id())
    m = ES.fit_gbt(ES.assemble(df, ["a", "b"]), "temperature", {"n_estimators": 20, "max_depth": 4,
                                                                  "learning_rate": 0.3})
    out = TR.attribution(m, df, ["a", "b"], n=40, permutations=4).orderBy(F.desc("mean_abs_shap")).collect()
    assert out[0].feature == "a"


def test_batch_run_writes_every_stage_and_skips_on_rerun(spark, tmp_out):
    from stationlab.plans.batch import run_batch
    master = TB.hourly_from_events(spark, SF_SMALL)
    out = os.path.join(tmp_out, "batch")
    res = run_batch(spark, master, out, split_at="2024-01-25",
                    gbt_params={"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3},
                    hidden=(8,), mlp_iter=3, shap_rows=20, n_candidates=2,
                    space={"n_estimators": [2, 4], "max_depth": [2], "learning_rate": [0.3]})
    assert res["metrics"].count() == 3 and res["metrics_optimized"].count() == 3
    assert {r.stage for r in res["metrics_optimized"].collect()} == {"optimized"}
    first = {r.model: r.mae for r in res["metrics"].collect()}
    assert res["predictions"].count() > 0
    assert 0.0 <= res["season_accuracy"].first().accuracy <= 1.0
    for sub in ("null_counts", "corr", "features", "metrics", "predictions", "anomaly_counts", "summary", "kpis",
                "webdata/kpis"):
        assert os.path.isdir(os.path.join(out, sub)), sub
    # other parameters: models and metrics are made anew, and the metrics are those of the predictions
    res = run_batch(spark, master, out, split_at="2024-01-25", hidden=(8,), mlp_iter=3, shap_rows=20,
                    gbt_params={"n_estimators": 1, "max_depth": 1, "learning_rate": 0.3}, n_candidates=0)
    again = {r.model: r.mae for r in res["metrics"].collect()}
    assert again["xgb"] != first["xgb"]
    mae = res["predictions"].agg(F.avg(F.abs(F.col("temperature_actual") - F.col("temperature_xgb_pred")))).first()[0]
    assert abs(mae - again["xgb"]) < 1e-4            # predictions are stored as 32-bit floats
    mtime = os.path.getmtime(os.path.join(out, "null_counts"))
    run_batch(spark, master, out, split_at="2099-01-01")      # empty test side: stops after features
    assert os.path.getmtime(os.path.join(out, "null_counts")) == mtime


# --------------------------------------------------------------------------- boosting
def _numbers(spark, n=900, key="i % 3"):
    """Rows whose label is a made function of three inputs, one of them with missing values."""
    return spark.range(n).selectExpr(
        "id AS i", "CAST((id * 7919) % 101 AS DOUBLE) AS a", "CAST((id * 104729) % 37 AS DOUBLE) AS b",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST((id * 31) % 5 AS DOUBLE) END AS c").selectExpr(
        "*", "a / 10 + CASE WHEN b > 20 THEN 5 ELSE 0 END + coalesce(c, -3.0) * a / 50 AS temperature", f"{key} AS key")


def _blocks(df):
    x = F.array("a", "b", "c")
    return BL.pack(df, x, F.col("temperature"), F.col("key")), BO.bin_edges(df, x, 3)


def _shape(tree, i=0):
    return None if tree.feature[i] < 0 else (tree.feature[i], tree.code[i], _shape(tree, tree.left[i]), _shape(tree, tree.right[i]))


def _brute(codes, g, spec, depth):
    """Exhaustive search over all features and bounds; of equal gains the first."""
    def q(s, n):
        s = np.sign(s) * max(abs(s) - spec.reg_alpha, 0.0)
        return s * s / (n + spec.reg_lambda)
    best, at = 1e-9, None
    for f in range(codes.shape[1] if depth else 0):
        for c in np.unique(codes[:, f])[:-1]:
            left = codes[:, f] <= c
            n = int(left.sum())
            if min(n, len(g) - n) >= spec.min_child_weight:
                gain = q(g[left].sum(), n) + q(g[~left].sum(), len(g) - n) - q(g.sum(), len(g))
                if gain > best + 1e-12:
                    best, at = gain, (f, int(c))
    if at is None:
        return None
    left = codes[:, at[0]] <= at[1]
    return (*at, _brute(codes[left], g[left], spec, depth - 1), _brute(codes[~left], g[~left], spec, depth - 1))


@pytest.mark.parametrize("spec", [BO.BoostSpec(max_depth=4), BO.BoostSpec(max_depth=3, min_child_weight=9, reg_alpha=2.5, reg_lambda=0.5)])
def test_grown_tree_is_the_exhaustive_one(spec):
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 9, (160, 4)).astype(np.uint8)
    g = rng.standard_normal(160) + codes[:, 1]
    tree = BO.grow(codes, g, spec, spec.max_depth, np.arange(4))
    assert _shape(tree) == _brute(codes, g, spec, spec.max_depth)
    leaf = BO.nodes_of(tree, codes)
    for i in np.unique(leaf):
        mine = leaf == i
        s = g[mine].sum()
        s = np.sign(s) * max(abs(s) - spec.reg_alpha, 0.0)
        assert tree.rows[i] == mine.sum() and abs(tree.value[i] + spec.learning_rate * s / (mine.sum() + spec.reg_lambda)) < 1e-12


def test_trees_split_by_spark_equal_trees_grown_in_a_task(spark):
    blocks, edges = _blocks(_numbers(spark))
    specs = [BO.BoostSpec(3, 4, 0.3, rows=("not", 2)), BO.BoostSpec(2, 3, 0.3, subsample=0.7, colsample_bytree=0.7, reg_alpha=0.3, rows=("not", 1))]
    whole = BO.train(blocks, edges, specs)
    parts = BO.train(blocks, edges, specs, local_rows=120, rounds=2)
    for m, s in enumerate(specs):
        assert len(whole.trees[m]) == s.n_estimators
        assert [_shape(t) for t in whole.trees[m]] == [_shape(t) for t in parts.trees[m]]
    test = [("equal", 2), ("equal", 1)]
    a, b = ({r.model: (r.n, r.mae) for r in x.errors(test).collect()} for x in (whole, parts))
    assert {m: n for m, (n, _) in a.items()} == {0: 300, 1: 300} and all(abs(a[m][1] - b[m][1]) < 1e-9 for m in a)


def test_models_share_the_jobs_of_a_level(spark, monkeypatch):
    blocks, edges = _blocks(_numbers(spark))
    asked, cells = [], BO.Batch._cells
    monkeypatch.setattr(BO.Batch, "_cells", lambda self, t, trees, nodes, *rest: asked.append({m for m, _ in nodes}) or cells(self, t, trees, nodes, *rest))
    BO.train(blocks, edges, [BO.BoostSpec(1, depth, 0.3) for depth in (1, 2, 2)], local_rows=120)
    assert asked == [{0, 1, 2}, {1, 2}]         # before: every model's levels one after the other


def test_a_level_is_one_job_with_one_shuffle_of_sums(spark, monkeypatch):
    blocks, edges = _blocks(_numbers(spark))
    plans, cells = [], BO.Batch._cells
    monkeypatch.setattr(BO.Batch, "_cells", lambda self, *a: plans.append(cells(self, *a)) or plans[-1])
    BO.train(blocks, edges, [BO.BoostSpec(1, 2, 0.3)], local_rows=120)
    # before: rows of single cells, shuffled once more for the splits, and the sums of every level kept
    assert [p._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") for p in plans] == [1, 1]
    rows = plans[0].collect()
    assert sorted((r.node, r.feature) for r in rows) == [(0, 0), (0, 1), (0, 2)] and len({r.n for r in rows}) == 1


@pytest.mark.parametrize("spec", [BO.BoostSpec(max_depth=5), BO.BoostSpec(max_depth=4, min_child_weight=40, reg_alpha=2.5, reg_lambda=0.0)])
def test_tree_from_sums_per_bin_is_the_sorted_one(spec, monkeypatch):
    monkeypatch.setattr(BO, "SORTED_ROWS", 150)
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 60, (3000, 5)).astype(np.uint8)
    codes[:, 3] = 7
    g = rng.standard_normal(3000) + np.abs(codes[:, 1] - 20.0) / 9 - codes[:, 4] / 30
    binned, plain = (f(codes, g, spec, spec.max_depth, np.array([0, 1, 3, 4])) for f in (BO.grow_binned, BO.grow))
    assert _shape(binned) == _shape(plain) and BO.grow_binned(codes, g, spec, 0, np.arange(2)).rows == [3000]
    a, b = (np.array(t.value)[BO.nodes_of(t, codes)] for t in (binned, plain))
    assert np.abs(a - b).max() < 1e-9


def test_a_model_that_one_task_can_hold_needs_no_job_a_level(spark, monkeypatch):
    blocks, edges = _blocks(_numbers(spark, 70_000))
    jobs = []
    monkeypatch.setattr(BO.Batch, "_cells", lambda self, *a: pytest.fail("a job for one level"))        # before: over 65,536 rows
    whole = BO.Batch._whole
    monkeypatch.setattr(BO.Batch, "_whole", lambda self, *a: jobs.append(a) or whole(self, *a))
    fitted = BO.train(blocks, edges, [BO.BoostSpec(3, 5, 0.3), BO.BoostSpec(2, 5, 0.3, subsample=0.5)])
    assert [len(t) for t in fitted.trees] == [3, 2] and [t.rows[0] for t in fitted.trees[0]] == [70_000] * 3 and len(jobs) == 1
    assert 34_000 < fitted.trees[1][0].rows[0] < 36_000
    monkeypatch.setattr(BO, "WHOLE_ROUNDS", 1)
    again = BO.train(blocks, edges, [BO.BoostSpec(3, 5, 0.3), BO.BoostSpec(2, 5, 0.3, subsample=0.5)])
    assert [[_shape(t) for t in m] for m in again.trees] == [[_shape(t) for t in m] for m in fitted.trees]


@pytest.mark.parametrize("held", [64 << 20, 1 << 18])
def test_sums_of_the_larger_child_are_the_difference(held, monkeypatch):
    """Wide nodes by sums per bin, narrow ones together by sorting; the trees are the sorted ones."""
    monkeypatch.setattr(BO, "SORTED_ROWS", 1000)
    monkeypatch.setattr(BO, "NARROW_ROWS", 60)
    monkeypatch.setattr(BO, "HELD_BYTES", held)
    rng = np.random.default_rng(7)
    codes = rng.integers(0, 250, (6000, 6)).astype(np.uint8)
    g = rng.standard_normal(6000) + np.abs(codes[:, 1] - 90.0) / 9 - codes[:, 4] * codes[:, 0] / 3000
    spec, rows, seen, sums = BO.BoostSpec(max_depth=8), np.flatnonzero(rng.random(6000) < 0.8), [], BO.bin_sums
    monkeypatch.setattr(BO, "bin_sums", lambda by, g, *a: seen.append(len(g)) or sums(by, g, *a))
    tree = BO.grow_rows(np.ascontiguousarray(codes.T), g, spec, 8, np.arange(6), rows)
    plain = BO.grow(codes[rows], g[rows], spec, 8, np.arange(6))
    a, b = (np.array(t.value)[BO.nodes_of(t, codes[rows])] for t in (tree, plain))      # of splits that part these rows alike either may win
    assert tree.rows[0] == len(rows) and np.abs(a - b).max() < 1e-9 and sorted(tree.rows) == sorted(plain.rows)
    if held > 1 << 20:
        assert max(seen[1:]) <= len(rows) // 2              # before: all rows at every level


def test_boosted_model_scores_saves_and_counts_its_splits(spark, tmp_out):
    df = _numbers(spark, 600)
    blocks, edges = _blocks(df)
    batch = BO.train(blocks, edges, [BO.BoostSpec(12, 3, 0.4), BO.BoostSpec(3, 2, 0.4, rows=("equal", 9))])
    model, none = BO.models_of(batch)
    assert none is None                                      # no rows
    fitted = {r.model: r.mae for r in batch.errors([None, None]).collect()}
    x = df.select("i", "temperature", array_to_vector(F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in ("a", "b", "c")])).alias("features"))
    scored = ST.regression_metrics(model.transform(x), "temperature", {"p": "xgb_pred"}).first()
    assert abs(scored.mae - fitted[0]) < 1e-9 and scored.r2 > 0.9 and set(fitted) == {0}
    ES.save_models(spark, {"xgb": model}, f"{tmp_out}/m", {"v": 1})
    again = ES.load_models(spark, f"{tmp_out}/m", {"v": 1})["xgb"]
    assert [m.transform(x).orderBy("i").select("xgb_pred").collect() for m in (again,)] == [model.transform(x).orderBy("i").select("xgb_pred").collect()]
    nodes = model.tree_rows(spark).where("feature >= 0").groupBy("feature").agg(F.count("*").alias("n"), F.avg("gain").alias("g")).collect()
    table = {r.feature: r for r in ES.importances(spark, model, ["a", "b", "c"]).collect()}
    assert {("a", "b", "c")[r.feature]: r.n for r in nodes} == {f: r.weight for f, r in table.items() if r.weight}
    assert all(abs(table[("a", "b", "c")[r.feature]].gain - r.g) < 1e-9 * max(r.g, 1) for r in nodes)
    top = ES.top_importance(spark, model, ["a", "b", "c"], 2).collect()
    assert sorted((r.kind, r["rank"]) for r in top) == [("gain", 1), ("gain", 2), ("weight", 1), ("weight", 2)]


def test_boosting_refuses_what_it_cannot_do(spark):
    with pytest.raises(ValueError, match="grow_policy"):
        BO.spec_of({"grow_policy": 1})
    with pytest.raises(ValueError, match="out of range"):
        BO.spec_of({"subsample": 0})
    with pytest.raises(ValueError, match="empty"):
        ES.fit_gbt(ES.assemble(_linear(spark).limit(0), ["a", "b"]))


def test_networks_of_one_batch_keep_to_their_rows(spark):
    df = _numbers(spark).where("c IS NOT NULL OR i < 50")
    blocks, _ = _blocks(df)
    specs = [NN.NetworkSpec((16,), learning_rate=0.02, max_iter=120, rows=rows) for rows in (("not", 2), ("equal", 0), ("equal", 7))]
    fitted = NN.fit_networks(blocks, 3, specs)
    assert fitted.models[2] is None and fitted.epochs[2] == 0
    assert fitted.skipped[0] == df.where("key <> 2 AND c IS NULL").count() > 0
    errors = {r.model: r for r in fitted.errors(blocks, [("equal", 2)] * 3).collect()}
    assert set(errors) == {0, 1} and errors[0].n == df.where("key = 2 AND c IS NOT NULL").count()
    assert all(r.r2 > 0.7 for r in errors.values()), errors
    alone = NN.fit_networks(blocks, 3, specs[1:2])
    assert np.allclose(alone.models[0].weights, fitted.models[1].weights, atol=1e-6) and alone.epochs == fitted.epochs[1:2]


def test_adam_step_is_the_plain_formula_and_keeps_no_denormal_numbers():
    unpack, _, grad, local_adam = NN.kernels()
    rng = np.random.default_rng(0)
    x, y = rng.standard_normal((450, 4)).astype("<f4"), rng.standard_normal(450).astype("<f4")
    shapes = NN._shapes(4, (8, 5))
    w, mask = (a.astype("<f4") for a in NN.initial(shapes, 3))
    zero = np.zeros_like(w)
    got = local_adam(w, zero, zero, 0, shapes, x, y, 0.01, 1e-3, 200, mask, np.random.default_rng(1))
    order, p, m, v = np.random.default_rng(1).permutation(450), w, zero, zero
    for t in (1, 2, 3):                                     # the last batch has 50 rows
        j = order[200 * t - 200:200 * t]
        g = (grad(unpack(p, shapes), x[j], y[j])[0] + 1e-3 * p * mask) / len(j)
        m, v = 0.9 * m + (1 - 0.9) * g, 0.999 * v + (1 - 0.999) * g * g
        p = p - (0.01 / (1 - 0.9 ** t)) * m / (np.sqrt(v * (1 / (1 - 0.999 ** t))) + 1e-8)
    assert got[3] == 3 and all(np.allclose(a, b, rtol=1e-6, atol=0) for a, b in zip(got[:3], (p, m, v), strict=True)) and not zero.any()
    x[:, 2] = 0.0                                           # a constant input: nothing but decay for its weights
    state = (w, zero, zero, 0)
    for epoch in range(400):
        state = local_adam(*state, shapes, x, y, 0.01, 1e-3, 50, mask, np.random.default_rng(epoch))
    tiny = np.finfo("<f4").tiny
    for a in state[:3]:                                     # before: denormal numbers, and steps ten times as long
        assert not ((a != 0) & (np.abs(a) < tiny)).any()


def test_the_longest_networks_start_first(spark, monkeypatch):
    blocks, _ = _blocks(_numbers(spark))
    held, shuffled = [], type(blocks).repartitionById
    monkeypatch.setattr(type(blocks), "repartitionById", lambda self, n, *c: held.append(shuffled(self, n, *c)) or held[-1])
    specs = [NN.NetworkSpec(hidden, max_iter=1, rows=rows) for hidden, rows in (((4,), None), ((64,), ("equal", 1)), ((64,), None), ((64, 64), ("equal", 2)))]
    NN.fit_networks(blocks, 3, specs)
    slots = {r.model: r.slot for r in held[0].groupBy("model").agg(F.min("slot").alias("slot")).collect()}
    assert sorted(slots, key=slots.get) == [3, 2, 1, 0]     # before: in the order of their numbers


def test_full_solver_does_not_depend_on_partitions(spark):
    df = ES.assemble(_linear(spark), ["a", "b"], "scaled")
    fits = [MlpRegressor(hidden=(6,), max_iter=15, solver="full").fit(df.repartition(n)).weights for n in (1, 5)]
    assert np.allclose(*fits, atol=1e-9)


def test_partitions_follow_from_size():
    assert BL.partitions_for(100, 200, 8) == 1 and BL.partitions_for(10_000, 200, 8) == 8
    assert BL.partitions_for(10_000_000, 200, 8) == 60


def test_tuning_takes_the_best_of_its_candidates(spark):
    df = _numbers(spark, 600).na.fill(0.0)
    space = {"n_estimators": [1, 15], "max_depth": [1, 4], "learning_rate": [0.3]}
    got = TR.tune(df, ["a", "b", "c"], n_candidates=4, space=space)
    assert (got["n_estimators"], got["max_depth"]) == (15, 4) and 0 < got["cv_mae"] < 1.0


# --------------------------------------------------------------------------- backtest
def _days(spark, n_days=6):
    return spark.range(24 * n_days).selectExpr(
        "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS datetime", "CAST(id % 24 AS DOUBLE) AS a",
        "CAST(id % 7 AS DOUBLE) AS b", "CAST(id % 24 AS DOUBLE) / 2 + id % 7 AS temperature")


def test_backtest_is_the_same_however_days_are_grouped(spark):
    days = [f"2024-01-0{d}" for d in range(1, 8)]
    params = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.5}
    runs = [{r.date: r for r in TR.backtest(_days(spark), days, ["a", "b"], params, (4,), 5, together=t).collect()} for t in (1, 4)]
    assert list(runs[0]) == days[1:6]                        # no day before the first, no rows on the last
    one = {r.date: r.xgb_mae for r in runs[0].values()}
    assert one["2024-01-02"] > one["2024-01-06"] and all(r.nn_mae is not None for x in runs for r in x.values())
    assert [r.date for r in TR.backtest(_days(spark), days, ["a", "b"], params, (4,), 5, every=2).collect()] == ["2024-01-03", "2024-01-05"]


def test_killed_backtest_repeats_no_written_day_and_every_leaves_no_hole(spark, tmp_out, monkeypatch):
    drift, landing, root = f"{tmp_out}/drift", f"{tmp_out}/landing", f"{tmp_out}/root"
    _days(spark).withColumn("region", F.lit("r")).write.parquet(landing)
    fitted, real = [], BO.train

    def train(blocks, edges, specs, *args):
        fitted.extend(s.rows[1] for s in specs)
        if len(fitted) == 3:
            raise RuntimeError("killed")
        return real(blocks, edges, specs, *args)
    monkeypatch.setattr(BO, "train", train)
    monkeypatch.setattr(TR, "TOGETHER", 1)
    monkeypatch.setattr(TR.backtest, "__defaults__", (*TR.backtest.__defaults__[:-1], 1))

    def call(**kwargs):
        feats = _days(spark).withColumn("region", F.lit("r"))
        monkeypatch.setattr(CU.SJ, "run_features", lambda *a: type("Q", (), {"awaitTermination": lambda self: None})())
        monkeypatch.setattr(CU.SJ, "read_features", lambda *a: feats)
        return CU.catch_up(spark, landing, spark.read.parquet(landing).schema, root, "2024-01-07", drift,
                           {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.5}, (4,), 2, default_last="2024-01-01", **kwargs)
    with pytest.raises(RuntimeError, match="killed"):
        call()
    assert [r.date for r in CU.SK.read_drift(spark, drift).orderBy("date").collect()] == ["2024-01-02", "2024-01-03"]
    assert call(every=2) == ["2024-01-04", "2024-01-06"]
    assert call() == ["2024-01-05"] and call() == []
    counts = [fitted.count(d) for d in sorted(set(fitted))]
    assert counts == [1, 1, 2, 1, 1]                         # only the day in flight was fitted again
