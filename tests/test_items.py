"""Bucket search, nearest-hour live errors, fetch control, request reads, typed CSV parts, density curves."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationlab.models import estimators as ES
from stationlab.models import training as TR
from stationlab.operators import features as FE
from stationlab.operators import halo as H
from stationlab.operators import report as RP
from stationlab.operators import stats as ST
from stationlab.plans import fetch_plan as PL
from stationlab.sources import hourly as HR
from stationlab.sources import testbed as TB

T0 = dt.datetime(2024, 1, 1)


def _hot(spark):
    """A station with quiet days, one hot day, one hot second of many microseconds, and a light station."""
    rows = [(T0 + dt.timedelta(hours=7 * i), "a", float(i % 11)) for i in range(60)]
    rows += [(T0 + dt.timedelta(days=9, minutes=3 * i), "a", float(i % 7)) for i in range(300)]
    rows += [(T0 + dt.timedelta(days=12, microseconds=13 * i), "a", float(i % 5)) for i in range(400)]
    rows += [(T0 + dt.timedelta(days=3 * i), "b", float(i)) for i in range(20)]
    return spark.createDataFrame(rows, "datetime timestamp_ntz, region string, temperature double")


def test_buckets_by_search_are_those_by_join_and_hot_seconds_are_split(spark):
    df = _hot(spark)
    one = H.assign_buckets(df, "region", "datetime", 50).collect()
    two = H._assign_by_join(df, "region", "datetime", 50, "day", H.REFINE).select("datetime", "region", "temperature", H.BKT).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    sizes = {}
    for r in one:
        sizes[r.region, r[H.BKT]] = sizes.get((r.region, r[H.BKT]), 0) + 1
    assert max(sizes.values()) < 100 and len([b for (k, b) in sizes if b >= T0 + dt.timedelta(days=12)]) >= 5


def test_more_starts_than_a_plan_carries_are_joined(spark, monkeypatch):
    df = _hot(spark)
    want = sorted(map(tuple, H.assign_buckets(df, "region", "datetime", 50).collect()))
    monkeypatch.setattr(H, "MAX_START_BYTES", 100)
    assert sorted(map(tuple, H.assign_buckets(df, "region", "datetime", 50).select("datetime", "region", "temperature", H.BKT).collect())) == want


def test_the_plan_does_not_grow_with_the_bucket_starts(spark):
    df = _hot(spark)
    few, many = (len(H.assign_buckets(df, "region", "datetime", n)._jdf.queryExecution().toString()) for n in (200, 3))
    assert many < few + 1000        # before: every start several times over, in every text of the plan


def test_bucket_search_tells_keys_apart_and_leaves_missing_ones(spark):
    df = _hot(spark).unionByName(spark.createDataFrame([(None, "a", 1.0), (T0, None, 2.0)], "datetime timestamp_ntz, region string, temperature double"))
    rows = H.assign_buckets(df, "region", "datetime", 50).collect()
    assert len(rows) == 782
    for r in rows:
        missing = r.region is None or r.datetime is None
        assert (r[H.BKT] is None) if missing else (r[H.BKT] <= r.datetime)


def test_bucketed_windows_move_the_rows_twice(spark):
    h = TB.hourly_from_events(spark, SF_SMALL)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = FE.feature_table(h, method="halo", target_rows=60)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "BroadcastHashJoin" not in plan and "from_json" not in plan.lower()      # the starts are one literal
    # exchanges above the scan of the rows (the bucket table and its lists come from checkpoints)
    depth, moved = [], 0
    for line in plan.splitlines():
        indent = len(re.match(r"[ :+\-]*", line).group())
        depth = [d for d in depth if d < indent]
        if "Exchange hashpartitioning" in line:
            depth.append(indent)
        if "FileScan parquet" in line:
            moved = max(moved, len(depth))
    assert moved == 2, plan
    assert out.count() == FE.feature_table(h, method="window").count()


def test_live_errors_use_the_nearest_hour_and_keep_what_has_none(spark):
    archive = [(T0 + dt.timedelta(minutes=m), "a", 1.0, float(m), float(-m)) for m in (0, 58, 130)] + [(T0, "far", 1.0, 1.0, 1.0)]
    preds = spark.createDataFrame(archive, "datetime timestamp_ntz, region string, temperature_actual double, temperature_nn_pred double, temperature_xgb_pred double")
    obs = spark.createDataFrame([(T0 + dt.timedelta(minutes=65), "a", 10.0), (T0 + dt.timedelta(minutes=20), "a", 0.0),
                                 (T0 + dt.timedelta(hours=5), "far", 2.0), (T0, "none", 3.0)], "datetime timestamp_ntz, region string, temperature double")
    summary = spark.createDataFrame([("Neural Network",)], "champion string")
    got = {r.region: (r.prediction, r.error, r.error_band) for r in RP.live_error(obs, preds, summary).collect()}
    assert got == {"a": (58.0, 48.0, "needs_work"), "far": (None, None, None), "none": (None, None, None)}


def test_live_errors_by_the_loaded_champion(spark, tmp_out):
    feat = FE.feature_table(TB.hourly_from_events(spark, SF_SMALL))
    cols = FE.feature_columns(feat)
    models = TR.fit_models(feat, cols, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3}, hidden=(4,), mlp_iter=5, mlp_lr=1e-2, forest=False)
    ES.save_models(spark, models, f"{tmp_out}/m", {})
    loaded = ES.load_models(spark, f"{tmp_out}/m", {})
    latest = RP.latest_per_region(feat)
    obs = latest.select("region", F.timestamp_add("MINUTE", F.lit(5), F.col("datetime")).alias("datetime"), F.lit(1.5).alias("temperature"))
    obs = obs.unionByName(spark.createDataFrame([("Atlantis", T0, 1.0)], "region string, datetime timestamp_ntz, temperature double"))
    summary = spark.createDataFrame([("XGBoost",)], "champion string")
    got = {r.region: r for r in RP.live_error(obs, feat, summary, TR.live_scorer(loaded, cols)).collect()}
    want = {r.region: r.xgb_pred for r in TR.predict(RP.inject_datetime(latest.withColumn(
        "target_datetime", F.timestamp_add("MINUTE", F.lit(5), F.col("datetime")))), models, cols).collect()}
    assert got.pop("Atlantis").prediction is None and got.keys() == want.keys()
    assert all(abs(got[k].prediction - want[k]) < 1e-9 and abs(got[k].error - abs(want[k] - 1.5)) < 1e-9 for k in want)


def test_outcomes_merge_in_any_order(spark):
    plan = spark.createDataFrame([(k,) for k in "abcd"], "chunk_key string")
    events = [("a", "done"), ("a", "missing"), ("b", "missing"), ("b", "planned"), ("c", "planned"), ("x", "done")]
    for order in (events, events[::-1], events * 3):
        control = PL.control_table(plan, spark.createDataFrame(order, "chunk_key string, status string"))
        assert {r.chunk_key: r.status for r in control.collect()} == {"a": "done", "b": "missing", "c": "planned", "d": "planned", "x": "done"}
        assert sorted(r.chunk_key for r in PL.to_fetch(plan, control).collect()) == ["c", "d"]
    r = PL.control_coverage(control).first()
    assert (r.n_planned, r.n_missing, r.n_done, r.n_total, r.pct_settled) == (2, 1, 2, 5, 60.0)
    with pytest.raises(Exception, match="unknown chunk state"):
        PL.control_table(plan, spark.createDataFrame([("a", "lost")], "chunk_key string, status string")).collect()


def test_requests_choose_the_tail_or_everything(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(days=i),) for i in range(60)], "datetime timestamp_ntz")
    as_of = "2024-03-01 00:00:00"

    def rows(*dates):
        return HR.for_requests(df, spark.createDataFrame([(d,) for d in dates], "date string"), as_of).count()
    assert rows("2024-02-20", "2024-03-05") == 30 and rows("2024-02-20", "2023-01-01") == 60
    assert rows("2024-02-20", "soon") == 60 and rows() == 30


def test_csv_parts_are_typed_by_the_schema(spark, tmp_out):
    for i, text in enumerate(("datetime,region,temperature,note\n2024-01-01T01:00,A,1.5,x\n2024-01-01,B,bad,y\n",
                              "region,pressure,datetime\nC,1000,2024-01-02 03:00:00\nD,NaN,never\n")):
        with open(os.path.join(tmp_out, f"raw_pt{i}"), "w") as f:
            f.write(text)
    got = HR.read_parts(spark, os.path.join(tmp_out, "raw_pt*"), "csv")
    assert dict(got.dtypes) == {"datetime": "timestamp_ntz", "region": "string", "temperature": "double", "note": "string", "pressure": "double"}
    rows = {r.region: r for r in got.collect()}
    assert rows["A"].temperature == 1.5 and rows["A"].datetime == dt.datetime(2024, 1, 1, 1) and rows["B"].temperature is None
    assert rows["C"].pressure == 1000.0 and rows["D"].pressure is None and rows["D"].datetime is None and rows["C"].note is None


def test_density_curves_integrate_to_one(spark):
    rows = [(float(i % 17), float(i % 5), 3.0, float(i % 17)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, p double, q double, r double")
    got = ST.residual_curve(df, "a", {"p": "p", "q": "q", "same": "r"}).collect()
    for m in ("p", "q"):
        mine = sorted((r.x, r.density) for r in got if r.model == m)
        step = mine[1][0] - mine[0][0]
        assert len(mine) == 200 and abs(sum(d for _, d in mine) * step - 1) < 0.01
    assert not [r for r in got if r.model == "same"]
