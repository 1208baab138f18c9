"""Invariances: bucketed halo == plain window, under shuffles, partition counts,
tiny buckets (many buckets per halo) and a region holding most rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationlab.operators import features as FE
from stationlab.operators import report as RP
from stationlab.sources import testbed as TB


def _sorted(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_halo_equals_window_hour_buckets(spark):
    h = TB.hourly_from_events(spark, SF_SMALL)
    a = FE.feature_table(h, method="window")
    b = FE.feature_table(h.repartition(7), method="halo", unit="hour")   # ~1-3 rows per bucket
    assert _sorted(a) == _sorted(b)


def test_halo_equals_window_day_buckets_shuffled(spark):
    h = TB.hourly_from_events(spark, SF_SMALL).orderBy(F.rand(3))
    assert _sorted(FE.feature_table(h, method="window")) == _sorted(FE.feature_table(h, method="halo"))


def test_skewed_region_and_sparse_buckets(spark):
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):               # one hot region with most of the rows
        rows.append((t0 + dt.timedelta(minutes=7 * i), "hot", rnd.choice([None, rnd.random()]),
                     rnd.random(), rnd.random(), rnd.random(), rnd.random()))
    for i in range(40):                 # a sparse region: one row every few days
        rows.append((t0 + dt.timedelta(days=3 * i), "sparse", rnd.random(), None if i % 3 else 1.0,
                     rnd.random(), rnd.random(), rnd.random()))
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, region string, temperature double, "
                                     "precipitation double, wind_speed double, humidity double, pressure double")
    assert _sorted(FE.feature_table(df, method="window")) == _sorted(FE.feature_table(df, method="halo"))
    assert _sorted(RP.naive_predictions(df, method="window", value="wind_speed")) == \
        _sorted(RP.naive_predictions(df, method="halo", value="wind_speed"))


def test_partition_count_does_not_change_rows(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = _sorted(FE.feature_table(TB.hourly_from_events(spark, SF_SMALL), method="halo"))
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    b = _sorted(FE.feature_table(TB.hourly_from_events(spark, SF_SMALL), method="halo"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_feature_plan_single_exchange(spark):
    """Window form: fills, lags and rolling frames share one exchange on region."""
    df = FE.feature_table(TB.hourly_from_events(spark, SF_SMALL), method="window")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(region") == 1, plan


def test_filters_and_columns_reach_the_scan(spark):
    from stationlab.sources.hourly import recent
    df = recent(TB.hourly_from_events(spark, SF_SMALL), "2024-01-25 00:00:00", 10).select("datetime")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan, plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan, plan


def test_windowed_operators_halo_equals_window(spark):
    h = TB.hourly_from_events(spark, SF_SMALL)
    cols = ["temperature", "humidity"]
    for fn in (lambda m: FE.ffill(h, cols, method=m), lambda m: FE.bfill(h, cols, method=m),
               lambda m: FE.fill(h, cols, method=m), lambda m: FE.lags(h, ["temperature"], [1, 6, 24], method=m),
               lambda m: FE.rolling(h, method=m)):
        assert _sorted(fn("window")) == _sorted(fn("halo"))


def test_head_per_group_prunes_but_keeps_first_rows(spark):
    h = TB.hourly_from_events(spark, SF_SMALL)
    got = RP.head_per_group(h, 7, 2)
    regions = sorted(r.region for r in h.select("region").distinct().collect())[:2]
    for r in regions:
        want = [x.datetime for x in h.where(F.col("region") == r).orderBy("datetime").limit(7).collect()]
        assert [x.datetime for x in got.where(F.col("region") == r).orderBy("rn").collect()] == want


def test_adaptive_buckets_pack_and_split(spark):
    from stationlab.operators import halo as H
    h = TB.hourly_from_events(spark, SF_SMALL)
    want = _sorted(FE.feature_table(h, method="window"))
    for target in (3, 25, 400):          # split hot days (3), mixed (25), pack many days (400)
        got = _sorted(FE.feature_table(h, method="halo", target_rows=target))
        assert got == want, target
    b = H.assign_buckets(h, "region", "datetime", 3)
    sizes = [r["count"] for r in b.groupBy("region", "_bkt").count().collect()]
    assert max(sizes) < 2 * 3             # hot units split; a pack stays under twice the target
    # every bucket is one contiguous time range: max(bucket k) < min(bucket k+1)
    from pyspark.sql import Window
    r = (b.groupBy("region", "_bkt").agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
         .withColumn("next_lo", F.lead("lo").over(Window.partitionBy("region").orderBy("_bkt")))
         .where(F.col("next_lo") <= F.col("hi")).count())
    assert r == 0


def test_hot_day_is_split(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=30 * i), "hot", float(i), 0.0, 1.0, 2.0, 3.0) for i in range(600)] + \
           [(t0 + dt.timedelta(days=d), "cold", float(d), 0.0, 1.0, 2.0, 3.0) for d in range(40)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, region string, temperature double, "
                                     "precipitation double, wind_speed double, humidity double, pressure double")
    from stationlab.operators import halo as H
    b = H.assign_buckets(df, "region", "datetime", 50)
    hot_sizes = [r["count"] for r in b.where("region = 'hot'").groupBy("_bkt").count().collect()]
    assert len(hot_sizes) > 1 and max(hot_sizes) < 100           # one hot day split (packs < 2x target)
    cold = b.where("region = 'cold'").select("_bkt").distinct().count()
    assert cold == 1                                              # 40 sparse days packed together
    assert _sorted(FE.feature_table(df, method="halo", target_rows=50)) == \
        _sorted(FE.feature_table(df, method="window"))


def test_small_side_broadcasts_only_under_its_row_bound(spark):
    from stationlab.session import small_side
    h = TB.hourly_from_events(spark, SF_SMALL)
    stats = h.groupBy("region").agg(F.avg("temperature").alias("m"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:                   # no size-based broadcast: only the hint can broadcast
            spark.conf.set(k, "-1")
        hinted = h.join(small_side(stats), "region")._jdf.queryExecution().executedPlan().toString()
        beyond = h.join(small_side(stats, max_rows=1), "region")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "BroadcastHashJoin" in hinted
    assert "BroadcastHashJoin" not in beyond and "SortMergeJoin" in beyond


def test_per_key_joins_do_not_shuffle_the_data(spark):
    from stationlab.operators import stats as ST
    h = TB.hourly_from_events(spark, SF_SMALL)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:                   # only the measured hint may broadcast
            spark.conf.set(k, "-1")
        plans = {name: df._jdf.queryExecution().executedPlan().toString()
                 for name, df in (("anomalies", ST.anomalies(h)), ("latest", RP.latest_per_region(h)))}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for name, p in plans.items():
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p, name
    # anomalies: the only shuffle is the statistics aggregate's (checkpointed before the join)
    assert "Exchange hashpartitioning" not in plans["anomalies"]
