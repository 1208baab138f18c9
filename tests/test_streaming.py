"""Streaming jobs with availableNow over landed files vs the batch answer."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationlab import schema as S
from stationlab.operators import clean as CL
from stationlab.operators import features as FE
from stationlab.operators import report as RP
from stationlab.sources import testbed as TB
from stationlab.streaming import jobs as SJ
from stationlab.streaming import versions as VS


def _sorted(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _land(df, folder, name):
    df.coalesce(1).write.parquet(os.path.join(folder, name))


def test_late_rows_upsert_and_incremental_features(spark, tmp_out):
    h = TB.hourly_from_events(spark, SF_SMALL, with_id=True)
    cut = "2024-01-15 00:00:00"
    land = os.path.join(tmp_out, "landing")
    early = h.where(F.col("datetime") < F.lit(cut).cast("timestamp_ntz"))
    late = h.where(F.col("datetime") >= F.lit(cut).cast("timestamp_ntz"))
    held_back = early.where(F.col("event_id") % 9 == 4)            # arrive after later rows
    corrected = early.where(F.col("event_id") % 13 == 5).withColumn("temperature", F.lit(-1.0))
    _land(early.join(held_back.select("event_id"), "event_id", "left_anti").drop("event_id"), land, "f1")
    _land(late.drop("event_id"), land, "f2")
    _land(held_back.drop("event_id").unionByName(corrected.drop("event_id")).dropDuplicates(["datetime", "region"]),
          land, "f3")
    _land(corrected.drop("event_id"), land, "f4")                  # the correction wins (last arrival)
    schema = h.drop("event_id").schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(land, "f*"))
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    q = SJ.run_features(rows, f"{root}/master", f"{root}/features", f"{root}/_ckpt")
    q.awaitTermination()
    assert q.lastProgress is not None
    # expected: batch upsert of the same arrivals, then the full feature table
    final = h.drop("event_id")
    final = CL.upsert(final.join(corrected.select("datetime", "region"), ["datetime", "region"], "left_anti"),
                      corrected.drop("event_id"))
    got_master = SJ.read_master(spark, f"{root}/master")
    assert _sorted(got_master) == _sorted(final)
    want = FE.feature_table(final, method="window")
    got = SJ.read_features(spark, f"{root}/features")
    assert _sorted(got.select(want.columns)) == _sorted(want)
    # restart with the same checkpoint: nothing new, nothing changes
    SJ.run_features(rows, f"{root}/master", f"{root}/features", f"{root}/_ckpt").awaitTermination()
    assert _sorted(SJ.read_master(spark, f"{root}/master")) == _sorted(final)


def test_latest_snapshot_over_several_batches(spark, tmp_out):
    e = TB.table(spark, SF_SMALL, "events").select(
        F.col("event_type").alias("region"), F.col("ts").cast("string").alias("timestamp"),
        F.col("value").alias("temperature_2m"), F.lit(None).cast("double").alias("relative_humidity_2m"),
        F.lit(None).cast("double").alias("wind_speed_10m"), F.lit(None).cast("double").alias("pressure_msl"))
    land = os.path.join(tmp_out, "obs")
    e.orderBy("timestamp").repartition(3).write.json(land)
    obs = SJ.observations_stream(spark, land, S.OBSERVATION, max_files=1)
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    SJ.run_latest_snapshot(obs, f"{root}/snap", f"{root}/_ckpt").awaitTermination()
    got = SJ.read_snapshot(spark, f"{root}/snap")
    want = RP.latest_per_region(spark.read.schema(S.OBSERVATION).json(land), order="timestamp")
    assert _sorted(got) == _sorted(want.select(got.columns))


def test_daily_mae_stream_equals_batch(spark, tmp_out):
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    preds = TB.predictions_from_events(spark, SF_SMALL)
    preds.repartition(4).write.parquet(f"{root}/preds")
    src = spark.readStream.schema(S.PREDICTIONS).option("maxFilesPerTrigger", 2).parquet(f"{root}/preds")
    SJ.run_daily_mae(src, f"{root}/out", f"{root}/_ckpt").awaitTermination()
    got = SJ.read_latest_by(spark, f"{root}/out", ["date"])
    from stationlab.operators.stats import daily_mae
    want = daily_mae(preds)
    g = {r.date: (r.xgb_mae, r.nn_mae) for r in got.collect()}
    w = {r.date: (r.xgb_mae, r.nn_mae) for r in want.collect()}
    assert g.keys() == w.keys()
    for k in w:
        assert abs(g[k][0] - w[k][0]) < 1e-9 and abs(g[k][1] - w[k][1]) < 1e-9


def test_catch_up_is_restart_safe(spark, tmp_out):
    from stationlab.sources import sinks as SK
    from stationlab.streaming.catch_up import catch_up
    h = TB.hourly_from_events(spark, SF_SMALL)
    land = os.path.join(tmp_out, "land")
    h.coalesce(1).write.parquet(land)
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    drift = os.path.join(root, "drift")
    SK.append_drift(spark.createDataFrame([("2024-01-27", 0.1, 0.2)], S.DRIFT), drift, arrival=0)
    small = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3}
    days = catch_up(spark, land, h.schema, root, "2024-01-30", drift, small, hidden=(8,), mlp_iter=3)
    assert days == ["2024-01-28", "2024-01-29"]
    again = catch_up(spark, land, h.schema, root, "2024-01-30", drift, small, hidden=(8,), mlp_iter=3)
    assert again == []
    assert sorted(r.date for r in SK.read_drift(spark, drift).collect()) == ["2024-01-27", "2024-01-28", "2024-01-29"]


def test_large_batch_takes_the_batch_feature_path(spark, tmp_out):
    h = TB.hourly_from_events(spark, SF_SMALL)
    land = os.path.join(tmp_out, "land_big")
    h.coalesce(1).write.parquet(land)
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    rows = spark.readStream.schema(h.schema).parquet(land)
    SJ.run_features(rows, f"{root}/master", f"{root}/features", f"{root}/_ckpt",
                    max_rows_per_task=50).awaitTermination()        # forces the bucketed batch path
    want = FE.feature_table(h, method="window")
    got = SJ.read_features(spark, f"{root}/features").select(want.columns)
    assert _sorted(got) == _sorted(want)


def test_first_value_arriving_late_refreshes_back_fill(spark, tmp_out):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    sch = "datetime timestamp_ntz, region string, temperature double, precipitation double, " \
          "wind_speed double, humidity double, pressure double"
    # temperature missing for hours 0-99; a late value at hour 60 becomes the first one, which changes
    # the back fill of hours 24-35, rows older than the 24-row context before hour 60
    early = [(t0 + dt.timedelta(hours=i), "A", None if i < 100 else float(i), 1.0, 1.0, 1.0, 1.0)
             for i in range(130)]
    late = [(t0 + dt.timedelta(hours=60), "A", 99.0, 1.0, 1.0, 1.0, 1.0)]
    land = os.path.join(tmp_out, "land_first")
    spark.createDataFrame(early, sch).coalesce(1).write.parquet(os.path.join(land, "f1"))
    spark.createDataFrame(late, sch).coalesce(1).write.parquet(os.path.join(land, "f2"))
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    rows = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1).parquet(os.path.join(land, "f*"))
    SJ.run_features(rows, f"{root}/master", f"{root}/features", f"{root}/_ckpt").awaitTermination()
    final = CL.upsert(spark.createDataFrame(early, sch), spark.createDataFrame(late, sch))
    want = FE.feature_table(final, method="window")
    got = SJ.read_features(spark, f"{root}/features").select(want.columns)
    assert _sorted(got) == _sorted(want)


def test_compaction_keeps_latest_rows(spark, tmp_out):
    p = os.path.join(tmp_out, "appended")
    a = spark.createDataFrame([("A", 1, 1.0, 0), ("A", 2, 2.0, 0)], "region string, k int, v double, _batch bigint")
    b = spark.createDataFrame([("A", 1, 9.0, 1)], "region string, k int, v double, _batch bigint")
    a.write.parquet(p)
    b.write.mode("append").parquet(p)
    SJ.compact(spark, p, ["region", "k"], os.path.join(tmp_out, "compact"))
    got = sorted((r.k, r.v) for r in spark.read.parquet(os.path.join(tmp_out, "compact")).collect())
    assert got == [(1, 9.0), (2, 2.0)]


def _stream_two_batches(spark, tmp_out, name, first, second, sch, **kw):
    land = os.path.join(tmp_out, name)
    spark.createDataFrame(first, sch).coalesce(1).write.parquet(os.path.join(land, "f1"))
    spark.createDataFrame(second, sch).coalesce(1).write.parquet(os.path.join(land, "f2"))
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    rows = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1).parquet(os.path.join(land, "f*"))
    SJ.run_features(rows, f"{root}/master", f"{root}/features", f"{root}/_ckpt", **kw).awaitTermination()
    final = CL.upsert(spark.createDataFrame(first, sch), spark.createDataFrame(second, sch))
    want = FE.feature_table(final, method="window")
    got = SJ.read_features(spark, f"{root}/features").select(want.columns)
    return _sorted(got), _sorted(want)


_SCH = "datetime timestamp_ntz, region string, temperature double, precipitation double, " \
       "wind_speed double, humidity double, pressure double"


def test_first_value_corrected_to_null_refreshes_back_fill(spark, tmp_out):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    # temperature missing for hours 0-99 but hour 60; hour 60 is then corrected to NULL, so the
    # back fill of hours 24-35 (older than the 24-row context before hour 60) moves to hour 100's value
    early = [(t0 + dt.timedelta(hours=i), "A", 99.0 if i == 60 else (None if i < 100 else float(i)),
              1.0, 1.0, 1.0, 1.0) for i in range(130)]
    early += [(t0 + dt.timedelta(hours=i), "B", float(i), 1.0, 1.0, 1.0, 1.0) for i in range(40)]
    late = [(t0 + dt.timedelta(hours=60), "A", None, 1.0, 1.0, 1.0, 1.0)]
    got, want = _stream_two_batches(spark, tmp_out, "land_null", early, late, _SCH)
    assert got == want


def test_late_row_far_back_takes_the_size_checked_path(spark, tmp_out):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    early = [(t0 + dt.timedelta(hours=i), "A", float(i % 17), 1.0, float(i % 5), 1.0, 1.0)
             for i in range(130) if i != 5]
    late = [(t0 + dt.timedelta(hours=5), "A", 50.0, 2.0, 3.0, 4.0, 5.0)]
    # the late row is 125 rows back: more than one window task of 50 rows may take
    got, want = _stream_two_batches(spark, tmp_out, "land_far", early, late, _SCH, max_rows_per_task=50)
    assert got == want


def test_recent_days_path_reads_no_full_history(spark, tmp_out, monkeypatch):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    early = [(t0 + dt.timedelta(hours=i), r, float((i * 7) % 23), float(i % 3), 1.0 + i % 4, 50.0, 1000.0 + i % 9)
             for r in ("A", "B") for i in range(300)]
    late = [(t0 + dt.timedelta(hours=250), "A", 40.0, 0.0, 2.0, 60.0, 990.0),
            (t0 + dt.timedelta(hours=299), "B", 41.0, 1.0, 3.0, 61.0, 991.0),
            (t0 + dt.timedelta(hours=300), "B", 42.0, 1.0, 3.0, 61.0, 992.0)]
    calls = []
    real = SJ.first_values
    monkeypatch.setattr(SJ, "first_values", lambda *a, **k: calls.append(1) or real(*a, **k))
    got, want = _stream_two_batches(spark, tmp_out, "land_recent", early, late, _SCH, lookback_days=2)
    assert got == want
    assert len(calls) == 1          # the first batch only; the second read two days, not the history


def test_rows_that_no_longer_exist_leave_the_feature_table(spark, tmp_out):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    # region A's only temperature value is corrected to NULL: none of A's rows survives the
    # missing-value drop any more, so its earlier feature rows must go; B's rows stay
    early = [(t0 + dt.timedelta(hours=i), "A", 5.0 if i == 30 else None, 1.0, 1.0, 1.0, 1.0) for i in range(60)]
    early += [(t0 + dt.timedelta(hours=i), "B", float(i), 1.0, 1.0, 1.0, 1.0) for i in range(60)]
    late = [(t0 + dt.timedelta(hours=30), "A", None, 1.0, 1.0, 1.0, 1.0)]
    got, want = _stream_two_batches(spark, tmp_out, "land_gone", early, late, _SCH)
    assert got == want and len(want) == 36 and all("A" not in r and "B" in r for r in want)


def test_daily_mae_watermark_drops_rows_later_than_its_bound(spark, tmp_out):
    import datetime as dt
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    sch = S.PREDICTIONS                 # datetime, region, actual, nn, xgb
    files = [[(dt.datetime(2024, 6, 1, h), "A", 10.0, 11.0, 12.0) for h in range(3)],
             [(dt.datetime(2024, 5, 1, 5), "A", 10.0, 13.0, 13.0)],     # 31 days behind: kept
             [(dt.datetime(2024, 1, 2, 5), "A", 10.0, 20.0, 20.0)]]     # 151 days behind: dropped
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, sch).coalesce(1).write.parquet(f"{root}/preds/f{i}")
    src = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1).parquet(f"{root}/preds/f*")
    # late rows are judged against the watermark of the batch before (Spark 3.4+), hence three batches
    SJ.run_daily_mae(src, f"{root}/out", f"{root}/_ckpt").awaitTermination()
    got = {r.date: (r.xgb_mae, r.nn_mae) for r in SJ.read_latest_by(spark, f"{root}/out", ["date"]).collect()}
    assert got == {"2024-06-01": (2.0, 1.0), "2024-05-01": (3.0, 3.0)}


def test_a_day_whose_rows_all_vanish_is_emptied(spark, tmp_out):
    import datetime as dt
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    # region A alone fills Jan 1-3; its only temperature value is corrected to NULL, so its days empty out
    early = [(t0 + dt.timedelta(hours=i), "A", 5.0 if i == 30 else None, 1.0, 1.0, 1.0, 1.0) for i in range(60)]
    early += [(t1 + dt.timedelta(hours=i), "B", float(i), 1.0, 1.0, 1.0, 1.0) for i in range(60)]
    late = [(t0 + dt.timedelta(hours=30), "A", None, 1.0, 1.0, 1.0, 1.0)]
    got, want = _stream_two_batches(spark, tmp_out, "land_gone_days", early, late, _SCH)
    assert got == want and len(want) == 36


def test_streaming_reads_prune_day_partitions(spark, tmp_out):
    import datetime as dt
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), "A", float(i), 1.0, 1.0, 1.0, 1.0) for i in range(96)]
    up = SJ.upsert_batch(f"{root}/master", ["datetime", "region"], [], VS.DayOf("datetime"))
    up(spark.createDataFrame(rows, _SCH), 0)
    before = VS.live(spark, f"{root}/master")
    late = spark.createDataFrame(rows[50:52], _SCH)
    up(late, 1)                                     # touches one day: only that partition is read and written
    after = VS.live(spark, f"{root}/master")
    assert before.keys() == after.keys() == {f"2024-01-0{d}" for d in range(1, 5)}
    assert [d for d in before if before[d] != after[d]] == ["2024-01-03"]
    assert SJ.read_master(spark, f"{root}/master").count() == 96
    recent = SJ.read_master(spark, f"{root}/master", dt.date(2024, 1, 3))
    assert {f.split("_part=")[1][:10] for f in recent.inputFiles()} == {"2024-01-03", "2024-01-04"}
    assert recent.count() == 48


class Stopped(Exception):
    pass


def test_a_write_that_stops_before_its_commit_changes_nothing(spark, tmp_out, monkeypatch):
    import datetime as dt
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i), "A", float(i % 7), 1.0, float(i % 3), 1.0, 1.0) for i in range(80)]
    write = SJ.features_batch(f"{root}/m", f"{root}/f")
    write(spark.createDataFrame(rows, _SCH), 0)
    first = (_sorted(SJ.read_master(spark, f"{root}/m")), _sorted(SJ.read_features(spark, f"{root}/f")))
    batch = spark.createDataFrame([(t0 + dt.timedelta(hours=30), "A", 99.0, 2.0, 2.0, 2.0, 2.0)], _SCH)
    real, calls = VS._sizes, []

    def stop_at(n):
        def sizes(*args):
            calls.append(1)
            if len(calls) == n:
                raise Stopped
            return real(*args)
        calls.clear()
        monkeypatch.setattr(VS, "_sizes", sizes)
    for n, expected in ((1, "master"), (2, "features")):    # after the new version is written, before its manifest
        stop_at(n)
        try:
            write(batch, 1)
        except Stopped:
            pass
        monkeypatch.setattr(VS, "_sizes", real)
        features = _sorted(SJ.read_features(spark, f"{root}/f"))
        assert features == first[1], expected
        if n == 1:
            assert _sorted(SJ.read_master(spark, f"{root}/m")) == first[0]
    # a manifest cut short has no success mark and is not read
    number = max(VS._numbers(spark, f"{root}/f"))
    os.makedirs(f"{root}/f/manifest/{number + 1:020d}")
    assert _sorted(SJ.read_features(spark, f"{root}/f")) == first[1]
    write(batch, 1)                                         # replayed: whole
    final = CL.upsert(spark.createDataFrame(rows, _SCH), batch)
    want = FE.feature_table(final, method="window")
    assert _sorted(SJ.read_features(spark, f"{root}/f").select(want.columns)) == _sorted(want)
    assert _sorted(SJ.read_master(spark, f"{root}/m")) == _sorted(final)
    gone = VS.vacuum(spark, f"{root}/m", keep=1)
    assert gone and _sorted(SJ.read_master(spark, f"{root}/m")) == _sorted(final)
    assert len(os.listdir(f"{root}/m/manifest")) == 1


def test_buckets_split_as_they_grow_and_a_batch_writes_its_own_only(spark, tmp_out):
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    sch = "k long, seq long, v double"
    part = VS.HashBuckets(["k"], most=2000, depth=1)
    up = SJ.upsert_batch(f"{root}/m", ["k"], ["seq"], part)
    for b in range(4):
        up(spark.range(1500).selectExpr("id AS k", f"CAST({b} AS LONG) AS seq", f"CAST(xxhash64(id) % 1000 AS DOUBLE) + {b} AS v"), b)
    parts = VS.live(spark, f"{root}/m")
    assert len(parts) > 8 and sum(2.0 ** -p.depth for p in parts.values()) == 1.0       # the whole hash range, once
    touched = spark.createDataFrame([(7, 9, 1.0), (8, 9, 1.0), (9000, 9, 2.0)], sch)
    up(touched, 4)
    after = VS.live(spark, f"{root}/m")
    kept = [p for p in parts if after.get(p) == parts[p]]
    assert len(parts) - len(kept) <= 3
    got = {r.k: (r.seq, r.v) for r in SJ.read_master(spark, f"{root}/m").collect()}
    assert len(got) == 1501 and got[7] == (9, 1.0) and got[9000] == (9, 2.0) and all(s == 3 for k, (s, _) in got.items() if k not in (7, 8, 9000))


def test_a_directory_of_ten_thousand_buckets(spark):
    depth = 14
    parts = {p: VS.Part(p, "v", 100, d) for p, d in VS.first_buckets(depth).items()}
    assert len(parts) == 16_384
    keys = spark.range(500).select("id", VS.HashBuckets(["id"]).value(parts).alias("p"), F.xxhash64("id").alias("h")).collect()
    touched = {r.p for r in keys}
    assert 400 < len(touched) <= 500 and touched <= set(parts)
    assert all(int(r.p) <= r.h < int(r.p) + (1 << (64 - depth)) for r in keys)
    big = {p: VS.Part(p, "v", 1000 if p in touched else 100, depth) for p in parts}
    grown = VS.grown(big, touched, most=300)
    assert len(grown) == 16_384 + 3 * len(touched) and all(grown[p] == depth for p in parts if p not in touched)
    assert sum(2.0 ** -d for d in grown.values()) == 1.0


def test_late_rows_are_kept_counted_and_evaluated_again(spark, tmp_out):
    import datetime as dt
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    batches = [[(dt.datetime(2024, 6, 1, h), "A", 10.0, 11.0, 12.0) for h in range(3)],
               [(dt.datetime(2024, 5, 25, 5), "A", 10.0, 13.0, 13.0), (dt.datetime(2024, 6, 1, 9), "A", 10.0, 14.0, 10.0),
                (dt.datetime(2024, 5, 30, 5), "A", 10.0, 10.0, 10.0), (None, "A", 10.0, 10.0, 10.0)]]
    write = SJ.daily_errors_batch(root, days=5)
    for i, rows in enumerate(batches):
        write(spark.createDataFrame(rows, S.PREDICTIONS), i)
    write(spark.createDataFrame(batches[1], S.PREDICTIONS), 1)          # replayed
    late = SJ.read_late(spark, root).collect()
    assert [(r.datetime, r._batch) for r in late] == [(dt.datetime(2024, 5, 25, 5), 1)]
    got = {r.date: (r.xgb_mae, r.nn_mae, r.n_late) for r in SJ.read_daily_errors(spark, root).collect()}
    assert got == {"2024-06-01": (1.5, 1.75, 0), "2024-05-30": (0.0, 0.0, 0), "2024-05-25": (None, None, 1), None: (0.0, 0.0, 0)}
    again = {r.date: (r.xgb_mae, r.nn_mae) for r in SJ.read_daily_errors(spark, root, with_late=True).collect()}
    assert again["2024-05-25"] == (3.0, 3.0) and again["2024-06-01"] == (1.5, 1.75)


def test_upsert_keeps_rows_without_a_day(spark, tmp_out):
    import datetime as dt
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    sch = "datetime timestamp_ntz, region string, temperature double"
    up = SJ.upsert_batch(f"{root}/m", ["datetime", "region"], [], VS.DayOf("datetime"))
    t = dt.datetime(2024, 1, 1)
    up(spark.createDataFrame([(None, "A", 1.0), (t, "A", 2.0)], sch), 0)
    up(spark.createDataFrame([(None, "B", 3.0), (t, "B", 4.0)], sch), 1)
    up(spark.createDataFrame([(None, "A", 5.0)], sch), 2)           # a NULL key is replaced like any other
    got = sorted((r.region, r.temperature) for r in SJ.read_master(spark, f"{root}/m").collect())
    assert got == [("A", 2.0), ("A", 5.0), ("B", 3.0), ("B", 4.0)]


def test_feature_sink_keeps_a_batch_without_times(spark, tmp_out):
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    write = SJ.features_batch(f"{root}/m", f"{root}/f")
    write(spark.createDataFrame([(None, "A", 1.0, 1.0, 1.0, 1.0, 1.0)], _SCH), 0)
    assert SJ.read_master(spark, f"{root}/m").count() == 1


def test_snapshot_survives_a_write_cut_short(spark, tmp_out):
    root = os.path.join(tmp_out, uuid.uuid4().hex)
    sink = SJ.snapshot_sink(f"{root}/snap")
    sch = "region string, timestamp string, temperature_2m double"
    assert SJ.read_snapshot(spark, f"{root}/snap") is None

    def rows():
        return sorted(tuple(r) for r in SJ.read_snapshot(spark, f"{root}/snap").collect())
    one = [("A", "1", 1.0), ("B", "1", 2.0)]
    sink(spark.createDataFrame(one, sch), 0)
    assert rows() == one
    batch = spark.createDataFrame([("A", "2", 3.0)], sch)
    sink(batch, 1)
    want = [("A", "2", 3.0), ("B", "1", 2.0)]
    assert rows() == want
    # the write of batch 1 cut short: some of its rows are there, or none
    part = spark.read.parquet(f"{root}/snap/slot1").where("region = 'A'").collect()
    schema = spark.read.parquet(f"{root}/snap/slot1").schema
    spark.createDataFrame(part, schema).write.mode("overwrite").parquet(f"{root}/snap/slot1")
    assert rows() == one
    sink(batch, 1)                                   # replayed: the same snapshot
    assert rows() == want
    sink(spark.createDataFrame([("C", "3", 4.0)], sch), 2)
    sink(spark.createDataFrame([("C", "3", 4.0)], sch), 2)
    assert rows() == want + [("C", "3", 4.0)]


def test_buckets_are_merged_and_written_after_one_shuffle(spark, tmp_out, monkeypatch):
    import glob

    from stationlab.streaming import versions as VS
    plans, commit = [], VS.commit

    def noted(df, *args, **kwargs):
        plans.append((df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1], kwargs.get("dealt")))
        commit(df, *args, **kwargs)
    monkeypatch.setattr(VS, "commit", noted)
    up = SJ.upsert_batch(f"{tmp_out}/m", ["k"], ["seq"], VS.HashBuckets(["k"], most=2000, depth=1))
    rows = spark.range(0, 3000, numPartitions=6).selectExpr("id % 1000 AS k", "id AS seq", "CAST(id AS STRING) AS v")
    for b in range(3):
        up(rows.unionByName(rows.selectExpr("CAST(NULL AS LONG) AS k", "seq", "v").limit(2)), b)
    # before: dealt by key, then once more by bucket
    assert [(p.count("Exchange"), dealt) for p, dealt in plans] == [(1, True)] * 3, plans
    parts = VS.live(spark, f"{tmp_out}/m")
    versions = {p.version for p in parts.values() if p.version}
    assert len(parts) > 4 and all(len(glob.glob(f"{d}/*.parquet")) == 1 for v in versions for d in glob.glob(f"{tmp_out}/m/data/{v}/_part=*"))
    got = SJ.read_master(spark, f"{tmp_out}/m")
    assert got.count() == 1001 and got.where("k IS NOT NULL AND seq < 2000").count() == 0


def test_a_commit_writes_about_as_many_files_as_partitions(spark, tmp_out):
    """Each task used to write a file for every partition it held rows of."""
    import glob

    from stationlab.streaming import versions as VS
    df = spark.range(0, 4000, numPartitions=8).select("id", (F.col("id") % 20).cast("string").alias(VS.PART))
    VS.commit(df.unionByName(df.limit(1).select("id", F.lit("a b=1:2").alias(VS.PART))), f"{tmp_out}/t", [])
    assert len(glob.glob(f"{tmp_out}/t/data/*/*/*.parquet")) == 21
    parts = VS.live(spark, f"{tmp_out}/t")
    assert len(parts) == 21 and "a b=1:2" in parts and all(p.bytes > 0 for p in parts.values())
    assert VS.read(spark, f"{tmp_out}/t").count() == 4001
    assert VS.read(spark, f"{tmp_out}/t", lambda p: p == "a b=1:2").count() == 1
