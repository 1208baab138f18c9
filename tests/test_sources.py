"""Sources and sinks: write to a scratch folder, read back, compare."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationlab import schema as S
from stationlab.operators import features as FE
from stationlab.sources import hourly as HR
from stationlab.sources import sinks as SK
from stationlab.sources import testbed as TB


def test_feature_table_roundtrip(spark, tmp_out):
    feat = FE.feature_table(TB.hourly_from_events(spark, SF_SMALL))
    path = os.path.join(tmp_out, "features")
    SK.write_features(feat, path)
    back = HR.read_features(spark, path).drop("year")
    assert back.count() == feat.count()
    assert back.exceptAll(feat.select(back.columns)).count() == 0


def test_write_features_spreads_a_hot_station(spark, tmp_out):
    """One station with 98 % of the rows: files of about equal size, sorted inside."""
    n = 40_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 50 == 0, "Rare").otherwise("Hot").alias("region"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("id") * 7919, F.lit(n)) * 3600).cast("timestamp_ntz").alias("datetime"),
        F.col("id").cast("double").alias("temperature"))
    path = os.path.join(tmp_out, "hot")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        SK.write_features(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    by_task: dict = {}
    for year in os.listdir(path):
        if not year.startswith("year="):
            continue
        for name in os.listdir(os.path.join(path, year)):
            if name.endswith(".parquet"):
                t = pq.read_table(os.path.join(path, year, name), columns=["region", "datetime"], partitioning=None)
                got = list(zip(t["region"].to_pylist(), t["datetime"].to_pylist(), strict=True))
                assert got == sorted(got)
                task = name.split("-")[1]
                by_task[task] = by_task.get(task, 0) + len(got)
    assert sum(by_task.values()) == n
    assert len(by_task) == 4 and max(by_task.values()) < 0.4 * n


def test_csv_master_scan_and_schema(spark, tmp_out):
    h = TB.hourly_from_events(spark, SF_SMALL)
    full = h.select(*[F.col(c) if c in h.columns else F.lit(None).cast("double").alias(c)
                      for c in [f.name for f in S.HOURLY.fields]])
    path = os.path.join(tmp_out, "master_csv")
    full.write.option("header", True).csv(path)
    back = HR.read_hourly(spark, path, fmt="csv")
    assert back.count() == h.count()
    assert HR.schema_of(spark, path, "csv").names == [f.name for f in S.HOURLY.fields]
    one = HR.read_hourly(spark, path, fmt="csv", columns=["datetime"])
    assert one.columns == ["datetime"]


def test_multi_part_reassembly(spark, tmp_out):
    h = TB.hourly_from_events(spark, SF_SMALL)
    h.select("datetime", "region", "temperature").write.parquet(os.path.join(tmp_out, "master_pt1"))
    h.select("datetime", "region", "pressure").write.parquet(os.path.join(tmp_out, "master_pt2"))
    both = HR.read_parts(spark, os.path.join(tmp_out, "master_pt*"))
    assert set(both.columns) == {"datetime", "region", "temperature", "pressure"}
    assert both.count() == 2 * h.count()


def test_metrics_params_drift_kpis(spark, tmp_out):
    m = spark.createDataFrame([("base", "xgb", 0.1, 0.2, 0.9)], S.METRICS)
    SK.write_metrics(m, os.path.join(tmp_out, "metrics"))
    assert SK.read_metrics(spark, os.path.join(tmp_out, "metrics")).collect() == m.collect()
    assert '"MAE":0.1' in SK.metrics_json(m).first().json
    assert SK.read_params(spark, os.path.join(tmp_out, "nope")) == S.DEFAULT_GBT_PARAMS
    SK.write_params(spark, {"n_estimators": 200, "max_depth": 10, "learning_rate": 0.1},
                    os.path.join(tmp_out, "params"))
    assert SK.read_params(spark, os.path.join(tmp_out, "params"))["n_estimators"] == 200
    drift_path = os.path.join(tmp_out, "drift")
    d1 = spark.createDataFrame([("2024-01-01", 0.5, 0.6)], S.DRIFT)
    d2 = spark.createDataFrame([("2024-01-01", 0.4, 0.3), ("2024-01-02", 0.2, 0.1)], S.DRIFT)
    SK.append_drift(d1, drift_path, arrival=1)
    SK.append_drift(d2, drift_path, arrival=2)
    SK.append_drift(d2, drift_path, arrival=3)          # re-run of the same day: no repeat
    got = sorted(tuple(r) for r in SK.read_drift(spark, drift_path).collect())
    assert got == [("2024-01-01", 0.4, 0.3), ("2024-01-02", 0.2, 0.1)]
    from stationlab.operators.report import kpis
    k = kpis(TB.hourly_from_events(spark, SF_SMALL))
    SK.write_kpis(k, [os.path.join(tmp_out, "k1"), os.path.join(tmp_out, "k2")])
    assert spark.read.json(os.path.join(tmp_out, "k2")).first().model_status == "Calibrated & Operational"


def test_staging_append_and_summary(spark, tmp_out):
    h = TB.hourly_from_events(spark, SF_SMALL)
    p = os.path.join(tmp_out, "staging")
    SK.append_staging(h, p)
    SK.append_staging(h, p)
    assert spark.read.parquet(p).count() == 2 * h.count()
    from stationlab.operators.report import summary_wide
    m = spark.createDataFrame([("base", "xgb", 0.1, 0.2, 0.9)], S.METRICS)
    SK.write_summary(summary_wide(m), os.path.join(tmp_out, "summary"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_out, "summary")).first()
    assert back.label == "base xgb" and float(back.MAE) == 0.1


def test_csv_mixed_datetime_forms(spark, tmp_out):
    import datetime as dt
    p = os.path.join(tmp_out, "mixed.csv")
    os.makedirs(p)
    header = ",".join(f.name for f in S.HOURLY.fields)
    rest = "," * (len(S.HOURLY.fields) - 2)
    with open(os.path.join(p, "part-0.csv"), "w") as f:
        f.write(header + "\n")
        for ts in ["2026-04-29T15:30", "2026-04-29 15:30:00", "2026-04-29", "2026-04-29T15:30:00.123456", "bad"]:
            f.write(f"{ts},London{rest}\n")
    got = [r.datetime for r in HR.read_hourly(spark, p, fmt="csv").collect()]
    assert got == [dt.datetime(2026, 4, 29, 15, 30), dt.datetime(2026, 4, 29, 15, 30), dt.datetime(2026, 4, 29),
                   dt.datetime(2026, 4, 29, 15, 30, 0, 123456), None]
