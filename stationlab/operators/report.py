"""Rollups behind the dashboard and the reports.

(A7, A10-A15, A18, J3-J6, W6-W8, S19, T3, T4, U2, S13, P22)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands as B
from ..session import small_side
from ..functions.calendar import calendar_fields
from . import halo as H
from .clean import union_all
from .features import region_window

PRED_COLS = {"xgb": "temperature_xgb_pred", "nn": "temperature_nn_pred"}


# --------------------------------------------------------------------------- predictions
def naive_predictions(df: DataFrame, method: str = "auto", unit: str = "day",
                      value: str = "temperature", mean_rows: int = 6,
                      max_rows_per_task: int = 2_000_000, target_rows: int | None = None) -> DataFrame:
    """Predictions frame from two deterministic forecasters over ``value``:
    "xgb" = previous row, "nn" = mean of the previous ``mean_rows`` rows.
    Rows without a previous row are dropped.  ``method`` as in
    ``halo.windowed``."""
    def cols(w, _):
        return {
            "temperature_actual": F.col(value),
            "temperature_xgb_pred": F.lag(value, 1).over(w),
            "temperature_nn_pred": F.avg(value).over(w.rowsBetween(-mean_rows, -1)),
        }
    keep = ["datetime", "region", "temperature_actual", "temperature_xgb_pred", "temperature_nn_pred"]
    out = H.windowed(df, cols, mean_rows, "region", "datetime", method, unit,
                     max_rows_per_task=max_rows_per_task, target_rows=target_rows)
    return out.select(*keep).where(F.col("temperature_xgb_pred").isNotNull())


# --------------------------------------------------------------------------- KPIs, extents
def kpis(df: DataFrame, region_count: int | None = None) -> DataFrame:
    """total_records, last_update, region_count (A7, S14 payload)."""
    rc = F.lit(region_count) if region_count is not None else F.count_distinct("region")
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.max("datetime").alias("last_update"),
                  rc.alias("region_count"))


def region_extent(df: DataFrame) -> DataFrame:
    """Distinct regions with first / last date and row count."""
    return df.groupBy("region").agg(F.to_date(F.min("datetime")).alias("first_date"),
                                    F.to_date(F.max("datetime")).alias("last_date"),
                                    F.count(F.lit(1)).alias("n_rows"))


def region_list(df: DataFrame) -> DataFrame:
    """Sorted distinct regions (T5)."""
    return df.select("region").distinct().orderBy("region")


def climatology(df: DataFrame, value: str = "temperature") -> DataFrame:
    """Mean by region, month and day of month over all years.

    Missing values are skipped (D9), not counted as 0.
    """
    return (df.groupBy("region", F.month("datetime").alias("month"),
                       F.dayofmonth("datetime").alias("day"))
            .agg(F.avg(value).alias("actual_climatology_avg")))


# --------------------------------------------------------------------------- latest / heads
def extreme_rows(df: DataFrame, keys: list, order: str, latest: bool = True,
                 key_exprs: dict | None = None) -> DataFrame:
    """One row per group: the row with the largest (or smallest) ``order``.

    ``max_by(struct(row), order)`` would be planned as a sort-based aggregate
    (the struct buffer is not fixed-width), sorting every input partition.
    Instead: a hash aggregate of the extreme ``order`` value per group (a
    primitive buffer, combined map-side), an equi-join back on (group,
    order) — the group table has one row per group and is broadcast when its
    measured row count allows (``small_side``), so the data is not shuffled
    for the join — and a tie-break among equal ``order`` values on the
    already tiny result.
    """
    key_exprs = key_exprs or {}
    d = df.withColumns(key_exprs) if key_exprs else df
    names = [k for k in keys]
    agg = F.max(order) if latest else F.min(order)
    ext = small_side(d.groupBy(*names).agg(agg.alias(order)))
    hit = d.join(ext, [*names, order], "inner")
    rest = [c for c in hit.columns if c not in names]
    pick = F.max(F.struct(*[F.col(c) for c in rest])) if latest else F.min(F.struct(*[F.col(c) for c in rest]))
    return hit.groupBy(*names).agg(pick.alias("_r")).select(*names, *[F.col(f"_r.{c}").alias(c) for c in rest])


def latest_per_region(df: DataFrame, order: str = "datetime", key: str = "region") -> DataFrame:
    """The latest row of each region (W6): hash aggregate + join back (see ``extreme_rows``)."""
    return extreme_rows(df, [key], order, latest=True).select(*df.columns)


def head_per_group(df: DataFrame, n: int = 2000, groups: int = 3, key: str = "region",
                   order: str = "datetime", unit: str = "day") -> DataFrame:
    """First ``n`` rows of each of the first ``groups`` regions.

    Rows are counted per (region, day) first (a small aggregate); only the
    days that can hold one of a region's first ``n`` rows are kept (a semi
    join on that small table), so the final numbering window sorts at most
    ``n`` rows plus one day per region, whatever the history length.
    """
    first = df.select(key).distinct().orderBy(key).limit(groups)
    d = df.join(first, key, "left_semi").withColumn("_bkt", F.date_trunc(unit, F.col(order)))
    wk = Window.partitionBy(key).orderBy("_bkt")
    need = (d.groupBy(key, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_before", F.coalesce(F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)))
            .where(F.col("_before") < n).select(key, "_bkt"))
    w = Window.partitionBy(key).orderBy(order)
    return (d.join(need, [key, "_bkt"], "left_semi").drop("_bkt")
            .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n))


def preview(df: DataFrame, n: int = 50, order: tuple[str, ...] = ("region", "datetime")) -> DataFrame:
    """Top-``n`` preview rows (S19): a distributed top-k, not a sort + collect."""
    return df.orderBy(*order).limit(n)


# --------------------------------------------------------------------------- forecasts
def forecast_value(ecmwf: str = "ecmwf", gfs: str = "gfs"):
    """Row-level fallback ``coalesce(ecmwf, gfs, 0)``."""
    return F.coalesce(F.col(ecmwf), F.col(gfs), F.lit(0.0))


def daily_minmax(fc: DataFrame, cold: float = B.COLD) -> DataFrame:
    """Daily min / max of the hourly forecast and the thermal band of the max."""
    v = forecast_value()
    return (fc.groupBy("region", F.to_date("time").alias("date"))
            .agg(F.min(v).alias("t_min"), F.max(v).alias("t_max"))
            .withColumn("band", B.thermal_band(F.col("t_max"), cold)))


def horizon_days(fc: DataFrame, now=None, days: int = 13, key: str = "region",
                 order: str = "time") -> DataFrame:
    """24-row slices from the current hour: day = (row - offset) div 24.

    The offset is the place of the row at exactly ``now``; a region without such a
    row, or no ``now``, has offset 0.
    ``rn <= days * 24`` bounds each region's slice (partial group limit).
    """
    src = fc
    if now is not None:
        hour = F.lit(now).cast("timestamp_ntz")
        there = small_side(fc.where(F.col(order) == hour).select(F.col(key)).distinct().withColumn("_there", F.lit(True)))
        src = fc.join(there, key, "left").where(F.col("_there").isNull() | (F.col(order) >= hour)).drop("_there")
    w = Window.partitionBy(key).orderBy(order)
    return (src.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= days * 24)
            .withColumn("day", ((F.col("_rn") - 1) / 24).cast("int"))
            .drop("_rn"))


def daily_mean(fc: DataFrame, value: str = "ecmwf", now=None, days: int = 13) -> DataFrame:
    """Mean per horizon day, missing counted as 0."""
    h = horizon_days(fc, now, days)
    return (h.groupBy("region", "day")
            .agg((F.sum(F.coalesce(F.col(value), F.lit(0.0))) / F.count(F.lit(1))).alias("day_mean")))


def forecast_diff(fc: DataFrame, base: DataFrame) -> DataFrame:
    """Forecast vs baseline aligned by (region, hour); baseline = ecmwf else gfs."""
    return (fc.join(base, ["region", "time"])
            .withColumn("baseline", F.coalesce(F.col("ecmwf"), F.col("gfs")))
            .withColumn("diff", F.col("forecast") - F.col("baseline")))


def diff_summary(diffs: DataFrame) -> DataFrame:
    """Mean and max absolute forecast difference."""
    return diffs.agg(F.avg(F.abs("diff")).alias("mean_abs_diff"),
                     F.max(F.abs("diff")).alias("max_abs_diff"))


# --------------------------------------------------------------------------- drift
def drift_summary(drift: DataFrame) -> DataFrame:
    """First / last date, days tracked, latest row, champion, health."""
    latest = F.max_by(F.struct("xgb_mae", "nn_mae"), F.col("date"))
    return (drift.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                      F.count(F.lit(1)).alias("days_tracked"), latest.alias("_l"))
            .select("first_date", "last_date", "days_tracked",
                    F.col("_l.xgb_mae").alias("latest_xgb_mae"), F.col("_l.nn_mae").alias("latest_nn_mae"))
            .withColumn("champion", B.champion(F.col("latest_xgb_mae"), F.col("latest_nn_mae")))
            .withColumn("health", B.health_status(F.col("last_date"))))


def nearest_hour(obs: DataFrame, rows: DataFrame, key: str = "region", ts: str = "datetime") -> DataFrame:
    """``obs`` (one row per key and ``ts``) with the row of ``rows`` that is nearest in time, as struct ``near``.

    Candidates are rows of the same key in the observation's hour or the hour on either side (an
    equi-join on key and hour); the least distance wins, of equal ones the earlier row.  An
    observation without a candidate, or without a time, is kept with a NULL ``near``.
    """
    hour = F.date_trunc("hour", F.col(ts))
    asked = small_side(obs.select(F.col(key).alias("_key"), F.col(ts).alias("_at")).distinct())
    hours = asked.withColumn("_hour", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda h: F.timestamp_add(
        "HOUR", h, F.date_trunc("hour", F.col("_at"))))))
    near = (rows.select(F.struct(*rows.columns).alias("near"), F.col(key).alias("_k"), hour.alias("_h"), F.col(ts).alias("_t"))
            .join(hours, (F.col("_k") == F.col("_key")) & (F.col("_h") == F.col("_hour"))))
    gap = F.abs(F.timestamp_diff("MICROSECOND", F.col("_at"), F.col("_t")))
    best = near.groupBy("_key", "_at").agg(F.min_by("near", F.struct(gap, F.col("_t"))).alias("near"))
    return obs.join(small_side(best), (F.col(key) == F.col("_key")) & (F.col(ts) == F.col("_at")), "left").drop("_key", "_at")


def live_error(obs: DataFrame, archive: DataFrame, summary: DataFrame, score=None) -> DataFrame:
    """Latest observation per region -> champion prediction for its nearest hour, and the error.

    ``archive`` holds both models' predictions, or, with ``score``, feature rows: the nearest one of a
    region gets the observation's time (P22), and ``score`` (a function of DataFrames, such as the
    loaded models of ``training.live_scorer``) adds the predictions.  ``summary`` is the one-row drift
    summary; its champion label is read as one value.  A region without a row near its observation
    is kept, without prediction and error.
    """
    champ = summary.select("champion").first()
    latest = latest_per_region(obs.select("region", "datetime", F.col("temperature").alias("actual")))
    if score is None:
        near = nearest_hour(latest, archive.select("region", "datetime", *PRED_COLS.values()))
        j = near.select("region", "datetime", "actual", *[F.col(f"near.{c}").alias(c) for c in PRED_COLS.values()])
    else:
        near = nearest_hour(latest, archive)
        found = near.where("near IS NOT NULL").select(F.col("datetime").alias("_seen"), "actual", "near.*")
        scored = score(inject_datetime(found.withColumn("target_datetime", F.col("_seen"))))
        j = scored.select("region", F.col("_seen").alias("datetime"), "actual", *PRED_COLS.values()).unionByName(
            near.where("near IS NULL").select("region", "datetime", "actual"), allowMissingColumns=True)
    j = j.withColumn("champion", F.lit(champ.champion if champ else B.MODEL_TREE))
    pred = F.when(F.col("champion") == B.MODEL_NETWORK, F.col(PRED_COLS["nn"])).otherwise(F.col(PRED_COLS["xgb"]))
    return (j.select("region", "datetime", "actual", "champion", pred.alias("prediction"))
            .withColumn("error", F.abs(F.col("prediction") - F.col("actual")))
            .withColumn("error_band", F.when(F.col("error").isNotNull(), B.error_band(F.col("error")))))


# --------------------------------------------------------------------------- requests
def lookup_actual(req: DataFrame, archive: DataFrame) -> DataFrame:
    """(region, date) requests -> first archive row of that date, NULL if none.

    The archive is reduced to one row per (region, date) before the join
    (``extreme_rows``), so the join input is the size of the calendar.
    """
    cols = archive.select("region", "datetime", "temperature_actual", *PRED_COLS.values())
    first = (extreme_rows(cols, ["region", "date"], "datetime", latest=False,
                          key_exprs={"date": F.to_date("datetime")})
             .select("region", "date", F.col("temperature_actual").alias("actual"), *PRED_COLS.values()))
    return req.join(first, ["region", "date"], "left")


def attach_latest(req: DataFrame, feat: DataFrame) -> DataFrame:
    """Each request gets its region's latest feature row; unknown regions drop."""
    latest = latest_per_region(feat).withColumnRenamed("datetime", "latest_datetime")
    return req.join(small_side(latest), "region")


def inject_datetime(df: DataFrame, target: str = "target_datetime") -> DataFrame:
    """Overwrite datetime, day_of_year, month, hour with the requested time.

    season_class is left as it is (it is not a model input).
    """
    df = df.withColumn("datetime", F.col(target))
    return calendar_fields(df, "datetime", season=False)


# --------------------------------------------------------------------------- leaderboards
def leaderboard(results: DataFrame, baseline_mae: float | None = None,
                best_other_mae: float | None = None) -> DataFrame:
    """Configs ordered by MAE with rank and pass flag vs thresholds.

    Flag: ``beats_best`` (< best_other_mae), ``beats_baseline`` (< baseline_mae),
    else ``none``.  Thresholds may also be columns of ``results``.
    """
    base = F.col("baseline_mae") if baseline_mae is None else F.lit(baseline_mae)
    other = F.lit(best_other_mae) if best_other_mae is not None else F.lit(None).cast("double")
    flag = (F.when(F.col("mae") < other, "beats_best").when(F.col("mae") < base, "beats_baseline")
            .otherwise("none"))
    # One row per config: the ranking window runs on the (small) results table.
    w = Window.orderBy("mae", "name")
    return results.withColumn("flag", flag).withColumn("rank", F.row_number().over(w))


def best(results: DataFrame) -> DataFrame:
    """Best config by MAE (T4); ties -> smallest name."""
    return results.agg(F.min_by(F.col("name"), F.struct("mae", "name")).alias("name"),
                       F.min("mae").alias("mae"))


def metrics_table(parts: list[DataFrame]) -> DataFrame:
    """Union of long metric tables (stage, model, mae, rmse, r2)."""
    return union_all(parts)


def summary_wide(metrics: DataFrame) -> DataFrame:
    """Long (stage, model, metric, value) -> wide (model label, MAE, RMSE, R2)."""
    long = metrics.selectExpr("concat_ws(' ', stage, model) AS label",
                              "stack(3, 'MAE', mae, 'RMSE', rmse, 'R2', r2) AS (metric, value)")
    return long.groupBy("label").pivot("metric", ["MAE", "RMSE", "R2"]).agg(F.first("value"))
