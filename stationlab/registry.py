"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the test tables (through ``sources.testbed``) and runs the
library operator named in its docstring over the whole tables.  Float
aggregates are passed through ``fixed6`` so that results compare with the
DuckDB oracle in ``oracle.py`` independent of summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .functions.numeric import fixed6
from .operators import features as FE
from .operators import halo as H
from .sources import testbed as TB

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def dates_as_text(df: DataFrame) -> DataFrame:
    """DATE columns leave as ISO ``yyyy-MM-dd`` text (one representation in
    every client, as the drift table stores them)."""
    from pyspark.sql import types as T
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.date_format(F.col(c), "yyyy-MM-dd") for c in dates}) if dates else df


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return dates_as_text(fn(spark, sf_dir))
        run.__doc__, run.__name__ = fn.__doc__, fn.__name__
        QUERIES[name] = run
        return fn
    return deco


def present(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: fixed6(F.col(c)) for c in cols})


ROLL_NAMES = [r[0] for r in S.ROLLING]


@register("feature_table")
def q_feature_table(spark, sf_dir):
    """W1-W3, P7, P8, P11, P14, P15 — form chosen from the measured region sizes."""
    return present(FE.feature_table(TB.hourly_from_events(spark, sf_dir), method="auto"), ROLL_NAMES)


@register("feature_table_halo")
def q_feature_table_halo(spark, sf_dir):
    """Same rows, forced bucketed form; a 50-row bucket target so that on test-sized
    data light days are packed, dense days split into hours, and halos span buckets."""
    return present(FE.feature_table(TB.hourly_from_events(spark, sf_dir), method="halo", target_rows=50),
                   ROLL_NAMES)


@register("feature_table_window")
def q_feature_table_window(spark, sf_dir):
    """Same rows with plain per-region windows."""
    return present(FE.feature_table(TB.hourly_from_events(spark, sf_dir), method="window"), ROLL_NAMES)


# ------------------------------------------------------------------ imports used below
from .functions import bands as B  # noqa: E402
from .functions.calendar import calendar_fields, lookback_days  # noqa: E402
from .functions.numeric import coerce_numeric, narrow, null_if_zero  # noqa: E402
from .operators import clean as CL  # noqa: E402
from .operators import report as RP  # noqa: E402
from .operators import stats as ST  # noqa: E402
from .plans import fetch_plan as PL  # noqa: E402
from .sources import hourly as HR  # noqa: E402
from .sources import payload as PY  # noqa: E402

MEASURES = ["temperature", "precipitation", "wind_speed", "humidity", "pressure"]
PREDS = {"xgb": "temperature_xgb_pred", "nn": "temperature_nn_pred"}
TODAY = "2024-02-05"          # fixed "today" so labels and plans are deterministic
FOLD_DAY = "2024-01-15"       # day-fold / recent-window anchor on the events month
ORDERS_TRAIN_END, ORDERS_TEST_START = 1998, 1999


def drift_frame(spark, sf_dir):
    return ST.daily_mae(TB.predictions_from_events(spark, sf_dir))


# ------------------------------------------------------------------ windows and fills
@register("fill_forward_back")
def q_fill(spark, sf_dir):
    """P14 + P15: forward then back fill within region."""
    return FE.fill(TB.hourly_from_events(spark, sf_dir), MEASURES)


@register("fill_forward")
def q_ffill(spark, sf_dir):
    """P14 alone: leading gaps stay missing."""
    return FE.ffill(TB.hourly_from_events(spark, sf_dir), MEASURES)


@register("lags")
def q_lags(spark, sf_dir):
    """15 lag columns on the unfilled frame."""
    return FE.lags(TB.hourly_from_events(spark, sf_dir), S.LAG_COLUMNS, S.LAGS)


@register("rolling")
def q_rolling(spark, sf_dir):
    """W2, W3 on the unfilled frame (NULLs skipped, all-NULL frame -> NULL)."""
    return present(FE.rolling(TB.hourly_from_events(spark, sf_dir)), ROLL_NAMES)


@register("latest_per_region")
def q_latest(spark, sf_dir):
    """Latest row of each region."""
    return RP.latest_per_region(TB.hourly_from_events(spark, sf_dir))


@register("head_per_group")
def q_head(spark, sf_dir):
    """First 2000 rows of each of the first 3 regions."""
    return RP.head_per_group(TB.hourly_from_events(spark, sf_dir), 2000, 3)


@register("upsert_latest_arrival")
def q_upsert(spark, sf_dir):
    """One row per (l_orderkey, l_linenumber), latest (l_shipdate, l_partkey) wins."""
    return CL.dedupe_latest(TB.arrivals_from_lineitem(spark, sf_dir),
                            ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


@register("horizon_days")
def q_horizon(spark, sf_dir):
    """24-row day slices of the hourly forecast from a given hour."""
    fc = TB.forecast_from_events(spark, sf_dir).select("region", "time", "ecmwf")
    return RP.horizon_days(fc, now="2024-01-10 00:00:00", days=13)


# ------------------------------------------------------------------ projections / predicates
@register("calendar_fields")
def q_calendar(spark, sf_dir):
    """P7, P8 over the multi-year orders dates."""
    d = TB.daily_from_orders(spark, sf_dir).select("seq", "datetime")
    return calendar_fields(d)


@register("split_by_year")
def q_split(spark, sf_dir):
    """Train <= 1998, test >= 1999 over the orders years."""
    train, test = TR.split_by_year(TB.daily_from_orders(spark, sf_dir), ORDERS_TRAIN_END, ORDERS_TEST_START)
    return (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("datetime").alias("first_datetime"),
                                  F.max("datetime").alias("last_datetime")))


@register("day_fold")
def q_day_fold(spark, sf_dir):
    """P10: train strictly before day D, test in [D, D + 1)."""
    h = TB.hourly_from_events(spark, sf_dir)
    train, test = TR.day_fold(h, FOLD_DAY)
    return (train.withColumn("fold", F.lit("train")).unionByName(test.withColumn("fold", F.lit("test")))
            .groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows")))


@register("drop_any")
def q_drop_any(spark, sf_dir):
    """P11."""
    return CL.drop_any(TB.hourly_from_events(spark, sf_dir))


@register("drop_all_null")
def q_drop_all(spark, sf_dir):
    """Rows with temperature and humidity both missing are dropped."""
    return CL.drop_all_null(TB.hourly_from_events(spark, sf_dir), ["temperature", "humidity"])


@register("all_null_count")
def q_all_null_count(spark, sf_dir):
    """P12 report: how many rows the all-missing drop removes."""
    return CL.all_null_count(TB.hourly_from_events(spark, sf_dir), ["temperature", "humidity"])


@register("coerce_numeric")
def q_coerce(spark, sf_dir):
    """Strings to DOUBLE, unparseable -> NULL."""
    e = TB.table(spark, sf_dir, "events").select(
        "event_id", "props", F.col("user_id").cast("string").alias("user_id"),
        F.regexp_extract("props", r":\s*([0-9]+)", 1).alias("k"))
    return coerce_numeric(e, except_=("event_id",))


@register("narrow_float32")
def q_narrow(spark, sf_dir):
    """Double -> float."""
    return narrow(TB.hourly_from_events(spark, sf_dir))


@register("null_if_zero")
def q_null_if_zero(spark, sf_dir):
    """P25: zero or NaN predictions -> missing (differences of the two forecasters)."""
    p = TB.predictions_from_events(spark, sf_dir)
    return p.select("datetime", "region",
                    null_if_zero(F.floor(F.col("temperature_xgb_pred") / 100.0).cast("double")).alias("bucket"))


@register("residuals")
def q_residuals(spark, sf_dir):
    """Residual and absolute error of the tree-model column."""
    p = TB.predictions_from_events(spark, sf_dir)
    return ST.residuals(p, "temperature_actual", "temperature_xgb_pred").select(
        "datetime", "region", "residual", "abs_residual")


@register("error_bands")
def q_error_bands(spark, sf_dir):
    """Rows per error band of the network-model absolute error."""
    p = TB.predictions_from_events(spark, sf_dir)
    err = F.abs(F.col("temperature_actual") - F.col("temperature_nn_pred"))
    return p.groupBy(B.error_band(err).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@register("request_labels")
def q_request_labels(spark, sf_dir):
    """P17 + P20: valid requests with the label of their actual value."""
    req = TB.request_rows(spark, sf_dir).withColumn("region", F.coalesce("region", F.lit(S.DEFAULT_REGION)))
    req = req.withColumn("date", F.to_date("date"))
    today = F.lit(TODAY).cast("date")
    look = RP.lookup_actual(req, TB.predictions_from_events(spark, sf_dir))
    return (look.where(B.valid_request(F.col("date"), today))
            .select("event_id", "region", "date",
                    B.actual_label(F.col("date"), today, F.col("actual")).alias("label")))


@register("lookback_days")
def q_lookback(spark, sf_dir):
    """Re-read window per region from its last date to 'today'."""
    h = TB.hourly_from_events(spark, sf_dir)
    return (h.groupBy("region").agg(F.to_date(F.max("datetime")).alias("last_date"))
            .withColumn("days", lookback_days(F.col("last_date"), F.lit(TODAY).cast("date"))))


@register("recent_rows")
def q_recent(spark, sf_dir):
    """Rows of the 10 days before the anchor."""
    return HR.recent(TB.hourly_from_events(spark, sf_dir), "2024-01-25 00:00:00", days=10)


@register("preview")
def q_preview(spark, sf_dir):
    """Top-50 rows by (region, datetime)."""
    return RP.preview(TB.hourly_from_events(spark, sf_dir), 50)


@register("one_column_scan")
def q_one_column(spark, sf_dir):
    """A single pruned column."""
    return TB.hourly_from_events(spark, sf_dir).select("datetime")


# ------------------------------------------------------------------ payloads
@register("hourly_payload_rows")
def q_payload(spark, sf_dir):
    """S6 + P1 + P2: API payloads (built from events) -> canonical rows."""
    return PY.explode_hourly(TB.hourly_payloads(spark, sf_dir))


@register("current_observation")
def q_current(spark, sf_dir):
    """Current-observation payload -> row; absent key -> NULL."""
    return PY.project_current(TB.current_payloads(spark, sf_dir))


@register("request_rows")
def q_requests(spark, sf_dir):
    """Request documents -> (region, date), missing region -> default."""
    return PY.read_requests(TB.request_payloads(spark, sf_dir))


# ------------------------------------------------------------------ aggregates
@register("null_counts")
def q_null_counts(spark, sf_dir):
    """A1 per column."""
    return CL.null_counts(TB.hourly_from_events(spark, sf_dir))


@register("null_total")
def q_null_total(spark, sf_dir):
    """A1 total."""
    return CL.null_total(TB.hourly_from_events(spark, sf_dir))


@register("null_pct")
def q_null_pct(spark, sf_dir):
    """A2: columns with more than 5 % missing."""
    return present(CL.null_pct(TB.hourly_from_events(spark, sf_dir), 5.0), ["pct_missing"])


@register("corr_matrix")
def q_corr(spark, sf_dir):
    """A3: Pearson correlation of the measures, pairwise complete."""
    return present(ST.corr_matrix(TB.hourly_from_events(spark, sf_dir), MEASURES), ["corr"])


@register("region_stats")
def q_region_stats(spark, sf_dir):
    """A5."""
    return present(ST.region_stats(TB.hourly_from_events(spark, sf_dir)), ["mean", "std"])


@register("anomalies")
def q_anomalies(spark, sf_dir):
    """Per-region z-score and |z| > 3 flag."""
    a = ST.anomalies(TB.values_from_events(spark, sf_dir))
    return present(a, ["temp_zscore"])


@register("anomaly_counts")
def q_anomaly_counts(spark, sf_dir):
    """A19 per region."""
    return ST.anomaly_counts(ST.anomalies(TB.values_from_events(spark, sf_dir)))


@register("high_water")
def q_high_water(spark, sf_dir):
    """Highest datetime and next fetch start."""
    return PL.high_water(TB.hourly_from_events(spark, sf_dir))


@register("kpis")
def q_kpis(spark, sf_dir):
    """A7."""
    return RP.kpis(TB.hourly_from_events(spark, sf_dir))


@register("regression_metrics")
def q_metrics(spark, sf_dir):
    """MAE, RMSE, R^2 of both forecasters."""
    m = ST.regression_metrics(TB.predictions_from_events(spark, sf_dir), "temperature_actual", PREDS)
    return present(m, ["mae", "rmse", "r2"])


@register("band_accuracy")
def q_accuracy(spark, sf_dir):
    """Accuracy of the thermal band predicted from the network forecast."""
    p = TB.predictions_from_events(spark, sf_dir).select(
        B.thermal_band(F.col("temperature_actual") / 10.0).alias("y"),
        B.thermal_band(F.col("temperature_nn_pred") / 10.0).alias("yhat"))
    return present(ST.accuracy(p, "y", "yhat"), ["accuracy"])


@register("daily_minmax")
def q_daily_minmax(spark, sf_dir):
    """A10 + P18: daily min / max of coalesce(ecmwf, gfs, 0) and band of the max (scaled /10)."""
    fc = TB.forecast_from_events(spark, sf_dir)
    fc = fc.withColumns({"ecmwf": F.col("ecmwf") / 10.0, "gfs": F.col("gfs") / 10.0})
    return present(RP.daily_minmax(fc), ["t_min", "t_max"])


@register("daily_mean")
def q_daily_mean(spark, sf_dir):
    """24-row mean per horizon day, missing counted as 0."""
    fc = TB.forecast_from_events(spark, sf_dir)
    return present(RP.daily_mean(fc, "ecmwf", now="2024-01-10 00:00:00"), ["day_mean"])


@register("climatology")
def q_climatology(spark, sf_dir):
    """A12 over the multi-year orders frame."""
    return present(RP.climatology(TB.daily_from_orders(spark, sf_dir)), ["actual_climatology_avg"])


@register("daily_mae")
def q_daily_mae(spark, sf_dir):
    """Per-day MAE of both forecasters (the drift table)."""
    return present(drift_frame(spark, sf_dir), ["xgb_mae", "nn_mae"])


@register("daily_mae_halo")
def q_daily_mae_halo(spark, sf_dir):
    """A20 with the predictions built in the forced halo form."""
    v = TB.values_from_events(spark, sf_dir)
    preds = RP.naive_predictions(v, method="halo", target_rows=50)
    return present(ST.daily_mae(preds), ["xgb_mae", "nn_mae"])


@register("drift_summary")
def q_drift_summary(spark, sf_dir):
    """A13, A14, P21 on the drift table."""
    return present(RP.drift_summary(drift_frame(spark, sf_dir)), ["latest_xgb_mae", "latest_nn_mae"])


@register("forecast_diff")
def q_forecast_diff(spark, sf_dir):
    """Forecast vs baseline aligned by (region, hour)."""
    fc, base = TB.forecast_tables(spark, sf_dir)
    return present(RP.forecast_diff(fc, base).select("region", "time", "forecast", "baseline", "diff"),
                   ["forecast", "baseline", "diff"])


@register("diff_summary")
def q_diff_summary(spark, sf_dir):
    """A15."""
    fc, base = TB.forecast_tables(spark, sf_dir)
    return present(RP.diff_summary(RP.forecast_diff(fc, base)), ["mean_abs_diff", "max_abs_diff"])


@register("residual_histogram")
def q_resid_hist(spark, sf_dir):
    """Residual bins of width 5 per model."""
    return ST.residual_histogram(TB.predictions_from_events(spark, sf_dir), "temperature_actual", PREDS)


@register("pred_density")
def q_density(spark, sf_dir):
    """2-D bins of actual vs tree-model prediction."""
    return ST.pred_density(TB.predictions_from_events(spark, sf_dir), "temperature_actual",
                           "temperature_xgb_pred", 0.0, 25.0)


@register("region_extent")
def q_extent(spark, sf_dir):
    """A18 over the multi-year frame."""
    return RP.region_extent(TB.daily_from_orders(spark, sf_dir))


@register("single_region")
def q_single_region(spark, sf_dir):
    """P13."""
    return CL.for_region(TB.hourly_from_events(spark, sf_dir), "view")


@register("region_list")
def q_region_list(spark, sf_dir):
    """T5."""
    return RP.region_list(TB.daily_from_orders(spark, sf_dir))


@register("anomaly_total")
def q_anomaly_total(spark, sf_dir):
    """A19 overall."""
    return ST.anomaly_counts(ST.anomalies(TB.values_from_events(spark, sf_dir)), key=None)


@register("anomaly_one_region")
def q_anomaly_one(spark, sf_dir):
    """A19 for one region."""
    return ST.anomaly_counts(CL.for_region(ST.anomalies(TB.values_from_events(spark, sf_dir)), "click"), key=None)


@register("region_year_counts")
def q_region_year_counts(spark, sf_dir):
    """A4."""
    return PL.region_year_counts(TB.daily_from_orders(spark, sf_dir))


@register("actual_range")
def q_actual_range(spark, sf_dir):
    """A17 axes: min / max of the actual value."""
    return ST.actual_range(TB.predictions_from_events(spark, sf_dir), "temperature_actual")


@register("predictions")
def q_predictions(spark, sf_dir):
    """Predictions table (S12 content) from the two forecasters."""
    return present(TB.predictions_from_events(spark, sf_dir), ["temperature_nn_pred"])


# ------------------------------------------------------------------ plans and joins
def _orders_bounds(spark, sf_dir):
    d = TB.daily_from_orders(spark, sf_dir)
    return d.agg(F.to_date(F.min("datetime")).alias("start"), F.to_date(F.max("datetime")).alias("end"))


def _plan(spark, sf_dir):
    b = _orders_bounds(spark, sf_dir).first()          # two dates
    return PL.month_plan(TB.region_names(spark, sf_dir), str(b.start), str(b.end))


@register("completeness")
def q_completeness(spark, sf_dir):
    """J1 + A4: nation x year grid 1995-2001, missing below 8000 rows."""
    return PL.completeness(TB.daily_from_orders(spark, sf_dir), TB.region_names(spark, sf_dir), 1995, 2001)


@register("missing_combos")
def q_missing_combos(spark, sf_dir):
    """Only the missing (region, year) combinations."""
    return PL.missing_combos(TB.daily_from_orders(spark, sf_dir), TB.region_names(spark, sf_dir), 1995, 2001)


@register("month_plan")
def q_month_plan(spark, sf_dir):
    """Month x nation chunks between the first and last order date."""
    return _plan(spark, sf_dir)


@register("pending_chunks")
def q_pending(spark, sf_dir):
    """Planned chunks without any order rows."""
    return PL.pending(_plan(spark, sf_dir), PL.done_chunks(TB.daily_from_orders(spark, sf_dir)))


@register("coverage")
def q_coverage(spark, sf_dir):
    """A21."""
    return present(PL.coverage(_plan(spark, sf_dir), PL.done_chunks(TB.daily_from_orders(spark, sf_dir))),
                   ["pct_done"])


@register("day_plan")
def q_day_plan(spark, sf_dir):
    """Days after the last drift date up to yesterday."""
    last = drift_frame(spark, sf_dir).agg(F.max(F.to_date("date")).alias("last"))
    return last.select(F.explode(PL.day_plan(F.col("last"), TODAY)).alias("day"))


@register("attach_latest")
def q_attach(spark, sf_dir):
    """J3 + P22: requests -> latest row of their region, time injected; unknown regions drop."""
    req = (TB.request_rows(spark, sf_dir)
           .withColumn("region", F.coalesce("region", F.lit(S.DEFAULT_REGION)))
           .withColumn("target_datetime", F.col("date").try_cast("timestamp_ntz")))
    j = RP.attach_latest(req, TB.hourly_from_events(spark, sf_dir))
    return RP.inject_datetime(j).select("event_id", "region", "date", "latest_datetime", "datetime",
                                        "hour", "day_of_year", "month", "temperature", "pressure")


@register("lookup_actual")
def q_lookup(spark, sf_dir):
    """Request -> first archive row of that date (left join)."""
    req = TB.request_rows(spark, sf_dir).where(F.col("region").isNotNull()).withColumn("date", F.to_date("date"))
    return RP.lookup_actual(req, TB.predictions_from_events(spark, sf_dir))


@register("live_error")
def q_live_error(spark, sf_dir):
    """Latest observation per region vs the champion's prediction for its nearest hour.

    Observations come five minutes after the archive's rows; one region has no archive."""
    preds = TB.predictions_from_events(spark, sf_dir)
    summary = RP.drift_summary(ST.daily_mae(preds))
    obs = TB.values_from_events(spark, sf_dir).withColumn("datetime", F.timestamp_add("MINUTE", F.lit(5), F.col("datetime")))
    alone = obs.agg(F.max("datetime").alias("datetime"), F.lit("Atlantis").alias("region"), F.max("temperature").alias("temperature"))
    return present(RP.live_error(obs.unionByName(alone), preds, summary), ["prediction", "error"])


def _outcomes(spark, sf_dir):
    """Outcomes as a fetch would append them: stored chunks twice, February chunks as missing even where rows came."""
    root = _scratch(spark, "outcomes")
    done = PL.done_chunks(TB.daily_from_orders(spark, sf_dir)).withColumn("status", F.lit("done"))
    february = _plan(spark, sf_dir).where(F.col("chunk_key").endswith("-02")).select("chunk_key", F.lit("missing").alias("status"))
    for part in (done.where("chunk_key < 'J'"), february, done, done.where("chunk_key < 'J'")):
        SK.append_outcomes(part, f"{root}/outcomes")
    return SK.read_outcomes(spark, f"{root}/outcomes")


@register("fetch_control")
def q_fetch_control(spark, sf_dir):
    """State of every chunk from repeated and conflicting outcomes, and whether it is fetched next."""
    plan = _plan(spark, sf_dir)
    control = materialize(PL.control_table(plan, _outcomes(spark, sf_dir)))
    todo = PL.to_fetch(plan, control).select("chunk_key", F.lit(True).alias("next"))
    return control.join(todo, "chunk_key", "left").withColumn("next", F.coalesce("next", F.lit(False)))


@register("fetch_coverage")
def q_fetch_coverage(spark, sf_dir):
    """Chunks by state."""
    return present(PL.control_coverage(PL.control_table(_plan(spark, sf_dir), _outcomes(spark, sf_dir))), ["pct_settled"])


@register("residual_curve")
def q_residual_curve(spark, sf_dir):
    """Gaussian density curve of both models' residuals on 200 points each."""
    return present(ST.residual_curve(TB.predictions_from_events(spark, sf_dir), "temperature_actual", PREDS), ["x", "density"])


@register("request_rows_needed")
def q_request_rows_needed(spark, sf_dir):
    """Rows read for a batch of requests by region: the tail for recent ones, everything for the others."""
    h, req = TB.hourly_from_events(spark, sf_dir), TB.request_rows(spark, sf_dir)
    out = None
    for name, asked, as_of in (("recent", req.where("date >= '2024-01-21'"), "2024-01-28 00:00:00"),
                               ("old", req, "2024-02-20 00:00:00")):
        n = HR.for_requests(h, asked, as_of, days=7).groupBy("region").agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(name))
        out = n if out is None else out.unionByName(n)
    return out


# ------------------------------------------------------------------ leaderboards, metric tables
GRID = [1, 2, 3, 6, 12, 24]


def grid_results(spark, sf_dir):
    """Config grid: rolling means of the previous k rows, scored on the same
    hold-out (rows with 24 predecessors)."""
    v = TB.values_from_events(spark, sf_dir)

    def cols(w, pos):
        return {**{f"mean{k}": F.avg("temperature").over(w.rowsBetween(-k, -1)) for k in GRID}, "_n": pos}
    scored = H.windowed(v, cols, max(GRID)).where(F.col("_n") > 24)
    m = ST.regression_metrics(scored, "temperature", {f"mean{k}": f"mean{k}" for k in GRID})
    return m.withColumnRenamed("model", "name")


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    """Grid ordered by MAE, flag vs the persistence (k=1) MAE."""
    res = materialize(grid_results(spark, sf_dir))      # one row per config
    base = res.where(F.col("name") == "mean1").first().mae       # one number
    lb = RP.leaderboard(res, float(base))
    return present(lb.select("name", "mae", "rmse", "r2", "flag", "rank"), ["mae", "rmse", "r2"])


@register("best_config")
def q_best(spark, sf_dir):
    """T4."""
    return present(RP.best(grid_results(spark, sf_dir)), ["mae"])


@register("performance_summary")
def q_summary(spark, sf_dir):
    """U2 + S13: base (all rows) and optimised (test days) metrics, pivoted wide."""
    p = TB.predictions_from_events(spark, sf_dir)
    base = ST.regression_metrics(p, "temperature_actual", PREDS).withColumn("stage", F.lit("base"))
    test = p.where(F.col("datetime") >= F.lit(FOLD_DAY).cast("timestamp_ntz"))
    opt = ST.regression_metrics(test, "temperature_actual", PREDS).withColumn("stage", F.lit("optimized"))
    wide = RP.summary_wide(RP.metrics_table([base, opt]))
    return present(wide, ["MAE", "RMSE", "R2"])


# ------------------------------------------------------------------ streaming (availableNow, read back)
import tempfile  # noqa: E402
import uuid  # noqa: E402

from .session import checkpoint_dir, materialize  # noqa: E402
from .streaming import jobs as SJ  # noqa: E402
from .streaming import versions as VS  # noqa: E402


def _scratch(spark, name):
    """Fresh folder under the shared checkpoint folder (set here only if unset)."""
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    base = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="stationlab-", dir="/tmp") if unset else None)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("stream_latest_snapshot")
def q_stream_latest(spark, sf_dir):
    """Latest observation per region from a file stream, snapshot table."""
    root = _scratch(spark, "latest")
    obs = TB.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("region"), F.col("ts").alias("timestamp"),
        F.col("value").alias("temperature_2m"), F.col("event_id"))
    # four files: the third brings rows older than those before it, the fourth repeats some
    obs = TB.landed(obs, f"{root}/landing", ["event_id % 5 < 2", "event_id % 5 = 2", "event_id % 5 > 2", "event_id % 7 = 0"]).drop("event_id")
    SJ.run_latest_snapshot(obs, f"{root}/snapshot", f"{root}/_checkpoint").awaitTermination()
    return SJ.read_snapshot(spark, f"{root}/snapshot")


@register("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    """Lineitem arrivals of four landed files merged into a hash-partitioned master, later arrival wins.

    The files follow the ship date, so keys of earlier files are corrected by later ones; the last
    file arrives twice.  Buckets split as they pass 64 KB."""
    root = _scratch(spark, "upsert")
    key = ["l_orderkey", "l_linenumber"]
    rows = TB.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount")
    q = rows.select(F.expr("percentile_approx(l_shipdate, array(0.25, 0.5, 0.75))").alias("q")).first().q or [None] * 3
    d = F.col("l_shipdate")
    files = [d <= q[0], (d > q[0]) & (d <= q[1]), (d > q[1]) & (d <= q[2]), d > q[2], d > q[2]]
    SJ.run_upsert(TB.landed(rows, f"{root}/landing", files), f"{root}/master", f"{root}/_checkpoint", key,
                  ["l_shipdate", "l_partkey"], VS.HashBuckets(key, most=64 << 10)).awaitTermination()
    return SJ.read_master(spark, f"{root}/master")


@register("stream_daily_mae")
def q_stream_daily_mae(spark, sf_dir):
    """Tumbling-day MAE over a stream of prediction files."""
    root = _scratch(spark, "daily")
    TB.predictions_from_events(spark, sf_dir).write.parquet(f"{root}/preds")
    preds = spark.readStream.schema(S.PREDICTIONS).parquet(f"{root}/preds")
    SJ.run_daily_mae(preds, f"{root}/daily", f"{root}/_checkpoint").awaitTermination()
    return present(SJ.read_latest_by(spark, f"{root}/daily", ["date"]), ["xgb_mae", "nn_mae"])


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """Daily errors over three landed files; rows more than five days late are kept aside, counted, and
    their days evaluated again with them."""
    root = _scratch(spark, "late")
    late, cut = "hour(datetime) = 7", "datetime < timestamp_ntz'2024-01-15'"
    preds = TB.landed(TB.predictions_from_events(spark, sf_dir), f"{root}/landing",
                      [f"{cut} AND NOT {late}", f"NOT ({cut})", f"{cut} AND {late}"])
    SJ.run_daily_errors(preds, f"{root}/errors", f"{root}/_checkpoint", days=5).awaitTermination()
    every = SJ.read_daily_errors(spark, f"{root}/errors", with_late=True)
    in_time = SJ.read_daily_errors(spark, f"{root}/errors").select("date", F.col("xgb_mae").alias("xgb_mae_in_time"))
    return present(every.join(in_time, "date"), ["xgb_mae", "nn_mae", "xgb_mae_in_time"])


@register("stream_features")
def q_stream_features(spark, sf_dir):
    """R3 + R7: hourly rows of four landed files (the third late, the fourth repeated) upserted per batch,
    features refreshed incrementally."""
    root = _scratch(spark, "features")
    h = TB.hourly_from_events(spark, sf_dir)
    cut, late = "datetime < timestamp_ntz'2024-01-15'", "hour(datetime) = 7"
    rows = TB.landed(h, f"{root}/landing", [f"{cut} AND NOT {late}", f"NOT ({cut}) AND NOT {late}", late, "hour(datetime) = 9"])
    SJ.run_features(rows, f"{root}/master", f"{root}/features", f"{root}/_checkpoint").awaitTermination()
    return present(SJ.read_features(spark, f"{root}/features"), ROLL_NAMES)


# ------------------------------------------------------------------ models (rows-only checks)
from .models import estimators as ES  # noqa: E402
from .models import training as TR  # noqa: E402

SPLIT_DAY = "2024-01-20"
# model fits are not SQL-expressible: the driver checks their rows only, tests/test_models.py the rest
ROWS_ONLY = {"ml_holdout_metrics", "season_classifier", "importances", "score_requests", "score_requests_saved", "backtest",
             "tuning", "grid_leaderboard", "attribution"}


def _ml_frame(spark, sf_dir):
    """The feature table, written once and read by every step of a query."""
    path = f"{_scratch(spark, 'ml')}/features"
    FE.feature_table(TB.hourly_from_events(spark, sf_dir)).write.parquet(path)
    feat = spark.read.parquet(path)
    return feat, FE.feature_columns(feat)


def _sides(feat):
    d = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return feat.where(F.col("datetime") < d), feat.where(F.col("datetime") >= d)


def _holdout(spark, sf_dir):
    feat, cols = _ml_frame(spark, sf_dir)
    return *_sides(feat), cols


@register("ml_holdout_metrics")
def q_ml_holdout(spark, sf_dir):
    """Scaler + network, boosted trees, forest; metrics on the hold-out days."""
    train, test, cols = _holdout(spark, sf_dir)
    models = TR.fit_models(train, cols)
    return TR.evaluate(test, models, cols, "base")


@register("season_classifier")
def q_season(spark, sf_dir):
    """4-class season forest on a 30 % sample of the multi-year frame."""
    d = calendar_fields(TB.daily_from_orders(spark, sf_dir))
    d = FE.lags(d, ["temperature"], [1, 6, 24]).na.drop()
    cols = ["temperature", "temperature_lag1", "temperature_lag6", "temperature_lag24", "day_of_year", "hour"]
    train, test = TR.split_by_year(d, ORDERS_TRAIN_END, ORDERS_TEST_START)
    sample = ES.training_frame(ES.assemble(ES.sample_frac(train, 0.3), cols))
    m = ES.fit_season(sample)
    sample.unpersist()
    p = m.transform(ES.assemble(test, cols))
    return ST.accuracy(p.withColumn("season_pred", F.col("season_pred").cast("int")), "season_class", "season_pred")


@register("importances")
def q_importances(spark, sf_dir):
    """Top-15 feature importances of the boosted trees, by split count and by gain."""
    train, _, cols = _holdout(spark, sf_dir)
    m = ES.fit_gbt(ES.assemble(train, cols), "temperature")
    return ES.top_importance(spark, m, cols, 15)


@register("score_requests")
def q_score(spark, sf_dir):
    """Request batch -> latest row of the region -> both models, 2 dp."""
    feat, cols = _ml_frame(spark, sf_dir)
    models = TR.fit_models(_sides(feat)[0], cols, forest=False)
    req = PY.read_requests(TB.request_payloads(spark, sf_dir))
    return TR.score_requests(req, feat, models, cols)


@register("score_requests_saved")
def q_score_saved(spark, sf_dir):
    """As ``score_requests``, from models saved to the shared folder and loaded again."""
    root = _scratch(spark, "models")
    feat, cols = _ml_frame(spark, sf_dir)
    ES.save_models(spark, TR.fit_models(_sides(feat)[0], cols, forest=False), root, {"features": cols})
    models = ES.load_models(spark, root, {"features": cols})
    req = PY.read_requests(TB.request_payloads(spark, sf_dir))
    return TR.score_requests(req, feat, models, cols)


@register("backtest")
def q_backtest(spark, sf_dir):
    """Expanding-window daily backtest over every day of the table after the first."""
    feat, cols = _ml_frame(spark, sf_dir)
    span = feat.agg(F.to_date(F.min("datetime")).alias("a"), F.date_add(F.to_date(F.max("datetime")), 1).alias("b"))
    days = [str(d) for d in span.select(PL.day_plan(F.col("a"), F.col("b")).alias("d")).first().d or []]
    return TR.backtest(feat, days, cols)


@register("tuning")
def q_tuning(spark, sf_dir):
    """M6: random search, 5 of the 12 points with 3-fold CV."""
    train, _, cols = _holdout(spark, sf_dir)
    return spark.createDataFrame([TR.tune(train, cols)])


@register("grid_leaderboard")
def q_grid(spark, sf_dir):
    """M7 + T3: the 7 tree and 15 network configs on a fixed hold-out, ranked by MAE."""
    train, test, cols = _holdout(spark, sf_dir)
    return TR.grid(spark, train, test, cols, TR.GRID_CONFIGS, baseline_mae=1.0)


@register("attribution")
def q_attribution(spark, sf_dir):
    """Sampled-Shapley mean |contribution| per feature of the boosted trees."""
    train, test, cols = _holdout(spark, sf_dir)
    m = ES.fit_gbt(ES.assemble(train, cols), "temperature")
    return TR.attribution(m, train.unionByName(test), cols, n=500)


# ------------------------------------------------------------------ sources / sinks round trips (scratch folder)
from .sources import sinks as SK  # noqa: E402


@register("csv_master_scan")
def q_csv_master(spark, sf_dir):
    """The hourly master written as headered CSV, read back with the explicit schema."""
    root = _scratch(spark, "csv")
    h = TB.hourly_from_events(spark, sf_dir)
    full = h.select(*[F.col(f.name) if f.name in h.columns else F.lit(None).cast("double").alias(f.name)
                      for f in S.HOURLY.fields])
    full.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") \
        .csv(f"{root}/master")
    return HR.read_hourly(spark, f"{root}/master", fmt="csv")


@register("multi_part_read")
def q_parts(spark, sf_dir):
    """A table stored as two parts with different columns, reassembled by name."""
    root = _scratch(spark, "parts")
    li = TB.arrivals_from_lineitem(spark, sf_dir)
    li.where(F.col("l_linenumber") <= 3).select("l_orderkey", "l_linenumber", "l_quantity") \
        .write.parquet(f"{root}/lineitem_pt1")
    li.where(F.col("l_linenumber") > 3).select("l_orderkey", "l_linenumber", "l_discount") \
        .write.parquet(f"{root}/lineitem_pt2")
    return HR.read_parts(spark, f"{root}/lineitem_pt*")


@register("feature_table_roundtrip")
def q_feature_roundtrip(spark, sf_dir):
    """S11 + S5: the feature table written partitioned by year and read back."""
    root = _scratch(spark, "features")
    SK.write_features(FE.feature_table(TB.hourly_from_events(spark, sf_dir)), f"{root}/features")
    return present(HR.read_features(spark, f"{root}/features").drop("year"), ROLL_NAMES)


@register("drift_roundtrip")
def q_drift_roundtrip(spark, sf_dir):
    """S10 + D7: the drift table appended twice (a stale then a fresh run); one row per date, last wins."""
    root = _scratch(spark, "drift")
    fresh = drift_frame(spark, sf_dir)
    stale = fresh.withColumns({"xgb_mae": F.col("xgb_mae") * 2.0, "nn_mae": F.col("nn_mae") * 2.0})
    SK.append_drift(stale, f"{root}/drift", arrival=1)
    SK.append_drift(fresh, f"{root}/drift", arrival=2)
    return present(SK.read_drift(spark, f"{root}/drift"), ["xgb_mae", "nn_mae"])


@register("kpis_roundtrip")
def q_kpis_roundtrip(spark, sf_dir):
    """KPIs written to two destinations as JSON and read back from the second."""
    root = _scratch(spark, "kpis")
    SK.write_kpis(RP.kpis(TB.hourly_from_events(spark, sf_dir)), [f"{root}/metrics", f"{root}/webdata"])
    return SK.read_kpis(spark, f"{root}/webdata")
