"""DuckDB oracle SQL for the registered queries (tables are pre-registered views).

Each statement restates the operator's semantics in plain SQL over the same
test tables; ``registry.py`` holds the Spark side under the same names.
Float aggregates are presented with ``fixed6`` on both sides (see
``functions.numeric.fixed6``).
"""

from __future__ import annotations

from . import schema as S


def fx(expr: str) -> str:
    return f"(FLOOR(({expr}) * 1000000.0 + 0.499) / 1000000.0)"


PROPS_K = "TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)"

HOURLY = f"""hourly AS (
  SELECT ts AS datetime, event_type AS region,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS temperature,
         {PROPS_K} / 10.0 AS precipitation,
         CAST(user_id % 40 AS DOUBLE) AS wind_speed,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE {PROPS_K} END AS humidity,
         1000.0 + value / 10.0 AS pressure
  FROM events)"""

HOURLY_MEASURES = ["temperature", "precipitation", "wind_speed", "humidity", "pressure"]

DAILY = """daily AS (
  SELECT o.o_orderdate AS datetime, n.n_name AS region, o.o_totalprice AS temperature,
         o.o_orderkey AS seq
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

PREDICTIONS = """preds AS (
  SELECT datetime, region, temperature_actual, temperature_xgb_pred, temperature_nn_pred FROM (
    SELECT ts AS datetime, event_type AS region, value AS temperature_actual,
           lag(value, 1) OVER (PARTITION BY event_type ORDER BY ts) AS temperature_xgb_pred,
           avg(value) OVER (PARTITION BY event_type ORDER BY ts
                            ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS temperature_nn_pred
    FROM events) WHERE temperature_xgb_pred IS NOT NULL)"""

CAL = """CAST(hour({t}) AS INTEGER) AS hour, CAST(dayofyear({t}) AS INTEGER) AS day_of_year,
         CAST(month({t}) AS INTEGER) AS month, CAST((month({t}) % 12) // 3 AS INTEGER) AS season_class"""


def filled_cte(src: str = "hourly", name: str = "filled") -> str:
    cols = ",\n    ".join(
        f"COALESCE(last_value({c} IGNORE NULLS) OVER pre, first_value({c} IGNORE NULLS) OVER post) AS {c}"
        for c in HOURLY_MEASURES)
    return f"""{name} AS (
  SELECT datetime, region,
    {cols}
  FROM {src}
  WINDOW pre AS (PARTITION BY region ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         post AS (PARTITION BY region ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def feature_sql() -> str:
    lags = ",\n    ".join(f"lag({c}, {n}) OVER w AS {c}_lag{n}" for c in S.LAG_COLUMNS for n in S.LAGS)
    rolls = ",\n    ".join(
        f"{'avg' if agg == 'mean' else 'sum'}({col}) OVER (PARTITION BY region ORDER BY datetime "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {name}"
        for name, col, n, agg in S.ROLLING)
    out_cols = (["datetime", "region"] + HOURLY_MEASURES
                + [f"{c}_lag{n}" for c in S.LAG_COLUMNS for n in S.LAGS])
    sel = ", ".join(out_cols + [f"{fx(r[0])} AS {r[0]}" for r in S.ROLLING] + S.CALENDAR_COLUMNS)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in out_cols + [r[0] for r in S.ROLLING])
    return f"""WITH {HOURLY}, {filled_cte()},
feat AS (
  SELECT *,
    {lags},
    {rolls},
    {CAL.format(t='datetime')}
  FROM filled WINDOW w AS (PARTITION BY region ORDER BY datetime))
SELECT {sel} FROM feat WHERE {notnull}"""


SQL: dict[str, str] = {}
SQL["feature_table"] = feature_sql()
SQL["feature_table_window"] = SQL["feature_table"]
SQL["feature_table_halo"] = SQL["feature_table"]

FORECAST = f"""fc AS (
  SELECT event_type AS region, date_trunc('hour', ts) AS time, avg(value) AS forecast,
         avg(CASE WHEN k > 50 THEN value END) AS ecmwf, avg(CASE WHEN k <= 50 THEN value END) AS gfs
  FROM (SELECT *, {PROPS_K} AS k FROM events) GROUP BY 1, 2)"""

DRIFT = """drift AS (
  SELECT strftime(datetime, '%Y-%m-%d') AS date,
         avg(abs(temperature_actual - temperature_xgb_pred)) AS xgb_mae,
         avg(abs(temperature_actual - temperature_nn_pred)) AS nn_mae
  FROM preds GROUP BY 1)"""

REQ = """req AS (
  SELECT event_id, CASE WHEN user_id % 10 = 0 THEN NULL ELSE event_type END AS region,
         strftime(CAST(ts AS DATE) + CAST(user_id % 3 AS INTEGER), '%Y-%m-%d') AS date
  FROM events)"""

FIRST_ARCHIVE = """first_row AS (
  SELECT region, CAST(datetime AS DATE) AS date,
         min_by(temperature_actual, datetime) AS actual,
         min_by(temperature_xgb_pred, datetime) AS temperature_xgb_pred,
         min_by(temperature_nn_pred, datetime) AS temperature_nn_pred
  FROM preds GROUP BY 1, 2)"""

ORDERS_PLAN = """bounds AS (SELECT CAST(min(datetime) AS DATE) AS s, CAST(max(datetime) AS DATE) AS e FROM daily),
plan AS (
  SELECT n.n_name AS region, strftime(greatest(m.m, b.s), '%Y-%m-%d') AS chunk_start,
         strftime(least(CAST(last_day(m.m) AS DATE), b.e), '%Y-%m-%d') AS chunk_end,
         n.n_name || '_' || strftime(m.m, '%Y-%m') AS chunk_key
  FROM nation n, bounds b,
       LATERAL (SELECT CAST(g AS DATE) AS m FROM generate_series(CAST(date_trunc('month', b.s) AS TIMESTAMP),
                CAST(date_trunc('month', b.e) AS TIMESTAMP), INTERVAL 1 MONTH) t(g)) m),
done AS (SELECT DISTINCT region || '_' || strftime(datetime, '%Y-%m') AS chunk_key FROM daily)"""

THERMAL = """CASE WHEN {x} > 24 THEN 'hot' WHEN {x} > 18 THEN 'warm' WHEN {x} < 8 THEN 'cold' ELSE 'mild' END"""


def _w(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


def _stack(cols: list[str], expr: str, name: str, src: str, cast: str = "") -> str:
    parts = []
    for c in cols:
        e = expr.format(c=c)
        parts.append(f"SELECT '{c}' AS \"column\", {('CAST(' + e + ' AS ' + cast + ')') if cast else e} AS {name} FROM {src}")
    return "\nUNION ALL ".join(parts)


HOURLY_COLS = ["datetime", "region"] + HOURLY_MEASURES

# ---- windows and fills
SQL["fill_forward_back"] = _w(f"{HOURLY}, {filled_cte()}", "SELECT * FROM filled")
SQL["fill_forward"] = _w(HOURLY, "SELECT datetime, region, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY region ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in HOURLY_MEASURES) + " FROM hourly")
SQL["lags"] = _w(HOURLY, "SELECT *, " + ", ".join(
    f"lag({c}, {n}) OVER (PARTITION BY region ORDER BY datetime) AS {c}_lag{n}"
    for c in S.LAG_COLUMNS for n in S.LAGS) + " FROM hourly")
SQL["rolling"] = _w(HOURLY, "SELECT *, " + ", ".join(
    fx(f"{'avg' if agg == 'mean' else 'sum'}({col}) OVER (PARTITION BY region ORDER BY datetime "
       f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)") + f" AS {name}"
    for name, col, n, agg in S.ROLLING) + " FROM hourly")
SQL["latest_per_region"] = _w(HOURLY, """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY datetime DESC) AS rn FROM hourly) WHERE rn = 1""")
SQL["head_per_group"] = _w(HOURLY, """SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY datetime) AS INTEGER) AS rn FROM hourly
  WHERE region IN (SELECT DISTINCT region FROM hourly ORDER BY region LIMIT 3)) WHERE rn <= 2000""")
SQL["upsert_latest_arrival"] = """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_discount FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC) AS rn FROM lineitem) WHERE rn = 1"""
SQL["horizon_days"] = _w(FORECAST, """SELECT region, time, ecmwf, CAST((rn - 1) // 24 AS INTEGER) AS day FROM (
  SELECT region, time, ecmwf, row_number() OVER (PARTITION BY region ORDER BY time) AS rn
  FROM fc f WHERE time >= TIMESTAMP '2024-01-10 00:00:00' OR NOT EXISTS (
    SELECT 1 FROM fc g WHERE g.region = f.region AND g.time = TIMESTAMP '2024-01-10 00:00:00')) WHERE rn <= 312""")

# ---- projections / predicates
SQL["calendar_fields"] = _w(DAILY, f"SELECT seq, datetime, {CAL.format(t='datetime')} FROM daily")
SQL["split_by_year"] = _w(DAILY, """SELECT split, count(*) AS n_rows, min(datetime) AS first_datetime,
       max(datetime) AS last_datetime FROM (
  SELECT *, CASE WHEN year(datetime) <= 1998 THEN 'train' WHEN year(datetime) >= 1999 THEN 'test' END AS split
  FROM daily) WHERE split IS NOT NULL GROUP BY split""")
SQL["day_fold"] = _w(HOURLY, """SELECT fold, count(*) AS n_rows FROM (
  SELECT CASE WHEN datetime < TIMESTAMP '2024-01-15' THEN 'train'
              WHEN datetime >= TIMESTAMP '2024-01-15' AND datetime < TIMESTAMP '2024-01-16' THEN 'test' END AS fold
  FROM hourly) WHERE fold IS NOT NULL GROUP BY fold""")
SQL["drop_any"] = _w(HOURLY, "SELECT * FROM hourly WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in HOURLY_COLS))
SQL["drop_all_null"] = _w(HOURLY, "SELECT * FROM hourly WHERE temperature IS NOT NULL OR humidity IS NOT NULL")
SQL["all_null_count"] = _w(HOURLY, "SELECT CAST(count_if(temperature IS NULL AND humidity IS NULL) AS BIGINT) AS n_dropped FROM hourly")
SQL["coerce_numeric"] = r"""SELECT event_id,
  TRY_CAST(trim(props) AS DOUBLE) AS props,
  TRY_CAST(trim(CAST(user_id AS VARCHAR)) AS DOUBLE) AS user_id,
  TRY_CAST(trim(regexp_extract(props, ':\s*([0-9]+)', 1)) AS DOUBLE) AS k
FROM events"""
SQL["narrow_float32"] = _w(HOURLY, "SELECT datetime, region, " + ", ".join(
    f"CAST({c} AS FLOAT) AS {c}" for c in HOURLY_MEASURES) + " FROM hourly")
SQL["null_if_zero"] = _w(PREDICTIONS, """SELECT datetime, region,
  nullif(CAST(FLOOR(temperature_xgb_pred / 100.0) AS DOUBLE), 0.0) AS bucket FROM preds""")
SQL["residuals"] = _w(PREDICTIONS, """SELECT datetime, region, temperature_actual - temperature_xgb_pred AS residual,
  abs(temperature_actual - temperature_xgb_pred) AS abs_residual FROM preds""")
SQL["error_bands"] = _w(PREDICTIONS, """SELECT band, count(*) AS n FROM (
  SELECT CASE WHEN e < 0.05 THEN 'excellent' WHEN e < 0.5 THEN 'good' ELSE 'needs_work' END AS band
  FROM (SELECT abs(temperature_actual - temperature_nn_pred) AS e FROM preds)) GROUP BY band""")
SQL["request_labels"] = _w(f"{PREDICTIONS}, {REQ}, {FIRST_ARCHIVE}", """SELECT r.event_id, r.region, strftime(r.date, '%Y-%m-%d') AS date,
  CASE WHEN f.actual IS NULL THEN
         CASE WHEN date_diff('day', r.date, DATE '2024-02-05') > 0 AND date_diff('day', r.date, DATE '2024-02-05') < 10
              THEN 'Retraining Pending'
              WHEN r.date < DATE '2020-01-01' THEN 'Archived Baseline' ELSE 'Awaiting Time' END
       WHEN r.date > DATE '2024-02-05' THEN 'Historical Archive'
       WHEN r.date = DATE '2024-02-05' THEN 'Live Sensor Data' ELSE 'Verified Actual Temp' END AS label
FROM (SELECT event_id, coalesce(region, 'London') AS region, CAST(date AS DATE) AS date FROM req) r
LEFT JOIN first_row f ON r.region = f.region AND r.date = f.date
WHERE year(r.date) >= 2001 AND r.date <= DATE '2024-02-05' + INTERVAL 365 DAY""")
SQL["lookback_days"] = _w(HOURLY, """SELECT region, strftime(last_date, '%Y-%m-%d') AS last_date,
  CAST(greatest(1, least(90, date_diff('day', last_date, DATE '2024-02-05') + 2)) AS INTEGER) AS days
FROM (SELECT region, CAST(max(datetime) AS DATE) AS last_date FROM hourly GROUP BY region)""")
SQL["recent_rows"] = _w(HOURLY, "SELECT * FROM hourly WHERE datetime >= TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 10 DAY AND datetime < TIMESTAMP '2024-01-25 00:00:00'")
SQL["preview"] = _w(HOURLY, "SELECT * FROM hourly ORDER BY region, datetime LIMIT 50")
SQL["one_column_scan"] = "SELECT ts AS datetime FROM events"

# ---- payloads
SQL["hourly_payload_rows"] = _w(HOURLY, "SELECT datetime, region, " + ", ".join(
    (c if c in HOURLY_MEASURES else f"CAST(NULL AS DOUBLE) AS {c}") for c in S.MEASURES) + " FROM hourly")
SQL["current_observation"] = _w(HOURLY, """SELECT region, CAST(datetime AS VARCHAR) AS timestamp,
  temperature AS temperature_2m, humidity AS relative_humidity_2m, wind_speed AS wind_speed_10m,
  pressure AS pressure_msl FROM hourly""")
SQL["request_rows"] = _w(REQ, "SELECT coalesce(region, 'London') AS region, date FROM req")

# ---- aggregates
SQL["null_counts"] = _w(HOURLY, _stack(HOURLY_COLS, "count_if({c} IS NULL)", "n_missing", "hourly", "BIGINT"))
SQL["null_total"] = _w(HOURLY, "SELECT CAST(" + " + ".join(f"count_if({c} IS NULL)" for c in HOURLY_COLS)
                       + " AS BIGINT) AS n_missing FROM hourly")
SQL["null_pct"] = _w(HOURLY, "SELECT * FROM (" + _stack(
    HOURLY_COLS, fx("avg(CAST({c} IS NULL AS DOUBLE)) * 100.0"), "pct_missing", "hourly") + ") WHERE pct_missing > 5.0")
SQL["corr_matrix"] = _w(HOURLY, "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {fx(f'corr({a}, {b})')} AS corr FROM hourly"
    for a in HOURLY_MEASURES for b in HOURLY_MEASURES))
SQL["region_stats"] = _w(HOURLY, f"""SELECT region, {fx('avg(temperature)')} AS mean,
  {fx('stddev_samp(temperature)')} AS std FROM hourly GROUP BY region""")
ANOM = """anom AS (
  SELECT e.ts AS datetime, e.event_type AS region, e.value AS temperature,
         (e.value - s.m) / nullif(s.sd, 0.0) AS temp_zscore
  FROM events e JOIN (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM events GROUP BY 1) s
    ON e.event_type = s.event_type)"""
SQL["anomalies"] = _w(ANOM, f"""SELECT datetime, region, temperature, {fx('temp_zscore')} AS temp_zscore,
  coalesce(abs(temp_zscore) > 3.0, false) AS is_anomaly FROM anom""")
SQL["anomaly_counts"] = _w(ANOM, "SELECT region, CAST(count_if(abs(temp_zscore) > 3.0) AS BIGINT) AS n_anomalies FROM anom GROUP BY region")
SQL["high_water"] = _w(HOURLY, """SELECT max(datetime) AS max_datetime,
  strftime(coalesce(CAST(max(datetime) AS DATE), DATE '2024-12-31'), '%Y-%m-%d') AS last_date,
  strftime(coalesce(CAST(max(datetime) AS DATE), DATE '2024-12-31') + INTERVAL 1 DAY, '%Y-%m-%d') AS next_start FROM hourly""")
SQL["kpis"] = _w(HOURLY, "SELECT count(*) AS total_records, max(datetime) AS last_update, count(DISTINCT region) AS region_count FROM hourly")


def metrics_sql(src: str, models: dict[str, str], actual: str, label: str = "model") -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{m}' AS {label}, {fx(f'avg(abs({actual} - {p}))')} AS mae,
  {fx(f'sqrt(avg(({actual} - {p}) * ({actual} - {p})))')} AS rmse,
  {fx(f'1 - avg(({actual} - {p}) * ({actual} - {p})) / var_pop(CASE WHEN {p} IS NOT NULL THEN {actual} END)')} AS r2 FROM {src}"""
        for m, p in models.items())


PRED_MODELS = {"xgb": "temperature_xgb_pred", "nn": "temperature_nn_pred"}
SQL["regression_metrics"] = _w(PREDICTIONS, metrics_sql("preds", PRED_MODELS, "temperature_actual"))
SQL["band_accuracy"] = _w(PREDICTIONS, f"""SELECT {fx('avg(CAST(y = yhat AS DOUBLE))')} AS accuracy FROM (
  SELECT {THERMAL.format(x='(temperature_actual / 10.0)')} AS y,
         {THERMAL.format(x='(temperature_nn_pred / 10.0)')} AS yhat FROM preds)""")
SQL["daily_minmax"] = _w(FORECAST, f"""SELECT region, strftime(date, '%Y-%m-%d') AS date, {fx('t_min')} AS t_min, {fx('t_max')} AS t_max,
  {THERMAL.format(x='t_max')} AS band FROM (
  SELECT region, CAST(time AS DATE) AS date, min(coalesce(ecmwf / 10.0, gfs / 10.0, 0.0)) AS t_min,
         max(coalesce(ecmwf / 10.0, gfs / 10.0, 0.0)) AS t_max FROM fc GROUP BY 1, 2)""")
SQL["daily_mean"] = _w(FORECAST, f"""SELECT region, day, {fx('sum(coalesce(ecmwf, 0.0)) / count(*)')} AS day_mean FROM (
  SELECT region, ecmwf, CAST((rn - 1) // 24 AS INTEGER) AS day FROM (
    SELECT region, ecmwf, row_number() OVER (PARTITION BY region ORDER BY time) AS rn
    FROM fc f WHERE time >= TIMESTAMP '2024-01-10 00:00:00' OR NOT EXISTS (
    SELECT 1 FROM fc g WHERE g.region = f.region AND g.time = TIMESTAMP '2024-01-10 00:00:00')) WHERE rn <= 312) GROUP BY region, day""")
SQL["climatology"] = _w(DAILY, f"""SELECT region, CAST(month(datetime) AS INTEGER) AS month,
  CAST(dayofmonth(datetime) AS INTEGER) AS day, {fx('avg(temperature)')} AS actual_climatology_avg
FROM daily GROUP BY 1, 2, 3""")
SQL["daily_mae"] = _w(f"{PREDICTIONS}, {DRIFT}", f"SELECT date, {fx('xgb_mae')} AS xgb_mae, {fx('nn_mae')} AS nn_mae FROM drift")
SQL["daily_mae_halo"] = SQL["daily_mae"]
SQL["drift_summary"] = _w(f"{PREDICTIONS}, {DRIFT}", f"""SELECT first_date, last_date, days_tracked,
  {fx('lx')} AS latest_xgb_mae, {fx('ln')} AS latest_nn_mae,
  CASE WHEN ln IS NOT NULL AND ln < lx THEN 'Neural Network' ELSE 'XGBoost' END AS champion,
  CASE WHEN contains(last_date, '2025') OR contains(last_date, '2026') THEN 'Active Autonomous Retraining'
       ELSE 'Baseline Validation Complete' END AS health
FROM (SELECT min(date) AS first_date, max(date) AS last_date, count(*) AS days_tracked,
             max_by(xgb_mae, date) AS lx, max_by(nn_mae, date) AS ln FROM drift)""")
DIFF = """diffs AS (SELECT region, time, forecast, coalesce(ecmwf, gfs) AS baseline,
  forecast - coalesce(ecmwf, gfs) AS diff FROM fc)"""
SQL["forecast_diff"] = _w(f"{FORECAST}, {DIFF}", f"""SELECT region, time, {fx('forecast')} AS forecast,
  {fx('baseline')} AS baseline, {fx('diff')} AS diff FROM diffs""")
SQL["diff_summary"] = _w(f"{FORECAST}, {DIFF}", f"""SELECT {fx('avg(abs(diff))')} AS mean_abs_diff,
  {fx('max(abs(diff))')} AS max_abs_diff FROM diffs""")
SQL["residual_histogram"] = _w(PREDICTIONS, """SELECT model, bin, count(*) AS n FROM (
  SELECT 'xgb' AS model, CAST(FLOOR((temperature_actual - temperature_xgb_pred - 0.0) / 5.0) AS BIGINT) AS bin
  FROM preds WHERE temperature_actual - temperature_xgb_pred IS NOT NULL
  UNION ALL
  SELECT 'nn', CAST(FLOOR((temperature_actual - temperature_nn_pred - 0.0) / 5.0) AS BIGINT)
  FROM preds WHERE temperature_actual - temperature_nn_pred IS NOT NULL) GROUP BY model, bin""")
SQL["pred_density"] = _w(PREDICTIONS, """SELECT CAST(FLOOR((temperature_actual - 0.0) / 25.0) AS BIGINT) AS bin_actual,
  CAST(FLOOR((temperature_xgb_pred - 0.0) / 25.0) AS BIGINT) AS bin_pred, count(*) AS n
FROM preds WHERE temperature_actual IS NOT NULL AND temperature_xgb_pred IS NOT NULL GROUP BY 1, 2""")
SQL["region_extent"] = _w(DAILY, """SELECT region, strftime(min(datetime), '%Y-%m-%d') AS first_date,
  strftime(max(datetime), '%Y-%m-%d') AS last_date, count(*) AS n_rows FROM daily GROUP BY region""")

# ---- plans and joins
SQL["completeness"] = _w(DAILY, """SELECT g.region, g.year, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows,
  coalesce(c.n, 0) < 8000 AS is_missing
FROM (SELECT n_name AS region, CAST(y AS INTEGER) AS year FROM nation, range(1995, 2002) t(y)) g
LEFT JOIN (SELECT region, CAST(year(datetime) AS INTEGER) AS year, count(*) AS n FROM daily GROUP BY 1, 2) c
  ON g.region = c.region AND g.year = c.year""")
SQL["month_plan"] = _w(f"{DAILY}, {ORDERS_PLAN}", "SELECT * FROM plan")
SQL["pending_chunks"] = _w(f"{DAILY}, {ORDERS_PLAN}", "SELECT * FROM plan WHERE chunk_key NOT IN (SELECT chunk_key FROM done)")
SQL["coverage"] = _w(f"{DAILY}, {ORDERS_PLAN}", f"""SELECT n_done, n_missing, n_total,
  {fx('n_done * 100.0 / n_total')} AS pct_done FROM (
  SELECT CAST(count_if(chunk_key IN (SELECT chunk_key FROM done)) AS BIGINT) AS n_done,
         CAST(count_if(chunk_key NOT IN (SELECT chunk_key FROM done)) AS BIGINT) AS n_missing,
         count(*) AS n_total FROM plan)""")
SQL["day_plan"] = _w(f"{PREDICTIONS}, {DRIFT}", """SELECT strftime(g, '%Y-%m-%d') AS day FROM
  (SELECT max(CAST(date AS DATE)) AS last FROM drift) d,
  generate_series(CAST(d.last + INTERVAL 1 DAY AS TIMESTAMP), CAST(DATE '2024-02-04' AS TIMESTAMP), INTERVAL 1 DAY) t(g)""")
SQL["attach_latest"] = _w(f"{HOURLY}, {REQ}", """, latest AS (
  SELECT region, datetime AS latest_datetime, temperature, pressure FROM (
    SELECT *, row_number() OVER (PARTITION BY region ORDER BY datetime DESC) AS rn FROM hourly) WHERE rn = 1)
SELECT r.event_id, r.region, r.date, l.latest_datetime, CAST(CAST(r.date AS DATE) AS TIMESTAMP) AS datetime,
  CAST(0 AS INTEGER) AS hour, CAST(dayofyear(CAST(r.date AS DATE)) AS INTEGER) AS day_of_year,
  CAST(month(CAST(r.date AS DATE)) AS INTEGER) AS month, l.temperature, l.pressure
FROM (SELECT event_id, coalesce(region, 'London') AS region, date FROM req) r JOIN latest l ON r.region = l.region""")
SQL["lookup_actual"] = _w(f"{PREDICTIONS}, {REQ}, {FIRST_ARCHIVE}", """SELECT r.event_id, r.region, strftime(r.date, '%Y-%m-%d') AS date, f.actual,
  f.temperature_xgb_pred, f.temperature_nn_pred
FROM (SELECT event_id, region, CAST(date AS DATE) AS date FROM req WHERE region IS NOT NULL) r
LEFT JOIN first_row f ON r.region = f.region AND r.date = f.date""")
SQL["live_error"] = _w(f"{PREDICTIONS}, {DRIFT}", f""", champ AS (
  SELECT CASE WHEN max_by(nn_mae, date) IS NOT NULL AND max_by(nn_mae, date) < max_by(xgb_mae, date)
              THEN 'Neural Network' ELSE 'XGBoost' END AS champion FROM drift),
latest AS (
  SELECT event_type AS region, max(ts) + INTERVAL 5 MINUTE AS datetime, max_by(value, ts) AS actual FROM events GROUP BY 1
  UNION ALL SELECT 'Atlantis', max(ts) + INTERVAL 5 MINUTE, max(value) FROM events),
near AS (
  SELECT l.region, arg_min(p, row(abs(epoch_us(p.datetime) - epoch_us(l.datetime)), p.datetime)) AS p
  FROM latest l JOIN preds p ON l.region = p.region
    AND date_trunc('hour', p.datetime) BETWEEN date_trunc('hour', l.datetime) - INTERVAL 1 HOUR AND date_trunc('hour', l.datetime) + INTERVAL 1 HOUR
  GROUP BY l.region),
j AS (SELECT l.region, l.datetime, l.actual, c.champion,
        CASE WHEN c.champion = 'Neural Network' THEN n.p.temperature_nn_pred ELSE n.p.temperature_xgb_pred END AS prediction
      FROM latest l LEFT JOIN near n ON l.region = n.region, champ c)
SELECT region, datetime, actual, champion, {fx('prediction')} AS prediction, {fx('abs(prediction - actual)')} AS error,
  CASE WHEN prediction IS NULL OR actual IS NULL THEN NULL WHEN abs(prediction - actual) < 0.05 THEN 'excellent'
       WHEN abs(prediction - actual) < 0.5 THEN 'good' ELSE 'needs_work' END AS error_band FROM j""")
CONTROL = """control AS (
  SELECT chunk_key, CASE WHEN chunk_key IN (SELECT chunk_key FROM done) THEN 'done'
                         WHEN chunk_key LIKE '%-02' THEN 'missing' ELSE 'planned' END AS status FROM plan)"""
SQL["fetch_control"] = _w(f"{DAILY}, {ORDERS_PLAN}, {CONTROL}", "SELECT chunk_key, status, status = 'planned' AS next FROM control")
SQL["fetch_coverage"] = _w(f"{DAILY}, {ORDERS_PLAN}, {CONTROL}", f"""SELECT n_planned, n_missing, n_done, n_total,
  {fx('(n_missing + n_done) * 100.0 / n_total')} AS pct_settled FROM (
  SELECT CAST(count_if(status = 'planned') AS BIGINT) AS n_planned, CAST(count_if(status = 'missing') AS BIGINT) AS n_missing,
         CAST(count_if(status = 'done') AS BIGINT) AS n_done, count(*) AS n_total FROM control)""")
SQL["residual_curve"] = _w(PREDICTIONS, f""", long AS (
  SELECT 'xgb' AS model, temperature_actual - temperature_xgb_pred AS r FROM preds
  UNION ALL SELECT 'nn', temperature_actual - temperature_nn_pred FROM preds),
stats AS (SELECT model, count(r) AS n, min(r) AS lo, max(r) AS hi, stddev_samp(r) * pow(count(r), -0.2) AS bw FROM long GROUP BY model),
grid AS (SELECT model, n, bw, lo - 3 * bw AS start, (hi - lo + 6 * bw) / 199 AS step FROM stats),
dealt AS (
  SELECT model, b, sum(w) AS w FROM (
    SELECT l.model, least(floor((r - start) / step), 198) + k AS b,
           CASE WHEN k = 0 THEN 1 - ((r - start) / step - least(floor((r - start) / step), 198))
                ELSE (r - start) / step - least(floor((r - start) / step), 198) END AS w
    FROM long l JOIN grid USING (model), (VALUES (0), (1)) t(k) WHERE r IS NOT NULL) GROUP BY model, b)
SELECT d.model, CAST(p AS INTEGER) AS point, {fx('any_value(start + p * step)')} AS x,
  {fx('sum(w * exp(-0.5 * pow((p - b) * step / bw, 2)) / (n * bw * sqrt(2 * pi())))')} AS density
FROM dealt d JOIN grid USING (model), (SELECT unnest(range(200)) AS p) GROUP BY d.model, p""")
SQL["request_rows_needed"] = _w(f"{HOURLY}, {REQ}", """SELECT 'recent' AS batch, region, count(*) AS n FROM hourly
  WHERE datetime >= TIMESTAMP '2024-01-21 00:00:00'
    OR (SELECT coalesce(bool_or(CAST(date AS TIMESTAMP) < TIMESTAMP '2024-01-21 00:00:00'), FALSE) FROM req WHERE date >= '2024-01-21') GROUP BY region
  UNION ALL
  SELECT 'old', region, count(*) FROM hourly WHERE datetime >= TIMESTAMP '2024-02-13 00:00:00'
    OR (SELECT bool_or(CAST(date AS TIMESTAMP) < TIMESTAMP '2024-02-13 00:00:00') FROM req) GROUP BY region""")
SQL["stream_late_rows"] = _w(PREDICTIONS, f"""SELECT strftime(datetime, '%Y-%m-%d') AS date,
  {fx('avg(abs(temperature_actual - temperature_xgb_pred))')} AS xgb_mae, {fx('avg(abs(temperature_actual - temperature_nn_pred))')} AS nn_mae,
  CAST(count_if(hour(datetime) = 7 AND datetime < TIMESTAMP '2024-01-15') AS BIGINT) AS n_late,
  {fx("avg(CASE WHEN NOT (hour(datetime) = 7 AND datetime < TIMESTAMP '2024-01-15') THEN abs(temperature_actual - temperature_xgb_pred) END)")} AS xgb_mae_in_time
FROM preds GROUP BY 1""")

GRID_SQL = """scored AS (
  SELECT value AS temperature, """ + ", ".join(
    f"avg(value) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS mean{k}"
    for k in [1, 2, 3, 6, 12, 24]) + """,
    row_number() OVER (PARTITION BY event_type ORDER BY ts) AS n FROM events),
hold AS (SELECT * FROM scored WHERE n > 24)"""
SQL["leaderboard"] = _w(f"{GRID_SQL}, " + "raw AS (" + "\nUNION ALL ".join(
    f"""SELECT 'mean{k}' AS name, avg(abs(temperature - mean{k})) AS mae,
  sqrt(avg((temperature - mean{k}) * (temperature - mean{k}))) AS rmse,
  1 - avg((temperature - mean{k}) * (temperature - mean{k})) / var_pop(temperature) AS r2 FROM hold"""
    for k in [1, 2, 3, 6, 12, 24]) + ")", f"""SELECT name, {fx('mae')} AS mae, {fx('rmse')} AS rmse, {fx('r2')} AS r2,
  CASE WHEN mae < (SELECT mae FROM raw WHERE name = 'mean1') THEN 'beats_baseline' ELSE 'none' END AS flag,
  CAST(row_number() OVER (ORDER BY mae, name) AS INTEGER) AS rank FROM raw""")
SQL["best_config"] = _w(f"{GRID_SQL}, " + "raw AS (" + "\nUNION ALL ".join(
    f"SELECT 'mean{k}' AS name, avg(abs(temperature - mean{k})) AS mae FROM hold"
    for k in [1, 2, 3, 6, 12, 24]) + ")", f"SELECT arg_min(name, (mae, name)) AS name, {fx('min(mae)')} AS mae FROM raw")
SQL["performance_summary"] = _w(PREDICTIONS + ", test AS (SELECT * FROM preds WHERE datetime >= TIMESTAMP '2024-01-15')",
    "SELECT label, MAE, RMSE, R2 FROM (" + "\nUNION ALL ".join(
        f"""SELECT '{stage} {m}' AS label, {fx(f'avg(abs(temperature_actual - {p}))')} AS MAE,
  {fx(f'sqrt(avg((temperature_actual - {p}) * (temperature_actual - {p})))')} AS RMSE,
  {fx(f'1 - avg((temperature_actual - {p}) * (temperature_actual - {p})) / var_pop(temperature_actual)')} AS R2 FROM {src}"""
        for stage, src in [("base", "preds"), ("optimized", "test")] for m, p in PRED_MODELS.items()) + ")")

# ---- streaming (the stream must equal the batch answer)
SQL["stream_latest_snapshot"] = """SELECT region, timestamp, temperature_2m FROM (
  SELECT event_type AS region, ts AS timestamp, value AS temperature_2m,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1"""
SQL["stream_upsert"] = SQL["upsert_latest_arrival"]
SQL["stream_daily_mae"] = SQL["daily_mae"]
SQL["stream_features"] = SQL["feature_table"]

SQL["single_region"] = _w(HOURLY, "SELECT * FROM hourly WHERE region = 'view'")
SQL["region_list"] = _w(DAILY, "SELECT DISTINCT region FROM daily")
SQL["anomaly_total"] = _w(ANOM, "SELECT CAST(count_if(abs(temp_zscore) > 3.0) AS BIGINT) AS n_anomalies FROM anom")
SQL["anomaly_one_region"] = _w(ANOM, "SELECT CAST(count_if(abs(temp_zscore) > 3.0) AS BIGINT) AS n_anomalies FROM anom WHERE region = 'click'")
SQL["region_year_counts"] = _w(DAILY, "SELECT region, CAST(year(datetime) AS INTEGER) AS year, count(*) AS n_rows FROM daily GROUP BY 1, 2")
SQL["actual_range"] = _w(PREDICTIONS, "SELECT min(temperature_actual) AS min_actual, max(temperature_actual) AS max_actual FROM preds")
SQL["predictions"] = _w(PREDICTIONS, f"""SELECT datetime, region, temperature_actual, temperature_xgb_pred,
  {fx('temperature_nn_pred')} AS temperature_nn_pred FROM preds""")
SQL["missing_combos"] = _w(DAILY, """SELECT g.region, g.year
FROM (SELECT n_name AS region, CAST(y AS INTEGER) AS year FROM nation, range(1995, 2002) t(y)) g
LEFT JOIN (SELECT region, CAST(year(datetime) AS INTEGER) AS year, count(*) AS n FROM daily GROUP BY 1, 2) c
  ON g.region = c.region AND g.year = c.year WHERE coalesce(c.n, 0) < 8000""")

# ---- sources / sinks round trips
SQL["csv_master_scan"] = _w(HOURLY, "SELECT datetime, region, " + ", ".join(
    (c if c in HOURLY_MEASURES else f"CAST(NULL AS DOUBLE) AS {c}") for c in S.MEASURES) + " FROM hourly")
SQL["multi_part_read"] = """SELECT l_orderkey, l_linenumber, l_quantity, CAST(NULL AS DOUBLE) AS l_discount
FROM lineitem WHERE l_linenumber <= 3
UNION ALL
SELECT l_orderkey, l_linenumber, CAST(NULL AS DOUBLE), l_discount FROM lineitem WHERE l_linenumber > 3"""
SQL["feature_table_roundtrip"] = SQL["feature_table"]
SQL["drift_roundtrip"] = SQL["daily_mae"]
SQL["kpis_roundtrip"] = _w(HOURLY, """SELECT count(*) AS total_records, max(datetime) AS last_update,
  count(DISTINCT region) AS region_count, 'Calibrated & Operational' AS model_status FROM hourly""")
