"""Schemas, canonical column names and the region dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source application's for the same results)
# ---------------------------------------------------------------------------
# Region dimension: name, latitude, longitude.
REGIONS = [
    ("London", 51.5085, -0.1257),
    ("Manchester", 53.4809, -2.2374),
    ("Birmingham", 52.4814, -1.8998),
    ("Leeds", 53.7964, -1.5478),
    ("Glasgow", 55.8651, -4.2576),
    ("Southampton", 50.9039, -1.4042),
    ("Liverpool", 53.4105, -2.9779),
    ("Newcastle", 54.9732, -1.6139),
    ("Sheffield", 53.3829, -1.4659),
    ("Middlesbrough", 54.5762, -1.2348),
]
DEFAULT_REGION = "London"
# Raw API variable name -> canonical column name (hourly payloads).
RAW_TO_CANONICAL = {
    "temperature_2m": "temperature",
    "apparent_temperature": "feels_like",
    "precipitation": "precipitation",
    "rain": "rain",
    "snowfall": "snowfall",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_direction",
    "relative_humidity_2m": "humidity",
    "dew_point_2m": "dew_point",
    "pressure_msl": "pressure",
    "cloud_cover": "cloud_cover",
}
# Split years, completeness threshold, default tuned parameters.
TRAIN_END_YEAR = 2019
TEST_START_YEAR = 2020
MIN_ROWS_PER_REGION_YEAR = 8000
DEFAULT_GBT_PARAMS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1}
# fixed values: the search grid and the configurations of the leaderboard
TUNE_GRID = {"n_estimators": [100, 200], "max_depth": [8, 10, 12], "learning_rate": [0.05, 0.1]}
TREE_CONFIGS = [
    {"name": "XGB-A", "params": {"n_estimators": 200, "max_depth": 10, "learning_rate": 0.1}},
    {"name": "XGB-B", "params": {"n_estimators": 300, "max_depth": 12, "learning_rate": 0.05}},
    {"name": "XGB-C", "params": {"n_estimators": 500, "max_depth": 10, "learning_rate": 0.05}},
    {"name": "XGB-D", "params": {"n_estimators": 300, "max_depth": 8, "learning_rate": 0.1, "subsample": 0.8,
                                 "colsample_bytree": 0.8}},
    {"name": "XGB-E", "params": {"n_estimators": 500, "max_depth": 12, "learning_rate": 0.03, "subsample": 0.9,
                                 "colsample_bytree": 0.9}},
    {"name": "XGB-F", "params": {"n_estimators": 400, "max_depth": 14, "learning_rate": 0.05, "min_child_weight": 3}},
    {"name": "XGB-G", "params": {"n_estimators": 600, "max_depth": 10, "learning_rate": 0.05, "subsample": 0.85,
                                 "reg_alpha": 0.1, "reg_lambda": 1.0}},
]
NETWORK_CONFIGS = [
    {"name": name, "hidden": hidden, "alpha": alpha, "lr": lr, "iter": epochs}
    for name, hidden, alpha, lr, epochs in (
        ("NN-01 (current)", (150,), 1e-3, 1e-3, 500), ("NN-02 (proven)", (128, 64, 32), 1e-3, 1e-3, 500),
        ("NN-03 wide", (256,), 1e-4, 1e-3, 500), ("NN-04 pyramid", (256, 128, 64), 1e-4, 1e-3, 500),
        ("NN-05 deep", (256, 128, 64, 32), 1e-4, 1e-3, 600), ("NN-06 very-deep", (512, 256, 128, 64), 1e-4, 5e-4, 600),
        ("NN-07 wide2", (512, 256), 1e-4, 1e-3, 500), ("NN-08 wide3", (256, 256), 1e-4, 1e-3, 500),
        ("NN-09 lo-reg", (256, 128, 64), 1e-5, 1e-3, 600), ("NN-10 hi-reg", (256, 128, 64), 1e-2, 1e-3, 500),
        ("NN-11 fast-lr", (256, 128, 64), 1e-4, 5e-3, 400), ("NN-12 slow-lr", (256, 128, 64), 1e-4, 5e-4, 800),
        ("NN-13 compact", (128, 64), 1e-4, 1e-3, 500), ("NN-14 mid", (200, 100, 50), 1e-4, 1e-3, 500),
        ("NN-15 beast", (512, 256, 128), 5e-5, 1e-3, 700))
]
# Lag columns, lag distances and rolling windows of the feature table.
LAG_COLUMNS = ["temperature", "precipitation", "wind_speed", "humidity", "pressure"]
LAGS = [1, 6, 24]
ROLLING = [  # (output, source column, rows, aggregate)
    ("temp_roll6", "temperature", 6, "mean"),
    ("temp_roll24", "temperature", 24, "mean"),
    ("wind_roll6", "wind_speed", 6, "mean"),
    ("precip_roll24", "precipitation", 24, "sum"),
]
CALENDAR_COLUMNS = ["hour", "day_of_year", "month", "season_class"]
# ---------------------------------------------------------------------------

MEASURES = list(RAW_TO_CANONICAL.values())

HOURLY = T.StructType(
    [T.StructField("datetime", T.TimestampNTZType()), T.StructField("region", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in MEASURES]
)

RAW_HOURLY = T.StructType(
    [T.StructField("datetime", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in RAW_TO_CANONICAL]
    + [T.StructField("region", T.StringType())]
)

PREDICTIONS = T.StructType([
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("region", T.StringType()),
    T.StructField("temperature_actual", T.DoubleType()),
    T.StructField("temperature_nn_pred", T.DoubleType()),
    T.StructField("temperature_xgb_pred", T.DoubleType()),
])

DRIFT = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("xgb_mae", T.DoubleType()),
    T.StructField("nn_mae", T.DoubleType()),
])

METRICS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
])

OBSERVATION = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("relative_humidity_2m", T.DoubleType()),
    T.StructField("wind_speed_10m", T.DoubleType()),
    T.StructField("pressure_msl", T.DoubleType()),
])

REQUEST = T.StructType([
    T.StructField("requests", T.ArrayType(T.StructType([
        T.StructField("region", T.StringType()),
        T.StructField("date", T.StringType()),
    ]))),
])

FORECAST = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("ecmwf", T.DoubleType()),
    T.StructField("gfs", T.DoubleType()),
])

REGION_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])


def regions(spark: SparkSession) -> DataFrame:
    """The 10-row region dimension (S18). Fixed size, so safe to broadcast."""
    return spark.createDataFrame(REGIONS, REGION_SCHEMA)


def feature_output_columns() -> list[str]:
    lags = [f"{c}_lag{n}" for c in LAG_COLUMNS for n in LAGS]
    return lags + [r[0] for r in ROLLING] + CALENDAR_COLUMNS
