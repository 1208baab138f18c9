"""Domain frames derived from the shared test tables (region ... conversations).

The station application reads landed weather files; the test tables are a
TPC-H-like star schema plus an ``events`` stream.  These adapters give each
domain role a deterministic expression over those tables, so every query's
work grows with the tables:

* hourly station frame  <- ``events``: region = event_type, datetime = ts,
  temperature = value with every 7th event_id missing, precipitation = the
  number in ``props`` / 10, wind_speed = user_id % 40, humidity = the
  ``props`` number with every 11th event_id missing, pressure = 1000 + value / 10.
* multi-year daily frame <- ``orders`` joined to ``customer`` and ``nation``:
  region = n_name, datetime = o_orderdate, temperature = o_totalprice.
* late / repeated arrivals <- ``lineitem`` keyed by (l_orderkey, l_linenumber),
  arrival sequence (l_shipdate, l_partkey).
* predictions <- hourly frame with two naive forecasters: "xgb" = previous
  row's value, "nn" = mean of the previous six rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def props_number(props) -> F.Column:
    return F.regexp_extract(props, r"([0-9]+)", 1).try_cast("double")


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A test table as a file-source stream (schema from the batch reader)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    # a file source lists a folder; the single file is picked by a glob under it
    r = spark.readStream.schema(spark.read.parquet(path).schema).option("basePath", sf_dir)
    path = f"{sf_dir.rstrip('/')}/{name}.parque[t]"
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def landed(df: DataFrame, folder: str, parts: list) -> DataFrame:
    """The rows of a test table landed file by file, in order, as a stream with one file a trigger.

    ``parts`` are conditions; a row is in the file of each one it meets (rows that meet several arrive again)."""
    for i, part in enumerate(parts):
        df.where(part).coalesce(1).write.parquet(f"{folder}/f{i}")
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/f*")


def hourly_from_events(spark: SparkSession, sf_dir: str, with_id: bool = False,
                       events: DataFrame | None = None) -> DataFrame:
    e = table(spark, sf_dir, "events") if events is None else events
    k = props_number(F.col("props"))
    return e.select(
        *(["event_id"] if with_id else []),
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("region"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value")).alias("temperature"),
        (k / 10.0).alias("precipitation"),
        (F.col("user_id") % 40).cast("double").alias("wind_speed"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(k).alias("humidity"),
        (F.lit(1000.0) + F.col("value") / 10.0).alias("pressure"),
    )


def daily_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderdate").alias("datetime"), F.col("n_name").alias("region"),
                    F.col("o_totalprice").alias("temperature"), F.col("o_orderkey").alias("seq")))


def region_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected regions of the multi-year frame: the nation dimension."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("region"))


def arrivals_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
                     "l_quantity", "l_extendedprice", "l_discount")


def predictions_from_events(spark: SparkSession, sf_dir: str, method: str = "auto") -> DataFrame:
    from ..operators.report import naive_predictions
    e = table(spark, sf_dir, "events").select(
        F.col("ts").alias("datetime"), F.col("event_type").alias("region"),
        F.col("value").alias("temperature"))
    return naive_predictions(e, method=method)


def forecast_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly forecast per region: model = mean value in the hour, ecmwf =
    mean of the events whose ``props`` number exceeds 50 (missing when none),
    gfs = mean of the others."""
    e = table(spark, sf_dir, "events")
    k = props_number(F.col("props"))
    return (e.groupBy(F.col("event_type").alias("region"),
                      F.date_trunc("hour", F.col("ts")).alias("time"))
            .agg(F.avg("value").alias("forecast"),
                 F.avg(F.when(k > 50, F.col("value"))).alias("ecmwf"),
                 F.avg(F.when(k <= 50, F.col("value"))).alias("gfs")))


def values_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(datetime, region, temperature) with every value present (events.value)."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("datetime"), F.col("event_type").alias("region"),
        F.col("value").alias("temperature"))


def forecast_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(model forecast per region-hour, baselines ecmwf / gfs per region-hour)."""
    fc = forecast_from_events(spark, sf_dir)
    return fc.select("region", "time", "forecast"), fc.select("region", "time", "ecmwf", "gfs")


def hourly_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly API-style payloads: one JSON document per (region, block of 24
    consecutive event ids), so each payload holds at most 24 hours."""
    from .payload import hourly_payload
    rows = hourly_from_events(spark, sf_dir, with_id=True)
    return hourly_payload(rows, (F.col("event_id") / 24).cast("bigint"))


def current_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One current-observation JSON per event (humidity absent where missing)."""
    from .payload import current_payload
    h = hourly_from_events(spark, sf_dir)
    obs = h.select("region", F.col("datetime").cast("string").alias("timestamp"),
                   F.col("temperature").alias("temperature_2m"),
                   F.col("humidity").alias("relative_humidity_2m"),
                   F.col("wind_speed").alias("wind_speed_10m"),
                   F.col("pressure").alias("pressure_msl"))
    return obs.select("region", current_payload(obs).alias("payload"))


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: region = event_type (absent for every 10th user),
    date = event day + user_id % 3 days."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.when(F.col("user_id") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("region"),
        F.date_format(F.date_add(F.to_date("ts"), (F.col("user_id") % 3).cast("int")), "yyyy-MM-dd").alias("date"))


def request_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"requests": [...]}`` documents of at most 24 requests each."""
    r = request_rows(spark, sf_dir)
    return (r.groupBy((F.col("event_id") / 24).cast("bigint").alias("chunk"))
            .agg(F.sort_array(F.collect_list(F.struct("event_id", "region", "date"))).alias("_a"))
            .select("chunk", F.to_json(F.struct(F.transform(
                "_a", lambda x: F.struct(x["region"].alias("region"), x["date"].alias("date"))).alias("requests")))
                .alias("payload")))
