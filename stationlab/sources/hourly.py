"""Readers for the station tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.numeric import coerce_numeric, nan_to_null_all
from ..operators.clean import union_all


def read_hourly(spark: SparkSession, path: str, fmt: str = "parquet",
                columns: list[str] | None = None, schema: T.StructType = S.HOURLY) -> DataFrame:
    """Master hourly table (S1); ``columns`` keeps only those (S2, pruned at the scan).

    CSV is read with the explicit schema (no inference pass), the datetime
    as text parsed by ``try_cast`` (ISO with ``T`` or space, date only,
    fractions: the mixed forms of the source files; bad -> NULL); NaN -> NULL.
    """
    if fmt == "csv":
        text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "datetime" else f
                             for f in schema.fields])
        df = spark.read.schema(text).option("header", True).csv(path)
        df = df.withColumn("datetime", F.col("datetime").try_cast("timestamp_ntz"))
    else:
        df = spark.read.format(fmt).load(path)
    if columns:
        df = df.select(*columns)
    return nan_to_null_all(df)


def schema_of(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType:
    """Header-only schema scan (S3): reads file footers / the header line only."""
    if fmt == "csv":
        return spark.read.option("header", True).csv(path).schema
    return spark.read.format(fmt).load(path).schema


def read_parts(spark: SparkSession, pattern: str, fmt: str = "parquet", schema: T.StructType = S.HOURLY) -> DataFrame:
    """Multi-part table ``stem_pt*`` read as one.

    Parquet parts are one scan with schema merging.  CSV parts (each with a header, columns in any
    order) are listed by Spark, typed by ``schema`` (a column it does not name is text) and unioned
    by name, a missing column -> NULL; bad numbers and times -> NULL.
    """
    if fmt == "parquet":
        return spark.read.option("mergeSchema", "true").parquet(pattern)
    files = spark.read.format("binaryFile").load(pattern).select("path").orderBy("path").collect()    # one row a part
    types = {f.name: f.dataType for f in schema.fields}
    parts = []
    for f in files:
        names = spark.read.option("header", True).csv(f.path).columns
        text = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).option("header", True).csv(f.path)
        parts.append(text.select(*[F.col(f"`{c}`").try_cast(types.get(c, T.StringType())).alias(c) for c in names]))
    if not parts:
        return spark.createDataFrame([], schema)
    return nan_to_null_all(union_all(parts))


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Feature table with a mixed-format datetime parsed to TIMESTAMP_NTZ (S5); of CSV, every column but
    the datetime and the region is a number (P3: bad -> NULL)."""
    if fmt == "csv":
        df = coerce_numeric(spark.read.option("header", True).csv(path), ["datetime", "region"])
    else:
        df = spark.read.format(fmt).load(path)
    if not isinstance(df.schema["datetime"].dataType, T.TimestampNTZType):
        df = df.withColumn("datetime", F.col("datetime").cast("string").try_cast("timestamp_ntz"))
    return df


def for_requests(df: DataFrame, requests: DataFrame, as_of, days: int = 30, ts: str = "datetime") -> DataFrame:
    """The rows a batch of requests needs (S20): the recent tail when every requested date lies within ``days``
    days before ``as_of`` or later, else all rows; so, too, when a date does not parse.

    One number of the requests decides; the tail is a range predicate (see ``recent``)."""
    hi = F.lit(as_of).cast("timestamp_ntz")
    asked = F.col("date").cast("string").try_cast("timestamp_ntz")
    old = asked.isNull() | (asked < hi - F.expr(f"INTERVAL {int(days)} DAYS"))
    if requests.agg(F.max(old.cast("int"))).first()[0] == 1:
        return df
    return df.where(F.col(ts) >= hi - F.expr(f"INTERVAL {int(days)} DAYS"))


def recent(df: DataFrame, as_of, days: int = 30, ts: str = "datetime") -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``, itself excluded.

    A plain range predicate: on a table partitioned by year it prunes
    partitions, and row-group statistics skip the rest at the scan.
    """
    hi = F.lit(as_of).cast("timestamp_ntz")
    return df.where((F.col(ts) >= hi - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(ts) < hi))
