"""Spark session defaults and the shared checkpoint folder.

The library never creates a session behind the caller's back: jobs take a
``SparkSession``. ``get_spark`` is a convenience for tests, the bench and the
driver contract; on a cluster the submitting tool owns the configuration and
only the settings that are unset are filled in here.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (all timestamps are
# TIMESTAMP_NTZ, but date functions still consult the session zone), AQE for
# runtime re-planning (coalescing, skew-join splitting, broadcast conversion
# after the size of a shuffle is known), Arrow for the few pandas paths.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "stationlab",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and must be shared
    storage; it is only filled from ``fallback`` where it is unset (tests,
    local runs).  Raises when neither is present rather than guessing a
    machine-local path.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        os.makedirs(fallback, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", fallback)
        spark.sparkContext.setCheckpointDir(fallback)
        d = fallback
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def existing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None before its first write; any other read failure is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def materialize(df):
    """Compute a small intermediate once and cut its lineage.

    Uses a reliable ``checkpoint`` into the shared ``spark.checkpoint.dir``
    (survives executor loss); when no folder is configured the frame is
    cached instead.  Meant for bounded tables (bucket indexes, statistics),
    not for fact data.
    """
    spark = df.sparkSession
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        df = df.persist()   # checkpoint writes what the job computed, not a recomputation
        out = df.checkpoint(eager=True)
        df.unpersist()
        return out
    out = df.cache()
    out.count()
    return out


# A join side gets a broadcast hint only when its measured row count is at
# most this (about 20 MB for the narrow tables it is used on).
BROADCAST_MAX_ROWS = 250_000


def small_side(df, max_rows: int = BROADCAST_MAX_ROWS):
    """A join side broadcast behind a measured size.

    The side (a per-key aggregate: one row per region, per region-day, per
    touched region) is materialized, so it is computed once, and its rows
    are counted.  Up to ``max_rows`` it is hinted for broadcast, so the large
    side is joined where it lies, without a shuffle; beyond that it stays a
    shuffle join, where AQE measures and splits skewed keys.
    """
    from pyspark.sql import functions as F
    d = materialize(df)
    return F.broadcast(d) if d.count() <= max_rows else d
