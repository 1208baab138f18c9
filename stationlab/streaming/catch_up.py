"""High-water-mark catch-up (R4, with A6, C2, P26, M11, S10).

One call drains what has landed (availableNow), refreshes the master and the
feature table incrementally, then evaluates every day up to yesterday that the drift
table does not have (an anti join of the calendar with it) and appends one
drift row per day.  A crash at any point is repaired by calling again: the
stream resumes from its checkpoint, days whose rows were written are not
fitted again, and days left out before (``every``) take their turn.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..models import training as TR
from ..operators import features as FE
from ..plans.fetch_plan import day_plan
from ..session import existing
from ..sources import sinks as SK
from . import jobs as SJ

DEFAULT_LAST = "2024-12-31"


def pending_days(spark: SparkSession, drift_path: str, today: str, default: str = DEFAULT_LAST) -> list[str]:
    """Days up to yesterday that have no drift row (C2, A6): after the table's first day, or after
    ``default`` where there is none yet; empty when caught up.  The list is calendar-sized (one entry
    per missed day), not data-sized."""
    drift = None if existing(spark, drift_path) is None else SK.read_drift(spark, drift_path).select("date")
    after = (drift.agg(F.min("date")).first()[0] if drift is not None else None) or default
    plan = spark.range(1).select(F.explode(day_plan(after, today)).alias("d")).select(F.col("d").cast("string").alias("date"))
    if drift is not None:
        plan = plan.join(drift, "date", "left_anti")
    return sorted(r.date for r in plan.collect())


def catch_up(spark: SparkSession, landing: str, schema: T.StructType, root: str, today: str,
             drift_path: str, gbt_params: dict | None = None, hidden=(150,), mlp_iter: int = 500,
             every: int = 1, fmt: str = "parquet", default_last: str = DEFAULT_LAST,
             as_of: str | None = None) -> list[str]:
    """Run one catch-up; returns the days evaluated.

    ``as_of``: rows after it (forecast hours a provider returns with the
    observations) are not stored (D5).  Without ``gbt_params`` the tuned parameters
    of ``root``/params are used (S9), if there are any; the latest day's models are
    kept in ``root``/models, for scoring from disk.  With ``every=n`` each n-th of the
    pending days is evaluated now, the others by later calls.
    """
    rows = spark.readStream.schema(schema).format(fmt).load(landing)
    if as_of is not None:
        rows = rows.where(F.col("datetime") <= F.lit(as_of).cast("timestamp_ntz"))
    SJ.run_features(rows, f"{root}/master", f"{root}/features", f"{root}/_checkpoint").awaitTermination()
    days = pending_days(spark, drift_path, today, default_last)
    if not days:
        return []
    feats = SJ.read_features(spark, f"{root}/features")
    cols = FE.feature_columns(feats)
    done = []

    def sink(rows):
        SK.append_drift(rows, drift_path)
        done.extend(r.date for r in rows.collect())         # one row a day
    params = SK.read_params(spark, f"{root}/params") if gbt_params is None else gbt_params
    TR.backtest(feats, days, cols, params, hidden, mlp_iter, every, sink=sink, save_to=f"{root}/models")
    return done
