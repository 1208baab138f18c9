"""Feature table: fills, lags, rolling statistics, calendar fields.

Two implementations with identical rows:

* ``method="window"``: one ``Window.partitionBy(region).orderBy(datetime)``
  spec shared by fills, lags and rolling frames -> one exchange, one sort.
  Parallelism is the number of regions.
* ``method="halo"`` (default): the same windows per (region, time bucket)
  with a 24-row halo (see ``halo.py``).  Parallelism is the number of buckets,
  so a region holding a third of all rows is split over its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.calendar import calendar_fields
from . import halo as H


def region_window(key: str = "region", order: str = "datetime", tie: tuple[str, ...] = ()) -> Window:
    return Window.partitionBy(key).orderBy(F.col(order), *[F.col(t) for t in tie])


def ffill(df: DataFrame, cols: list[str], key: str = "region", order: str = "datetime",
          method: str = "auto") -> DataFrame:
    """Forward fill within each region by time."""
    return H.windowed(df, None, 0, key, order, method, fill=cols, fill_mode="forward")


def reverse_running(key: str = "region", order: str = "datetime") -> Window:
    """Running frame over *descending* time.

    ``first(ignorenulls)`` over ``currentRow..unboundedFollowing`` is
    re-evaluated for every row (quadratic in the partition); the same value
    is ``last(ignorenulls)`` over a running frame in reverse order, which is
    linear.  Same partitioning, so it costs one more sort, no exchange.
    """
    return (Window.partitionBy(key).orderBy(F.col(order).desc())
            .rowsBetween(Window.unboundedPreceding, 0))


def bfill(df: DataFrame, cols: list[str], key: str = "region", order: str = "datetime",
          method: str = "auto") -> DataFrame:
    """Back fill within each region by time."""
    return H.windowed(df, None, 0, key, order, method, fill=cols, fill_mode="backward")


def fill(df: DataFrame, cols: list[str], key: str = "region", order: str = "datetime",
         method: str = "auto") -> DataFrame:
    """Forward fill then back fill (the order the pipeline applies them)."""
    return H.windowed(df, None, 0, key, order, method, fill=cols, fill_mode="both")


def lag_columns(w: Window, cols: list[str], lags: list[int]) -> dict[str, Column]:
    """``{c}_lag{n}``: value ``n`` rows back in the region."""
    return {f"{c}_lag{n}": F.lag(c, n).over(w) for c in cols for n in lags}


def rolling_columns(w: Window, spec=S.ROLLING) -> dict[str, Column]:
    """Rolling mean / sum over the current and ``n-1`` preceding rows.

    NULLs are skipped and an all-NULL frame gives NULL, as ``min_periods=1``.
    """
    out = {}
    for name, col, n, agg in spec:
        frame = w.rowsBetween(-(n - 1), 0)
        out[name] = (F.avg(col) if agg == "mean" else F.sum(col)).over(frame)
    return out


def lags(df: DataFrame, cols: list[str], ns: list[int], key: str = "region",
         order: str = "datetime", method: str = "auto") -> DataFrame:
    """W1 in the plain or bucketed form (``halo.windowed``)."""
    return H.windowed(df, lambda w, _: lag_columns(w, cols, ns), max(ns), key, order, method)


def rolling(df: DataFrame, spec=S.ROLLING, key: str = "region", order: str = "datetime",
            method: str = "auto") -> DataFrame:
    """W2, W3 in the plain or bucketed form; ``spec`` rows are (name, column, n, mean|sum)."""
    reach = max(n for _, _, n, _ in spec) - 1
    return H.windowed(df, lambda w, _: rolling_columns(w, spec), reach, key, order, method)


def _finish(df: DataFrame, drop_any: bool) -> DataFrame:
    df = calendar_fields(df)
    return df.na.drop("any") if drop_any else df


# Rows one window task may take before the bucketed form is used.
MAX_ROWS_PER_KEY_TASK = 2_000_000


def feature_table(hourly: DataFrame, method: str = "auto", unit: str = "day",
                  measures: list[str] | None = None, drop_any: bool = True,
                  max_rows_per_task: int = MAX_ROWS_PER_KEY_TASK,
                  target_rows: int | None = None) -> DataFrame:
    """Canonical hourly frame -> ML feature table.

    Fills every measure within its region (forward, then back), adds the 15
    lags and four rolling columns, calendar fields and season class, and drops
    rows with any missing value (the first 24 rows of each region).

    ``method``: "window" (one exchange by region), "halo" (per region and
    time bucket, see ``halo.py``) or "auto": one small aggregate measures the
    largest region; up to ``max_rows_per_task`` rows the plain window is used,
    beyond it the bucketed form.
    """
    measures = measures or [c for c in hourly.columns if c not in ("datetime", "region")]
    max_reach = max(max(S.LAGS), max(n for _, _, n, _ in S.ROLLING))
    df = H.windowed(hourly, lambda w, _: {**lag_columns(w, S.LAG_COLUMNS, S.LAGS), **rolling_columns(w)},
                    max_reach, "region", "datetime", method, unit, fill=measures,
                    max_rows_per_task=max_rows_per_task, target_rows=target_rows)
    return _finish(df, drop_any)


def engineered_columns(df: DataFrame) -> list[str]:
    """Engineered-column report by substring match on the schema."""
    marks = ["_lag", "roll", "season_class", "hour", "day_of_year", "month"]
    return [c for c in df.columns if any(m in c for m in marks)]


def feature_columns(df: DataFrame, target: str = "temperature",
                    exclude: tuple[str, ...] = ("datetime", "region", "season_class")) -> list[str]:
    """Feature set by exclusion list (P5); the exclusion list is an argument."""
    return [c for c in df.columns if c != target and c not in exclude]
