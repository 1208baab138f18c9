"""Calendar and date column expressions (P7, P8, P26, strftime helpers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def season_class(month: Column) -> Column:
    """``month % 12 // 3``: Dec-Feb 0, Mar-May 1, Jun-Aug 2, Sep-Nov 3."""
    return ((month % 12) / 3).cast("int")


def calendar_fields(df: DataFrame, ts: str = "datetime", season: bool = True) -> DataFrame:
    """hour, day_of_year, month (P7) and, unless disabled, season_class."""
    cols = {
        "hour": F.hour(ts).cast("int"),
        "day_of_year": F.dayofyear(ts).cast("int"),
        "month": F.month(ts).cast("int"),
    }
    df = df.withColumns(cols)
    if season:
        df = df.withColumn("season_class", season_class(F.col("month")))
    return df


def lookback_days(last_date: Column, now: Column, lo: int = 1, hi: int = 90) -> Column:
    """Days to re-read for late data: ``clamp(datediff(now, last) + 2, lo, hi)``."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.datediff(now, last_date) + 2))


def parse_mixed_datetime(c: Column) -> Column:
    """Mixed ISO forms (``T`` or space separator, date only) to TIMESTAMP_NTZ; bad -> NULL."""
    return c.try_cast("timestamp_ntz")


def month_key(region: Column, month_start: Column) -> Column:
    """Chunk key ``Region_YYYY-MM`` of the month plan."""
    return F.concat_ws("_", region, F.date_format(month_start, "yyyy-MM"))
