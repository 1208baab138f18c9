"""Numeric column helpers: coercion, NaN handling, narrowing, rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def nan_to_null(c: Column) -> Column:
    """pandas skips NaN in aggregates, Spark propagates it: map NaN to NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_double(c: Column) -> Column:
    """Numeric coercion with bad values -> NULL (P3): ``'abc'`` NULL, ``' 1e3 '`` 1000."""
    return nan_to_null(F.trim(c.cast("string")).try_cast("double"))


def coerce_numeric(df: DataFrame, except_: tuple[str, ...] = ("datetime", "region")) -> DataFrame:
    """Every column except ``except_`` to DOUBLE, unparseable and NaN to NULL."""
    return df.select(*[F.col(c) if c in except_ else to_double(F.col(c)).alias(c)
                       for c in df.columns])


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN -> NULL on every floating column (applied at read)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def narrow(df: DataFrame) -> DataFrame:
    """float64 -> float32 on every DOUBLE column."""
    return df.select(*[F.col(f.name).cast("float").alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def null_if_zero(c: Column) -> Column:
    """Prediction 0 or NaN -> missing (P25)."""
    return F.nullif(nan_to_null(c), F.lit(0.0))


def round_half_even(c: Column, digits: int) -> Column:
    """Python's ``round`` of a double (P23): the exact binary value decides, ties go to even.

    ``bround`` rounds the shortest decimal text instead (2.675 to 2.68, where the
    double lies below the tie).  The product with the power of ten is taken
    with its rounding error (the factor is split into halves), so the distance to the
    tie has its true sign.  For values below 2**53 / 10**digits; ``digits`` 0 to 7.
    """
    scale = F.lit(float(10 ** digits))

    def rounded(x: Column) -> Column:
        split = x * F.lit(134217729.0)
        high = split - (split - x)
        p = x * scale
        error = (high * scale - p) + (x - high) * scale
        low = F.floor(p).cast("double")
        over = (p - low - F.lit(0.5)) + error
        up = (over > 0) | ((over == 0) & (F.pmod(low, F.lit(2.0)) == 1.0))
        return (low + F.when(up, 1.0).otherwise(0.0)) / scale

    # bound as a variable, so the column's expression stands in the plan once
    return F.transform(F.array(c.cast("double")), rounded)[0]


def fixed6(c: Column) -> Column:
    """Output precision for float aggregates: ``floor(x * 1e6 + 0.499) / 1e6``.

    Written as plain arithmetic so that any engine evaluating the same
    expression on the same double gets the same bits; aggregates summed in a
    different order differ only far below this precision.  The rounding
    boundary sits at 0.501 of a micro-unit rather than 0.5: averages of
    decimal data often land exactly on a binary fraction such as k/128, which
    is an exact half-micro tie, and summation noise would split such a tie
    differently in different engines.  No such value lands on 0.501.
    """
    return (F.floor(c * F.lit(1000000.0) + F.lit(0.499)) / F.lit(1000000.0)).cast("double")


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]
