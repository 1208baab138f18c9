"""Cleaning: canonical names, missing-value reports, row drops, union, upsert.

(P1, P11, P12, A1, A2, U1, W5)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S


def canonicalise(df: DataFrame, mapping: dict[str, str] = S.RAW_TO_CANONICAL) -> DataFrame:
    """Raw API names -> canonical names (P1), applied before any union.

    When a frame carries both spellings of a measure the canonical one wins
    and the raw one fills its gaps.
    """
    cols = set(df.columns)
    out = []
    done = set()
    for c in df.columns:
        if c in mapping:
            target = mapping[c]
            if target in done:
                continue
            if target in cols and target != c:
                out.append(F.coalesce(F.col(target), F.col(c)).alias(target))
            else:
                out.append(F.col(c).alias(target))
            done.add(target)
        elif c in mapping.values():
            if c in done:
                continue
            raw = [r for r, t in mapping.items() if t == c and r in cols and r != c]
            out.append(F.coalesce(F.col(c), *[F.col(r) for r in raw]).alias(c) if raw else F.col(c))
            done.add(c)
        else:
            out.append(F.col(c))
    return df.select(*out)


def for_region(df: DataFrame, region: str) -> DataFrame:
    """Single-region filter (P13); pushed to the scan / partition filter."""
    return df.where(F.col("region") == region)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one input is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def drop_any(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with any missing value."""
    return df.na.drop("any", subset=subset)


def drop_all_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows whose measures are all missing."""
    return df.na.drop("all", subset=subset)


def all_null_count(df: DataFrame, subset: list[str]) -> DataFrame:
    """How many rows ``drop_all_null`` removes (the P12 report)."""
    cond = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in subset])
    return df.agg(F.count_if(cond).alias("n_dropped"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing count per column in long form (column, n_missing) (A1).

    One pass: a single aggregate over all columns, then ``stack``.
    """
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, n_missing)")


def null_total(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Total missing cells (A1, total)."""
    cols = cols or df.columns
    return df.agg(reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in cols])
                  .alias("n_missing"))


def null_pct(df: DataFrame, threshold: float = 5.0, cols: list[str] | None = None) -> DataFrame:
    """Columns whose missing share exceeds ``threshold`` percent, strict (A2)."""
    cols = cols or df.columns
    agg = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, pct_missing)")
            .where(F.col("pct_missing") > threshold))


def dedupe_latest(df: DataFrame, key: list[str], seq: list[str]) -> DataFrame:
    """One row per key: the one with the highest arrival sequence.

    ``row_number() = 1`` over (key, seq desc): Spark plans a *partial*
    ``WindowGroupLimit`` before the shuffle, so each task keeps one row per
    key and a key repeated a billion times moves at most one row per task.
    Measured faster than ``max_by(struct(row), struct(seq))``, which is a
    sort-based aggregate with the same map-side reduction.
    """
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in seq])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert(master: DataFrame, new: DataFrame, key: list[str] = ("datetime", "region"),
           seq: str | None = None) -> DataFrame:
    """Append ``new`` to ``master``; on equal key the later arrival wins.

    Arrival order is explicit: ``seq`` if given (ties broken by source,
    ``new`` after ``master``), else the source alone.
    """
    key = list(key)
    m = master.withColumn("_src", F.lit(0))
    n = new.withColumn("_src", F.lit(1))
    both = union_all([m, n])
    order = ([seq] if seq else []) + ["_src"]
    return dedupe_latest(both, key, order).drop("_src")
