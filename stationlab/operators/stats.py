"""Statistics: correlation, per-region z-scores, model metrics, distributions.

(A3, A5, P16, J7, A8, A9, A16, A17, A19, A20, P24)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form (col_a, col_b, corr) (A3).

    One aggregate pass computes all pairs; pairs with a NULL on either side
    are skipped pairwise, as pandas does.
    """
    upper = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]     # corr is symmetric
    agg = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in upper])
    cell = {}
    for a, b in upper:
        cell[(a, b)] = cell[(b, a)] = f"`{a}__{b}`"
    body = ", ".join(f"'{a}', '{b}', {cell[(a, b)]}" for a in cols for b in cols)
    return agg.selectExpr(f"stack({len(cols) ** 2}, {body}) AS (col_a, col_b, corr)")


def region_stats(df: DataFrame, col: str = "temperature", key: str = "region") -> DataFrame:
    """Mean and sample standard deviation per region (A5); one row -> NULL std."""
    return df.groupBy(key).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))


def anomalies(df: DataFrame, col: str = "temperature", k: float = 3.0, key: str = "region") -> DataFrame:
    """z-score per region and ``abs(z) > k`` flag, strict.

    Region statistics are an aggregate joined back on the key (no unbounded
    window frame, no sort).  The statistics side has one row per region; it
    is broadcast once its row count is measured (``small_side``), so the
    rows are flagged where they lie, with no shuffle of the data.  A zero or
    undefined std gives z NULL and flag false instead of an ANSI error; so does
    a NULL region, whose rows stay.
    """
    st = small_side(region_stats(df, col, key))
    z = F.try_divide(F.col(col) - F.col("mean"), F.nullif(F.col("std"), F.lit(0.0)))
    return (df.join(st, key, "left")
            .withColumn("temp_zscore", z)
            .withColumn("is_anomaly", F.coalesce(F.abs(F.col("temp_zscore")) > k, F.lit(False)))
            .drop("mean", "std"))


def anomaly_counts(flagged: DataFrame, key: str | None = "region") -> DataFrame:
    """Anomaly count overall (``key=None``) or per region."""
    agg = F.count_if(F.col("is_anomaly")).alias("n_anomalies")
    return flagged.agg(agg) if key is None else flagged.groupBy(key).agg(agg)


def residuals(df: DataFrame, actual: str, pred: str, name: str = "residual") -> DataFrame:
    """``actual - predicted`` and its absolute value."""
    e = F.col(actual) - F.col(pred)
    return df.withColumns({name: e, f"abs_{name}": F.abs(e)})


def regression_metrics(df: DataFrame, actual: str, preds: dict[str, str]) -> DataFrame:
    """MAE, RMSE, R^2 per model in long form (model, mae, rmse, r2).

    One pass over the rows for all models: sums of |e|, e^2 and the moments
    of the actual value.  R^2 = 1 - SSE / SST with SST = n * var_pop(actual),
    both over the rows that have the model's prediction.
    """
    y = F.col(actual)
    aggs = []
    for m, p in preds.items():
        e = y - F.col(p)
        aggs += [F.avg(F.abs(e)).alias(f"{m}__mae"), F.avg(e * e).alias(f"{m}__mse"),
                 F.var_pop(F.when(F.col(p).isNotNull(), y)).alias(f"{m}__var")]
    a = df.agg(*aggs)
    body = ", ".join(
        f"'{m}', `{m}__mae`, sqrt(`{m}__mse`), 1 - try_divide(`{m}__mse`, `{m}__var`)" for m in preds)
    return a.selectExpr(f"stack({len(preds)}, {body}) AS (model, mae, rmse, r2)")


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Share of rows with ``y = yhat``."""
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"))


def bucket(c: Column, lo: float, width: float) -> Column:
    """Histogram bin ``floor((x - lo) / width)``."""
    return F.floor((c - F.lit(lo)) / F.lit(width))


def residual_histogram(df: DataFrame, actual: str, preds: dict[str, str],
                       lo: float = 0.0, width: float = 5.0) -> DataFrame:
    """Residual distribution per model as fixed-width bins (A16; re-aims the KDE plot)."""
    parts = ", ".join(f"'{m}', `{actual}` - `{p}`" for m, p in preds.items())
    long = df.selectExpr(f"stack({len(preds)}, {parts}) AS (model, residual)")
    return (long.where(F.col("residual").isNotNull())
            .groupBy("model", bucket(F.col("residual"), lo, width).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


GRID_POINTS = 200               # of a density curve
CUT = 3                         # bandwidths beyond the extremes


def residual_curve(df: DataFrame, actual: str, preds: dict[str, str], points: int = GRID_POINTS) -> DataFrame:
    """Density curve of each model's residuals (A16): (model, point, x, density).

    Gaussian kernel with Scott's bandwidth n^(-1/5) s, on ``points`` places from ``CUT`` bandwidths below the
    least residual to as many above the greatest.  Residuals are dealt linearly to their two neighbouring
    places in one aggregate; the kernel then runs over at most ``points`` weights per model.  A model
    without residuals, or whose residuals are all equal, has no curve.
    """
    parts = ", ".join(f"'{m}', `{actual}` - `{p}`" for m, p in preds.items())
    long = df.selectExpr(f"stack({len(preds)}, {parts}) AS (model, residual)").where("residual IS NOT NULL")
    stats = (long.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("residual").alias("s"), F.min("residual").alias("lo"),
                                       F.max("residual").alias("hi")).where("s > 0")
             .withColumn("bw", F.col("s") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
             .withColumn("start", F.col("lo") - CUT * F.col("bw"))
             .withColumn("step", (F.col("hi") - F.col("lo") + 2 * CUT * F.col("bw")) / (points - 1))
             .select("model", "n", "bw", "start", "step"))
    stats = small_side(stats)                               # one row a model
    place = (F.col("residual") - F.col("start")) / F.col("step")
    left = F.least(F.floor(place), F.lit(points - 2))
    dealt = (long.join(stats, "model").select("model", left.cast("int").alias("b"), (place - left).alias("f"))
             .groupBy("model", "b").agg(F.count(F.lit(1)).alias("c"), F.sum("f").alias("f")))
    weights = (dealt.select("model", F.inline(F.array(F.struct(F.col("b"), (F.col("c") - F.col("f")).alias("w")),
                                                      F.struct((F.col("b") + 1).alias("b"), F.col("f").alias("w")))))
               .groupBy("model", "b").agg(F.sum("w").alias("w")))
    z = (F.col("point") - F.col("b")) * F.col("step") / F.col("bw")
    kernel = F.exp(-z * z / 2) / (F.col("n") * F.col("bw") * F.sqrt(2 * F.pi()))
    return (weights.join(stats, "model").withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .groupBy("model", "point").agg(F.first(F.col("start") + F.col("point") * F.col("step")).alias("x"),
                                           F.sum(F.col("w") * kernel).alias("density")))


def pred_density(df: DataFrame, actual: str, pred: str, lo: float = 0.0,
                 width: float = 10.0) -> DataFrame:
    """Actual-vs-predicted 2-D density as (bin_actual, bin_pred, n)."""
    return (df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
            .groupBy(bucket(F.col(actual), lo, width).alias("bin_actual"),
                     bucket(F.col(pred), lo, width).alias("bin_pred"))
            .agg(F.count(F.lit(1)).alias("n")))


def actual_range(df: DataFrame, actual: str) -> DataFrame:
    """min / max of the actual value (the axes of A17)."""
    return df.agg(F.min(actual).alias("min_actual"), F.max(actual).alias("max_actual"))


def daily_mae(preds: DataFrame, actual: str = "temperature_actual",
              models: dict[str, str] | None = None) -> DataFrame:
    """Per-day MAE of each model -> (date, xgb_mae, nn_mae)."""
    models = models or {"xgb": "temperature_xgb_pred", "nn": "temperature_nn_pred"}
    return (preds.groupBy(F.date_format(F.col("datetime"), "yyyy-MM-dd").alias("date"))
            .agg(*[F.avg(F.abs(F.col(actual) - F.col(p))).alias(f"{m}_mae") for m, p in models.items()]))
