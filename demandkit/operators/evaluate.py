"""Regression metrics, residuals, histograms and model comparison.

Predictions live as rows ``(model, split, actual, prediction)``; every
metric is one grouped aggregate over them, so any number of models and
splits is evaluated in a single pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_denominator
from .inventory import BASELINES, baseline_prediction
from ..session import broadcast_if_small, materialize
from .ordering import row_numbers

GROUP = ["model", "split"]


def long_predictions(df: DataFrame, models: Sequence[str] = tuple(BASELINES),
                     keys: Sequence[str] = (), actual: str = "qty") -> DataFrame:
    """One row per (row, model) from baseline columns of an engineered
    frame (explode of a fixed-size array: rows x len(models))."""
    arr = F.array(*[F.struct(F.lit(m).alias("model"), baseline_prediction(m).alias("prediction"))
                    for m in models])
    return df.select(*keys, "split", F.col(actual).cast("double").alias("actual"),
                     F.explode(arr).alias("_p")).select(*keys, "split", "actual", "_p.model", "_p.prediction")


def r_squared(y: str = "actual", p: str = "prediction"):
    """Coefficient of determination over the rows that have both values. A
    constant target gives 1 for a perfect prediction, else 0."""
    err = F.col(y) - F.col(p)
    known = F.when(err.isNotNull(), F.col(y))
    residual, total = F.sum(err * err), F.var_pop(known) * F.count(known)
    return F.when(total > 0, 1 - residual / F.when(total > 0, total)).when(residual == 0, F.lit(1.0)).when(
        residual > 0, F.lit(0.0))


def metric_columns(y: str = "actual", p: str = "prediction") -> list:
    err = F.col(y) - F.col(p)
    return [
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        r_squared(y, p).alias("r2"),
        (F.avg(F.abs(err / safe_denominator(y))) * 100).alias("mape"),
    ]


def regression_metrics(pred: DataFrame, group: Sequence[str] = GROUP, rounded: bool = True) -> DataFrame:
    """MAE, RMSE, R^2, MAPE (%) per group, rounded 4/4/4/2."""
    m = pred.groupBy(*group).agg(*metric_columns(), F.count(F.lit(1)).alias("n"))
    if rounded:
        m = m.select(*group, F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
                     F.round("r2", 4).alias("r2"), F.round("mape", 2).alias("mape"), "n")
    return m


def overfit_gap(metrics: DataFrame) -> DataFrame:
    """Train R^2 - test R^2 per model with the gap class."""
    wide = metrics.groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("r2"))).alias("train_r2"),
        F.max(F.when(F.col("split") == "test", F.col("r2"))).alias("test_r2"))
    gap = F.col("train_r2") - F.col("test_r2")
    return wide.withColumn("gap", gap).withColumn(
        "status", F.when(gap < 0.05, "No overfitting").when(gap < 0.15, "Mild overfitting")
        .otherwise("Overfitting"))


def residuals(pred: DataFrame) -> DataFrame:
    return pred.withColumn("residual", F.col("actual") - F.col("prediction"))


def prediction_range(pred: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    return pred.groupBy(*group).agg(
        F.least(F.min("actual"), F.min("prediction")).alias("range_min"),
        F.greatest(F.max("actual"), F.max("prediction")).alias("range_max"))


def histogram(df: DataFrame, value_col: str, bins: int = 30, group: Sequence[str] = (),
              density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max] per group, last bin closed; empty
    bins appear with count 0 (join to the bin sequence). Output
    (group..., bin 1..n, lo, hi, count[, density])."""
    g = list(group)
    lo, hi = F.min(value_col), F.max(value_col)
    # A constant column has a range of one around its value.
    bounds = df.groupBy(*g).agg(F.when(lo < hi, lo).otherwise(lo - 0.5).alias("_lo"),
                                F.when(lo < hi, hi).otherwise(hi + 0.5).alias("_hi"),
                                F.count(value_col).alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    # One row per group. Groups are few (models, splits), so a shuffle join
    # on the group key would put a whole group in one task: the bound table
    # is checkpointed and broadcast behind the bounded-count check instead.
    if g:
        bounds = materialize(bounds)
        tagged = df.join(broadcast_if_small(bounds), g)
    else:
        tagged = df.crossJoin(F.broadcast(bounds))
    pos = F.when(F.col("_hi") > F.col("_lo"),
                 F.floor((F.col(value_col) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)
                 ).otherwise(F.lit(0))
    tagged = tagged.where(F.col(value_col).isNotNull()).withColumn(
        "bin", (F.least(pos, F.lit(bins - 1)) + 1).cast("int"))
    counts = tagged.groupBy(*g, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = bounds.select(*g, "_lo", "_hi", "_n", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = grid.join(counts, [*g, "bin"], "left").select(
        *g, "bin",
        (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
        (F.col("_lo") + F.col("bin") * width).alias("hi"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"), "_n")
    if density:
        out = out.withColumn("density", F.col("count") / (F.col("_n") * (F.col("hi") - F.col("lo"))))
    return out.drop("_n")


def bin_midpoints(hist: DataFrame) -> DataFrame:
    return hist.withColumn("midpoint", F.round((F.col("lo") + F.col("hi")) / 2, 1))


def best_model(metrics: DataFrame, split: str = "test", by: str = "r2") -> DataFrame:
    """The model with the highest ``by`` on ``split``."""
    m = metrics.where(F.col("split") == split)
    top = F.min_by("model", F.struct(-F.col(by), F.col("model")))  # of equal ones the first name
    return m.agg(top.alias("best_model"), F.max(by).alias(by))


def model_comparison(metrics: DataFrame, split: str = "test") -> DataFrame:
    return metrics.where(F.col("split") == split).select("model", "mae", "rmse", "r2", "mape")


def cv_summary(fold_metrics: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population std of per-fold MAE and R^2, plus the fold list."""
    return fold_metrics.groupBy(*group).agg(
        F.round(F.avg("mae"), 4).alias("mae_mean"), F.round(F.stddev_pop("mae"), 4).alias("mae_std"),
        F.round(F.avg("r2"), 4).alias("r2_mean"), F.round(F.stddev_pop("r2"), 4).alias("r2_std"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "mae", "r2"))),
                    lambda s: F.round(s["mae"], 4)).alias("mae_folds"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "mae", "r2"))),
                    lambda s: F.round(s["r2"], 4)).alias("r2_folds"))


def best_error(wide: DataFrame, models: Sequence[str], actual: str = "actual") -> DataFrame:
    """Least absolute error across model columns, per row."""
    least = F.least(*[F.abs(F.col(actual) - F.col(m)) for m in models])
    # Rounded on decimals: a half goes the same way in any engine.
    return wide.withColumn("best_err", F.round(least.cast("decimal(38,6)"), 1).cast("double"))


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 200, seed: int = 42) -> DataFrame:
    """Seeded sample of ``n`` rows without replacement: the ``n`` smallest
    md5 hashes of (keys, seed); a top-k, so the plan is a
    TakeOrderedAndProject with ``n`` rows per task."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")


def row_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return row_numbers(df, keys, "row_idx")


def rank_within(df: DataFrame, group: str, order_col: str, name_col: str, out: str = "rank") -> DataFrame:
    """Rank rows of small per-model tables (importances, coefficients);
    equal values rank by name."""
    return df.withColumn(out, F.row_number().over(
        Window.partitionBy(group).orderBy(F.desc(order_col), F.col(name_col))))
