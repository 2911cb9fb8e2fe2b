"""Profiling and validation: each check is one wide aggregate pass,
unpivoted with ``stack`` into (column, value) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import parse_percent
from .ordering import exact_quantiles_grouped

NUMERIC_TYPES = ("int", "bigint", "double", "float", "smallint", "tinyint")


def _stack(row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """Unpivot a one-row frame whose columns are ``names``."""
    return row.unpivot([], list(names), label, value)


def profile_shape(df: DataFrame, n_cols: int | None = None) -> DataFrame:
    """Rows and columns; ``n_cols`` where ``df`` is a projection of the table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(n_cols or len(df.columns)))


def profile_types(df: DataFrame) -> DataFrame:
    """Spark type and non-null count per column."""
    counts = _stack(df.agg(*[F.count(c).alias(c) for c in df.columns]), df.columns,
                    "column_name", "non_null")
    types = df.sparkSession.createDataFrame(df.dtypes, "column_name string, dtype string")
    return counts.join(F.broadcast(types), "column_name")


def profile_missing(df: DataFrame) -> DataFrame:
    """Nulls per column plus a ``__total__`` row."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    per = _stack(row, df.columns, "column_name", "n_missing")
    total = per.agg(F.lit("__total__").alias("column_name"), F.sum("n_missing").alias("n_missing"))
    return per.unionByName(total)


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES]


def profile_describe(df: DataFrame, cols: Sequence[str] | None = None,
                     approx_accuracy: int | None = None) -> DataFrame:
    """count, mean, std (ddof 1), min, exact 25/50/75 % (linear), max per
    numeric column. The columns are unpivoted into (column_name, v) rows
    in one scan; basic statistics are one grouped aggregate and the
    quartiles one distributed grouped-quantile pass, never a single
    aggregation buffer. ``approx_accuracy`` switches the quartiles to
    ``percentile_approx`` (bounded sketches merged map-side) for raw columns
    too large for an exact range pass."""
    cols = list(cols or numeric_columns(df))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "v")
    basic = long.groupBy("column_name").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    if approx_accuracy:
        pa = F.percentile_approx("v", [0.25, 0.5, 0.75], approx_accuracy)
        qs = long.groupBy("column_name").agg(pa.alias("_q")).select(
            "column_name", *[F.col("_q")[i].alias(n) for i, n in enumerate(("q_25", "q_50", "q_75"))])
    else:
        qs = exact_quantiles_grouped(long, "v", (0.25, 0.5, 0.75), ["column_name"])
    return basic.join(qs, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q_25").alias("p25"), F.col("q_50").alias("p50"), F.col("q_75").alias("p75"), "max")


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Rows identical to an earlier row (all columns)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def profile_nunique(df: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Distinct non-null values per column (exact, or HyperLogLog++ with
    ``approx_rsd`` for very wide / very large tables)."""
    if approx_rsd:
        aggs = [F.approx_count_distinct(c, approx_rsd).alias(c) for c in df.columns]
        return _stack(df.agg(*aggs), df.columns, "column_name", "n_unique")
    # One shuffle of the distinct (column, value) pairs for all columns; values are
    # reduced inside the tasks first. Nulls keep a row, so that a column of nulls counts 0.
    return _by_column(df, df.columns).distinct().groupBy("column_name").agg(F.count("value").alias("n_unique"))


def _by_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value) rows of several columns, in one scan."""
    return df.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted distinct values of several columns as (column, value) rows."""
    return _by_column(df, cols).distinct().orderBy("column_name", "value")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _by_column(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def column_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def validate_profit(df: DataFrame, price: str = "unit_price", margin: str = "margin_pct",
                    profit: str = "profit", tolerance: float = 1.0) -> DataFrame:
    """Recompute ``round(price * margin, 2)`` and compare with the stored
    profit; the margin may still be a ``"15%"`` string."""
    m = parse_percent(margin) if dict(df.dtypes)[margin] == "string" else F.col(margin)
    diff = F.abs(F.col(profit) - F.round(F.col(price) * m, 2))
    return df.agg(F.round(F.max(diff), 6).alias("max_diff"),
                  F.count_if(diff > tolerance).alias("n_over_tolerance"),
                  F.count(F.lit(1)).alias("n_rows"))


def validate_identities(df: DataFrame, checks: dict, tolerance: float = 1.0) -> DataFrame:
    """Several column identities in one pass: ``checks`` maps a name to
    (stored column, expected expression); one row per check with the
    largest absolute difference and the rows beyond ``tolerance``."""
    aggs = []
    for name, (stored, expected) in checks.items():
        diff = F.abs(F.col(stored) - expected)
        aggs += [F.round(F.max(diff), 6).alias(f"{name}__max"), F.count_if(diff > tolerance).alias(f"{name}__n")]
    row = df.agg(*aggs)
    out = None
    for name in checks:
        one = row.select(F.lit(name).alias("check"), F.col(f"{name}__max").alias("max_diff"),
                         F.col(f"{name}__n").alias("n_over_tolerance"))
        out = one if out is None else out.unionByName(one)
    return out


def validate_dependency(df: DataFrame, key: str = "dealer", value: str = "dealer_location") -> DataFrame:
    """Functional dependency key -> value: distinct values per key."""
    per = df.groupBy(key).agg(F.count_distinct(value).alias("n_values"))
    return per.agg(F.count(F.lit(1)).alias("n_keys"),
                   F.count_if(F.col("n_values") != 1).alias("n_violations"),
                   F.coalesce(F.bool_and(F.col("n_values") == 1), F.lit(True)).alias("consistent"))


def dependency_map(df: DataFrame, key: str = "dealer", value: str = "dealer_location",
                   order: Sequence[str] | None = None) -> DataFrame:
    """key -> value: the value of the first row in ``order`` (``min_by``),
    or the smallest value when no order is given."""
    if order:
        v = F.min_by(value, F.struct(*order))
    else:
        v = F.min(value)
    return df.groupBy(key).agg(v.alias(value))
