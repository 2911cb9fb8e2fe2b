"""Daily demand series, lag and rolling-window features.

The daily series has one row per date (per group when ``partition_by`` is
given), so it is bounded by the calendar, not by the number of sales. Lags
and rolling windows are computed without a single-partition window: every
day is copied to the ``span`` following row positions (``explode`` of a
fixed-length sequence) and each target position aggregates the copies it
received. That is one hash shuffle of ``span + 1`` times the daily table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize
from .ordering import row_index

LAGS = (1, 7, 14, 30)
WINDOWS = (7, 14, 30)
STD_WINDOWS = (7,)
LAG_COLS = ["lag_1", "lag_7", "lag_14", "lag_30",
            "rolling_7_mean", "rolling_14_mean", "rolling_30_mean", "rolling_7_std"]
DAILY_COLS = ["date", "daily_total_demand", *LAG_COLS]


def daily_demand(sales: DataFrame, date_col: str = "date", qty_col: str = "qty",
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """Total quantity and number of sales per date (partial + final
    aggregate, so a hot date is pre-combined on the map side)."""
    return sales.groupBy(*partition_by, date_col).agg(
        F.sum(qty_col).alias("daily_total_demand"),
        F.count(F.lit(1)).alias("daily_rows"))


def lag_rolling(daily: DataFrame, value_col: str = "daily_total_demand", date_col: str = "date",
                lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS,
                std_windows: Sequence[int] = STD_WINDOWS, partition_by: Sequence[str] = (),
                mode: str = "rows", exclude_current: bool = False,
                carry: Sequence[str] = ("daily_rows",)) -> DataFrame:
    """Lag ``L`` = value ``L`` rows back; rolling mean/std over the current
    and previous ``w-1`` rows, NULL until ``w`` rows exist (the full-window
    rule of a pandas ``rolling(w)``).

    ``mode="days"`` counts calendar days instead of rows: a missing date is
    a day with zero demand. ``exclude_current`` shifts every rolling frame
    one row back so the current day's total is not part of its own feature.
    Columns in ``carry`` are passed through, and their ``w``-row means are
    emitted as ``<col>_<w>_mean`` for the rolling windows.
    """
    groups = list(partition_by)
    if mode == "rows":
        ix = row_index(daily, [*groups, date_col], "_t")
        if groups:
            first = ix.groupBy(*groups).agg(F.min("_t").alias("_t0"))
            ix = ix.join(first, groups).withColumn("_t", F.col("_t") - F.col("_t0")).drop("_t0")
    elif mode == "days":
        first = daily.groupBy(*groups).agg(F.min(date_col).alias("_d0")) if groups else \
            daily.agg(F.min(date_col).alias("_d0"))
        ix = daily.join(first, groups) if groups else daily.crossJoin(F.broadcast(first))
        ix = ix.withColumn("_t", F.datediff(date_col, "_d0").cast("long")).drop("_d0")
    else:
        raise ValueError(f"mode must be 'rows' or 'days', not {mode!r}")

    shift = 1 if exclude_current else 0
    span = max([*lags, *[w - 1 + shift for w in windows], 0])
    fan = ix.select(*groups, date_col, value_col, *carry, "_t",
                    F.explode(F.sequence(F.lit(0), F.lit(span))).alias("_k"))
    fan = fan.withColumn("_tgt", F.col("_t") + F.col("_k"))
    k, v = F.col("_k"), F.col(value_col)

    def own(c):
        return F.max(F.when(k == 0, F.col(c))).alias(c)

    aggs = [own(date_col), own(value_col), *[own(c) for c in carry]]
    for lag in lags:
        val = F.max(F.when(k == lag, v))
        if mode == "days":
            val = F.when(F.col("_tgt") >= lag, F.coalesce(val, F.lit(0.0)))
        aggs.append(val.alias(f"lag_{lag}"))
    for w in windows:
        inside = (k >= shift) & (k < w + shift)
        if mode == "rows":
            full = F.count(F.when(inside, v)) == w
            aggs.append(F.when(full, F.avg(F.when(inside, v))).alias(f"rolling_{w}_mean"))
            for c in carry:
                aggs.append(F.when(full, F.avg(F.when(inside, F.col(c)))).alias(f"{c}_{w}_mean"))
            if w in std_windows:
                aggs.append(F.when(full, F.stddev_samp(F.when(inside, v))).alias(f"rolling_{w}_std"))
        else:
            full = F.col("_tgt") >= (w - 1 + shift)
            s = F.sum(F.when(inside, v).otherwise(0.0))
            aggs.append(F.when(full, s / w).alias(f"rolling_{w}_mean"))
            for c in carry:
                aggs.append(F.when(full, F.sum(F.when(inside, F.col(c)).otherwise(0)) / w)
                            .alias(f"{c}_{w}_mean"))
            if w in std_windows:
                ss = F.sum(F.when(inside, v * v).otherwise(0.0))
                var = (ss - s * s / w) / (w - 1)
                aggs.append(F.when(full, F.sqrt(F.greatest(var, F.lit(0.0))))
                            .alias(f"rolling_{w}_std"))
    out = fan.groupBy(*groups, "_tgt").agg(*aggs)
    return out.where(F.col(date_col).isNotNull()).drop("_tgt")


def daily_features(sales: DataFrame, **kw) -> DataFrame:
    """Daily series with its lag/rolling columns (warm-up rows kept)."""
    part = kw.get("partition_by", ())
    return lag_rolling(daily_demand(sales, partition_by=part), **kw)


def drop_warmup(df: DataFrame, cols: Sequence[str] = LAG_COLS) -> DataFrame:
    return df.na.drop(subset=list(cols))


def demand_features(sales: DataFrame) -> DataFrame:
    """Flagship: daily totals -> lags -> rolling means/std -> drop warm-up."""
    return drop_warmup(daily_features(sales)).select(*DAILY_COLS)


def attach_daily_features(sales: DataFrame, daily: DataFrame, date_col: str = "date",
                          cols: Sequence[str] = LAG_COLS, checkpointed: bool = False) -> DataFrame:
    """Left join every sale to its date's features.

    The daily side is checkpointed (unless the caller already did) and
    broadcast only when a bounded count shows it small; the sales side is
    then never shuffled for this join."""
    side = daily.select(date_col, *cols)
    side = side if checkpointed else materialize(side)
    return sales.join(broadcast_if_small(side), date_col, "left")
