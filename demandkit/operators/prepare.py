"""Cleaning, encoding, scaling and splitting of the sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import calendar_columns, parse_percent
from ..session import BROADCAST_BYTES, BROADCAST_ROW_LIMIT, broadcast_if_small, materialize, row_bytes
from .features import LAG_COLS, attach_daily_features, daily_features, drop_warmup
from .ordering import row_index

# Column groups and the model's feature order.
LEAKAGE_COLS = ["net_profit", "revenue", "net_tax"]
REDUNDANT_COLS = ["margin_pct", "tax_pct", "tax_amount", "dealer_location", "profit"]
CATEGORICAL_COLS = ["product", "brand", "dealer"]
CALENDAR_COLS = ["day_of_week", "day_of_month", "month", "quarter", "year",
                 "week_of_year", "is_weekend", "is_month_start", "is_month_end"]
SCALED_COLS = ["unit_price", "size", "stock", *LAG_COLS]
FEATURES = ["product_encoded", "brand_encoded", "dealer_encoded",
            "size", "unit_price", "stock",
            *CALENDAR_COLS, *LAG_COLS]
TARGET = "qty"
SPLIT_DATE = "2000-07-01"


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist; absent names are ignored."""
    return df.drop(*cols)


def parse_rates(df: DataFrame, cols: Sequence[str] = ("margin_pct", "tax_pct")) -> DataFrame:
    return df.withColumns({c: parse_percent(c) for c in cols if c in df.columns})


def with_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumns(calendar_columns(date_col))


def engineer(sales: DataFrame, daily: DataFrame | None = None, drop: bool = True,
             extra_daily: Sequence[str] = ("daily_rows_7_mean",),
             daily_checkpointed: bool = False) -> DataFrame:
    """Parse, drop leakage/redundant columns, add calendar and daily
    lag/rolling features (broadcast join), drop warm-up rows."""
    daily = daily if daily is not None else daily_features(sales)
    df = drop_columns(parse_rates(sales), LEAKAGE_COLS + REDUNDANT_COLS)
    df = with_calendar(df)
    df = attach_daily_features(df, daily, cols=[*LAG_COLS, *extra_daily],
                               checkpointed=daily_checkpointed)
    return drop_warmup(df) if drop else df


def encoder_mappings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted distinct values of several columns -> codes 0..n-1 per column
    (byte order, as a sorted list of Python strings), as rows
    (column_name, value, code). One distributed row index over the stacked
    distinct values numbers every column at once, so a high-cardinality
    column (millions of dealers) never meets one task."""
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("_e")).select("_e.*").where(F.col("value").isNotNull()).distinct()
    return _codes(values)


def _codes(values: DataFrame) -> DataFrame:
    ix = row_index(values, ["column_name", "value"], "_i")
    first = ix.groupBy("column_name").agg(F.min("_i").alias("_i0"))  # one row per column
    return ix.join(F.broadcast(first), "column_name").select(
        "column_name", "value", (F.col("_i") - F.col("_i0")).alias("code"))


def fit_preparation(df: DataFrame, cols: Sequence[str] = CATEGORICAL_COLS,
                    scaled: Sequence[str] = SCALED_COLS) -> tuple[DataFrame, DataFrame]:
    """Encoder maps (as :func:`encoder_mappings`) and the scaler's one row (as
    :func:`scaler_params`) from a single pass: every row becomes one row per category column
    and one with the numbers, which partial aggregates reduce to the distinct values."""
    nothing = [F.lit(None).cast("double").alias(c) for c in scaled]
    parts = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), *nothing) for c in cols]
    numbers = F.struct(F.lit("").alias("column_name"), F.lit("").alias("value"), *[F.col(c).cast("double").alias(c) for c in scaled])
    found = materialize(df.select(F.inline(F.array(*parts, numbers))).groupBy("column_name", "value").agg(*_scaler_columns(scaled)))
    maps = _codes(found.where((F.col("column_name") != "") & F.col("value").isNotNull()).select("column_name", "value"))
    return materialize(maps), materialize(found.where(F.col("column_name") == "").drop("column_name", "value"))


def encoder_mapping(df: DataFrame, col: str) -> DataFrame:
    """Mapping of one column as (col, col_encoded)."""
    m = encoder_mappings(df, [col])
    return m.select(F.col("value").alias(col), F.col("code").alias(f"{col}_encoded"))


def label_encode(df: DataFrame, cols: Sequence[str] = CATEGORICAL_COLS,
                 mappings: DataFrame | None = None, unseen: int | None = None) -> DataFrame:
    """Add ``<col>_encoded`` for each column. The mappings of all columns
    come from one pass over ``df`` (or are given, e.g. fitted on training
    rows) and are materialized; each is broadcast only when a bounded count
    shows it small. Values without a code get ``unseen`` (NULL by default)."""
    maps = materialize(mappings if mappings is not None else encoder_mappings(df, cols))
    # One job sizes every mapping in rows and bytes (one row per column comes back).
    size = maps.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(maps)).alias("size"))
    fits = {r[0]: r["n"] <= BROADCAST_ROW_LIMIT and r["size"] <= BROADCAST_BYTES for r in size.collect()}
    for c in cols:
        m = maps.where(F.col("column_name") == c).select(
            F.col("value").alias(c), F.col("code").alias(f"{c}_encoded"))
        df = df.join(F.broadcast(m) if fits.get(c, True) else m, c, "left")
        if unseen is not None:
            df = df.withColumn(f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), F.lit(unseen).cast("long")))
    return df


def inverse_encode(df: DataFrame, mapping: DataFrame, col: str) -> DataFrame:
    """Codes back to labels (``IndexToString`` equivalent)."""
    return df.join(broadcast_if_small(mapping), f"{col}_encoded", "left")


def scaler_params(df: DataFrame, cols: Sequence[str] = SCALED_COLS) -> DataFrame:
    """One row: mean and population std per column (std 0 becomes 1)."""
    return df.agg(*_scaler_columns(cols))


def _scaler_columns(cols: Sequence[str]) -> list:
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"{c}__mean"),
                 F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"{c}__std")]
    return aggs


def standard_scale(df: DataFrame, cols: Sequence[str] = SCALED_COLS,
                   params: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std. The one-row parameter table is
    materialized and broadcast (a single row is a proven bound)."""
    params = materialize(params if params is not None else scaler_params(df, cols))
    joined = df.crossJoin(F.broadcast(params))
    scaled = joined.withColumns({c: (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std")
                                 for c in cols})
    return scaled.drop(*[f"{c}__{s}" for c in cols for s in ("mean", "std")])


def split_column(date_col: str = "date", split_date: str = SPLIT_DATE):
    return F.when(F.col(date_col) < F.lit(split_date).cast("date"), F.lit("train")).otherwise(
        F.lit("test"))


def time_split(df: DataFrame, split_date: str = SPLIT_DATE, date_col: str = "date") -> DataFrame:
    """Tag rows train (< split) / test (>= split)."""
    return df.withColumn("split", split_column(date_col, split_date))


def prepare(sales: DataFrame, split_date: str = SPLIT_DATE, scale: bool = True) -> DataFrame:
    """The full preparation: engineered rows, encoded, scaled, split-tagged."""
    df = label_encode(engineer(sales))
    if scale:
        df = standard_scale(df)
    return time_split(df, split_date)


def select_features(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*extra, *FEATURES, TARGET)
