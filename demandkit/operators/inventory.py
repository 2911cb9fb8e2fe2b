"""Forecast aggregation and inventory decisions.

Every table is an aggregate of the sales rows keyed by product or by
product x brand, followed by narrow CASE logic; the shuffles carry only
partially aggregated rows. Thresholds and "latest date" scalars are one-row
tables joined by broadcast, never collected into driver literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import item_label
from ..session import materialize
from .ordering import exact_quantiles

PAIR = ["product", "brand"]


# The default policy.
@dataclass(frozen=True)
class InventoryPolicy:
    lead_time_days: int = 7
    z: float = 1.65           # 95 % service level
    order_cost: float = 500.0
    holding_rate: float = 0.2  # yearly holding cost as a share of price
    recent_days: int = 30
    slow_days: int = 90
    overstock_turnover: float = 4.0
    fast_turnover: float = 8.0
    missing_turnover: float = 5.0


DEFAULT_POLICY = InventoryPolicy()

# Labels, actions and display colours of the decisions.
HEALTH_ACTIONS = {
    "Deadstock": "Liquidate — deep discount or bundle",
    "Slow-Moving": "Promote — run targeted discounts",
    "Fast-Moving": "Maintain — ensure consistent stock",
    "Normal": "Monitor — standard replenishment",
}
ALERT_DEADSTOCK = ("Deadstock", "Low", "Run clearance sale or bundle with fast-movers", "#ef4444")
ALERT_CRITICAL = ("Critical — Below Safety Stock", "Urgent", "Order {eoq} units immediately (Express shipping)", "#ef4444")
ALERT_REORDER = ("Reorder Now", "High", "Place order for {eoq} units", "#f59e0b")
ALERT_OVERSTOCK = ("Overstock Warning", "Medium", "Consider 10-15% discount to accelerate sales", "#a855f7")
ALERT_HEALTHY = ("Healthy", "Normal", "Stock OK — ~{days} days until reorder", "#22c55e")
PRIORITY_RANK = ["Urgent", "High", "Medium", "Low", "Normal"]
STATUS_CLASSES = ["Critical", "Reorder", "Healthy", "Overstock"]
HEALTH_CLASSES = ["Fast-Moving", "Normal", "Slow-Moving", "Deadstock"]
STATUS_COLORS = {"Critical": "red", "Reorder": "amber", "Healthy": "green", "Overstock": "purple"}


# --- scoring inputs -----------------------------------------------------

BASELINES = {"naive": "lag_1", "seasonal_naive": "lag_7", "rolling": "rolling_7_mean"}


def baseline_prediction(model: str = "rolling") -> Column:
    """Per-sale baseline: a daily-total feature divided by the trailing
    7-day mean number of sales per day."""
    return F.col(BASELINES[model]) / F.col("daily_rows_7_mean")


def max_date(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.agg(F.max(date_col).alias("_max_date"))


def scan_bound(latest: DataFrame, days: int):
    """First date of the recent window as a literal, from a one-row
    (checkpointed) max-date table. This single value is the one scalar we
    bring to the driver: as a literal the filter reaches the Parquet scan
    (``l_shipdate >= ...`` is pushed), so only row groups of the recent
    window are read."""
    import datetime as dt
    mx = latest.first()[0]
    return None if mx is None else mx - dt.timedelta(days=days)


def recent_window(df: DataFrame, days: int, date_col: str = "date",
                  latest: DataFrame | None = None, since=None) -> DataFrame:
    """Rows with date >= max(date) - days, both ends inclusive (days + 1
    dates). With ``since`` (see :func:`scan_bound`) the bound is a literal
    that prunes the scan; otherwise the max is a one-row table joined by
    broadcast."""
    if since is not None:
        return df.where(F.col(date_col) >= F.lit(since))
    latest = latest if latest is not None else max_date(df, date_col)
    return (df.crossJoin(F.broadcast(latest))
              .where(F.col(date_col) >= F.date_sub("_max_date", days))
              .drop("_max_date"))


def scored_recent(engineered: DataFrame, model: str = "rolling",
                  policy: InventoryPolicy = DEFAULT_POLICY,
                  prediction: Column | None = None) -> DataFrame:
    """Last ``recent_days`` of the engineered rows with a prediction column."""
    pred = prediction if prediction is not None else baseline_prediction(model)
    return recent_window(engineered, policy.recent_days).withColumn("prediction", pred)


# --- aggregates -----------------------------------------------------------

def product_history(raw: DataFrame, keys: Sequence[str] = ("product",)) -> DataFrame:
    """Mean and sample std (NULL -> 0) of quantity over all history."""
    return raw.groupBy(*keys).agg(
        F.avg("qty").alias("hist_mean"),
        F.coalesce(F.stddev_samp("qty"), F.lit(0.0)).alias("hist_std"),
        F.avg("unit_price").alias("hist_price"),
        F.avg("stock").alias("hist_stock"))


def history_vs_recent(raw: DataFrame, scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History aggregate joined to the recent prediction aggregate; the
    inner join keeps only keys with recent rows (the reference's skip)."""
    rec = scored.groupBy(*keys).agg(
        F.avg("prediction").alias("pred_mean"),
        F.sum("prediction").alias("pred_sum"),
        F.count(F.lit(1)).alias("records"))
    return product_history(raw, keys).join(rec, list(keys))


def product_forecast(raw: DataFrame, scored: DataFrame) -> DataFrame:
    h = history_vs_recent(raw, scored, ["product"])
    return h.select(
        "product",
        F.round("hist_mean", 1).alias("avg_daily_demand"),
        F.round("pred_mean", 1).alias("predicted_avg_demand"),
        F.round("pred_sum", 0).alias("total_predicted_30d"),
        F.round("hist_std", 2).alias("demand_std"),
        F.col("records").cast("long").alias("records"))


def product_brand_forecast(raw: DataFrame, scored: DataFrame) -> DataFrame:
    return pbf_from_parts(history_vs_recent(raw, scored, PAIR))


def pbf_from_parts(h: DataFrame) -> DataFrame:
    """Rounded forecast row from per-pair history (hist_mean, hist_std,
    hist_price, hist_stock) and the recent prediction mean (pred_mean)."""
    return h.select(
        "product", "brand",
        F.round("hist_mean", 1).alias("avg_daily_demand"),
        F.round("pred_mean", 1).alias("predicted_demand"),
        F.round("hist_std", 2).alias("demand_std"),
        F.round("hist_price", 0).alias("avg_price"),
        F.round("hist_stock", 0).alias("current_stock"))


# --- policy columns (inputs already rounded, as in the reference) ----------

def safety_stock(std: Column, p: InventoryPolicy = DEFAULT_POLICY) -> Column:
    return F.round(F.lit(p.z) * std * F.sqrt(F.lit(float(p.lead_time_days))), 1)


def reorder_point(avg: Column, ss: Column, p: InventoryPolicy = DEFAULT_POLICY) -> Column:
    return F.round(avg * p.lead_time_days + ss, 1)


def eoq(avg: Column, price: Column, p: InventoryPolicy = DEFAULT_POLICY) -> Column:
    """Wilson lot size; 30 days of demand when the holding cost is not
    positive."""
    holding = price * p.holding_rate
    wilson = F.round(F.sqrt(2 * avg * 365 * p.order_cost / holding), 0)
    return F.when(holding > 0, wilson).otherwise(F.round(avg * 30, 0)).cast("int")


def stock_status(stock: Column, rop: Column) -> Column:
    return (F.when(stock < rop * 0.5, "Critical")
             .when(stock < rop, "Reorder")
             .when(stock < rop * 3, "Healthy")
             .otherwise("Overstock"))


def inventory_optimization(pbf: DataFrame, p: InventoryPolicy = DEFAULT_POLICY) -> DataFrame:
    ss = safety_stock(F.col("demand_std"), p)
    df = pbf.withColumn("safety_stock", ss)
    df = df.withColumn("reorder_point", reorder_point(F.col("avg_daily_demand"), F.col("safety_stock"), p))
    return df.select(
        "product", "brand", "avg_daily_demand", "predicted_demand", "safety_stock",
        "reorder_point",
        eoq(F.col("avg_daily_demand"), F.col("avg_price"), p).alias("eoq"),
        F.col("current_stock").cast("int").alias("current_stock"),
        stock_status(F.col("current_stock"), F.col("reorder_point")).alias("stock_status"),
        F.lit(p.lead_time_days).alias("lead_time"))


# --- stock health ---------------------------------------------------------

def pair_means(raw: DataFrame) -> DataFrame:
    return raw.groupBy(*PAIR).agg(F.avg("qty").alias("mean_qty"))


def pair_quantiles(raw: DataFrame, qs: Sequence[float] = (0.25, 0.10)) -> DataFrame:
    """Exact linear-interpolated quantiles of the per-pair mean quantity."""
    return exact_quantiles(pair_means(raw), "mean_qty", qs)


def window_totals(raw: DataFrame, p: InventoryPolicy = DEFAULT_POLICY,
                  latest: DataFrame | None = None) -> DataFrame:
    """One pass: totals, means, last-90 / last-30 totals (0 when none)."""
    latest = latest if latest is not None else max_date(raw)
    d = F.col("date")
    recent90 = d >= F.date_sub("_max_date", p.slow_days)
    recent30 = d >= F.date_sub("_max_date", p.recent_days)
    return raw.crossJoin(F.broadcast(latest)).groupBy(*PAIR).agg(
        F.sum("qty").alias("total_sold"),
        F.avg("qty").alias("mean_qty"),
        F.coalesce(F.sum(F.when(recent90, F.col("qty"))), F.lit(0.0)).alias("sold_last_90d"),
        F.coalesce(F.sum(F.when(recent30, F.col("qty"))), F.lit(0.0)).alias("sold_last_30d"),
        F.avg("stock").alias("mean_stock"))


def turnover_ratio(total: Column, avg_stock: Column) -> Column:
    return F.round(total / F.greatest(avg_stock, F.lit(1.0)), 2)


def days_of_supply(avg_stock: Column, avg_sold: Column) -> Column:
    days = F.when(avg_sold > 0, F.round(avg_stock / F.greatest(avg_sold / 30, F.lit(0.1)), 0)
                  ).otherwise(F.lit(999.0))
    return F.least(days, F.lit(999.0)).cast("int")


def health_class(avg_sold: Column, turnover: Column, q10: Column, q25: Column,
                 p: InventoryPolicy = DEFAULT_POLICY) -> Column:
    return (F.when(avg_sold <= q10, "Deadstock")
             .when(avg_sold <= q25, "Slow-Moving")
             .when(turnover > p.fast_turnover, "Fast-Moving")
             .otherwise("Normal"))


def health_action(health: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in HEALTH_ACTIONS.items() for x in kv])
    return m[health]


def stock_health(raw: DataFrame, p: InventoryPolicy = DEFAULT_POLICY,
                 latest: DataFrame | None = None) -> DataFrame:
    """One scan of the sales rows: the per-pair totals (bounded by the
    number of product x brand pairs) are checkpointed and feed both the
    quantile thresholds and the classification."""
    return health_from_totals(materialize(window_totals(raw, p, latest)), p)


def health_from_totals(tot: DataFrame, p: InventoryPolicy = DEFAULT_POLICY) -> DataFrame:
    """Stock health from per-pair totals (product, brand, total_sold,
    mean_qty, sold_last_90d, sold_last_30d, mean_stock)."""
    q = exact_quantiles(tot, "mean_qty", (0.25, 0.10)).select(
        F.col("q_25").alias("_q25"), F.col("q_10").alias("_q10"))
    df = tot.crossJoin(F.broadcast(q)).select(
        *PAIR,
        F.col("total_sold").cast("long").alias("total_sold"),
        F.round("mean_qty", 1).alias("avg_daily_sales"),
        F.col("sold_last_90d").cast("long").alias("sold_last_90d"),
        F.col("sold_last_30d").cast("long").alias("sold_last_30d"),
        F.round("mean_stock", 0).alias("_avg_stock"),
        "_q10", "_q25")
    df = df.withColumn("turnover_ratio", turnover_ratio(F.col("total_sold"), F.col("_avg_stock")))
    df = df.withColumn("health", health_class(F.col("avg_daily_sales"), F.col("turnover_ratio"),
                                              F.col("_q10"), F.col("_q25"), p))
    return df.select(
        *PAIR, "total_sold", "avg_daily_sales", "sold_last_90d", "sold_last_30d",
        F.col("_avg_stock").cast("int").alias("avg_stock"), "turnover_ratio",
        days_of_supply(F.col("_avg_stock"), F.col("avg_daily_sales")).alias("days_of_supply"),
        "health", health_action(F.col("health")).alias("action"))


# --- recommendations --------------------------------------------------------

def days_until_reorder(stock: Column, rop: Column, avg: Column) -> Column:
    return F.coalesce(F.round((stock - rop) / F.greatest(avg, F.lit(0.5)), 0), F.lit(0.0)).cast("int")


def _alert(spec, **fmt) -> Column:
    alert, priority, action, color = spec
    if fmt:
        key, val = next(iter(fmt.items()))
        head, tail = action.split("{" + key + "}")
        action_col = F.concat(F.lit(head), val.cast("string"), F.lit(tail))
    else:
        action_col = F.lit(action)
    return F.struct(F.lit(alert).alias("alert"), F.lit(priority).alias("priority"),
                    action_col.alias("action"), F.lit(color).alias("color"))


def recommend(p: InventoryPolicy = DEFAULT_POLICY) -> Column:
    """Decision struct in precedence order: deadstock, below safety stock,
    at/below reorder point, overstock with slow turnover, healthy."""
    stock, ss, rop = F.col("current_stock"), F.col("safety_stock"), F.col("reorder_point")
    e = F.col("eoq")
    days = days_until_reorder(stock, rop, F.col("avg_daily_demand"))
    return (F.when(F.col("health") == "Deadstock", _alert(ALERT_DEADSTOCK))
             .when(stock <= ss, _alert(ALERT_CRITICAL, eoq=e))
             .when(stock <= rop, _alert(ALERT_REORDER, eoq=e))
             .when((stock >= rop * 3) & (F.col("turnover") < p.overstock_turnover), _alert(ALERT_OVERSTOCK))
             .otherwise(_alert(ALERT_HEALTHY, days=days)))


def join_health(inv: DataFrame, health: DataFrame, p: InventoryPolicy = DEFAULT_POLICY) -> DataFrame:
    """Health of each item; 'Normal' and the default turnover when absent."""
    h = health.select(*PAIR, F.col("health").alias("_h"), F.col("turnover_ratio").alias("_t"))
    return inv.join(h, PAIR, "left").withColumns({
        "health": F.coalesce(F.col("_h"), F.lit("Normal")),
        "turnover": F.coalesce(F.col("_t"), F.lit(p.missing_turnover)),
    }).drop("_h", "_t")


def recommendations(inv: DataFrame, health: DataFrame, p: InventoryPolicy = DEFAULT_POLICY) -> DataFrame:
    df = join_health(inv, health, p).withColumn("_r", recommend(p))
    alert = F.col("_r.alert")
    order = F.when(alert.isin(ALERT_CRITICAL[0], ALERT_REORDER[0]), F.col("eoq")).otherwise(F.lit(0))
    return df.select(
        *PAIR, "current_stock", "reorder_point", "safety_stock",
        alert.alias("alert"), F.col("_r.priority").alias("priority"),
        F.col("_r.action").alias("action"), order.alias("order_qty"),
        F.col("_r.color").alias("color"))


# --- dashboard shaping --------------------------------------------------------

def class_counts(df: DataFrame, col: str, classes: Sequence[str] | None = None) -> DataFrame:
    """Count per class; with ``classes`` every listed class appears (0 when
    absent), by a right join to the class list."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if not classes:
        return counts
    spark = df.sparkSession
    names = spark.createDataFrame([(c,) for c in classes], [col])
    return names.join(counts, col, "left").select(col, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def priority_rank(priority: Column) -> Column:
    expr = F.lit(len(PRIORITY_RANK))
    for i, name in reversed(list(enumerate(PRIORITY_RANK))):
        expr = F.when(priority == name, F.lit(i)).otherwise(expr)
    return expr


def alert_feed(recs: DataFrame) -> DataFrame:
    """Recommendations with their priority rank (Urgent first)."""
    return recs.withColumn("priority_rank", priority_rank(F.col("priority")))


def order_totals(recs: DataFrame) -> DataFrame:
    return recs.agg(
        F.count_if(F.col("priority") == "Urgent").alias("urgent"),
        F.count_if(F.col("priority") == "High").alias("high"),
        F.count_if(F.col("alert") == "Healthy").alias("healthy"),
        F.coalesce(F.sum("order_qty"), F.lit(0)).cast("long").alias("units_to_order"))


def status_color(status: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in STATUS_COLORS.items() for x in kv])
    return m[status]


def with_item_label(df: DataFrame) -> DataFrame:
    return df.withColumn("item_label", item_label())
