"""DuckDB-dialect building blocks for the oracle queries.

Each block is a CTE over the pre-registered parquet views; an oracle query is
``WITH <blocks> SELECT ...``. They restate the same semantics as the Spark
operators in plain SQL windows and aggregates, so the two can be compared.
"""

from __future__ import annotations

from ..operators.prepare import SPLIT_DATE
from ..sources.tables import SALES_SQL

LAGS_NOT_NULL = " AND ".join(
    f"f.{c} IS NOT NULL" for c in ["lag_1", "lag_7", "lag_14", "lag_30", "rolling_7_mean",
                                   "rolling_14_mean", "rolling_30_mean", "rolling_7_std"])

DAILY_SQL = """
daily AS (SELECT date, sum(qty) AS daily_total_demand, count(*) AS daily_rows
          FROM sales GROUP BY date),
feats AS (
  SELECT date, daily_total_demand, daily_rows,
    lag(daily_total_demand, 1) OVER (ORDER BY date) AS lag_1,
    lag(daily_total_demand, 7) OVER (ORDER BY date) AS lag_7,
    lag(daily_total_demand, 14) OVER (ORDER BY date) AS lag_14,
    lag(daily_total_demand, 30) OVER (ORDER BY date) AS lag_30,
    CASE WHEN count(*) OVER w7 = 7 THEN avg(daily_total_demand) OVER w7 END AS rolling_7_mean,
    CASE WHEN count(*) OVER w14 = 14 THEN avg(daily_total_demand) OVER w14 END AS rolling_14_mean,
    CASE WHEN count(*) OVER w30 = 30 THEN avg(daily_total_demand) OVER w30 END AS rolling_30_mean,
    CASE WHEN count(*) OVER w7 = 7 THEN stddev_samp(daily_total_demand) OVER w7 END AS rolling_7_std,
    CASE WHEN count(*) OVER w7 = 7 THEN avg(daily_rows) OVER w7 END AS daily_rows_7_mean
  FROM daily
  WINDOW w7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w14 AS (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
         w30 AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
)"""


def calendar_sql(d: str) -> str:
    return (f"CAST(isodow({d}) - 1 AS INTEGER) AS day_of_week, "
            f"CAST(day({d}) AS INTEGER) AS day_of_month, CAST(month({d}) AS INTEGER) AS month, "
            f"CAST(quarter({d}) AS INTEGER) AS quarter, CAST(year({d}) AS INTEGER) AS year, "
            f"CAST(weekofyear({d}) AS INTEGER) AS week_of_year, "
            f"CASE WHEN isodow({d}) >= 6 THEN 1 ELSE 0 END AS is_weekend, "
            f"CASE WHEN day({d}) = 1 THEN 1 ELSE 0 END AS is_month_start, "
            f"CASE WHEN last_day({d}) = {d} THEN 1 ELSE 0 END AS is_month_end")


ENG_SQL = f"""
eng AS (
  SELECT s.date, s.product, s.brand, s.dealer, s.size, s.unit_price, s.qty, s.stock,
         s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, s.l_extendedprice,
         {calendar_sql('s.date')},
         f.lag_1, f.lag_7, f.lag_14, f.lag_30, f.rolling_7_mean, f.rolling_14_mean,
         f.rolling_30_mean, f.rolling_7_std, f.daily_rows_7_mean,
         CASE WHEN s.date < DATE '{SPLIT_DATE}' THEN 'train' ELSE 'test' END AS split
  FROM sales s JOIN feats f ON s.date = f.date
  WHERE {LAGS_NOT_NULL}
)"""

KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

PRED_SQL = f"""
pred AS (
  SELECT date, {KEYS}, split, qty AS actual, 'naive' AS model, lag_1 / daily_rows_7_mean AS prediction FROM eng
  UNION ALL
  SELECT date, {KEYS}, split, qty, 'seasonal_naive', lag_7 / daily_rows_7_mean FROM eng
  UNION ALL
  SELECT date, {KEYS}, split, qty, 'rolling', rolling_7_mean / daily_rows_7_mean FROM eng
)"""

SCORED_SQL = """
scored AS (
  SELECT *, rolling_7_mean / daily_rows_7_mean AS prediction FROM eng
  WHERE date >= (SELECT max(date) FROM eng) - 30
)"""

PBF_SQL = """
pbf AS (
  SELECT h.product, h.brand, round(h.m, 1) AS avg_daily_demand, round(r.pm, 1) AS predicted_demand,
         round(h.sd, 2) AS demand_std, round(h.price, 0) AS avg_price, round(h.stk, 0) AS current_stock
  FROM (SELECT product, brand, avg(qty) AS m, coalesce(stddev_samp(qty), 0) AS sd,
               avg(unit_price) AS price, avg(stock) AS stk FROM sales GROUP BY product, brand) h
  JOIN (SELECT product, brand, avg(prediction) AS pm FROM scored GROUP BY product, brand) r
    ON h.product = r.product AND h.brand = r.brand
)"""

INV_SQL = """
inv0 AS (SELECT *, round(CAST(1.65 AS DOUBLE) * demand_std * sqrt(7.0), 1) AS safety_stock FROM pbf),
inv1 AS (SELECT *, round(avg_daily_demand * 7 + safety_stock, 1) AS reorder_point FROM inv0),
inv AS (
  SELECT product, brand, avg_daily_demand, predicted_demand, safety_stock, reorder_point,
         CAST(CASE WHEN avg_price * 0.2 > 0
                   THEN round(sqrt(2 * avg_daily_demand * 365 * 500.0 / (avg_price * 0.2)), 0)
                   ELSE round(avg_daily_demand * 30, 0) END AS INTEGER) AS eoq,
         CAST(current_stock AS INTEGER) AS current_stock,
         CASE WHEN current_stock < reorder_point * 0.5 THEN 'Critical'
              WHEN current_stock < reorder_point THEN 'Reorder'
              WHEN current_stock < reorder_point * 3 THEN 'Healthy'
              ELSE 'Overstock' END AS stock_status,
         7 AS lead_time
  FROM inv1
)"""

HEALTH_SQL = """
mx AS (SELECT max(date) AS md FROM sales),
tot AS (
  SELECT product, brand, sum(qty) AS total_sold, avg(qty) AS mean_qty,
         coalesce(sum(CASE WHEN date >= md - 90 THEN qty END), 0) AS s90,
         coalesce(sum(CASE WHEN date >= md - 30 THEN qty END), 0) AS s30,
         avg(stock) AS mean_stock
  FROM sales, mx GROUP BY product, brand
),
qs AS (SELECT quantile_cont(mean_qty, 0.25) AS q25, quantile_cont(mean_qty, 0.10) AS q10 FROM tot),
sh0 AS (
  SELECT product, brand, CAST(total_sold AS BIGINT) AS total_sold, round(mean_qty, 1) AS avg_daily_sales,
         CAST(s90 AS BIGINT) AS sold_last_90d, CAST(s30 AS BIGINT) AS sold_last_30d,
         round(mean_stock, 0) AS avg_stock_d, q10, q25
  FROM tot, qs
),
sh1 AS (SELECT *, round(total_sold / greatest(avg_stock_d, 1.0), 2) AS turnover_ratio FROM sh0),
health AS (
  SELECT product, brand, total_sold, avg_daily_sales, sold_last_90d, sold_last_30d,
         CAST(avg_stock_d AS INTEGER) AS avg_stock, turnover_ratio,
         CAST(least(CASE WHEN avg_daily_sales > 0
                         THEN round(avg_stock_d / greatest(avg_daily_sales / 30, 0.1), 0)
                         ELSE 999 END, 999) AS INTEGER) AS days_of_supply,
         CASE WHEN avg_daily_sales <= q10 THEN 'Deadstock'
              WHEN avg_daily_sales <= q25 THEN 'Slow-Moving'
              WHEN turnover_ratio > 8 THEN 'Fast-Moving'
              ELSE 'Normal' END AS health
  FROM sh1
)"""

# Labels, actions and colours of the decisions, as in operators/inventory.py.
HEALTH_ACTION_SQL = """CASE health
  WHEN 'Deadstock' THEN 'Liquidate — deep discount or bundle'
  WHEN 'Slow-Moving' THEN 'Promote — run targeted discounts'
  WHEN 'Fast-Moving' THEN 'Maintain — ensure consistent stock'
  ELSE 'Monitor — standard replenishment' END"""

# Labels, actions and colours of the decisions, as in operators/inventory.py.
RECS_SQL = """
rj AS (
  SELECT i.*, coalesce(h.health, 'Normal') AS hh, coalesce(h.turnover_ratio, 5.0) AS tt
  FROM inv i LEFT JOIN health h ON i.product = h.product AND i.brand = h.brand
),
rk AS (
  SELECT *, CASE WHEN hh = 'Deadstock' THEN 1 WHEN current_stock <= safety_stock THEN 2
                 WHEN current_stock <= reorder_point THEN 3
                 WHEN current_stock >= reorder_point * 3 AND tt < 4 THEN 4 ELSE 5 END AS branch,
         CAST(coalesce(round((current_stock - reorder_point) / greatest(avg_daily_demand, 0.5), 0), 0)
              AS INTEGER) AS days_until_reorder
  FROM rj
),
recs AS (
  SELECT product, brand, current_stock, reorder_point, safety_stock,
    CASE branch WHEN 1 THEN 'Deadstock' WHEN 2 THEN 'Critical — Below Safety Stock'
         WHEN 3 THEN 'Reorder Now' WHEN 4 THEN 'Overstock Warning' ELSE 'Healthy' END AS alert,
    CASE branch WHEN 1 THEN 'Low' WHEN 2 THEN 'Urgent' WHEN 3 THEN 'High' WHEN 4 THEN 'Medium'
         ELSE 'Normal' END AS priority,
    CASE branch WHEN 1 THEN 'Run clearance sale or bundle with fast-movers'
         WHEN 2 THEN 'Order ' || CAST(eoq AS VARCHAR) || ' units immediately (Express shipping)'
         WHEN 3 THEN 'Place order for ' || CAST(eoq AS VARCHAR) || ' units'
         WHEN 4 THEN 'Consider 10-15% discount to accelerate sales'
         ELSE 'Stock OK — ~' || CAST(days_until_reorder AS VARCHAR) || ' days until reorder' END AS action,
    CASE WHEN branch IN (2, 3) THEN eoq ELSE 0 END AS order_qty,
    CASE branch WHEN 1 THEN '#ef4444' WHEN 2 THEN '#ef4444' WHEN 3 THEN '#f59e0b'
         WHEN 4 THEN '#a855f7' ELSE '#22c55e' END AS color
  FROM rk
)"""

METRICS_SQL = """
metrics AS (
  SELECT model, split,
         round(avg(abs(actual - prediction)), 4) AS mae,
         round(sqrt(avg((actual - prediction) * (actual - prediction))), 4) AS rmse,
         round(1 - sum((actual - prediction) * (actual - prediction)) / (var_pop(actual) * count(*)), 4) AS r2,
         round(avg(abs((actual - prediction) / CASE WHEN actual = 0 THEN 1.0 ELSE actual END)) * 100, 2) AS mape,
         count(*) AS n
  FROM pred GROUP BY model, split
)"""


def with_blocks(*blocks: str) -> str:
    return "WITH " + ",\n".join([SALES_SQL.strip(), *[b.strip() for b in blocks]])
