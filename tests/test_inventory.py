import math

from demandkit.operators import inventory as inv

PBF = "product string, brand string, avg_daily_demand double, predicted_demand double, demand_std double, avg_price double, current_stock double"


def _inv(spark, rows):
    return inv.inventory_optimization(spark.createDataFrame(rows, PBF))


def test_policy_columns(spark):
    r = _inv(spark, [("P", "B", 10.0, 9.0, 2.0, 100.0, 50.0)]).first()
    ss = round(1.65 * 2.0 * math.sqrt(7), 1)
    assert r.safety_stock == ss
    assert r.reorder_point == round(10.0 * 7 + ss, 1)
    assert r.eoq == round(math.sqrt(2 * 10 * 365 * 500 / (100 * 0.2)))
    assert r.lead_time == 7


def test_eoq_fallback_when_price_zero(spark):
    r = _inv(spark, [("P", "B", 10.0, 9.0, 2.0, 0.0, 50.0)]).first()
    assert r.eoq == 300


def test_stock_status_boundaries(spark):
    # std 0 -> ss 0, rop = 7 * avg = 70.
    rows = [("P", f"B{s}", 10.0, 9.0, 0.0, 100.0, float(s)) for s in (34, 35, 69, 70, 209, 210)]
    got = {r.brand: r.stock_status for r in _inv(spark, rows).collect()}
    assert got == {"B34": "Critical", "B35": "Reorder", "B69": "Reorder", "B70": "Healthy",
                   "B209": "Healthy", "B210": "Overstock"}


HEALTH = "product string, brand string, health string, turnover_ratio double"


def _recs(spark, inv_rows, health_rows):
    invdf = _inv(spark, inv_rows)
    h = spark.createDataFrame(health_rows, HEALTH)
    return {r.brand: r for r in inv.recommendations(invdf, h).collect()}


def test_recommendation_precedence(spark):
    # avg 10, std 1 -> ss = round(1.65*sqrt7,1)=4.4, rop = 74.4, eoq = 427
    rows = [("P", name, 10.0, 9.0, 1.0, 100.0, stock) for name, stock in
            [("dead", 1.0), ("crit", 4.0), ("reord", 74.0), ("over", 224.0), ("over_fast", 224.0), ("ok", 100.0),
             ("nohealth", 300.0)]]
    health = [("P", "dead", "Deadstock", 1.0), ("P", "crit", "Normal", 1.0), ("P", "reord", "Normal", 1.0),
              ("P", "over", "Normal", 3.9), ("P", "over_fast", "Normal", 4.0), ("P", "ok", "Fast-Moving", 9.0)]
    r = _recs(spark, rows, health)
    assert (r["dead"].alert, r["dead"].priority, r["dead"].order_qty) == ("Deadstock", "Low", 0)
    assert (r["crit"].priority, r["crit"].order_qty) == ("Urgent", 427)
    assert r["crit"].action == "Order 427 units immediately (Express shipping)"
    assert (r["reord"].alert, r["reord"].action) == ("Reorder Now", "Place order for 427 units")
    assert r["over"].alert == "Overstock Warning" and r["over"].color == "#a855f7"
    assert r["over_fast"].alert == "Healthy"
    assert r["ok"].action == "Stock OK — ~3 days until reorder"  # (100-74.4)/10 = 2.56 -> 3
    # No health row: Normal with turnover 5, so no overstock warning.
    assert r["nohealth"].alert == "Healthy"


def test_days_of_supply_and_turnover(spark):
    df = spark.createDataFrame([(0.0, 50.0, 100.0), (3.0, 50.0, 100.0), (0.001, 0.0, 1.0)],
                               "avg double, stock double, total double")
    from pyspark.sql import functions as F
    out = df.select(inv.days_of_supply(F.col("stock"), F.col("avg")).alias("d"),
                    inv.turnover_ratio(F.col("total"), F.col("stock")).alias("t")).collect()
    assert [o.d for o in out] == [999, 500, 0]
    assert [o.t for o in out] == [2.0, 2.0, 1.0]


def test_health_classes_use_quantile_thresholds(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1.0, 9.0), (2.0, 9.0), (3.0, 9.0), (3.0, 5.0)], "avg double, turn double")
    got = [r.h for r in df.select(inv.health_class(F.col("avg"), F.col("turn"), F.lit(1.0), F.lit(2.0)).alias("h")).collect()]
    assert got == ["Deadstock", "Slow-Moving", "Fast-Moving", "Normal"]


def test_class_counts_zero_fill(spark):
    df = spark.createDataFrame([("Critical",), ("Critical",)], "stock_status string")
    got = {r.stock_status: r.n for r in inv.class_counts(df, "stock_status", inv.STATUS_CLASSES).collect()}
    assert got == {"Critical": 2, "Reorder": 0, "Healthy": 0, "Overstock": 0}


def test_priority_rank_urgent_first(spark):
    df = spark.createDataFrame([(p,) for p in ["Normal", "Urgent", "Low", "High", "Medium"]], "priority string")
    from pyspark.sql import functions as F
    got = [r.priority for r in df.withColumn("r", inv.priority_rank(F.col("priority"))).orderBy("r").collect()]
    assert got == ["Urgent", "High", "Medium", "Low", "Normal"]


def test_policy_parameters_flow_through(spark):
    p = inv.InventoryPolicy(lead_time_days=14, z=2.33)
    df = spark.createDataFrame([("P", "B", 10.0, 9.0, 2.0, 100.0, 50.0)], PBF)
    r = inv.inventory_optimization(df, p).first()
    ss = round(2.33 * 2.0 * math.sqrt(14), 1)
    assert (r.safety_stock, r.reorder_point, r.lead_time) == (ss, round(140 + ss, 1), 14)
