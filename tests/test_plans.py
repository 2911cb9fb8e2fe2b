"""Plan-shape checks: pruned scans, joins and passes, pushed filters."""
import re

import pytest

import __spark_entry__ as entry


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _scans(plan, table):
    """Columns of every scan of a table."""
    found = re.findall(rf"FileScan parquet [^\n]*?{table}\.parquet[^\n]*?ReadSchema: struct<([^>]*)>", plan)
    return [{c.split(":")[0] for c in s.split(",")} for s in found]


@pytest.mark.parametrize("name,columns", [
    ("daily_demand", {"l_shipdate", "l_quantity"}), ("month_counts", {"l_shipdate"}), ("clip", {"l_quantity"}),
    ("calendar_features", {"l_shipdate"}), ("parse_percent", {"l_discount", "l_tax"})])
def test_one_scan_of_the_needed_columns_and_no_dimension(spark, small_dir, name, columns):
    plan = _plan(entry.queries()[name](spark, small_dir))
    assert _scans(plan, "lineitem") == [columns]
    assert not _scans(plan, "part") and not _scans(plan, "supplier")


@pytest.mark.parametrize("name", ["standard_scale", "regression_metrics", "correlation", "value_counts", "stock_health"])
def test_no_cartesian_and_at_most_one_fact_scan(spark, small_dir, name):
    plan = _plan(entry.queries()[name](spark, small_dir))
    assert "CartesianProduct" not in plan
    scans = _scans(plan, "lineitem")
    assert len(scans) <= 1 and all(not s & {"l_returnflag", "l_linestatus"} for s in scans)


def test_pairs_join_the_part_only(spark, small_dir):
    plan = _plan(entry.queries()["pairs"](spark, small_dir))
    assert len(_scans(plan, "lineitem")) == 1 and len(_scans(plan, "part")) == 1 and not _scans(plan, "supplier")


def test_recent_window_bound_reaches_scan(spark, small_dir):
    plan = _plan(entry.queries()["recent_window"](spark, small_dir))
    pushed = re.findall(r"lineitem\.parquet.*?PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(l_shipdate" in p for p in pushed)


@pytest.mark.parametrize("name", ["regression_metrics", "histogram", "contiguous_folds", "drift_monitor", "time_split", "split_report",
                                  "target_stats", "box_stats", "residuals", "row_order", "sample_rows", "drop_warmup", "profile_shape"])
def test_dates_and_quantities_need_no_dimension(spark, small_dir, name):
    plan = _plan(entry.queries()[name](spark, small_dir))
    assert not _scans(plan, "part") and not _scans(plan, "supplier") and not _scans(plan, "nation")


@pytest.mark.parametrize("name", ["product_brand_forecast", "inventory_optimization", "standard_scale", "normalise_by_max",
                                  "round_modes", "target_correlation", "profile_describe"])
def test_prices_and_products_need_no_dealer(spark, small_dir, name):
    plan = _plan(entry.queries()[name](spark, small_dir))
    assert not _scans(plan, "supplier") and not _scans(plan, "nation")


def test_features_are_streamed_and_not_persisted(spark, small_dir):
    plan = _plan(entry.queries()["select_features"](spark, small_dir))
    assert "InMemoryTableScan" not in plan and len(_scans(plan, "lineitem")) == 1


def test_distinct_counts_take_no_copy_per_column_through_the_shuffle(spark, small_dir):
    plan = _plan(entry.queries()["profile_nunique"](spark, small_dir))
    assert "Expand" not in plan and len(_scans(plan, "lineitem")) == 1
