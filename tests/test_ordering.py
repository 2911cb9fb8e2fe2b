import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandkit.operators.ordering import (contiguous_folds, exact_quantiles, exact_quantiles_grouped,
                                          row_index, row_numbers, running_sum)


def test_row_index_matches_row_number(spark):
    rows = [(i % 7, (i * 37) % 101, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    got = row_index(df, ["a", "b", "v"], "idx", num_partitions=5)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("a", "b", "v")) - 1)
    j = got.join(ref, ["a", "b", "v"])
    assert j.count() == 500
    assert j.where(F.col("idx") != F.col("rn")).count() == 0


def test_row_index_skewed_key_spreads(spark):
    # One key holds a third of the rows; the composite key still splits it.
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int")
    got = row_index(df, ["k", "t"], "idx", num_partitions=6)
    idx = sorted(r.idx for r in got.collect())
    assert idx == list(range(3000))


def test_contiguous_folds_match_ntile(spark):
    for n in (103, 100, 7):
        df = spark.range(n).withColumn("d", F.col("id") * 3 % 17)
        got = contiguous_folds(df, ["d", "id"], 5, num_partitions=4)
        ref = df.withColumn("nt", F.ntile(5).over(Window.orderBy("d", "id")))
        j = got.join(ref, ["id", "d"])
        assert j.count() == n
        assert j.where(F.col("fold") != F.col("nt")).count() == 0
        sizes = [r["count"] for r in got.groupBy("fold").count().collect()]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, "v", (0.1, 0.25, 0.5, 0.9), bins=4, rows=3).first()
    ref = np.percentile(np.array(values), [10, 25, 50, 90])
    assert np.allclose([row.q_10, row.q_25, row.q_50, row.q_90], ref, rtol=1e-9, atol=1e-6)


def test_grouped_quantiles(spark):
    rows = [("a", float(i)) for i in range(11)] + [("b", float(i * i)) for i in range(6)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in exact_quantiles_grouped(df, "v", (0.25, 0.5), ["g"]).collect()}
    assert got["a"].q_25 == np.percentile(range(11), 25)
    assert got["b"].q_50 == np.percentile([i * i for i in range(6)], 50)


def test_running_sum(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(200)], "t int, v double")
    got = {r.t: r.running_sum for r in running_sum(df, ["t"], "v", num_partitions=7).collect()}
    cum = np.cumsum([float(i % 4) for i in range(200)])
    assert all(got[i] == cum[i] for i in range(200))


def test_quantiles_of_crowded_and_spread_out_values(spark):
    """A value with most rows, neighbours that differ in the last bit, and a range of all magnitudes."""
    cases = {
        "crowded": [7.0] * 500 + [float(i) for i in range(101)],
        "near": [1e9 + i * 2 ** -20 for i in range(300)],
        "wide": [s * 10.0 ** e for e in range(-300, 300, 7) for s in (-1, 1)] + [1.7e308, -1.7e308],
        "one": [3.5], "same": [2.0] * 9, None: [1.0, 4.0],
    }
    rows = [(k, v) for k, vs in cases.items() for v in vs] + [("one", None), ("one", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in exact_quantiles_grouped(df, "v", (0.0, 0.25, 0.5, 1.0), ["g"]).collect()}
    small = {r.g: r for r in exact_quantiles(df, "v", (0.0, 0.25, 0.5, 1.0), ["g"], bins=5, rows=4).collect()}
    assert got == small and set(got) == set(cases)
    for k, vs in cases.items():
        vs = sorted(vs)
        for q, at in (("q_0", 0), ("q_25", 0.25 * (len(vs) - 1)), ("q_50", 0.5 * (len(vs) - 1)), ("q_100", len(vs) - 1)):
            lo, hi = vs[int(np.floor(at))], vs[int(np.ceil(at))]
            want = lo + (hi - lo) * (at - np.floor(at))
            assert got[k][q] == want or abs(got[k][q] - want) <= 1e-12 * abs(want)


def test_row_numbers_in_ranges_match_row_number(spark):
    rows = [(None if i % 11 == 0 else (5 if i % 3 == 0 else i % 7), (i * 37) % 101, float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b int, v double").repartition(4)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("a", "b", "v")) - 1)
    for ranges in (None, 1, 2, 9, 64):
        got = row_numbers(df, ["a", "b", "v"], "idx", ranges=ranges)
        assert {r.v: r.idx for r in got.collect()} == {r.v: r.rn for r in ref.collect()}
    assert row_numbers(df.limit(0), ["a"], "idx").collect() == []
    plan = row_numbers(df, ["a", "b", "v"], "idx", ranges=9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and "Scan ExistingRDD" in plan
