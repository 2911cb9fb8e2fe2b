import numpy as np
from pyspark.sql import functions as F

from demandkit.operators import evaluate as ev


def test_metrics_match_formulas(spark):
    y = np.array([0.0, 2.0, 4.0, 5.0, 10.0])
    p = np.array([1.0, 2.5, 3.0, 5.0, 7.0])
    df = spark.createDataFrame([("m", "test", float(a), float(b)) for a, b in zip(y, p)],
                               "model string, split string, actual double, prediction double")
    r = ev.regression_metrics(df).first()
    mae = np.mean(np.abs(y - p))
    rmse = np.sqrt(np.mean((y - p) ** 2))
    r2 = 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)
    mape = np.mean(np.abs((y - p) / np.where(y == 0, 1, y))) * 100
    assert (r.mae, r.rmse, r.r2, r.mape) == (round(mae, 4), round(rmse, 4), round(r2, 4), round(mape, 2))


def test_histogram_counts_and_last_bin(spark):
    vals = [0.0, 1.0, 2.5, 3.0, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = ev.histogram(df, "x", bins=4).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=4)
    assert [r["count"] for r in h] == list(counts)
    assert np.allclose([r.lo for r in h] + [h[-1].hi], edges)


def test_best_model_and_gap(spark):
    m = spark.createDataFrame([("a", "test", 0.5), ("b", "test", 0.7), ("a", "train", 0.6), ("b", "train", 0.9)],
                              "model string, split string, r2 double")
    assert ev.best_model(m).first().best_model == "b"
    g = {r.model: r.status for r in ev.overfit_gap(m).collect()}
    assert g == {"a": "Mild overfitting", "b": "Overfitting"}


def test_sample_rows_is_deterministic(spark):
    df = spark.range(1000).withColumn("k", F.col("id") * 7)
    a = [r.id for r in ev.sample_rows(df, ["id", "k"], 50, 42).collect()]
    b = [r.id for r in ev.sample_rows(df, ["id", "k"], 50, 42).collect()]
    assert a == b and len(set(a)) == 50


def test_describe_approx_option(spark):
    from demandkit.operators.profile import profile_describe
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    exact = profile_describe(df, ["x"]).first()
    approx = profile_describe(df, ["x"], approx_accuracy=10000).first()
    assert exact.p50 == 500.0 and abs(approx.p50 - 500.0) <= 1


def test_constant_target_and_constant_column(spark):
    rows = [("a", "test", 2.0, 2.0), ("a", "test", 2.0, 2.0), ("b", "test", 2.0, 1.0), ("b", "test", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "model string, split string, actual double, prediction double")
    r2 = {r.model: r.r2 for r in ev.regression_metrics(df).collect()}
    assert r2 == {"a": 1.0, "b": 0.0}
    h = ev.histogram(df, "actual", bins=4, density=True).orderBy("bin").collect()
    counts, edges = np.histogram([2.0] * 4, bins=4)
    assert [r["count"] for r in h] == list(counts)
    assert np.allclose([r.lo for r in h] + [h[-1].hi], edges) and abs(sum(r.density * 0.25 for r in h) - 1) < 1e-9


def test_nulls_and_ties(spark):
    df = spark.createDataFrame([("m", "test", 1.0, 1.5), ("m", "test", None, 3.0), ("m", "test", 3.0, 2.5)],
                               "model string, split string, actual double, prediction double")
    assert abs(ev.regression_metrics(df).first().r2 - 0.75) < 1e-9
    m = spark.createDataFrame([("b", "test", 0.7), ("a", "test", 0.7)], "model string, split string, r2 double")
    assert ev.best_model(m).first().best_model == "a"
    f = spark.createDataFrame([("x", "q", 0.1), ("x", "p", 0.1), ("x", "r", 0.2)], "model string, feature string, s double")
    assert [r.feature for r in ev.rank_within(f, "model", "s", "feature").orderBy("rank").collect()] == ["r", "p", "q"]


def test_correlation_takes_pairs_that_have_both_values(spark):
    import pandas as pd

    from demandkit.plans.catalog import corr_long
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)) + [0, 2000, 5], columns=list("abc"))
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "c"] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.to_numpy()]
    got = {(r.feature_a, r.feature_b): r["corr"] for r in corr_long(
        spark.createDataFrame(rows, "a double, b double, c double").repartition(4), list("abc")).collect()}
    want = pdf.corr()
    assert got.keys() == {("a", "b"), ("a", "c"), ("b", "c")}
    assert all(abs(v - want.loc[k[0], k[1]]) < 1e-9 for k, v in got.items())


def test_correlation_keeps_its_digits_and_skips_nulls(spark):
    """Means of 1e9 with a spread of one, nulls in either column, a constant column."""
    import numpy as np

    from demandkit.plans.catalog import corr_long
    rng = np.random.default_rng(3)
    a = rng.normal(size=500)
    data = {"a": a, "b": 1e9 + a + rng.normal(size=500), "c": -1e9 + rng.normal(size=500), "d": np.full(500, 3.3), "e": rng.normal(size=500) - a}
    rows = [[None if (name == "e" and i % 7 == 0) or (name == "a" and i % 11 == 3) else float(v[i]) for name, v in data.items()] + [None]
            for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(6)
    got = {(r.feature_a, r.feature_b): r["corr"] for r in corr_long(df, list("abcdef")).collect()}
    assert len(got) == 15
    for (x, y), value in got.items():
        if "d" in (x, y) or "f" in (x, y):
            assert value is None
            continue
        i, j = "abcde".index(x), "abcde".index(y)
        both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
        assert abs(value - np.corrcoef(both.T)[0, 1]) < 1e-7
