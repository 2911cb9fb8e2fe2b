from demandkit.operators import profile as prof

ROWS = [("a", 1, 10.0), ("a", 1, 10.0), ("b", None, 20.0), ("c", 3, None)]
SCHEMA = "k string, n int, x double"


def test_missing_duplicates_nunique(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    miss = {r.column_name: r.n_missing for r in prof.profile_missing(df).collect()}
    assert miss == {"k": 0, "n": 1, "x": 1, "__total__": 2}
    assert prof.profile_duplicates(df).first().duplicate_rows == 1
    uniq = {r.column_name: r.n_unique for r in prof.profile_nunique(df).collect()}
    assert uniq == {"k": 3, "n": 2, "x": 2}


def test_types_shape_and_dependency(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    types = {r.column_name: (r.dtype, r.non_null) for r in prof.profile_types(df).collect()}
    assert types == {"k": ("string", 4), "n": ("int", 3), "x": ("double", 3)}
    shape = prof.profile_shape(df).first()
    assert (shape.n_rows, shape.n_cols) == (4, 3)
    dep = spark.createDataFrame([("d1", "x"), ("d1", "x"), ("d2", "y"), ("d2", "z")], "dealer string, dealer_location string")
    v = prof.validate_dependency(dep).first()
    assert (v.n_keys, v.n_violations, v.consistent) == (2, 1, False)
    m = {r.dealer: r.dealer_location for r in prof.dependency_map(dep).collect()}
    assert m == {"d1": "x", "d2": "y"}


def test_describe_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 4.0, 8.0, 16.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = prof.profile_describe(df, ["x"]).first()
    d = pd.Series(vals).describe()
    assert (r["count"], r.mean, r.min, r.p25, r.p50, r.p75, r.max) == (
        d["count"], d["mean"], d["min"], d["25%"], d["50%"], d["75%"], d["max"])
    assert abs(r["std"] - d["std"]) < 1e-12
