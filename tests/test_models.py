import pytest
import numpy as np
from pyspark.sql import functions as F

from demandkit.operators import models as M
from demandkit.operators.ordering import contiguous_folds

FEATS = ["x1", "x2"]


def _planted(spark, n=400):
    rng = np.random.default_rng(0)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 3 * x1 - 2 * x2 + rng.normal(scale=0.1, size=n)
    return spark.createDataFrame([(i, float(a), float(b), float(c), "train") for i, (a, b, c) in enumerate(zip(x1, x2, y))],
                                 "id long, x1 double, x2 double, qty double, split string")


def test_linear_recovers_plant_and_beats_mean(spark):
    df = _planted(spark)
    m = M.fit(df, M.linear(), FEATS)
    coefs = dict(M.coefficients(m, FEATS))
    assert abs(coefs["x1"] - 3) < 0.05 and abs(coefs["x2"] + 2) < 0.05
    p = M.predict(m, df).select(F.col("qty").alias("actual"), "prediction")
    from demandkit.operators.evaluate import regression_metrics
    r2 = regression_metrics(p.withColumn("model", F.lit("l")).withColumn("split", F.lit("t"))).first().r2
    assert r2 > 0.99


def test_sample_params_seeded_and_distinct():
    a = M.sample_params(M.FOREST_SPACE, 30, 42)
    assert a == M.sample_params(M.FOREST_SPACE, 30, 42)
    assert len({tuple(sorted((k, str(v)) for k, v in c.items())) for c in a}) == 30


def test_random_search_and_cv_small(spark):
    df = contiguous_folds(_planted(spark, 200), ["id"], 3)
    space = {"n_estimators": [5, 10], "max_depth": [2, 3], "min_samples_leaf": [1],
             "max_features": ["sqrt"]}
    res = M.random_search(df, "forest", space, 2, features=FEATS, parallelism=2)
    assert len(res.avg_mae) == 2 and res.best_params in res.candidates
    cv = M.cross_validate(df, M.linear(), features=FEATS)
    assert cv.count() == 3 and cv.where(F.col("r2") < 0.9).count() == 0


def test_forest_is_deterministic(spark):
    df = _planted(spark, 200)
    imp1 = M.importances(M.fit(df, M.forest(n_estimators=5, max_depth=3), FEATS), FEATS)
    imp2 = M.importances(M.fit(df, M.forest(n_estimators=5, max_depth=3), FEATS), FEATS)
    assert imp1 == imp2 and abs(sum(v for _, v in imp1) - 1) < 1e-9


def test_saved_artifacts_score_raw_rows_like_the_fitted_model(spark, small_dir, tmp_path):
    from demandkit.plans.context import KEY_COLS, Tables
    t = Tables(spark, small_dir)
    name = "Linear Regression"
    loaded = t.artifacts(name, str(tmp_path / "model"))
    assert loaded.meta["name"] == name and loaded.meta["feature_columns"] == M.FEATURES
    raw = t.eng_model.where(F.col("split") == "test")
    got = {tuple(r[k] for k in KEY_COLS): r for r in loaded.score(raw).collect()}
    want = M.predict(t.model(name), t.prepared.where(F.col("split") == "test")).select(*KEY_COLS, "prediction").collect()
    assert len(got) == len(want) > 0
    assert all(abs(got[tuple(r[k] for k in KEY_COLS)].prediction - r.prediction) < 1e-9 for r in want)
    own = {tuple(r[k] for k in KEY_COLS): r.unit_price for r in raw.select(*KEY_COLS, "unit_price").collect()}
    assert all(abs(r.unit_price - own[k]) < 1e-6 for k, r in got.items())
    t.release()


def test_feature_shares_keep_their_point():
    assert M._subset(1.0) == "1.0" and M._subset(0.5) == "0.5" and M._subset("sqrt") == "sqrt"
    with pytest.raises(TypeError):
        M.forest(min_samples_split=5)


def test_store_fits_once_and_publishes_whole(spark, tmp_path):
    from demandkit.operators.model_store import ModelStore
    df, fits = _planted(spark, 100), []

    def fit():
        fits.append(1)
        return M.fit(df, M.linear(), FEATS)

    content = {"files": [("a", 1, 2)], "settings": {"x": None}}
    one = ModelStore(spark, str(tmp_path / "s")).fitted(content, fit)
    two = ModelStore(spark, str(tmp_path / "s")).fitted(dict(reversed(content.items())), fit)  # another session
    assert len(fits) == 1 and M.coefficients(one, FEATS) == M.coefficients(two, FEATS)
    ModelStore(spark, str(tmp_path / "s")).fitted({**content, "files": [("a", 1, 3)]}, fit)
    assert len(fits) == 2  # changed input, another address
    store = ModelStore(spark, str(tmp_path / "s"))
    assert store.create("x/y.json", {"v": 1}) and not store.create("x/y.json", {"v": 2}) and store.read("x/y.json") == {"v": 1}
    assert store.names("x") == ["y.json"] and store.read("x/none.json") is None and store.champion("nobody") is None


def test_search_of_both_kinds_finishes_and_resumes(spark, tmp_path, monkeypatch):
    """12 x 5 fits of each kind from the whole spaces (with a hundredth of the trees and less depth) on a small frame."""
    from demandkit.operators import search
    from demandkit.operators.model_store import ModelStore
    train = contiguous_folds(_planted(spark, 60), ["id"], 5).coalesce(1).cache()
    store, fits, real = ModelStore(spark, str(tmp_path / "s")), [], search.fit
    monkeypatch.setattr(search, "fit", lambda *a: fits.append(1) or real(*a))
    for kind, space, n in (("forest", M.FOREST_SPACE, 30), ("boosted", M.BOOSTED_SPACE, 40)):
        small = {**space, "n_estimators": [max(1, x // 100) for x in space["n_estimators"]], "max_depth": [2, 3]}
        args = (train, {"frame": "planted"}, kind, small, min(n, 12), store)
        kw = dict(features=FEATS, parallelism=4)
        del fits[:]
        part = search.search_table(*args, **kw, most=7)
        assert part.count() == 7 == len(fits)
        table = search.search_table(*args, **kw)  # a new driver goes on
        whole = min(n, 12) * 5
        assert table.count() == whole == len(fits)
        again = search.search_table(*args, **kw)
        assert len(fits) == whole and sorted(map(tuple, again.collect())) == sorted(map(tuple, table.collect()))
        ranks = search.ranked(table).orderBy("rank").collect()
        assert [r["rank"] for r in ranks] == list(range(1, min(n, 12) + 1)) and all(r.folds == 5 for r in ranks)
        assert ranks[0].mae == min(r.mae for r in ranks) and search.best_params(table) in M.sample_params(small, min(n, 12))
        est = M.ESTIMATORS[kind](**search.best_params(table))
        want = M.cross_validate(train, est, features=FEATS).agg(F.avg("mae")).first()[0]
        assert abs(want - ranks[0].mae) < 1e-9


def test_scored_rows_keep_their_own_columns(spark, small_dir, tmp_path):
    from demandkit.plans.context import Tables
    t = Tables(spark, small_dir)
    loaded = t.artifacts("Linear Regression", str(tmp_path / "m"))
    raw = t.eng_model.where(F.col("split") == "test")
    back = loaded.score(raw)
    assert back.columns == [*raw.columns, "prediction"] and back.drop("prediction").exceptAll(raw).isEmpty()
    t.release()


def test_training_frame_takes_a_partition_a_core_until_these_are_full(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [M.training_partitions(n, 12) for n in (0, 20_001, 2_850_000, 28_500_000, 171_000_000)] == [1, 2, 12, 29, 171]
    many = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:  # not as many as the session shuffles
        frame = M.persist_training(spark.range(cores * 200).withColumn("k", F.col("id") % 7), ["id"], rows=100)
        assert frame.rdd.getNumPartitions() == cores
        frame.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", many)


def test_only_deep_trees_cache_node_ids(spark):
    """An execution setting: the trees are the same."""
    assert not M.boosted().getCacheNodeIds() and M.forest().getCacheNodeIds()
    df = _planted(spark, 300).coalesce(2)
    small = dict(n_estimators=4, max_depth=3)
    for est in (M.boosted(**small), M.forest(**small)):
        assert not est.getCacheNodeIds()
        plain, cached = (M.fit(df, e, FEATS).stages[-1].toDebugString.split("\n", 1)[1] for e in (est, est.copy().setCacheNodeIds(True)))
        assert plain == cached


def test_kept_rows_are_cut_by_their_number_not_by_the_scan(spark, small_dir, monkeypatch):
    from demandkit.plans.context import Tables
    monkeypatch.setattr(M, "training_partitions", lambda *a: 5)
    t = Tables(spark, small_dir)
    assert t.eng_model.rdd.getNumPartitions() == 5
    t.release()


def test_missing_models_are_fitted_at_the_same_time(spark, small_dir, tmp_path, monkeypatch):
    """Both tree fits are under way together, their models are those of single fits, and each is fitted once."""
    import threading

    from demandkit.plans import catalog
    from demandkit.plans.context import Tables
    small = {"Linear Regression": ("linear", {}), "Random Forest": ("forest", dict(n_estimators=3, max_depth=4)),
             "Boosted Trees": ("boosted", dict(n_estimators=3, max_depth=2))}
    monkeypatch.setattr(M, "MODELS", small)
    spark.conf.set("spark.demandkit.models", str(tmp_path / "store"))
    real, meet, fits = M.fit, threading.Barrier(2, timeout=60), []

    def fit(train, est, *a):
        fits.append(type(est).__name__)
        meet.wait()  # broken if the second fit waits for the end of the first
        return real(train, est, *a)

    monkeypatch.setattr(M, "fit", fit)
    try:
        t = Tables(spark, small_dir)
        assert catalog._importances(t).count() == 2 * len(M.FEATURES)
        assert sorted(fits) == ["GBTRegressor", "RandomForestRegressor"]
        monkeypatch.setattr(M, "fit", real)
        for name, (kind, settings) in list(small.items())[1:]:
            one = real(t.train, M.ESTIMATORS[kind](**settings))
            assert one.stages[-1].toDebugString.split("\n", 1)[1] == t.model(name).stages[-1].toDebugString.split("\n", 1)[1]
        assert t.best_fitted() in small
        t.release()
    finally:
        spark.conf.unset("spark.demandkit.models")


def test_rows_of_a_day_are_kept_side_by_side(spark, monkeypatch):
    """Trees pass over the rows day by day; a day of many rows is cut, and no row is lost."""
    monkeypatch.setattr(M, "NEAR_ROWS", 50)
    day = F.when(F.col("id") < 1000, F.lit(7)).when(F.col("id") >= 1010, 100 + F.col("id") % 200)  # ten rows without one
    df = spark.range(4000).withColumn("day", day).withColumn("x", F.col("id") * 2)
    frame = M.persist_training(df, ["id"], rows=1000, near="day")
    assert frame.columns == df.columns
    parts = [[tuple(r) for r in p] for p in frame.rdd.glom().collect()]
    assert len(parts) == M.training_partitions(4000, spark.sparkContext.defaultParallelism, 1000)
    assert sorted(r for p in parts for r in p) == sorted(map(tuple, df.collect()))
    for p in parts:
        assert p == sorted(p, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    holding = [{r[1] for r in p} for p in parts]
    assert all(sum(d in h for h in holding) == 1 for d in [None, *range(100, 300)])
    assert sum(7 in h for h in holding) == len(parts)
    frame.unpersist()
    empty = M.persist_training(df.limit(0), ["id"], near="day")
    assert empty.count() == 0
    empty.unpersist()


def test_prepared_rows_lie_by_date(spark, small_dir):
    from demandkit.plans.context import KEY_COLS, Tables
    t = Tables(spark, small_dir)
    parts = [[tuple(r) for r in p] for p in t.prepared.select(*KEY_COLS).rdd.glom().collect()]
    assert all(p == sorted(p) for p in parts) and sum(map(len, parts)) == t.eng_model.count() > 0
    t.release()


def test_tasks_of_an_executor_hold_bounded_node_statistics():
    assert M.forest().getMaxMemoryInMB() == M.boosted().getMaxMemoryInMB() <= 512


def test_registered_search_takes_all_rows_the_whole_spaces_and_every_candidate(spark, small_dir, tmp_path, monkeypatch):
    from demandkit.operators import search
    from demandkit.plans import catalog
    from demandkit.plans.context import KEY_COLS, Tables
    spark.conf.set("spark.demandkit.models", str(tmp_path / "store"))
    asked, refits, real = {}, [], search.search_table

    def table(train, content, kind, space, n_iter, store, **kw):
        asked[kind] = (train, space, n_iter)
        few = {**space, "n_estimators": [2], "max_depth": [2]}
        return real(train, content, kind, few, 2, store, most=4, **kw)  # the fits themselves are another test's

    monkeypatch.setattr(search, "search_table", table)
    monkeypatch.setattr(Tables, "tuned", lambda self, kind, settings: refits.append((kind, settings)))
    try:
        t = Tables(spark, small_dir)
        rows = catalog.REGISTRY["random_search"][0](t).collect()
        assert {k: v[1:] for k, v in asked.items()} == {"forest": (M.FOREST_SPACE, 30), "boosted": (M.BOOSTED_SPACE, 40)}
        assert [k for k, _ in refits] == ["forest", "boosted"] and all(r["kind"] in asked for r in rows)
        keys = sorted(map(tuple, t.train.select(*KEY_COLS).collect()))
        for train, *_ in asked.values():
            folds = {tuple(r[k] for k in KEY_COLS): r["fold"] for r in train.select(*KEY_COLS, "fold").collect()}
            assert sorted(folds) == keys and len(keys) > 1000  # every training row, not a row a day
            assert [folds[k] for k in keys] == sorted(folds.values()) and set(folds.values()) == {1, 2, 3, 4, 5}
        t.release()
    finally:
        spark.conf.unset("spark.demandkit.models")


def test_best_of_a_search_is_fitted_on_all_training_rows_and_kept(spark, small_dir, tmp_path):
    from demandkit.plans.context import Tables
    spark.conf.set("spark.demandkit.models", str(tmp_path / "store"))
    try:
        t, settings = Tables(spark, small_dir), dict(n_estimators=2, max_depth=2, min_samples_leaf=1, max_features="sqrt")
        trees = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in (t.tuned("forest", settings), M.fit(t.train, M.forest(**settings)))]
        assert trees[0] == trees[1] and len(t.store.names("models")) == 1
        t.release()
    finally:
        spark.conf.unset("spark.demandkit.models")


def test_fits_of_a_search_together_hold_bounded_rows():
    from demandkit.operators import search
    assert [search.fits_at_once(n) for n in (0, 50_000, 700_000, 2_850_000)] == [4, 4, 2, 1]


def test_linear_fits_and_folds_keep_no_rows(spark, small_dir, tmp_path):
    """Neither shuffled nor persisted copies of the engineered rows; coefficients and folds are those of the kept rows."""
    from demandkit.plans import catalog
    from demandkit.plans.context import KEY_COLS, Tables
    spark.conf.set("spark.demandkit.models", str(tmp_path / "store"))
    try:
        held = spark.sparkContext._jsc.getPersistentRDDs().size()
        t = Tables(spark, small_dir)
        coefs = {r["feature"]: r["coefficient"] for r in catalog.REGISTRY["coefficient_table"][0](t).collect()}
        cv = catalog.REGISTRY["cross_validate"][0](t).collect()
        assert not {"eng_model", "prepared"} & set(t.__dict__) and spark.sparkContext._jsc.getPersistentRDDs().size() == held
        plan = t.fit_rows("linear", *KEY_COLS)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "InMemoryTableScan" not in plan
        want = dict(M.coefficients(M.fit(t.train, M.linear())))
        assert set(coefs) == set(M.FEATURES) and all(abs(want[f] - c) < 1e-3 for f, c in coefs.items())
        folds = contiguous_folds(t.train, KEY_COLS, 5)
        mae = [r["mae"] for r in M.cross_validate(folds, M.linear()).orderBy("fold").collect()]
        assert all(abs(a - b) < 1e-3 for a, b in zip(mae, cv[0]["mae_folds"], strict=True))
        t.release()
    finally:
        spark.conf.unset("spark.demandkit.models")


def test_rows_made_from_written_sales_are_the_engineered_ones(spark, small_dir):
    from demandkit.operators import features as feat
    from demandkit.operators import prepare as prep
    from demandkit.plans.context import FEATURE_SOURCES, KEY_COLS, Tables
    t = Tables(spark, small_dir)
    daily = feat.daily_features(t.sales_of("date", "qty"), exclude_current=True)
    eng = t.eng_of(*KEY_COLS, *FEATURE_SOURCES, daily=daily.checkpoint())
    train = eng.where(F.col("split") == "train")
    codes = prep.label_encode(eng, prep.CATEGORICAL_COLS, mappings=prep.encoder_mappings(train, prep.CATEGORICAL_COLS), unseen=-1)
    want = prep.standard_scale(codes, params=prep.scaler_params(train))
    cols = [*KEY_COLS, *prep.FEATURES, "qty", "split"]
    got = sorted(map(tuple, t.encoded_rows(*KEY_COLS).select(*cols).collect()))
    want = sorted(map(tuple, want.select(*cols).collect()))
    assert len(got) == len(want) > 1000
    for a, b in zip(got, want):
        assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(a, b)), (a, b)
    t.release()


def test_what_a_day_shares_is_not_shuffled(spark, small_dir, monkeypatch):
    """The dealt rows are the sale's own columns; calendar and daily features come after, by broadcast."""
    from demandkit.operators import prepare as prep
    from demandkit.plans.context import KEY_COLS, Tables
    real, dealt = M.persist_training, []
    monkeypatch.setattr(M, "persist_training", lambda df, *a, **k: dealt.append(set(df.columns)) or real(df, *a, **k))
    t = Tables(spark, small_dir)
    frame = t.prepared
    assert len(dealt) == 1 and not dealt[0] & {*prep.CALENDAR_COLS, *prep.LAG_COLS} and set(KEY_COLS) < dealt[0]
    assert set(frame.columns) == {*KEY_COLS, *prep.FEATURES, prep.TARGET, "split"}
    t.release()
