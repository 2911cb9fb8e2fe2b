import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandkit.operators.features import daily_demand
from demandkit.streaming import demand_stream as S


def test_stream_daily_equals_batch_closed_days(spark, small_dir):
    streamed = S.stream_daily_demand(spark, small_dir)
    li = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    mx = li.agg(F.max(F.col("l_shipdate").cast("date"))).first()[0]
    batch = daily_demand(li.select(F.col("l_shipdate").cast("date").alias("date"),
                                   F.col("l_quantity").alias("qty")))
    closed = batch.where(F.col("date") <= F.lit(mx - dt.timedelta(days=3)))
    a = sorted(tuple(r) for r in streamed.collect())
    b = sorted(tuple(r) for r in closed.collect())
    assert a == b and len(a) > 0


def test_nightly_refresh_equals_batch(spark, small_dir):
    from demandkit.operators.features import demand_features
    from demandkit.sources.tables import read_table
    li = read_table(spark, small_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_quantity").alias("qty"))
    a = sorted(tuple(r) for r in S.nightly_scoring(spark, small_dir).collect())
    b = sorted(tuple(r) for r in demand_features(li).collect())
    assert len(a) == len(b)
    assert all(abs(x - y) < 1e-9 if isinstance(x, float) else x == y
               for ra, rb in zip(a, b) for x, y in zip(ra, rb))


def test_drift_streak(spark):
    maes = [5, 4, 5, 6, 7, 3, 4]
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(m)) for i, m in enumerate(maes)],
                               "date date, mae double")
    out = [(r.streak, r.alert) for r in S.drift_monitor(df).orderBy("date").collect()]
    assert [s for s, _ in out] == [0, 0, 1, 2, 3, 0, 1]
    assert [a for _, a in out] == [False, False, False, False, True, False, False]


def test_retrain_gate(spark):
    m = spark.createDataFrame([("cur", "test", 0.80, 6.0), ("new", "test", 0.82, 5.9), ("bad", "test", 0.85, 6.5)],
                              "model string, split string, r2 double, mae double")
    assert S.retrain_gate(m, "cur", "new").first().accept is True
    assert S.retrain_gate(m, "cur", "bad").first().accept is False


def test_nightly_insights_equal_batch_recommendations(spark, small_dir):
    from demandkit.plans.context import Tables
    batch = sorted(tuple(r) for r in Tables(spark, small_dir).recs.collect())
    incremental = sorted(tuple(r) for r in S.nightly_insights(spark, small_dir).collect())
    assert batch == incremental and len(batch) > 0


def test_stream_reads_a_folder_of_part_files(spark, small_dir, tmp_path):
    # A table laid out as a folder of part files, as on a cluster.
    li = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    li.repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = S.file_stream(spark, str(tmp_path), "lineitem", S.LINEITEM_SCHEMA)
    out = S.run_available(rows.select("l_orderkey"), "folder")
    assert out.count() == li.count()


def test_nightly_insights_overwrites_output(spark, small_dir, tmp_path):
    out = str(tmp_path / "recs")
    first = S.nightly_insights(spark, small_dir, output=out).count()
    second = S.nightly_insights(spark, small_dir, output=out).count()
    assert first == second > 0


def test_watermark_counts_late_rows_and_drops_closed_days(spark, tmp_path):
    import time

    def rows(days):
        return [(i, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", dt.datetime(2024, 1, d, 12)) for i, d in enumerate(days)]

    # Three files, one micro-batch each (in modification-time order):
    # Jan 1-10; then Jan 20 plus a late row for Jan 9 (still within the
    # 2-day watermark of that batch); then a row for Jan 2, whose day was
    # closed and emitted by the previous batch.
    folder = tmp_path / "flat" / "lineitem.parquet"
    folder.mkdir(parents=True)
    for i, days in enumerate([range(1, 11), [20, 9], [2]]):
        out = tmp_path / f"b{i}"
        spark.createDataFrame(rows(days), S.LINEITEM_SCHEMA).coalesce(1).write.parquet(str(out))
        (folder / f"part-{i}.parquet").write_bytes(next(out.glob("*.parquet")).read_bytes())
        time.sleep(1.1)
    with pytest.raises(S.LateRows):
        S.stream_daily_demand(spark, str(tmp_path / "flat"), max_files=1)
    got = {r.date.day: r.daily_rows for r in S.stream_daily_demand(
        spark, str(tmp_path / "flat"), late_rows="drop", max_files=1).collect()}
    assert got[9] == 2          # late, within the watermark: counted
    assert got[2] == 1          # day already closed: the late row is dropped
    assert 20 not in got        # the last day is still open
    assert sorted(got) == list(range(1, 11))


def test_daily_error_accepts_prediction_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 3.0, 1.0), (dt.date(2024, 1, 1), 5.0, 6.0)],
                               "date date, qty double, p double")
    assert S.daily_error(df, prediction="p").first().mae == 1.5


def _shuffled(spark, small_dir, folder, table, order):
    """The table as four files whose rows are in no order of time."""
    df = spark.read.parquet(f"{small_dir}/{table}.parquet")
    df.repartition(4, F.pmod(F.hash(order), F.lit(4))).write.parquet(f"{folder}/{table}.parquet")


@pytest.mark.parametrize("name,table,key", [("stream_daily_demand", "lineitem", "l_orderkey"),
                                            ("stream_rolling_sales", "lineitem", "l_orderkey"),
                                            ("stream_rolling_demand", "events", "event_id")])
def test_files_out_of_time_order_lose_nothing(spark, small_dir, tmp_path, name, table, key):
    _shuffled(spark, small_dir, tmp_path, table, key)
    one = sorted(tuple(r) for r in getattr(S, name)(spark, small_dir).collect())
    four = sorted(tuple(r) for r in getattr(S, name)(spark, str(tmp_path)).collect())
    assert len(one) == len(four) > 0
    assert all(abs(x - y) < 1e-6 if isinstance(x, float) else x == y
               for a, b in zip(one, four) for x, y in zip(a, b))


def test_nightly_jobs_resume_and_read_new_files_only(spark, small_dir, tmp_path, monkeypatch):
    import shutil
    data, folder = tmp_path / "data", tmp_path / "data" / "lineitem.parquet"
    li = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    li.repartition(2).write.parquet(str(tmp_path / "halves"))
    files = sorted((tmp_path / "halves").glob("*.parquet"))
    folder.mkdir(parents=True)
    for name in ("part", "supplier", "nation"):
        shutil.copy(f"{small_dir}/{name}.parquet", data / f"{name}.parquet")
    sizes = []
    add = S.EpochState.add
    monkeypatch.setattr(S.EpochState, "add", lambda self, b, e: (sizes.append(
        b.agg(F.sum("n" if "n" in b.columns else "daily_rows")).first()[0]), add(self, b, e))[1])
    monkeypatch.setattr(S, "COMPACT_EPOCHS", 1)
    for f in files:
        shutil.copy(f, folder / f.name)
        scored = S.nightly_scoring(spark, str(data), state_dir=str(tmp_path / "state"))
        recs = S.nightly_insights(spark, str(data), state_dir=str(tmp_path / "pairs"))
    assert len(sizes) == 4 and sum(sizes) == 2 * li.count()  # each file once in each job
    assert (tmp_path / "state" / "daily_state" / "snapshots").exists()
    whole = sorted(tuple(r) for r in S.nightly_scoring(spark, small_dir).select("date", "daily_total_demand").collect())
    assert sorted(tuple(r) for r in scored.select("date", "daily_total_demand").collect()) == whole
    before = len(sizes)
    again = S.nightly_insights(spark, str(data), state_dir=str(tmp_path / "pairs"))
    assert len(sizes) == before  # no new file, nothing read
    want = sorted(tuple(r) for r in S.nightly_insights(spark, small_dir).collect())
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in recs.collect()) == want


def _sales(spark, out, days, hour=12):
    rows = [(i, 1, 1, 1, 1.0 + i, 1.0, 0.0, 0.0, "N", "O", dt.datetime(2024, 1, d, hour)) for i, d in enumerate(days)]
    spark.createDataFrame(rows, S.LINEITEM_SCHEMA).coalesce(1).write.parquet(str(out))
    return next(out.glob("*.parquet"))


@pytest.mark.parametrize("name", ["stream_daily_demand", "stream_rolling_sales"])
def test_streams_resume_and_late_rows_correct_their_day(spark, tmp_path, name):
    import shutil
    folder = tmp_path / "flat" / "lineitem.parquet"
    folder.mkdir(parents=True)
    run = lambda: sorted(tuple(r) for r in getattr(S, name)(spark, str(tmp_path / "flat"), state_dir=str(tmp_path / "state")).collect())
    results = []
    for i, days in enumerate([range(1, 11), [20, 9], [2, 21]]):
        shutil.copy(_sales(spark, tmp_path / f"b{i}", days), folder / f"part-{i}.parquet")
        results.append(run())
    assert run() == results[-1]  # no new file: the same state
    rows = spark.read.schema(S.LINEITEM_SCHEMA).parquet(str(folder))
    fresh = sorted(tuple(r) for r in getattr(S, name)(spark, str(tmp_path / "flat"), state_dir=str(tmp_path / "other")).collect())
    assert results[-1] == fresh and rows.count() == 14  # late rows count as if they had been in time
    late = {(r.epoch, r.date.day): r.n for r in S.late_rows(spark, str(tmp_path / "state")).collect()}
    allowed = 2 if name == "stream_daily_demand" else 1
    assert late[2, 2] == 1 and ((1, 9) in late) == (allowed == 0 or 10 <= 10 - allowed)
    if name == "stream_daily_demand":
        day2 = {r[0].day: r[2] for r in results[0]}[2], {r[0].day: r[2] for r in results[-1]}[2]
        assert day2 == (1, 2)


def test_state_folders_of_old_epochs_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "COMPACT_EPOCHS", 1)
    state = S.EpochState(spark, str(tmp_path / "s"), ["k"], ["v"])
    for epoch in range(9):
        state.add(spark.createDataFrame([(epoch % 2, 1.0)], "k int, v double"), epoch)
        state.compact()
        assert sum(r.v for r in state.read().collect()) == epoch + 1
    assert len(list((tmp_path / "s" / "snapshots").iterdir())) <= 2 and len(list((tmp_path / "s" / "epochs").iterdir())) <= 5


def test_champion_changes_only_through_the_gate(spark, tmp_path):
    from demandkit.operators.model_store import ModelStore
    store, saved = ModelStore(spark, str(tmp_path / "store")), []

    def offer(r2, mae, **kw):
        return S.promote_if_better(store, "demand", {"model": f"m{r2}", "r2": r2, "mae": mae}, lambda: saved.append(r2), **kw)

    assert offer(0.8, 6.0)["accept"] and store.champion("demand")["version"] == 1
    rejected = offer(0.79, 5.0)
    assert not rejected["accept"] and rejected["champion"]["model"] == "m0.8" and saved == [0.8]
    assert not offer(0.81, 6.5)["accept"]
    assert offer(0.81, 6.5, mae_tolerance=0.1)["champion"]["version"] == 2 and saved == [0.8, 0.81]
    # Another session promotes in between: the challenger is compared again with the new champion.
    def race():
        saved.append("race")
        store.promote("demand", {"model": "other", "r2": 0.95, "mae": 1.0}, store.champion("demand"))
    out = S.promote_if_better(store, "demand", {"model": "slow", "r2": 0.9, "mae": 2.0}, race)
    assert not out["accept"] and out["champion"]["model"] == "other" and store.champion("demand")["version"] == 3
