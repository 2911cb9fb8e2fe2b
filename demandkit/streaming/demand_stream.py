"""Structured Streaming operators: closed daily demand, rolling demand,
incremental nightly refresh, drift monitoring and the retrain gate.

Streams read the Parquet folders as file sources (new files = new data) and
run with ``trigger(availableNow=True)``: the backlog is one micro-batch, then
the query stops, as a nightly job would. A watermark moves between batches
only, so rows of a backlog are never late to each other, however they are
spread over files.

The nightly jobs take a ``state_dir``: with the same one, a later call resumes
the stream's checkpoint and reads new files only. Without one a job starts
from nothing, in a fresh folder under the shared checkpoint folder.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import features as feat
from ..operators import inventory as inv
from ..operators.ordering import row_index, running_sum
from ..session import ensure_checkpoint_dir, materialize

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


@contextmanager
def utc_session(spark: SparkSession):
    """Event times are zone-less (TIMESTAMP_NTZ) wall clocks; watermarks
    need TIMESTAMP. The conversion and the 1-day window boundaries are
    pinned to UTC while the (synchronous, availableNow) query runs; the
    caller's zone is restored afterwards. Outputs are dates and numbers,
    so they do not depend on the zone they are later read in."""
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "UTC")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _run_dir(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:8]}"


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def file_stream(spark: SparkSession, sf_dir: str, table: str, schema: T.StructType,
                max_files: int | None = None) -> DataFrame:
    """Stream the Parquet files of ``table``: a folder of part files (the
    usual layout, new files = new data) or a single ``<table>.parquet``
    file selected from its folder by name. ``max_files`` cuts the backlog
    into batches of so many files; a watermark then drops rows that are
    late between batches, so it is for files in time order only."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if _is_dir(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


class LateRows(RuntimeError):
    """Rows came after their window had been emitted."""


def dropped_rows(query) -> int:
    """Rows that the watermark dropped in the batches of a finished query."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


class DroppedRows(StreamingQueryListener):
    """Counts the rows that the watermark drops over all batches of one query; a query's own
    record of its progress goes back a hundred batches only."""

    def __init__(self):
        self.seen, self.query, self.by_query, self.done = False, None, {}, threading.Event()
        self.ended: set[str] = set()

    def follow(self, query: str) -> None:
        self.query = query
        if query in self.ended:
            self.done.set()

    @property
    def dropped(self) -> int:
        return self.by_query.get(self.query, 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        n = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        query = str(event.progress.id)
        self.by_query[query] = self.by_query.get(query, 0) + n

    def onQueryTerminated(self, event) -> None:
        self.seen = True
        self.ended.add(str(event.id))
        if self.query == str(event.id):
            self.done.set()


def run_available(df: DataFrame, name: str, mode: str = "append", partition_by=(), late_rows: str = "fail",
                  state_dir: str | None = None) -> DataFrame:
    """Drain the stream into a Parquet table (availableNow) and return the
    table as a batch DataFrame. Rows that the watermark drops raise
    :class:`LateRows` unless ``late_rows`` is "drop"."""
    spark = df.sparkSession
    base = state_dir or _run_dir(spark, name)
    w = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/out")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    counter = DroppedRows()
    spark.streams.addListener(counter)
    try:
        q = w.start()
        counter.follow(str(q.id))
        q.awaitTermination()
        counter.done.wait(10)
    finally:
        spark.streams.removeListener(counter)
    if late_rows != "drop" and (n := counter.dropped if counter.seen else dropped_rows(q)):
        raise LateRows(f"{name}: {n} rows (after aggregation) came after their window was emitted")
    return spark.read.parquet(f"{base}/out")


# --- state that later runs resume ----------------------------------------------

#: Epochs kept apart before they are folded into one snapshot.
COMPACT_EPOCHS = 16


class EpochState:
    """Partial sums (and largest values) by key, one folder per micro-batch, written
    idempotently (a batch that runs again overwrites its own folder). After
    ``COMPACT_EPOCHS`` of them the sums so far become a snapshot; readers take
    the newest complete snapshot and the epochs after it. What an older snapshot holds too is
    removed when the next one is complete, so a reader of the last state never loses its files."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sums: list[str], maxes: tuple[str, ...] = ()):
        self.spark, self.path, self.keys, self.sums, self.maxes = spark, path.rstrip("/"), keys, sums, list(maxes)

    def add(self, batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/epochs/{epoch}")

    def _folder(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the folders that were written to the end."""
        top, fs = self._folder(kind)
        if not fs.exists(top):
            return []
        done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        found = [s.getPath() for s in fs.listStatus(top)]
        return sorted(int(p.getName()) for p in found if fs.exists(done(p, "_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame | None:
        """The sums by key (of the epochs before ``before``), or None before any data came."""
        upto = max(self._numbers("snapshots"), default=-1)
        epochs = [n for n in self._numbers("epochs") if n > upto and (before is None or n < before)]
        paths = [f"{self.path}/snapshots/{upto}"] * (upto >= 0) + [f"{self.path}/epochs/{n}" for n in epochs]
        if not paths:
            return None
        columns = [*self.keys, *self.sums, *self.maxes]
        rows = self.spark.read.parquet(*paths).select(*columns)
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums], *[F.max(c).alias(c) for c in self.maxes])

    def compact(self) -> None:
        before = max(self._numbers("snapshots"), default=-1)
        epochs = [n for n in self._numbers("epochs") if n > before]
        if len(epochs) > COMPACT_EPOCHS:
            self.read().write.mode("overwrite").parquet(f"{self.path}/snapshots/{epochs[-1]}")
            old = [("epochs", n) for n in self._numbers("epochs") if n <= before]
            for kind, n in old + [("snapshots", n) for n in self._numbers("snapshots") if n < before]:
                path, fs = self._folder(f"{kind}/{n}")
                fs.delete(path, True)


def _fold_new_files(stream: DataFrame, state: EpochState, partials, base: str):
    """Fold the files that came since the last run into ``state``."""
    q = (stream.writeStream.foreachBatch(lambda batch, epoch: state.add(partials(batch), epoch))
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    state.compact()
    return q


# --- windows that are corrected by late rows ------------------------------------

_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def _micros(interval: str) -> int:
    number, unit = interval.split()
    return int(number) * _MICROS[unit.rstrip("s")]


def _ends(date: str, days: int):
    """Microseconds since 1970 (UTC) at which the window of ``days`` from ``date`` ends."""
    return (F.unix_date(date) + days).cast("long") * _MICROS["day"]


def _folded_days(stream: DataFrame, base: str, ts: str, value: str, late: str, keys: tuple[str, ...] = ()) -> tuple[DataFrame | None, int]:
    """Per-date sums of a stream that resumes in ``base``: the state (date, keys, total, n)
    and the watermark in microseconds, the latest time seen less ``late``.

    A batch's rows of days that the batches before it had closed are late. They go
    into the sums as all others do, so the day is right from then on, and beside
    it into ``base/late`` (:func:`late_rows`). Both are written by epoch: a batch that
    runs again after a lost driver replaces its own folders."""
    spark = stream.sparkSession
    state = EpochState(spark, f"{base}/days", ["date", *keys], ["total", "n"], ("latest",))

    def fold(batch: DataFrame, epoch: int) -> None:
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        sums = materialize(batch.groupBy(F.col(ts).cast("date").alias("date"), *keys).agg(
            F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"), F.max(at).alias("latest")))
        earlier = state.read(before=epoch)
        closed = earlier.agg(F.max("latest")).first()[0] if earlier is not None else None
        late_now = sums.where(_ends("date", 1) <= F.lit(closed - _micros(late))) if closed is not None else sums.limit(0)
        late_now.select("date", *keys, "total", "n").write.mode("overwrite").parquet(f"{base}/late/{epoch}")
        state.add(sums, epoch)

    with utc_session(spark):
        q = (stream.writeStream.foreachBatch(fold).option("checkpointLocation", f"{base}/_checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        state.compact()
    days = state.read()
    if days is None:
        return None, 0
    return days.drop("latest"), days.agg(F.max("latest")).first()[0] - _micros(late)


def late_rows(spark: SparkSession, state_dir: str) -> DataFrame:
    """epoch, date, [keys], total, n: sums of the rows that came after their day was closed, by
    the batch that brought them."""
    table = spark.read.parquet(f"{state_dir.rstrip('/')}/late/*")
    epoch = F.element_at(F.split(F.regexp_extract(F.input_file_name(), r"/late/(\d+)/", 1), "/"), 1).cast("long")
    return table.select(epoch.alias("epoch"), *table.columns)


def _sliding(days: DataFrame, watermark: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """window_start, [keys], total, n of the closed windows of seven days, advancing by a day."""
    starts = F.explode(F.sequence(F.date_sub("date", 6), F.col("date"))).alias("window_start")
    return (days.select(starts, *keys, "total", "n").where(_ends("window_start", 7) <= F.lit(watermark))
            .groupBy("window_start", *keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n")))


# --- S1: closed daily demand --------------------------------------------------

def stream_daily_demand(spark: SparkSession, sf_dir: str, late: str = "2 days", late_rows: str = "fail",
                        max_files: int | None = None, state_dir: str | None = None) -> DataFrame:
    """Sales stream -> tumbling 1-day totals, emitted once the watermark
    (max ship time - ``late``) closes the day. Rows for a day that an earlier
    batch has closed raise :class:`LateRows`, or go with
    ``late_rows="drop"``. With ``state_dir`` the next call reads new files only, and
    late rows correct their day instead (see :func:`late_rows` for them)."""
    if state_dir:
        li = file_stream(spark, sf_dir, "lineitem", LINEITEM_SCHEMA, max_files)
        days, watermark = _folded_days(li, state_dir.rstrip("/"), "l_shipdate", "l_quantity", late)
        if days is None:
            return spark.createDataFrame([], "date date, daily_total_demand double, daily_rows long")
        return days.where(_ends("date", 1) <= F.lit(watermark)).select(
            "date", F.col("total").alias("daily_total_demand"), F.col("n").alias("daily_rows"))
    with utc_session(spark):
        li = file_stream(spark, sf_dir, "lineitem", LINEITEM_SCHEMA, max_files)
        ts = F.col("l_shipdate").cast("timestamp")
        daily = (li.select(ts.alias("ts"), F.col("l_quantity").alias("qty"))
                   .withWatermark("ts", late)
                   .groupBy(F.window("ts", "1 day"))
                   .agg(F.sum("qty").alias("daily_total_demand"), F.count(F.lit(1)).alias("daily_rows")))
        out = daily.select(F.col("window.start").cast("date").alias("date"), "daily_total_demand",
                           "daily_rows")
        return run_available(out, "daily_demand", late_rows=late_rows)


# --- S2: trailing 7-day demand -----------------------------------------------

def stream_rolling_demand(spark: SparkSession, sf_dir: str, late: str = "1 day", state_dir: str | None = None) -> DataFrame:
    """Event stream -> sliding 7-day windows advancing by a day, per event
    type; each window is emitted once closed by the watermark. ``state_dir`` as in
    :func:`stream_daily_demand`."""
    if state_dir:
        days, watermark = _folded_days(file_stream(spark, sf_dir, "events", EVENTS_SCHEMA), state_dir.rstrip("/"), "ts", "value",
                                       late, ("event_type",))
        if days is None:
            return spark.createDataFrame([], "window_start date, event_type string, total_value double, n_events long")
        return _sliding(days, watermark, ("event_type",)).select(
            "window_start", "event_type", F.round("total", 6).alias("total_value"), F.col("n").alias("n_events"))
    with utc_session(spark):
        ev_ = file_stream(spark, sf_dir, "events", EVENTS_SCHEMA)
        roll = (ev_.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
                   .withWatermark("ts", late)
                   .groupBy(F.window("ts", "7 days", "1 day"), "event_type")
                   .agg(F.sum("value").alias("total_value"), F.count(F.lit(1)).alias("n_events")))
        out = roll.select(F.col("window.start").cast("date").alias("window_start"), "event_type",
                          F.round("total_value", 6).alias("total_value"), "n_events")
        return run_available(out, "rolling_demand")


def stream_rolling_sales(spark: SparkSession, sf_dir: str, late: str = "1 day", state_dir: str | None = None) -> DataFrame:
    """Sales stream -> trailing 7-day demand ending each day (sliding
    windows advancing by a day), emitted once closed by the watermark. ``state_dir`` as in
    :func:`stream_daily_demand`."""
    if state_dir:
        days, watermark = _folded_days(file_stream(spark, sf_dir, "lineitem", LINEITEM_SCHEMA), state_dir.rstrip("/"),
                                       "l_shipdate", "l_quantity", late)
        if days is None:
            return spark.createDataFrame([], "window_start date, demand_7d double, sales_7d long")
        return _sliding(days, watermark).select("window_start", F.col("total").alias("demand_7d"), F.col("n").alias("sales_7d"))
    with utc_session(spark):
        li = file_stream(spark, sf_dir, "lineitem", LINEITEM_SCHEMA)
        roll = (li.select(F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_quantity").alias("qty"))
                  .withWatermark("ts", late)
                  .groupBy(F.window("ts", "7 days", "1 day"))
                  .agg(F.sum("qty").alias("demand_7d"), F.count(F.lit(1)).alias("sales_7d")))
        out = roll.select(F.col("window.start").cast("date").alias("window_start"), "demand_7d", "sales_7d")
        return run_available(out, "rolling_sales")


# --- S3: incremental nightly refresh ------------------------------------------

def nightly_scoring(spark: SparkSession, sf_dir: str, state_dir: str | None = None) -> DataFrame:
    """Each night's new sales are reduced to per-date partial totals and added
    to a daily state (bounded by the calendar); the demand features are
    recomputed from the state only, never from the raw history. With the
    same ``state_dir`` the next call reads new files only."""
    base = (state_dir or _run_dir(spark, "nightly")).rstrip("/")
    sums = ["daily_total_demand", "daily_rows"]
    state = EpochState(spark, f"{base}/daily_state", ["date"], sums)

    def partials(batch: DataFrame) -> DataFrame:
        return (batch.select(F.col("l_shipdate").cast("date").alias("date"), F.col("l_quantity").alias("qty"))
                .groupBy("date").agg(F.sum("qty").alias("daily_total_demand"), F.count(F.lit(1)).alias("daily_rows")))

    _fold_new_files(file_stream(spark, sf_dir, "lineitem", LINEITEM_SCHEMA), state, partials, base)
    daily = state.read()
    if daily is None:
        daily = spark.createDataFrame([], "date date, daily_total_demand double, daily_rows long")
    return feat.drop_warmup(feat.lag_rolling(daily)).select(*feat.DAILY_COLS)


# --- S4: drift monitor ----------------------------------------------------------

def daily_error(engineered: DataFrame, model: str = "rolling", prediction=None,
                actual: str = "qty") -> DataFrame:
    """Per-date MAE of a per-sale forecast against the actual quantity,
    summed on exact decimals so the daily value does not depend on the
    order in which partitions are combined. ``prediction`` (a column, e.g.
    a fitted model's output) replaces the named baseline."""
    pred = prediction if prediction is not None else inv.baseline_prediction(model)
    if isinstance(pred, str):
        pred = F.col(pred)
    err = F.abs(F.col(actual) - pred).cast("decimal(38,18)")
    return engineered.groupBy("date").agg(F.avg(err).cast("double").alias("mae"))


def drift_monitor(daily_mae: DataFrame, alert_days: int = 3) -> DataFrame:
    """Previous day's error, rising flag and the length of the current run
    of consecutive rising days (gaps and islands, distributed: a row index,
    a self-join for the previous day and a prefix sum for island ids)."""
    ix = row_index(daily_mae, ["date"], "_i")
    prev = ix.select((F.col("_i") + 1).alias("_i"), F.col("mae").alias("prev_mae"))
    d = ix.join(prev, "_i", "left").withColumn(
        "rising", F.coalesce(F.col("mae") > F.col("prev_mae"), F.lit(False)))
    d = running_sum(d.withColumn("_reset", (~F.col("rising")).cast("long")), ["_i"], "_reset", "_island")
    starts = d.groupBy("_island").agg(F.min("_i").alias("_i0"))
    d = d.join(starts, "_island").withColumn(
        "streak", F.when(F.col("rising"), F.col("_i") - F.col("_i0")).otherwise(F.lit(0)).cast("int"))
    return d.select("date", "mae", "prev_mae", "rising", "streak",
                    (F.col("streak") >= alert_days).alias("alert"))


# --- S5: retrain gate -------------------------------------------------------------

def retrain_gate(metrics: DataFrame, current: str, candidate: str, split: str = "test",
                 r2_tolerance: float = 0.0, mae_tolerance: float = 0.0) -> DataFrame:
    """Accept the candidate only if its R^2 does not drop and its MAE does
    not rise (beyond the tolerances) against the current model."""
    m = metrics.where(F.col("split") == split)
    cur = m.where(F.col("model") == current).select(
        F.lit(current).alias("current"), F.col("r2").alias("current_r2"), F.col("mae").alias("current_mae"))
    cand = m.where(F.col("model") == candidate).select(
        F.lit(candidate).alias("candidate"), F.col("r2").alias("candidate_r2"),
        F.col("mae").alias("candidate_mae"))
    g = cur.crossJoin(cand)  # one row each
    ok = ((F.col("candidate_r2") >= F.col("current_r2") - r2_tolerance)
          & (F.col("candidate_mae") <= F.col("current_mae") * (1 + mae_tolerance)))
    return g.withColumn("accept", ok)


def promote_if_better(store, name: str, challenger: dict, save, r2_tolerance: float = 0.0,
                      mae_tolerance: float = 0.0) -> dict:
    """Champion and challenger. ``challenger`` has r2 and mae (and what else describes it);
    against the champion's they pass the same gate as :func:`retrain_gate`. Only an
    accepted challenger is saved (``save()``) and becomes the next version, by
    one file that appears whole; if another session was faster, the challenger is compared
    with the new champion. Returns accept, and the champion that serves now."""
    while True:
        champion = store.champion(name)
        accept = champion is None or (challenger["r2"] >= champion["r2"] - r2_tolerance
                                      and challenger["mae"] <= champion["mae"] * (1 + mae_tolerance))
        if not accept:
            return {"accept": False, "champion": champion}
        save()
        if store.promote(name, challenger, champion):
            return {"accept": True, "champion": store.champion(name)}


# --- S3 (full): incremental insight refresh -------------------------------------

PART_COLS = ["p_partkey", "p_type", "p_brand"]


def _pair_partials(batch: DataFrame, part: DataFrame) -> DataFrame:
    """Per (date, product, brand) partial sums of one micro-batch: counts,
    quantity, squared quantity, price and stock."""
    rows = batch.join(part, batch.l_partkey == part.p_partkey)
    stock = F.substring("p_brand", 7, 10).cast("int") * 40 + F.col("l_linenumber")
    return (rows.select(F.col("l_shipdate").cast("date").alias("date"),
                        F.col("p_type").alias("product"), F.col("p_brand").alias("brand"),
                        F.col("l_quantity").alias("qty"), F.col("p_retailprice").alias("price"),
                        stock.alias("stock"))
                .groupBy("date", "product", "brand")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("s_qty"),
                     F.sum(F.col("qty") * F.col("qty")).alias("s_qty2"),
                     F.sum("price").alias("s_price"), F.sum("stock").alias("s_stock")))


def insights_from_state(state: DataFrame, p: inv.InventoryPolicy = inv.DEFAULT_POLICY) -> DataFrame:
    """Recommendations computed from the (date, product, brand) state only.

    History means and sample std come from counts, sums and sums of squares
    (exact for whole-number quantities); the recent prediction mean is the
    row-weighted mean of the per-date baseline; health windows are sums of
    the per-date totals."""
    import datetime as dt
    daily = state.groupBy("date").agg(F.sum("s_qty").alias("daily_total_demand"),
                                      F.sum("n").alias("daily_rows"))
    fe = feat.drop_warmup(feat.lag_rolling(daily)).select(
        "date", (F.col("rolling_7_mean") / F.col("daily_rows_7_mean")).alias("pred"))
    latest = daily.agg(F.max("date").alias("_max_date"))
    mx = latest.first()[0]
    since = mx - dt.timedelta(days=p.recent_days)
    recent = (state.where(F.col("date") >= F.lit(since)).join(
        F.broadcast(fe.where(F.col("date") >= F.lit(since))), "date")  # a row per day of the window
                   .groupBy(*inv.PAIR).agg((F.sum(F.col("n") * F.col("pred")) / F.sum("n")).alias("pred_mean")))
    n, s, q = F.col("N"), F.col("S"), F.col("Q")
    d = F.col("date")
    hist = state.groupBy(*inv.PAIR).agg(
        F.sum("n").alias("N"), F.sum("s_qty").alias("S"), F.sum("s_qty2").alias("Q"),
        F.sum("s_price").alias("P"), F.sum("s_stock").alias("K"),
        F.sum(F.when(d >= F.lit(mx - dt.timedelta(days=p.slow_days)), F.col("s_qty"))).alias("S90"),
        F.sum(F.when(d >= F.lit(since), F.col("s_qty"))).alias("S30"))
    var = (q - s * s / n) / (n - 1)
    hist = hist.select(
        *inv.PAIR, (s / n).alias("hist_mean"),
        F.coalesce(F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))), F.lit(0.0)).alias("hist_std"),
        (F.col("P") / n).alias("hist_price"), (F.col("K") / n).alias("hist_stock"),
        s.alias("total_sold"), F.coalesce("S90", F.lit(0.0)).alias("sold_last_90d"),
        F.coalesce("S30", F.lit(0.0)).alias("sold_last_30d"))
    hist = materialize(hist)  # one row per pair, read by both branches below
    pbf = inv.pbf_from_parts(hist.join(recent, inv.PAIR))
    health = inv.health_from_totals(hist.select(
        *inv.PAIR, "total_sold", F.col("hist_mean").alias("mean_qty"), "sold_last_90d", "sold_last_30d",
        F.col("hist_stock").alias("mean_stock")), p)
    return inv.recommendations(inv.inventory_optimization(pbf, p), health, p)


_PAIR_SUMS = ["n", "s_qty", "s_qty2", "s_price", "s_stock"]


def nightly_insights(spark: SparkSession, sf_dir: str, output: str | None = None,
                     state_dir: str | None = None) -> DataFrame:
    """Nightly job: new sales are folded into (date, product, brand) partial
    sums, and recommendations are rebuilt from that state alone, so a night's
    work is the new files plus a state bounded by dates x pairs. With the same
    ``state_dir`` the next call reads new files only. With ``output`` the
    refreshed table overwrites the previous one there."""
    base = (state_dir or _run_dir(spark, "insights")).rstrip("/")
    state = EpochState(spark, f"{base}/pair_state", ["date", "product", "brand"], _PAIR_SUMS)
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet").select(*PART_COLS, "p_retailprice")
    _fold_new_files(file_stream(spark, sf_dir, "lineitem", LINEITEM_SCHEMA), state,
                    lambda batch: _pair_partials(batch, part), base)
    sums = state.read()
    if sums is None:
        raise ValueError(f"no sales under {sf_dir} and none in the state")
    recs = insights_from_state(materialize(sums))
    if output:
        # The refreshed table replaces the previous night's output.
        recs.write.mode("overwrite").parquet(output)
        return spark.read.parquet(output)
    return recs
