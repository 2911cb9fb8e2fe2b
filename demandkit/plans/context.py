"""Per-dataset derived frames shared by the registered queries.

``Tables(spark, sf_dir)`` builds the sales view lazily and keeps the small
derived tables (the daily series) checkpointed, so several queries over the
same folder reuse them instead of recomputing from the fact table.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import inventory as inv
from ..operators import ordering
from ..operators import prepare as prep
from ..operators.model_store import ModelStore, address, code_digest
from ..session import materialize, written
from ..sources.tables import ROW_KEY, sales_view

KEY_COLS = list(ROW_KEY)
#: Columns of a sale that model features are made of, and the target.
FEATURE_SOURCES = ["product", "brand", "dealer", "size", "unit_price", "stock", "qty"]

METRIC_COLS = ["model", "split", "mae", "rmse", "r2", "mape", "n"]
METRIC_SCHEMA = "model string, split string, mae double, rmse double, r2 double, mape double, n long"

_CACHE: dict[tuple, "Tables"] = {}


def input_files(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and modification time of the star schema's files."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in ("lineitem", "part", "supplier", "nation"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            continue
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def reset() -> None:
    """Forget the shared frames and release everything they persisted."""
    for t in _CACHE.values():
        t.release()
    _CACHE.clear()


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """The shared frames of a folder as its files are now: new, changed
        or removed files make new frames."""
        key = (spark.sparkContext.applicationId, id(spark), sf_dir, input_files(spark, sf_dir))
        if key not in _CACHE:
            _CACHE[key] = cls(spark, sf_dir)
        return _CACHE[key]

    def release(self) -> None:
        for name in ("eng_model", "prepared"):
            if name in self.__dict__:
                self.__dict__.pop(name).unpersist()
        for name in ("_models", "train", "search_frame"):
            self.__dict__.pop(name, None)

    @cached_property
    def sales(self) -> DataFrame:
        return sales_view(self.spark, self.sf_dir)

    def sales_of(self, *columns: str) -> DataFrame:
        """The sales view with these columns and only the joins they need."""
        return sales_view(self.spark, self.sf_dir, columns=columns)

    @cached_property
    def pair_sales(self) -> DataFrame:
        """What the product and product-brand tables need: no dealer is joined."""
        return self.sales_of("date", "product", "brand", "qty", "unit_price", "stock")

    @cached_property
    def daily(self) -> DataFrame:
        """Daily series with lag/rolling columns, warm-up kept (checkpointed:
        one row per date); no dimension is joined for it."""
        return materialize(feat.daily_features(self.sales_of("date", "qty")))

    def eng_of(self, *columns: str, daily: DataFrame | None = None) -> DataFrame:
        """Engineered rows (calendar + daily features, warm-up dropped),
        unscaled, with the train/test tag. Of the sale's own columns they have
        the date and ``columns``, and only the dimensions these need are joined."""
        sales = self.sales_of("date", *columns)
        return prep.time_split(prep.engineer(sales, self.daily if daily is None else daily, daily_checkpointed=True))

    @cached_property
    def eng_features(self) -> DataFrame:
        """Engineered rows with all that the model features are made of."""
        return self.eng_of(*KEY_COLS, *FEATURE_SOURCES)

    @cached_property
    def preparation(self) -> tuple[DataFrame, DataFrame]:
        """Encoder maps and scaler numbers of all engineered rows, from one
        pass over them; both are checkpointed (one row per category, one row)."""
        return prep.fit_preparation(self.eng_features)

    @cached_property
    def latest(self) -> DataFrame:
        """One-row table with the latest sale date (from the daily series)."""
        return self.daily.agg(F.max("date").alias("_max_date"))

    @cached_property
    def scored(self) -> DataFrame:
        """Recent engineered rows scored by the rolling baseline."""
        pred = inv.baseline_prediction("rolling")
        since = inv.scan_bound(self.latest, inv.DEFAULT_POLICY.recent_days)
        return inv.recent_window(self.eng_of("product", "brand"), inv.DEFAULT_POLICY.recent_days,
                                 since=since).withColumn("prediction", pred)

    @cached_property
    def pbf(self) -> DataFrame:
        return inv.product_brand_forecast(self.pair_sales, self.scored)

    @cached_property
    def inv(self) -> DataFrame:
        return inv.inventory_optimization(self.pbf)

    @cached_property
    def health(self) -> DataFrame:
        return inv.stock_health(self.pair_sales, latest=self.latest)

    @cached_property
    def recs(self) -> DataFrame:
        return inv.recommendations(self.inv, self.health)

    # --- modelling ----------------------------------------------------------

    @cached_property
    def model_days(self) -> DataFrame:
        """The features that rows of a day share, for model fitting, warm-up dropped: calendar, daily features and split; a
        row a day, so it is broadcast as it is (a million of them are 2,700 years). Rolling windows exclude the current day (its total contains the row's own target)."""
        daily = feat.daily_features(self.sales_of("date", "qty"), exclude_current=True)
        days = feat.drop_warmup(daily.select("date", *feat.LAG_COLS, "daily_rows_7_mean"))
        return materialize(prep.time_split(prep.with_calendar(days)))

    @cached_property
    def fit_sales(self) -> DataFrame:
        """What model features are made of, and the target, joined once and written: some bytes a sale as
        Parquet, where engineered rows kept for the passes of a fit take twenty times as much."""
        return written(self.sales_of("date", *FEATURE_SOURCES), "fit-sales")

    @cached_property
    def keyed_sales(self) -> DataFrame:
        """:attr:`fit_sales` with the row key, for folds and predictions by row."""
        return written(self.sales_of(*KEY_COLS, *FEATURE_SOURCES), "keyed-sales")

    def kept_sales(self, *keys: str) -> DataFrame:
        """The written sales that have ``keys``; of both copies the one that is there."""
        return self.keyed_sales if set(keys) - {"date"} or "keyed_sales" in self.__dict__ else self.fit_sales

    def model_rows(self, *keys: str) -> DataFrame:
        """Engineered rows for model fitting with ``keys`` of the row key, made from the written sales in every
        pass: what a day's rows share comes by one broadcast join on the date, not by expressions a row."""
        rows = self.kept_sales(*keys).select("date", *[k for k in keys if k != "date"], *FEATURE_SOURCES)
        return rows.join(F.broadcast(self.model_days), "date")

    @cached_property
    def eng_model(self) -> DataFrame:
        """:meth:`model_rows` with the row key, persisted for callers that pass over raw engineered rows
        again and again, in blocks of bounded rows: a split of the scan may hold any number of sales."""
        from ..operators import models
        return models.persist_training(self.model_rows(*KEY_COLS), KEY_COLS)

    def coded_sales(self, *keys: str) -> DataFrame:
        """The kept sales with codes for categories (-1 for those unseen in training): what a
        row has of its own, not scaled."""
        sales = self.kept_sales(*keys)  # before the encoders, which then take the same copy
        coded = prep.label_encode(sales, prep.CATEGORICAL_COLS, mappings=self.encoders, unseen=-1)
        own = [c for c in prep.FEATURES if c in coded.columns]
        return coded.select("date", *[k for k in keys if k != "date"], *own, prep.TARGET)

    def with_days(self, coded: DataFrame) -> DataFrame:
        """:meth:`coded_sales` of the days that have all features, scaled and with the scaled features of their day
        and its split."""
        days = prep.standard_scale(self.model_days, feat.LAG_COLS, params=self.scaler).select(*self.model_days.columns)
        rows = coded.join(F.broadcast(days), "date")
        own = [c for c in prep.SCALED_COLS if c not in feat.LAG_COLS]
        keys = [c for c in coded.columns if c not in prep.FEATURES and c != prep.TARGET]
        return prep.standard_scale(rows, own, params=self.scaler).select(*keys, *prep.FEATURES, prep.TARGET, "split")

    def encoded_rows(self, *keys: str) -> DataFrame:
        """Encoded + scaled :meth:`model_rows`: date, ``keys``, features, target and split.
        Encoders and scaler are fitted on the training rows only (categories unseen in
        training get code -1), so no test information leaks into the features."""
        return self.with_days(self.coded_sales(*keys))

    @cached_property
    def prepared(self) -> DataFrame:
        """:meth:`encoded_rows` persisted for the repeated passes of tree fits, the rows of a day side by side;
        only what a row has of its own is shuffled."""
        from ..operators import models
        coded = self.coded_sales(*KEY_COLS).join(F.broadcast(self.model_days.select("date")), "date", "left_semi")
        return models.persist_training(coded, KEY_COLS, near="date", finish=self.with_days)

    @cached_property
    def model_preparation(self) -> tuple[DataFrame, DataFrame]:
        """Encoder maps and the scaler's numbers of the training rows, from one pass over them."""
        return prep.fit_preparation(self.model_rows().where(F.col("split") == "train"))

    @property
    def encoders(self) -> DataFrame:
        """Encoder maps of the training rows."""
        return self.model_preparation[0]

    @property
    def scaler(self) -> DataFrame:
        """The scaler's numbers (one row) over the training rows."""
        return self.model_preparation[1]

    def artifacts(self, name: str, path: str | None = None):
        """Model ``name`` saved with its encoders and scaler, and loaded back. Without a
        path they go to the model's own address in the store, so that two runs never
        overwrite each other."""
        from ..operators import models
        base = path or f"{self.store.root}/artifacts/{address(self.content(name))}-{uuid.uuid4().hex}"
        metrics = {r["split"]: r.asDict() for r in
                   self.metrics_of(name).collect()}  # a row per split
        models.save_artifacts(base, self.model(name), self.encoders, self.scaler, name, metrics)
        return models.load_artifacts(self.spark, base)

    def saved(self, name: str):
        """The artifacts of model ``name``, saved at most once per address."""
        from ..operators import models
        entry = f"saved/{address(self.content(name))}.json"
        if self.store.read(entry) is None:
            folder = f"artifacts/{address(self.content(name))}-{uuid.uuid4().hex}"
            self.artifacts(name, f"{self.store.root}/{folder}")
            self.store.create(entry, {"folder": folder, "model": name})
        return models.load_artifacts(self.spark, f"{self.store.root}/{self.store.read(entry)['folder']}")

    def metrics_of(self, name: str) -> DataFrame:
        """Metrics of a fitted model by split; scored once and kept in the store."""
        from ..operators import models
        entry = self._metrics_entry(name)
        if self.store.read(entry) is None:
            rows = [r.asDict() for r in models.scored_metrics(self.model(name), self.prepared, name).collect()]  # a row per split
            self.store.create(entry, {"rows": rows})
        return self.spark.createDataFrame([tuple(r[c] for c in METRIC_COLS) for r in self.store.read(entry)["rows"]], METRIC_SCHEMA)

    def _metrics_entry(self, name: str) -> str:
        return f"metrics/{address(self.content(name))}.json"

    def metrics(self, *names: str) -> list[DataFrame]:
        """:meth:`metrics_of` each model; those not scored yet are fitted together."""
        self.models(*[n for n in names if self.store.read(self._metrics_entry(n)) is None])
        return [self.metrics_of(n) for n in names]

    def best_fitted(self) -> str:
        """Name of the fitted model with the highest test R^2 (of equal ones the first name)."""
        rows = [(-r["r2"], r["model"]) for m in self.metrics(*self.MODEL_NAMES) for r in m.collect() if r["split"] == "test"]
        return min(rows)[1]

    def scored_by(self, name: str) -> DataFrame:
        """The recent window scored by the saved and reloaded model."""
        since = inv.scan_bound(self.latest, inv.DEFAULT_POLICY.recent_days)
        recent = inv.recent_window(self.model_rows(*KEY_COLS), inv.DEFAULT_POLICY.recent_days, since=since)
        return materialize(self.saved(name).score(recent))

    @cached_property
    def train(self) -> DataFrame:
        return self.prepared.where(F.col("split") == "train")

    def fit_rows(self, kind: str, *keys: str) -> DataFrame:
        """Training rows for a fit. Tree learners pass over them once a level, so theirs are kept; a linear fit
        passes over them once or twice and takes them from the written sales, unless they are kept anyhow."""
        if kind != "linear" or "prepared" in self.__dict__:
            return self.train
        return self.encoded_rows(*keys).where(F.col("split") == "train")

    @cached_property
    def _models(self) -> dict:
        return {}

    @cached_property
    def store(self) -> ModelStore:
        return ModelStore(self.spark)

    def content(self, name: str) -> dict:
        """All that the model ``name`` is fitted from."""
        from ..operators import models
        kind, settings = models.MODELS[name]
        return {"model": name, "kind": kind, "settings": settings, **self.training_content}

    @cached_property
    def training_content(self) -> dict:
        return {"files": input_files(self.spark, self.sf_dir), "features": prep.FEATURES, "split": prep.SPLIT_DATE,
                "code": code_digest(), "spark": self.spark.version}

    def model(self, name: str):
        """One of the three reference models with its reference settings: from the store,
        or fitted on first use and published there for every later session."""
        from ..operators import models
        if name not in self._models:
            kind, settings = models.MODELS[name]
            self._models[name] = self.store.fitted(
                self.content(name), lambda: models.fit(self.fit_rows(kind), models.ESTIMATORS[kind](**settings)))
        return self._models[name]

    def tuned(self, kind: str, settings: dict):
        """The model of a search's best settings on all training rows, from the store or fitted now."""
        from ..operators import models
        content = {"model": f"tuned {kind}", "kind": kind, "settings": settings, **self.training_content}
        return self.store.fitted(content, lambda: models.fit(self.train, models.ESTIMATORS[kind](**settings)))

    def models(self, *names: str) -> list:
        """:meth:`model` of each name; those that must be fitted are fitted at the same time, each from a
        driver thread: boosting rounds are many short jobs one after the other, which alone leave cores idle."""
        missing = [n for n in names if n not in self._models and not self.store.holds(self.content(n))]
        if len(missing) > 1:
            self.train.count()  # kept before the fits share it
            with ThreadPoolExecutor(len(missing)) as pool:
                fits = [pool.submit(inheritable_thread_target(self.spark)(self.model), n) for n in missing]
            for f in fits:
                f.result()
        return [self.model(n) for n in names]

    MODEL_NAMES = ("Linear Regression", "Random Forest", "Boosted Trees")

    @cached_property
    def search_frame(self) -> DataFrame:
        """All training rows in five contiguous folds, for the fits of a search."""
        return ordering.contiguous_folds(self.train, KEY_COLS, 5)

    def fold_rows(self, kind: str) -> DataFrame:
        """All training rows in five contiguous folds, for the passes of a cross-validation: kept ones, or those of
        a linear fit written with nothing but features, target and fold (dictionary codes, a few bytes a column)."""
        if kind != "linear" or "prepared" in self.__dict__:
            return self.search_frame
        folds = ordering.contiguous_folds(self.fit_rows(kind, *KEY_COLS), KEY_COLS, 5)
        return written(folds.select(*prep.FEATURES, prep.TARGET, "fold"), "folds")
