"""Model fitting, cross-validation, search and persistence with pyspark.ml.

Estimators are distributed (tree learners aggregate split statistics over
all partitions); the driver only holds parameter maps, fitted models and
one-row-per-fold metrics. The training frame is persisted once per fit
session because every fold and candidate reads it again.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, ensure_checkpoint_dir, materialize
from .evaluate import r_squared, regression_metrics
from .prepare import CATEGORICAL_COLS, FEATURES, SCALED_COLS, TARGET, label_encode, standard_scale

FEATURE_VEC = "features"
MAX_TREE_DEPTH = 30  # Spark's limit; an unbounded depth maps to it

# The reference models' settings and search spaces, without those
# that Spark's tree learners don't have (least split size, leaf penalties).
FOREST_DEFAULTS = dict(n_estimators=200, max_depth=15, min_samples_leaf=2, max_features="sqrt")
BOOSTED_DEFAULTS = dict(n_estimators=300, max_depth=6, learning_rate=0.1, subsample=0.8,
                        colsample_bytree=0.8, min_child_weight=3)
FOREST_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [10, 15, 20, 25, None],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2", 0.5, 0.7],
}
BOOSTED_SPACE = {
    "n_estimators": [200, 300, 500, 700],
    "max_depth": [4, 6, 8, 10],
    "learning_rate": [0.01, 0.05, 0.1, 0.15],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.6, 0.7, 0.8, 0.9],
    "min_child_weight": [1, 3, 5, 7],
}
SEED = 42
# Execution settings only: node batches (every running task holds the statistics of one; four tasks
# share an executor; a level of several batches draws its nodes' features in another order) and, from
# ``CACHED_DEPTH`` levels on, cached node ids halve the passes
# over the data for deep trees; node-id caches are checkpointed to keep lineage short. A
# shallow tree finds the node of a row sooner than such a cache is written.
TREE_EXECUTION = dict(maxMemoryInMB=512, checkpointInterval=10)
CACHED_DEPTH = 10


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURE_VEC, handleInvalid="keep")


def _subset(v) -> str:
    """A share of the features as Spark takes it: with a point, as "1" would
    be one feature."""
    return v if isinstance(v, str) else repr(float(v))


def linear(reg: float = 0.0) -> LinearRegression:
    """Ordinary least squares with intercept (``reg > 0`` adds a ridge)."""
    return LinearRegression(featuresCol=FEATURE_VEC, labelCol=TARGET, regParam=reg,
                            elasticNetParam=0.0, solver="normal")


def forest(n_estimators=200, max_depth=15, min_samples_leaf=2, max_features="sqrt", seed=SEED) -> RandomForestRegressor:
    """Spark has no minimum split size; the leaf minimum carries over as
    ``minInstancesPerNode``."""
    depth = MAX_TREE_DEPTH if max_depth is None else min(int(max_depth), MAX_TREE_DEPTH)
    return RandomForestRegressor(featuresCol=FEATURE_VEC, labelCol=TARGET, numTrees=int(n_estimators),
                                 maxDepth=depth, minInstancesPerNode=int(min_samples_leaf),
                                 featureSubsetStrategy=_subset(max_features), seed=seed,
                                 cacheNodeIds=depth >= CACHED_DEPTH, **TREE_EXECUTION)


def boosted(n_estimators=300, max_depth=6, learning_rate=0.1, subsample=0.8, colsample_bytree=0.8,
            min_child_weight=3, seed=SEED) -> GBTRegressor:
    """Gradient-boosted trees. Under squared loss the child weight is a row
    count (``minInstancesPerNode``); column sampling is per node."""
    depth = min(int(max_depth), MAX_TREE_DEPTH)
    return GBTRegressor(featuresCol=FEATURE_VEC, labelCol=TARGET, maxIter=int(n_estimators),
                        maxDepth=depth, stepSize=float(learning_rate),
                        subsamplingRate=float(subsample), featureSubsetStrategy=_subset(colsample_bytree),
                        minInstancesPerNode=int(min_child_weight), seed=seed,
                        cacheNodeIds=depth >= CACHED_DEPTH, **TREE_EXECUTION)


ESTIMATORS = {"linear": linear, "forest": forest, "boosted": boosted}
#: Models by name: kind of estimator and settings.
MODELS = {"Linear Regression": ("linear", {}), "Random Forest": ("forest", FOREST_DEFAULTS),
          "Boosted Trees": ("boosted", BOOSTED_DEFAULTS)}


def pipeline(estimator, features: Sequence[str] = FEATURES) -> Pipeline:
    return Pipeline(stages=[assembler(features), estimator])


def fit(train: DataFrame, estimator, features: Sequence[str] = FEATURES) -> PipelineModel:
    # Tree learners checkpoint their node-id cache into the shared folder.
    ensure_checkpoint_dir(train.sparkSession)
    return pipeline(estimator, features).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop(FEATURE_VEC)


def scored_metrics(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Rounded metrics of ``model`` on ``df`` per split."""
    p = predict(model, df).select(F.lit(name).alias("model"), "split",
                                  F.col(TARGET).cast("double").alias("actual"), "prediction")
    return regression_metrics(p)


def coefficients(model: PipelineModel, features: Sequence[str] = FEATURES) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return [*zip(features, [float(c) for c in lr.coefficients]), ("intercept", float(lr.intercept))]


def importances(model: PipelineModel, features: Sequence[str] = FEATURES) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances
    return [(f, float(imp[i])) for i, f in enumerate(features)]


def sample_params(space: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """Seeded random choice of ``n_iter`` distinct points of a discrete
    grid (or all points when the grid is smaller)."""
    keys = sorted(space)
    total = 1
    for k in keys:
        total *= len(space[k])
    rng = random.Random(seed)
    seen, out = set(), []
    while len(out) < min(n_iter, total):
        pick = tuple(rng.randrange(len(space[k])) for k in keys)
        if pick not in seen:
            seen.add(pick)
            out.append({k: space[k][i] for k, i in zip(keys, pick)})
    return out


@dataclass
class SearchResult:
    best_params: dict
    best_model: PipelineModel
    avg_mae: list[float] = field(default_factory=list)
    candidates: list[dict] = field(default_factory=list)


def random_search(train: DataFrame, kind: str, space: dict, n_iter: int, fold_col: str = "fold",
                  parallelism: int = 4, seed: int = SEED, features: Sequence[str] = FEATURES) -> SearchResult:
    """Random search scored by mean MAE over the contiguous folds in
    ``fold_col`` (1..k), refit on all training rows. Candidate fits are
    Spark jobs submitted from ``parallelism`` driver threads."""
    cands = sample_params(space, n_iter, seed)
    ests = [ESTIMATORS[kind](**c) for c in cands]
    # One pipeline per candidate: CrossValidator needs a single estimator,
    # so the candidates become values of a "stage" parameter map.
    pipe = Pipeline(stages=[assembler(features), ests[0]])
    maps = [{pipe.stages: [assembler(features), e]} for e in ests]
    data = train.withColumn("_cv_fold", (F.col(fold_col) - 1).cast("int"))
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps,
                        evaluator=RegressionEvaluator(labelCol=TARGET, metricName="mae"),
                        foldCol="_cv_fold", parallelism=parallelism, seed=seed)
    model = cv.fit(data)
    avg = list(model.avgMetrics)
    best = min(range(len(avg)), key=avg.__getitem__)
    return SearchResult(cands[best], model.bestModel, avg, cands)


def cross_validate(train: DataFrame, estimator, fold_col: str = "fold",
                   features: Sequence[str] = FEATURES) -> DataFrame:
    """Fit on k-1 contiguous folds, score the held-out fold; one fit per
    fold gives both MAE and R^2. Returns (fold, mae, r2) rows."""
    folds = [r[0] for r in train.select(fold_col).distinct().orderBy(fold_col).collect()]
    out = None
    for k in folds:  # k is bounded by the fold count, not by the data
        one = fold_metrics(train, estimator, k, fold_col, features)
        out = one if out is None else out.unionByName(one)
    return out


def fold_metrics(train: DataFrame, estimator, k: int, fold_col: str = "fold",
                 features: Sequence[str] = FEATURES) -> DataFrame:
    """One row (mae, r2, fold): fitted without fold ``k`` and scored on it."""
    m = fit(train.where(F.col(fold_col) != k), estimator, features)
    p = predict(m, train.where(F.col(fold_col) == k)).select(
        F.col(TARGET).cast("double").alias("actual"), "prediction")
    return p.agg(F.avg(F.abs(F.col("actual") - F.col("prediction"))).alias("mae"),
                 r_squared().alias("r2")).withColumn("fold", F.lit(int(k)))


#: Training rows of a task, at least and at most. Every level of every tree is a job with a task a
#: partition, and every task sends the statistics of all its nodes: small frames take few partitions, larger
#: ones as many as there are cores, and more only when these would hold too many rows each.
TRAINING_ROWS, MOST_TRAINING_ROWS = 20_000, 1_000_000


def training_partitions(n: int, cores: int, rows: int = TRAINING_ROWS, most: int = MOST_TRAINING_ROWS) -> int:
    """Partitions for ``n`` training rows on ``cores`` cores."""
    return max(1, min(cores, -(-n // rows)), -(-n // most))


#: Rows of a block of :func:`persist_training`'s ``near``, about.
NEAR_ROWS = 2_000


def persist_training(df: DataFrame, keys: Sequence[str] = (), rows: int = TRAINING_ROWS, near: str | None = None,
                     finish: Callable[[DataFrame], DataFrame] = lambda dealt: dealt) -> DataFrame:
    """Keep the training frame in memory/disk for the many passes of a
    fit session; lost blocks are recomputed from (deterministic) lineage.

    The rows are hash-partitioned on ``keys`` into :func:`training_partitions`: a
    recomputed block holds the same rows and bagging draws the same samples, whatever
    AQE made of the input, and no task holds more than ``MOST_TRAINING_ROWS`` or so.

    ``near`` names a column whose equal values lie side by side, in the order of ``keys``: rows of a day share
    the calendar and the lags, so one after the other they reach the same nodes of a tree, whose statistics
    are then still in the processor's cache. A value of many rows is cut by ``keys`` into blocks of about ``NEAR_ROWS``,
    dealt over all partitions. ``finish`` makes the kept rows of the dealt ones, row by row or by broadcast joins, so that
    what it adds isn't shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if near is None:
        n = training_partitions(df.count(), cores, rows)
        return finish(df.repartition(n, *keys) if keys else df.repartition(n)).persist(StorageLevel.MEMORY_AND_DISK)
    counts = materialize(df.groupBy(F.col(near).alias("_near")).agg(F.count(F.lit(1)).alias("_near_rows")))
    n = training_partitions(counts.agg(F.sum("_near_rows")).first()[0] or 0, cores, rows)
    block = F.pmod(F.xxhash64(*keys), F.ceil(F.col("_near_rows") / NEAR_ROWS))
    dealt = df.join(broadcast_if_small(counts), F.col(near).eqNullSafe(F.col("_near"))).repartition(n, near, block)
    # Sorted after: Catalyst drops a sort under a join.
    return finish(dealt.select(*df.columns)).sortWithinPartitions(near, *keys).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Artifacts:
    """A saved model with all that raw engineered rows need before it: the
    encoder maps, the scaler's numbers and the feature order."""

    model: PipelineModel
    encoders: DataFrame
    scaler: DataFrame
    meta: dict

    def score(self, engineered: DataFrame) -> DataFrame:
        """``engineered`` rows (not encoded, not scaled) with a prediction."""
        own = [c for c in engineered.columns if c in SCALED_COLS]
        # The scaled columns are the model's; the rows' own values are kept aside.
        aside = engineered.withColumns({f"{c}__own": F.col(c) for c in own})
        rows = label_encode(aside, CATEGORICAL_COLS, mappings=self.encoders, unseen=-1)
        out = predict(self.model, standard_scale(rows, params=self.scaler))
        return out.select(*[F.col(f"{c}__own").alias(c) if c in own else F.col(c) for c in engineered.columns], "prediction")


def save_artifacts(path: str, model: PipelineModel, encoders: DataFrame, scaler: DataFrame, name: str,
                   metrics: dict, features: Sequence[str] = FEATURES) -> str:
    """Write model, encoder maps, scaler and metadata under ``path`` (a shared
    folder), replacing what is there. ``load_artifacts`` of another
    process scores raw engineered rows with them."""
    spark, base = encoders.sparkSession, path.rstrip("/")
    model.write().overwrite().save(f"{base}/pipeline")
    encoders.write.mode("overwrite").parquet(f"{base}/encoders")
    scaler.write.mode("overwrite").parquet(f"{base}/scaler")
    meta = {"name": name, "feature_columns": list(features), "target": TARGET, "metrics": metrics}
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string").write.mode("overwrite").text(f"{base}/meta")
    return base


def load_artifacts(spark, path: str) -> Artifacts:
    base = path.rstrip("/")
    return Artifacts(PipelineModel.load(f"{base}/pipeline"), spark.read.parquet(f"{base}/encoders"),
                     spark.read.parquet(f"{base}/scaler"), json.loads(spark.read.text(f"{base}/meta").first()[0]))
