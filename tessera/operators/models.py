"""spark.ml estimators of the analyses, with the reference settings as
defaults, and the evaluation glue around them.

Training data is persisted (memory and disk) only while an iterative fit
runs and released afterwards. Folds and holdouts come from key hashes
(``operators.split``), so a retried task or a different layout never moves
a row between train and test. Metrics are DataFrames from
``operators.metrics``; nothing iterates over collected rows except the
bounded model summaries (one value per feature or per grid cell).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from math import ceil

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tessera.operators import metrics as M
from tessera.operators.split import assign_folds, fold_train_test
from tessera.session import drop_finished, dropping, releasing
from tessera.sources.tables import fit_layout

# The seed of every split, sample and estimator.
SEED = 123


@contextmanager
def persisted(df: DataFrame):
    """Keep ``df`` materialised for the duration of an iterative fit, and have
    the shuffles of its finished passes leave the disk meanwhile."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with dropping(df.sparkSession):
            yield df
    finally:
        df.unpersist()


# --- estimators (reference settings as defaults) ---------------------------

def gbt(label: str = "label", max_depth: int = 10, max_bins: int = 10, max_iter: int = 20,
        seed: int = SEED) -> GBTClassifier:
    """Gradient-boosted trees (particle classifier settings)."""
    return GBTClassifier(featuresCol="features", labelCol=label, predictionCol="prediction",
                         maxDepth=max_depth, maxBins=max_bins, maxIter=max_iter, seed=seed)


def forest(label: str = "label", max_depth: int = 10, max_bins: int = 10, num_trees: int = 20,
           seed: int = SEED) -> RandomForestClassifier:
    """Random forest with entropy impurity (tuned particle model)."""
    return RandomForestClassifier(featuresCol="features", labelCol=label, predictionCol="prediction",
                                  maxDepth=max_depth, impurity="entropy", maxBins=max_bins,
                                  numTrees=num_trees, seed=seed)


def claim_tree(label: str = "y", max_depth: int = 20, seed: int = SEED) -> DecisionTreeClassifier:
    """Decision tree for zero / non-zero claims (entropy impurity)."""
    return DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth,
                                  impurity="entropy", predictionCol="prediction1", seed=seed)


def gamma_glm(label: str = "Claim_Amount", max_iter: int = 50,
              reg_param: float = 0.01) -> GeneralizedLinearRegression:
    """Gamma GLM with log link for positive claim amounts."""
    return GeneralizedLinearRegression(family="gamma", link="log", featuresCol="features",
                                       labelCol=label, maxIter=max_iter, regParam=reg_param,
                                       predictionCol="prediction2")


# spark.ml's GLM solver (normal equations on the driver) accepts at most
# this many features.
GLM_MAX_FEATURES = 4096


def check_glm_width(width: int) -> int:
    """Fail before fitting when the encoded feature vector is too wide for
    the GLM solver (drop or bucket high-cardinality columns first)."""
    if width > GLM_MAX_FEATURES:
        raise ValueError(f"{width} GLM features > {GLM_MAX_FEATURES}; reduce categorical columns")
    return width


def glm_width(labels: list, numeric: list[str]) -> int:
    """Features of the severity model: a slot per seen category, and numbers."""
    return sum(len(seen) for seen in labels) + len(numeric)


def fit_claim_gate(train: DataFrame, categorical: list[str], numeric: list[str],
                   max_depth: int = 20):
    """Tree on the encoded ids (as plain doubles) and numbers: y = 0 / 1."""
    return Pipeline(stages=[VectorAssembler(inputCols=categorical + numeric, outputCol="features"),
                            claim_tree("y", max_depth=max_depth)]).fit(train)


def fit_claim_severity(positives: DataFrame, categorical: list[str], numeric: list[str],
                       max_iter: int = 50, reg_param: float = 0.01):
    """Gamma GLM (log link) on one-hot categories and numbers, trained on
    rows with an actual claim. Categories are indexed first so that a raw
    value such as a year does not set the one-hot width. The gamma family
    needs a strictly positive label: other amounts are an error, not left
    out. A category not seen in training has no active slot."""
    wrong = positives.filter(~F.coalesce(F.col("Claim_Amount") > 0, F.lit(False))).count()
    if wrong:
        raise ValueError(f"{wrong} claim amounts are not positive")
    idx = [c + "_idx" for c in categorical]
    ohe = [c + "_ohe" for c in categorical]
    indexer = StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(positives)
    # one slot per seen category; the encoder drops the last one, which is the
    # indexer's slot for unseen values
    check_glm_width(glm_width(indexer.labelsArray, numeric))
    return Pipeline(stages=[indexer,
                            OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
                            VectorAssembler(inputCols=ohe + numeric, outputCol="features"),
                            gamma_glm("Claim_Amount", max_iter=max_iter, reg_param=reg_param)]
                    ).fit(positives)


# Ratings in one block of ALS: at least, and from ALS_BLOCKS blocks on.
ALS_BLOCK_ROWS, ALS_BLOCKS, ALS_LARGE_BLOCK_ROWS, MAX_ALS_BLOCKS = 50_000, 24, 4_000_000, 4_000
# Ratings up to which several fits run at once: more than that have blocks
# enough for a cluster in one fit, and every fit at once holds its own blocks,
# messages and shuffles.
ALS_CONCURRENT_ROWS = 20_000_000
# Iterations after which the factors are written and older shuffles removed.
ALS_CHECKPOINT = 1


def als_blocks(ratings: int) -> int:
    """User and item blocks for a number of ratings: block sizes, not the
    cluster, decide, so a model does not depend on where it was fitted. A
    half-step sends a message from every block to every other one and a factor
    to each block that has a rating of it, so that blocks are many only where
    memory asks for it."""
    few = min(max(1, ceil(ratings / ALS_BLOCK_ROWS)), ALS_BLOCKS)
    return min(max(few, ceil(ratings / ALS_LARGE_BLOCK_ROWS)), MAX_ALS_BLOCKS)


def als_at_once(ratings: int, parallelism: int) -> int:
    """Fits that run at once over a number of ratings."""
    return max(1, parallelism) if ratings <= ALS_CONCURRENT_ROWS else 1


def als(reg_param: float = 0.1, rank: int = 10, max_iter: int = 10, seed: int = SEED,
        num_blocks: int | None = None) -> ALS:
    """Explicit-feedback ALS; cold-start rows are dropped when scoring.
    ``num_blocks`` sets the user and item block counts (Spark's default is 10
    whatever the size; ``als_blocks`` derives them from the number of ratings).
    The factors are checkpointed in every iteration, which removes the shuffles
    of the ones before from disk; results do not depend on it."""
    est = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, userCol="userId", itemCol="movieId",
              ratingCol="rating", coldStartStrategy="drop", seed=seed, checkpointInterval=ALS_CHECKPOINT)
    if num_blocks:
        est = est.setNumUserBlocks(num_blocks).setNumItemBlocks(num_blocks)
    return est


def kmeans(k: int = 25, seed: int = SEED, max_iter: int = 20) -> KMeans:
    """k-means with k-means|| initialisation."""
    return KMeans(k=k, seed=seed, initMode="k-means||", maxIter=max_iter,
                  featuresCol="features", predictionCol="prediction")


# --- classification with a holdout -----------------------------------------

def binary_report(pred: DataFrame, label: str) -> DataFrame:
    """auc (of the positive-class probability), accuracy and scored rows."""
    scored = pred.select(F.col(label).cast("double").alias("_y"),
                         vector_to_array("probability")[1].alias("_p"),
                         F.col("prediction").cast("double").alias("_pred"))
    auc = M.auc(scored, "_p", F.col("_y") == 1.0)
    acc = scored.agg(F.avg((F.col("_pred") == F.col("_y")).cast("double")).alias("accuracy"),
                     F.count(F.lit(1)).alias("n_test"))
    return side_by_side(auc, acc)


def side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side of two one-row aggregates (joined on a constant key)."""
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k").drop("_k")


def feature_importances(model, names: list[str], spark) -> DataFrame:
    """(feature, importance) for a tree model; one value per input feature."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])),
                                 "feature string, importance double")


def top_importances(importances: DataFrame, n: int = 3) -> DataFrame:
    """The n most important features (ties by name)."""
    return importances.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


# --- tuning ----------------------------------------------------------------

def cross_validate(train: DataFrame, feature_cols: list[str], estimator, grid: list,
                   key: list[str], label: str = "label", folds: int = 5, seed: int = SEED,
                   parallelism: int = 2):
    """k-fold CV with hash folds; the features are assembled once, before the
    fits. Returns the best model (assembler included) and a (cell, params,
    auc, best) DataFrame; of tied cells the first is the best, which is the
    one that was refitted.

    ``seed`` must differ from the one that split ``train`` off: with the
    same key and seed every training row has u < train_fraction and the
    folds would be unbalanced."""
    data = assign_folds(train, key, folds, seed, out="fold").withColumn(
        "fold", F.col("fold") - 1)
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features")
    data = assembler.transform(data).select("features", label, "fold")
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev, numFolds=folds,
                        foldCol="fold", seed=seed, parallelism=parallelism)
    with persisted(data):
        model = cv.fit(data)
    best = model.avgMetrics.index(max(model.avgMetrics))
    rows = [(i, {p.name: str(v) for p, v in pm.items()}, float(m), i == best)
            for i, (pm, m) in enumerate(zip(grid, model.avgMetrics))]
    metrics = train.sparkSession.createDataFrame(
        rows, "cell int, params map<string,string>, auc double, best boolean")
    return PipelineModel(stages=[assembler, model.bestModel]), metrics


def grid_best(grid_metrics: DataFrame) -> DataFrame:
    """The grid cell of the refitted model: the first with the highest metric."""
    return grid_metrics.filter("best").select("params", "auc")


def param_grid(estimator, **values) -> list:
    """ParamGridBuilder grid from ``param_name=[values]`` keywords."""
    b = ParamGridBuilder()
    for name, vals in values.items():
        b = b.addGrid(estimator.getParam(name), vals)
    return b.build()


# --- ratings -----------------------------------------------------------------

def als_grid(folded: DataFrame, reg_params: tuple[float, ...], folds: int = 3, rank: int = 10,
             max_iter: int = 10, parallelism: int = 3, fold_col: str = "fold",
             num_blocks: int | None = None) -> DataFrame:
    """Fit one ALS model per (fold, regParam) on the other folds, score the
    held-out fold and return (model, fold, rmse, mae, n_scored, n_rows) cells
    (cold-start rows are in n_rows only).

    Each fit is a distributed job; up to ``parallelism`` fits run at once
    (as CrossValidator's ``parallelism`` does) while the ratings are few
    (``ALS_CONCURRENT_ROWS``). Only the per-cell metric row
    comes back to the driver: folds x params rows, independent of the data.
    """
    spark = folded.sparkSession

    def cell(task):
        k, i, reg = task
        train, test = fold_train_test(folded, k, fold_col)
        model = als(reg, rank=rank, max_iter=max_iter, num_blocks=num_blocks).setColdStartStrategy("nan").fit(train)
        r = M.regression_metrics(model.transform(test), "prediction", "rating").first()
        del train, test, model
        drop_finished(spark)  # the next cells shuffle as much again
        return (i, k, r["rmse"], r["mae"], int(r["n_scored"]), int(r["n_rows"]))

    tasks = [(k, i, reg) for k in range(1, folds + 1) for i, reg in enumerate(reg_params, start=1)]
    with releasing(spark), persisted(folded):
        rows_rated = folded.count()
        num_blocks = num_blocks or als_blocks(rows_rated)
        with ThreadPoolExecutor(max_workers=als_at_once(rows_rated, parallelism)) as pool:
            # job group / local properties follow the caller into the workers
            rows = list(pool.map(inheritable_thread_target(spark)(cell), tasks))
    return spark.createDataFrame(rows, "model int, fold int, rmse double, mae double, n_scored long, n_rows long")


def item_clusters(ratings: DataFrame, k: int = 25, reg_param: float = 0.1, rank: int = 10,
                  max_iter: int = 10, kmeans_iter: int = 20, seed: int = SEED,
                  num_blocks: int | None = None) -> DataFrame:
    """ALS item factors -> dense vectors -> k-means: (movieId, prediction).
    The assignment is checkpointed, so the two fits run once."""
    return clustered_items(ratings, k, reg_param, rank, max_iter, kmeans_iter, seed, num_blocks)[0]


def clustered_items(ratings: DataFrame, k: int = 25, reg_param: float = 0.1, rank: int = 10, max_iter: int = 10,
                    kmeans_iter: int = 20, seed: int = SEED, num_blocks: int | None = None) -> tuple[DataFrame, DataFrame, list]:
    """((movieId, prediction), (movieId, features), the centres): factors and
    assignment are checkpointed, and what the fits held is released with the
    caller's ``releasing`` block."""
    from tessera.operators.features import factor_vectors
    num_blocks = num_blocks or als_blocks(ratings.count())
    factors = als(reg_param, rank=rank, max_iter=max_iter, seed=seed, num_blocks=num_blocks).fit(ratings).itemFactors
    vecs = factor_vectors(factors).checkpoint(eager=True)
    del factors
    drop_finished(ratings.sparkSession)
    # k-means starts from a sample, which depends on the layout
    with persisted(fit_layout(vecs, ["movieId"])) as data:
        model = kmeans(k, seed=seed, max_iter=kmeans_iter).fit(data)
    assigned = model.transform(vecs).select("movieId", "prediction").checkpoint(eager=True)
    return assigned, vecs, model.clusterCenters()
