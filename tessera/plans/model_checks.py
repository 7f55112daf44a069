"""Companions of the model queries whose results SQL can state: estimators on
inputs with a known answer, fold sizes, cold-start counts, and the equations
that the models fitted at the analyses' own settings satisfy."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import diagnostics as D
from tessera.operators import metrics as MT
from tessera.operators import models as M
from tessera.operators.split import assign_folds, fold_train_test, hash_sample, in_train, train_test
from tessera.plans import models as PM
from tessera.plans.recommend import RATING_KEY, rating_folds
from tessera.session import drop_finished, ensure_checkpoint_dir, releasing
from tessera.sources.tables import fit_layout, laid_out, read_table, stored

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _separable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a feature x that decides the label and a constant z."""
    li = read_table(spark, sf_dir, "lineitem", *KEY, "l_quantity")
    y = (F.col("l_quantity") > 25).cast("double")
    return li.select(*KEY, y.alias("x"), F.lit(1.0).alias("z"), y.alias("label"))


def _separable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_layout(_separable_rows(spark, sf_dir), KEY)


def tree_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split of every tree family on a separable label: accuracy 1, all
    importance on the feature that varies."""
    ensure_checkpoint_dir(spark)
    data = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(_separable(spark, sf_dir))
    out = None
    with M.persisted(data):
        for name, est in (("tree", M.claim_tree("label", max_depth=1).setPredictionCol("prediction")),
                          ("forest", M.forest("label", max_depth=1, num_trees=1)),
                          ("gbt", M.gbt("label", max_depth=1, max_iter=1))):
            model = est.fit(data)
            x, z = (float(v) for v in model.featureImportances.toArray())
            row = MT.accuracy(model.transform(data), "prediction", "label").checkpoint(eager=True)
            row = row.select(F.lit(name).alias("model"), "*", F.lit(x).alias("importance_x"), F.lit(z).alias("importance_z"))
            out = row if out is None else out.unionByName(row)
    return out


def cv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-fold grid on a separable label: every cell ties, the first is best."""
    est = M.forest("label", max_depth=1, num_trees=1)
    grid = M.param_grid(est, numTrees=[1, 2], maxBins=[5, 10])
    _, cells = M.cross_validate(_separable(spark, sf_dir), ["x"], est, grid, KEY, "label", folds=5, seed=M.SEED + 1)
    return cells.select("cell", F.col("params")["numTrees"].alias("numTrees"), F.col("params")["maxBins"].alias("maxBins"),
                        F.round("auc", 9).alias("auc"), "best")


def cv_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each of five tuning folds."""
    folds = assign_folds(read_table(spark, sf_dir, "embeddings", "vec_id"), ["vec_id"], 5, M.SEED + 1)
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


def als_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of each fold and how many of them ALS can score: those whose
    user and item both have training ratings."""
    ensure_checkpoint_dir(spark)
    cells = M.als_grid(fit_layout(rating_folds(spark, sf_dir), RATING_KEY), (0.1,), folds=3, rank=2, max_iter=1)
    return cells.select("fold", "n_scored", "n_rows")


def two_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means on two far-apart groups: the centres are the groups' means."""
    emb = fit_layout(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), ["vec_id"])
    moved = F.transform("embedding", lambda v: v.cast("double") + 100 * (F.col("vec_id") % 2))
    vecs = emb.select(array_to_vector(moved).alias("features"))
    with M.persisted(vecs):
        centres = sorted(M.kmeans(2).fit(vecs).clusterCenters(), key=lambda c: c[0])
    rows = [(g, i, round(float(v), 6) + 0.0) for g, c in enumerate(centres) for i, v in enumerate(c)]
    return spark.createDataFrame(rows, "grp int, pos int, value double")


def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim gate on a label that its only category decides: predicted
    ones, actual ones, rows."""
    from tessera.operators.clean import class_balance
    data = _separable(spark, sf_dir).withColumnRenamed("label", "y")
    with M.persisted(data):
        model = M.fit_claim_gate(data, ["x"], ["z"])
        scored = model.transform(data)
        return class_balance(scored, F.col("prediction1") != 0, F.col("y") != 0).checkpoint(eager=True)


# --- what fitted models must satisfy ---------------------------------------------

SPLIT_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a label that several columns decide together."""
    li = read_table(spark, sf_dir, "lineitem", *KEY, "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    score = F.col("l_quantity") + 200 * F.col("l_discount") + 100 * F.col("l_tax") + F.col("l_linenumber")
    return li.withColumn("label", (score > 43).cast("double"))


def split_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy gain of every candidate split; the price has far more values
    than bins."""
    ensure_checkpoint_dir(spark)
    rows = _split_rows(spark, sf_dir)
    gains = (D.split_gains(rows, SPLIT_FEATURES, "label", max_bins=64)
             .unionByName(D.split_gains(rows, ["l_extendedprice"], "label", max_bins=32)))
    return gains.withColumn("gain", F.round("gain", 9))


def tree_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root feature and threshold: of a fitted tree, and of the gain table."""
    ensure_checkpoint_dir(spark)
    rows = _split_rows(spark, sf_dir)
    data = VectorAssembler(inputCols=SPLIT_FEATURES, outputCol="features").transform(fit_layout(rows.select(*KEY, *SPLIT_FEATURES[:-1], "label"), KEY))
    with M.persisted(data):
        model = M.claim_tree("label", max_depth=5).setMaxBins(64).fit(data)
    feature, threshold = D.tree_root(model, SPLIT_FEATURES)
    fitted = spark.createDataFrame([("tree", feature, threshold)], "source string, feature string, threshold double")
    best = D.best_split(D.split_gains(rows, SPLIT_FEATURES, "label", max_bins=64))
    return fitted.unionByName(best.select(F.lit("gains").alias("source"), "feature", "threshold"))


def importance_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most important features of a tree of two levels, ranked: the label is
    'x or z', so the gains of its two splits are known."""
    ensure_checkpoint_dir(spark)
    li = read_table(spark, sf_dir, "lineitem", *KEY, "l_quantity", "l_discount")
    x, z = F.col("l_quantity") > 25, F.col("l_discount") > 0.07
    names = ["w", "x", "z"]
    rows = li.select(*KEY, F.lit(1.0).alias("w"), x.cast("double").alias("x"), z.cast("double").alias("z"), (x | z).cast("double").alias("label"))
    data = VectorAssembler(inputCols=names, outputCol="features").transform(fit_layout(rows, KEY))
    with M.persisted(data):
        model = M.claim_tree("label", max_depth=2).fit(data)
    top = M.top_importances(M.feature_importances(model, names, spark), 3)
    order = Window.orderBy(F.desc("importance"), "feature")  # three rows
    return top.select(F.row_number().over(order).alias("rank"), "feature", F.round("importance", 9).alias("importance"))


def holdout_separable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holdout classifier at its full settings on a label that one column
    decides: rows and positives of either side, AUC and accuracy 1, the deciding
    column on top."""
    ensure_checkpoint_dir(spark)
    rows = stored(_separable_rows(spark, sf_dir))
    train = laid_out(rows, KEY, keep=in_train(KEY, 0.7, M.SEED), columns=["x", "z", "label"])
    _, test = train_test(rows, KEY, 0.7, M.SEED)  # scored as written: no row's order matters
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["z", "x"], outputCol="features"), M.gbt("label")])
    with M.persisted(train):
        model = pipe.fit(train)
        sizes = train.agg(F.count(F.lit(1)).alias("n_train"), F.count_if(F.col("label") == 1).alias("train_positives")).checkpoint(eager=True)
    report = M.side_by_side(M.binary_report(model.transform(test), "label"), sizes)
    top = M.top_importances(M.feature_importances(model.stages[-1], ["z", "x"], spark), 1).select("feature")
    return M.side_by_side(report.withColumns({"auc": F.round("auc", 9), "accuracy": F.round("accuracy", 9)}), top)


def tuning_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 % sample before tuning, its holdout, and the five folds of its
    training part: (part, fold, n, positives)."""
    train, test = _tuning_sample(spark, sf_dir)
    folds = assign_folds(train, KEY, 5, M.SEED + 2).withColumn("part", F.lit("train"))
    both = folds.unionByName(test.withColumns({"fold": F.lit(0), "part": F.lit("test")}))
    return both.groupBy("part", "fold").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("positives"))


def _tuning_sample(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sample = hash_sample(_separable(spark, sf_dir), KEY, 0.05, M.SEED)
    return train_test(sample, KEY, 0.7, M.SEED + 1)  # independent of the sample's draw


def gbt_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees in the tuner, five folds, on the 5 % sample with a
    separable label: every cell ties, the first is refitted, and it gets the
    held-out rows right."""
    ensure_checkpoint_dir(spark)
    train, test = _tuning_sample(spark, sf_dir)
    est = M.gbt("label", max_depth=1, max_bins=5, max_iter=1)
    grid = M.param_grid(est, maxBins=[5, 10], maxIter=[1, 2])
    model, cells = M.cross_validate(fit_layout(train, KEY), ["x", "z"], est, grid, KEY, "label", folds=5, seed=M.SEED + 2, parallelism=4)
    report = M.binary_report(model.transform(test), "label").select("accuracy", "n_test")
    return cells.crossJoin(F.broadcast(report)).select(
        "cell", F.col("params")["maxBins"].alias("maxBins"), F.col("params")["maxIter"].alias("maxIter"), F.round("auc", 9).alias("auc"), "best",
        F.round("accuracy", 9).alias("accuracy"), "n_test")


# Relative bounds: the GLM solver stops at a relative change of 1e-6; ALS solves
# the users last, so they are exact up to single precision and the items lag by
# one half-step; k-means stops when no centre moves by more than 1e-4.
SCORE_BOUND, USER_BOUND, ITEM_BOUND, CENTRE_BOUND = 1e-4, 1e-4, 0.2, 1e-3


def severity_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every coefficient of the fitted severity model with its training rows
    and whether its score equation holds; and the test rows it is scored on."""
    positives, test, cat, num = PM.encoded_claims(spark, sf_dir, actual_only=True)
    with M.persisted(positives):
        model = M.fit_claim_severity(positives, cat, num)
        eq = D.score_equations(positives, model, cat, num, "Claim_Amount", "prediction2", 0.01)
        solved = F.abs("residual") <= SCORE_BOUND * F.col("scale")
        scored = MT.regression_metrics(model.transform(test), "prediction2", "Claim_Amount")
        out = eq.select("feature", F.coalesce("level", F.lit("")).alias("level"), "n", solved.alias("solved")).unionByName(
            scored.select(F.lit("(test rows)").alias("feature"), F.lit("").alias("level"), F.col("n_scored").alias("n"),
                          (F.col("n_scored") == F.col("n_rows")).alias("solved")))
        return out.checkpoint(eager=True)


def als_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each fold's model at the grid's first parameter: every user and item
    with its training ratings and whether its normal equations hold."""
    ensure_checkpoint_dir(spark)
    folded = fit_layout(rating_folds(spark, sf_dir), RATING_KEY)
    out, rank, reg = None, 10, 0.1
    with releasing(spark), M.persisted(folded):
        blocks = M.als_blocks(folded.count())
        for fold in (1, 2, 3):
            train, _ = fold_train_test(folded, fold)
            model = M.als(reg, rank=rank, num_blocks=blocks).fit(train)
            users = D.normal_residuals(train, model.itemFactors, model.userFactors, "movieId", "userId", reg, rank)
            items = D.normal_residuals(train, model.userFactors, model.itemFactors, "userId", "movieId", reg, rank)
            for side, rows, bound in (("user", users, USER_BOUND), ("item", items, ITEM_BOUND)):
                part = rows.toDF("id", "n", "residual").select(F.lit(fold).alias("fold"), F.lit(side).alias("side"), "id", "n",
                                                              (F.col("residual") <= bound).alias("solved")).checkpoint(eager=True)
                out = part if out is None else out.unionByName(part)
                del rows, part
            del train, model, users, items
            drop_finished(spark)
    return out


def split_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rating fold alone: its ratings and the items it has factors for,
    all of them in a cluster, and whether k-means came to rest: every centre is
    the mean of its members."""
    ensure_checkpoint_dir(spark)
    folded = fit_layout(rating_folds(spark, sf_dir), RATING_KEY)
    out = None
    with releasing(spark), M.persisted(folded):
        for fold in (1, 2, 3):
            part = folded.filter(F.col("fold") == fold)
            assigned, vecs, centres = M.clustered_items(part, k=25, kmeans_iter=200)
            gaps = D.centre_gaps(vecs, assigned, centres, "movieId").agg(
                F.sum("n").alias("n_items"), F.coalesce(F.max("gap") <= CENTRE_BOUND, F.lit(True)).alias("at_rest"))
            row = M.side_by_side(part.agg(F.count(F.lit(1)).alias("n_ratings")), gaps).select(
                F.lit(fold).alias("fold"), "n_ratings", "n_items", "at_rest").checkpoint(eager=True)
            out = row if out is None else out.unionByName(row)
    return out


QUERIES = {
    "split_gains": split_gains,
    "tree_roots": tree_roots,
    "importance_rank": importance_rank,
    "holdout_separable": holdout_separable,
    "tuning_folds": tuning_folds,
    "gbt_cells": gbt_cells,
    "severity_equations": severity_equations,
    "als_equations": als_equations,
    "split_fits": split_fits,
    "tree_families": tree_families,
    "cv_cells": cv_cells,
    "cv_fold_sizes": cv_fold_sizes,
    "als_scored": als_scored,
    "two_centres": two_centres,
    "gate_report": gate_report,
}
