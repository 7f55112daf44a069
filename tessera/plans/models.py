"""Registered model queries, at the analyses' own settings: depth 10, 20
iterations, 3 x 3 grids and 5 folds for the particle models, depth 20 and 50
iterations for the claims, rank 10 and 10 iterations for the ratings. They
train on the whole tables. ``plans.model_checks`` has companions whose results
SQL can state.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tessera.operators import metrics as MT
from tessera.operators import models as M
from tessera.operators import recommend as R
from tessera.operators.clean import class_balance
from tessera.operators.encode import encode
from tessera.operators.split import hash_split, train_test
from tessera.operators.tandem import gate
from tessera.plans import claims as CP
from tessera.plans.recommend import RATING_KEY, REG_PARAMS, rating_folds
from tessera.sources.fixtures import genome_scores, genome_tags, particles
from tessera.session import drop_finished, ensure_checkpoint_dir, releasing
from tessera.sources.tables import fit_layout, laid_out, stored

# The tuning grids of the two particle models.
FOREST_GRID = {"numTrees": [5, 10, 20], "maxBins": [3, 5, 10]}
GBT_GRID = {"maxBins": [3, 5, 10], "maxIter": [5, 10, 15]}

FEATURES = [f"f{i}" for i in range(1, 29)]
LABEL = "label_signal"  # the particle label with learnable signal


def _particle_split(spark, sf_dir):
    ensure_checkpoint_dir(spark)  # boosted trees checkpoint their lineage there
    p = particles(spark, sf_dir).select("vec_id", F.col(LABEL).alias("label"), *FEATURES)
    return train_test(fit_layout(p, ["vec_id"]), ["vec_id"], 0.7, M.SEED)


def _fit_gbt(spark, sf_dir):
    train, test = _particle_split(spark, sf_dir)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"),
                            M.gbt("label")])
    with M.persisted(train):
        model = pipe.fit(train)
    return model, test


def gbt_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _fit_gbt(spark, sf_dir)
    return M.binary_report(model.transform(test), "label")


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _fit_gbt(spark, sf_dir)
    imp = M.feature_importances(model.stages[-1], FEATURES, spark)
    return M.top_importances(imp, 3)


def _cv(spark, sf_dir, which: str):
    train, test = _particle_split(spark, sf_dir)
    if which == "forest":
        est = M.forest("label")
        grid = M.param_grid(est, **FOREST_GRID)
    else:
        est = M.gbt("label", max_bins=5, max_iter=10)
        grid = M.param_grid(est, **GBT_GRID)
    model, cells = M.cross_validate(train, FEATURES, est, grid, ["vec_id"], "label", folds=5,
                                    seed=M.SEED + 1, parallelism=4)
    return model, cells, test


def _cells_out(cells: DataFrame) -> DataFrame:
    return cells.select(F.to_json("params").alias("params"), "auc", "best")


def forest_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, cells, _ = _cv(spark, sf_dir, "forest")
    return _cells_out(cells)


def gbt_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, cells, _ = _cv(spark, sf_dir, "gbt")
    return _cells_out(cells)


def grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best grid cell per tuned model, and that model's held-out AUC/accuracy."""
    out = None
    for which in ("forest", "gbt"):
        model, cells, test = _cv(spark, sf_dir, which)
        best = M.grid_best(cells).select(F.lit(which).alias("model"),
                                         F.to_json("params").alias("params"),
                                         F.col("auc").alias("cv_auc"))
        report = M.binary_report(model.transform(test), "label")
        row = M.side_by_side(best, report)
        out = row if out is None else out.unionByName(row)
    return out


# --- two-part claim model ---------------------------------------------------

def encoded_claims(spark, sf_dir, actual_only: bool = False):
    """(training rows in their layout, test rows, categorical, numeric columns).
    All encoded rows are written once; what is dealt, sorted and persisted for a
    fit are the rows of the training split with the columns of the models. With
    ``actual_only`` (models of actual claims) the other claims leave before the
    tables are joined; the dictionaries are learned from all of them."""
    clean = CP.cleaned_claims(spark, sf_dir)
    cols = CP.claim_columns(clean)
    mapping = CP.learned_mapping(spark, sf_dir)
    drop_finished(spark)  # the joins that were counted
    enc = encode(clean.filter(F.col("y") == 1) if actual_only else clean, mapping, cols["large"] + cols["string"])
    categorical = cols["int"] + cols["string"] + cols["large"]
    # the whole row as key: the business key repeats in small tables
    enc = enc.withColumn("row_key", F.xxhash64(*enc.columns))
    rows = stored(hash_split(enc, CP.KEY + ["y"], 0.7, M.SEED))
    drop_finished(spark)  # the joins that were written
    train = laid_out(rows, ["row_key"], keep=F.col("split") == "train",
                     columns=[*categorical, *cols["numeric"], "y", "Claim_Amount"])
    return train, rows.filter(F.col("split") == "test"), categorical, cols["numeric"]


def claim_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree gate on the training split: predicted ones, actual ones, rows."""
    train, _, cat, num = encoded_claims(spark, sf_dir)
    with M.persisted(train):
        model = M.fit_claim_gate(train, cat, num)
        scored = model.transform(train)
        return _materialised(class_balance(scored, F.col("prediction1") != 0, F.col("y") != 0))


def _materialised(result: DataFrame) -> DataFrame:
    """Compute a small result while the training data is still persisted; it
    is written, so nothing stays held for it."""
    return result.checkpoint(eager=True)


def claim_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gamma GLM on actual claims; rmse/mae on the test split's claims."""
    positives, test_pos, cat, num = encoded_claims(spark, sf_dir, actual_only=True)
    with M.persisted(positives):
        model = M.fit_claim_severity(positives, cat, num)
    return _materialised(MT.regression_metrics(model.transform(test_pos), "prediction2", "Claim_Amount"))


def tandem_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier gates the GLM on the test split; ungated rows predict 0."""
    train, test, cat, num = encoded_claims(spark, sf_dir)
    with M.persisted(train):
        clf = M.fit_claim_gate(train, cat, num)
        # a pass of the GLM reads the actual claims only
        with M.persisted(train.filter(F.col("y") == 1)) as positives:
            reg = M.fit_claim_severity(positives, cat, num)
    both = reg.transform(clf.transform(test).drop("features"))
    final = both.select(gate("prediction1", "prediction2").alias("prediction"), "Claim_Amount")
    return _materialised(MT.regression_metrics(final, "prediction", "Claim_Amount"))


# --- ratings: ALS grid and clusters ------------------------------------------

def als_fold_grid(spark: SparkSession, sf_dir: str, num_blocks: int | None = None) -> DataFrame:
    """3 folds x 3 regularisation values; metric matrix with mean/std."""
    ensure_checkpoint_dir(spark)  # ALS checkpoints its factor lineage there
    folded = fit_layout(rating_folds(spark, sf_dir), RATING_KEY)
    cells = M.als_grid(folded, REG_PARAMS, folds=3, parallelism=3, num_blocks=num_blocks)
    return MT.fold_metric_matrix(cells)


def item_clusters(spark: SparkSession, sf_dir: str, k: int = 25, num_blocks: int | None = None) -> DataFrame:
    """Per rating fold alone: ALS item factors -> k-means -> the 3 biggest
    clusters' 3 strongest tags (by summed best-tag relevance) with names,
    plus each cluster's member and scored-member counts. The three splits
    are fitted concurrently."""
    ensure_checkpoint_dir(spark)
    folded = fit_layout(rating_folds(spark, sf_dir), RATING_KEY)
    best = R.item_best_tag(genome_scores(spark, sf_dir)).checkpoint(eager=True)  # used for each split, twice
    tags = genome_tags(spark, sf_dir)

    def clusters(split):
        part = folded.filter(F.col("fold") == split)
        return split, M.item_clusters(part, k=k, num_blocks=num_blocks)

    with releasing(spark), M.persisted(folded), ThreadPoolExecutor(max_workers=3) as pool:
        assigned = list(pool.map(inheritable_thread_target(spark)(clusters), (1, 2, 3)))
    out = None
    for split, a in assigned:
        top = (R.cluster_top_tags(a, best, tags)
               .join(R.cluster_coverage(a, best), "prediction")  # 3 rows: members, scored
               .withColumn("split", F.lit(split)))
        out = top if out is None else out.unionByName(top)
    return out


QUERIES = {
    "gbt_holdout": gbt_holdout,
    "feature_importance": feature_importance,
    "forest_cv": forest_cv,
    "gbt_cv": gbt_cv,
    "grid_best": grid_best,
    "claim_classifier": claim_classifier,
    "claim_severity": claim_severity,
    "tandem_model": tandem_model,
    "als_fold_grid": als_fold_grid,
    "item_clusters": item_clusters,
}
