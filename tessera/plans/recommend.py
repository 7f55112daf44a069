"""Registered recommendation queries: folds, tag relevance, cluster
descriptions and the fold-metric matrix.

The relational queries use the fixed stand-in cluster assignment
``least(movieId % 31, 24)`` over the rated items (uneven cluster sizes), so
they have exact SQL oracles; ``plans.models`` runs the same operators on
real ALS + k-means output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import recommend as R
from tessera.operators.split import assign_folds, fold_train_test
from tessera.session import ensure_checkpoint_dir, scratch_path
from tessera.sources import files
from tessera.sources.fixtures import FIXTURE_TAGS, genome_scores, genome_tags, ratings

RATING_KEY = ["userId", "movieId"]
# Regularisation grid of the rating models.
REG_PARAMS = (0.1, 0.5, 1.0)


def rating_folds(spark: SparkSession, sf_dir: str, k: int = 3, seed: int = 123) -> DataFrame:
    return assign_folds(ratings(spark, sf_dir), RATING_KEY, k, seed)


def stand_in_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = ratings(spark, sf_dir).select("movieId").distinct()
    return items.select("movieId", F.least(F.col("movieId") % 31, F.lit(24)).cast("int").alias("prediction"))


def kfold_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_folds(spark, sf_dir)


def fold_train_sets(spark: SparkSession, sf_dir: str, folds: int = 3) -> DataFrame:
    """(k, userId, movieId, part): for each fold k, the union of the other
    folds as 'train' and fold k as 'test'."""
    folded = rating_folds(spark, sf_dir, folds)
    out = None
    for k in range(1, folds + 1):
        for part, rows in zip(("train", "test"), fold_train_test(folded, k)):
            rows = rows.select(F.lit(k).alias("k"), *RATING_KEY, F.lit(part).alias("part"))
            out = rows if out is None else out.unionByName(rows)
    return out


def ratings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings written as headered CSV and read back with a typed schema."""
    path = scratch_path(spark, "ratings-csv")
    files.write_csv(ratings(spark, sf_dir), path)
    return files.read_csv(spark, path, "userId bigint, movieId bigint, rating double")


def tag_names_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tag-name lookup of the scored items' tags, through CSV."""
    names = genome_scores(spark, sf_dir).select("tagId").distinct().join(genome_tags(spark, sf_dir), "tagId")
    path = scratch_path(spark, "tags-csv")
    files.write_csv(names, path)
    return files.read_csv(spark, path, "tagId int, tag string")


def best_tag_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best tag of every item with its name, written as a report and read
    back; tags without a name stay NULL."""
    best = R.item_best_tag(genome_scores(spark, sf_dir)).join(genome_tags(spark, sf_dir), "tagId", "left")
    paths = files.write_report({"best": best.select("movieId", "max_relevance", "tag")}, scratch_path(spark, "best-tag"))
    return files.read_csv(spark, paths["best"], "movieId bigint, max_relevance double, tag string")


def fold_matrix_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold-metric matrix written as a report and read back."""
    matrix = fold_metric_matrix(spark, sf_dir)
    paths = files.write_report({"matrix": matrix}, scratch_path(spark, "fold-matrix"))
    return files.read_csv(spark, paths["matrix"], matrix.schema)


def item_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.item_tag_counts(genome_scores(spark, sf_dir))


def complete_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.complete_items(genome_scores(spark, sf_dir), full=FIXTURE_TAGS)


def item_max_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.item_max_relevance(genome_scores(spark, sf_dir))


def item_best_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.item_best_tag(genome_scores(spark, sf_dir))


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cluster_sizes(stand_in_clusters(spark, sf_dir), k=3)


def cluster_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cluster_coverage(stand_in_clusters(spark, sf_dir),
                              R.item_best_tag(genome_scores(spark, sf_dir)), k=3)


def cluster_top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = R.cluster_top_tags(stand_in_clusters(spark, sf_dir),
                             R.item_best_tag(genome_scores(spark, sf_dir)),
                             genome_tags(spark, sf_dir), k_clusters=3, k_tags=3)
    return top.withColumn("sum_relevance", F.round("sum_relevance", 6))


def shrunk_item_mean_cells(folded: DataFrame, reg_params=REG_PARAMS) -> DataFrame:
    """Deterministic stand-in scores for the fold grid: model i predicts the
    item's training-fold mean shrunk towards the training-fold global mean
    by ``reg_params[i]``; items without training ratings are not scored
    (cold-start rows dropped).

    The prediction is constant per (item, fold, model), so the ratings are
    reduced once to (item, fold, rating value) counts with a partial
    aggregate — a hot item adds one row per task, not its ratings — and
    everything after that (training statistics of fold k = item totals
    minus the item's fold-k part, all folds and models at once) joins only
    aggregated tables."""
    ensure_checkpoint_dir(folded.sparkSession)
    # read four times below: materialise the (small) aggregate once
    cells = (folded.groupBy("movieId", "fold", "rating").agg(F.count(F.lit(1)).alias("c"))
             .checkpoint(eager=True))
    per_item_fold = cells.groupBy("movieId", "fold").agg(
        F.sum(F.col("c") * F.col("rating")).alias("s"), F.sum("c").alias("n"))
    per_item = per_item_fold.groupBy("movieId").agg(F.sum("s").alias("item_s"), F.sum("n").alias("item_n"))
    per_fold = per_item_fold.groupBy("fold").agg(F.sum("s").alias("fs"), F.sum("n").alias("fn"))
    every_fold = Window.partitionBy()  # k rows, one per fold
    fold_mean = per_fold.select(
        "fold", F.try_divide(F.sum("fs").over(every_fold) - F.col("fs"),
                             F.sum("fn").over(every_fold) - F.col("fn")).alias("mu"))
    train = (per_item_fold.join(per_item, "movieId")
             .select("movieId", "fold", (F.col("item_s") - F.col("s")).alias("ts"),
                     (F.col("item_n") - F.col("n")).alias("tn"))
             .filter(F.col("tn") > 0))
    grid = F.array(*[F.struct(F.lit(i + 1).alias("model"), F.lit(r).alias("lam"))
                     for i, r in enumerate(reg_params)])
    scored = (cells.join(train, ["movieId", "fold"])
              .join(F.broadcast(fold_mean), "fold")  # k rows
              .select("fold", "rating", "c", "ts", "tn", "mu", F.explode(grid).alias("g"))
              .select(F.col("g.model").alias("model"), "fold", "rating", "c",
                      ((F.col("ts") + F.col("g.lam") * F.col("mu")) / (F.col("tn") + F.col("g.lam")))
                      .alias("prediction")))
    return M.regression_metrics(scored, "prediction", "rating", by=["model", "fold"], weight="c")


def fold_metric_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = shrunk_item_mean_cells(rating_folds(spark, sf_dir))
    cells = cells.select("model", "fold", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))
    out = M.fold_metric_matrix(cells)
    return out.select("model", *[F.round(c, 6).alias(c) for c in out.columns if c != "model"])


QUERIES = {
    "kfold_train_test": kfold_train_test,
    "fold_train_sets": fold_train_sets,
    "ratings_csv": ratings_csv,
    "tag_names_csv": tag_names_csv,
    "best_tag_csv": best_tag_csv,
    "fold_matrix_csv": fold_matrix_csv,
    "item_tag_counts": item_tag_counts,
    "complete_items": complete_items,
    "item_max_relevance": item_max_relevance,
    "item_best_tag": item_best_tag,
    "cluster_sizes": cluster_sizes,
    "cluster_coverage": cluster_coverage,
    "cluster_top_tags": cluster_top_tags,
    "fold_metric_matrix": fold_metric_matrix,
}
