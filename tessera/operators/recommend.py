"""Item-tag relevance and cluster description operators.

Everything the reference does with one Spark job per item or per cluster
and driver-side pandas (best tag per item, cluster sizes, coverage, the
strongest tags of the biggest clusters, tag names) is a single plan here:
partial aggregates, semi/inner joins and one ranking window whose
partial ``WindowGroupLimit`` runs before the shuffle.

Broadcasts are only of tables that are small by construction: the top-k
clusters (k rows) and the top tags (k x m rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A fully scored item carries this many tags in the genome table.
FULL_TAG_COUNT = 1128


def item_tag_counts(scores: DataFrame) -> DataFrame:
    """(movieId, n_tags) per scored item."""
    return scores.groupBy("movieId").agg(F.count(F.lit(1)).alias("n_tags"))


def complete_items(scores: DataFrame, full: int = FULL_TAG_COUNT) -> DataFrame:
    """One row: scored items and those with exactly ``full`` tags."""
    per_item = item_tag_counts(scores)
    return per_item.agg(F.count(F.lit(1)).alias("n_items"),
                        F.count_if(F.col("n_tags") == full).alias("n_complete"))


def item_max_relevance(scores: DataFrame) -> DataFrame:
    """(movieId, max_relevance)."""
    return scores.groupBy("movieId").agg(F.max("relevance").alias("max_relevance"))


def item_best_tag(scores: DataFrame) -> DataFrame:
    """(movieId, max_relevance, tagId): the tag with the highest relevance per
    item, ties to the smallest tag id. One aggregate (``max_by`` on a
    (relevance, -tagId) struct), partially combined before the shuffle."""
    order = F.struct(F.col("relevance"), (-F.col("tagId")).alias("neg_tag"))
    return scores.groupBy("movieId").agg(
        F.max("relevance").alias("max_relevance"),
        F.max_by("tagId", order).alias("tagId"))


def cluster_sizes(assignments: DataFrame, k: int = 3) -> DataFrame:
    """The k biggest clusters: (prediction, n_members), ties by cluster id."""
    return (assignments.groupBy("prediction").agg(F.count(F.lit(1)).alias("n_members"))
            .orderBy(F.desc("n_members"), F.asc("prediction")).limit(k))


def top_cluster_members(assignments: DataFrame, k: int = 3) -> DataFrame:
    """Assignments restricted to the k biggest clusters (semi-join with a
    k-row table)."""
    top = cluster_sizes(assignments, k).select("prediction")
    return assignments.join(F.broadcast(top), "prediction", "left_semi")


def cluster_coverage(assignments: DataFrame, best_tags: DataFrame, k: int = 3) -> DataFrame:
    """Per top-k cluster: members, and members that have tag scores."""
    members = top_cluster_members(assignments, k)
    scored = best_tags.select("movieId", F.lit(1).alias("_scored"))
    return (members.join(scored, "movieId", "left")
            .groupBy("prediction")
            .agg(F.count(F.lit(1)).alias("n_members"), F.count("_scored").alias("n_scored")))


def cluster_top_tags(assignments: DataFrame, best_tags: DataFrame, tags: DataFrame,
                     k_clusters: int = 3, k_tags: int = 3) -> DataFrame:
    """For each of the k biggest clusters, the ``k_tags`` best tags ranked by
    summed best-tag relevance of the cluster's scored members (ties by tag
    id), with their names; tags without a name are dropped after ranking.
    Output: prediction, rank, tagId, tag, n_items, sum_relevance."""
    members = top_cluster_members(assignments, k_clusters)
    per_tag = (members.join(best_tags, "movieId")
               .groupBy("prediction", "tagId")
               .agg(F.count(F.lit(1)).alias("n_items"),
                    F.sum("max_relevance").alias("sum_relevance")))
    by_sum = Window.partitionBy("prediction").orderBy(F.desc("sum_relevance"), F.asc("tagId"))
    top = (per_tag.withColumn("rank", F.row_number().over(by_sum))
           .filter(F.col("rank") <= k_tags))
    named = tags.join(F.broadcast(top), "tagId")  # top has <= k_clusters * k_tags rows
    return named.select("prediction", F.col("rank").cast("int").alias("rank"), "tagId", "tag",
                        "n_items", "sum_relevance")
