"""Evaluation metrics as DataFrame aggregates.

The same numbers as spark.ml's evaluators, but as plain aggregates: they
combine map-side, can be grouped by model/fold in one pass, and can be
checked against SQL. AUC is exact (ties get half credit) and never sorts
all rows in one task: scores are grouped first, and the running count of
negatives uses ranged prefix sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import ordered_prefix


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def auc(df: DataFrame, score: str | Column, label: str | Column, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve of ``score`` for a boolean/0-1 ``label``:
    sum over positives of (negatives scored lower + half the negatives with
    the same score), over positives x negatives. Optionally per group.
    Rows without score or label are not scored: ``n_scored`` of ``n_rows``."""
    by = by or []
    pos = _c(label).cast("boolean")
    known = F.col("score").isNotNull() & ~F.isnan("score") & F.col("_pos").isNotNull()
    grouped = (df.select(*by, _c(score).cast("double").alias("score"), pos.alias("_pos"))
               .withColumn("score", F.when(known, F.col("score")))
               .groupBy(*by, "score")
               .agg(F.count_if(F.col("_pos") & F.col("score").isNotNull()).alias("pos"),
                    F.count_if(~F.col("_pos") & F.col("score").isNotNull()).alias("neg"),
                    F.count(F.lit(1)).alias("rows")))
    ranked = ordered_prefix(grouped, by, ["score"], weight="neg", out="neg_before")
    credit = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    return ranked.groupBy(*by).agg(
        # a group without positives or without negatives has no AUC: NULL
        F.try_divide(F.sum(credit), F.sum("pos") * F.sum("neg")).alias("auc"),
        F.sum(F.col("pos") + F.col("neg")).cast("bigint").alias("n_scored"),
        F.sum("rows").cast("bigint").alias("n_rows"))


def accuracy(df: DataFrame, prediction: str | Column, label: str | Column) -> DataFrame:
    """Share of the scored rows whose prediction equals the label; rows
    without either are not scored: ``n_scored`` of ``n_rows``."""
    hit = (_c(prediction).cast("double") == _c(label).cast("double")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(hit).alias("n_scored"),
                  F.count(F.lit(1)).alias("n_rows"))


def regression_metrics(df: DataFrame, prediction: str | Column, label: str | Column,
                       by: list[str] | None = None, weight: str | Column | None = None) -> DataFrame:
    """rmse, mae, the number of scored rows and of all (NULL/NaN predictions,
    e.g. cold-start rows, are not scored). With ``weight`` each row stands for
    that many identical rows (pre-aggregated input)."""
    by = by or []
    err = _c(prediction).cast("double") - _c(label).cast("double")
    w = F.lit(1).cast("bigint") if weight is None else _c(weight)
    scored = df.select(*by, F.when(~F.isnan(err), err).alias("_err"), w.alias("_all")).withColumn(
        "_w", F.when(F.col("_err").isNotNull(), F.col("_all")))
    if weight is None:
        return scored.groupBy(*by).agg(
            F.sqrt(F.avg(F.col("_err") * F.col("_err"))).alias("rmse"),
            F.avg(F.abs("_err")).alias("mae"),
            F.count("_err").alias("n_scored"),
            F.count(F.lit(1)).alias("n_rows"))
    n = F.sum("_w")
    return scored.groupBy(*by).agg(
        F.sqrt(F.try_divide(F.sum(F.col("_w") * F.col("_err") * F.col("_err")), n)).alias("rmse"),
        F.try_divide(F.sum(F.col("_w") * F.abs("_err")), n).alias("mae"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("n_scored"),
        F.sum("_all").cast("bigint").alias("n_rows"))


def rmse(df: DataFrame, prediction: str | Column, label: str | Column) -> DataFrame:
    """Root mean squared error (one row)."""
    return regression_metrics(df, prediction, label).select("rmse", "n_scored", "n_rows")


def mae(df: DataFrame, prediction: str | Column, label: str | Column) -> DataFrame:
    """Mean absolute error (one row)."""
    return regression_metrics(df, prediction, label).select("mae", "n_scored", "n_rows")


def fold_metric_matrix(cells: DataFrame, metrics: tuple[str, ...] = ("rmse", "mae"),
                       folds: int = 3) -> DataFrame:
    """(model, fold, rmse, mae, ...) cells -> one row per model with
    ``<metric>_1..k``, ``mean_<metric>`` and ``std_<metric>`` (population
    standard deviation across folds)."""
    aggs = []
    for m in metrics:
        aggs += [F.max(F.when(F.col("fold") == f, F.col(m))).alias(f"{m}_{f}") for f in range(1, folds + 1)]
        aggs += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    return cells.groupBy("model").agg(*aggs)
