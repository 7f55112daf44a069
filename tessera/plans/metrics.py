"""Registered metric, split and combination queries on deterministic scores
(the fixed stand-ins: score ``l_quantity`` for label ``l_returnflag='R'``,
gate ``l_quantity > 25``, prediction ``0.9 * l_extendedprice`` for label
``l_extendedprice``), so each has an exact SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators.clean import class_balance as balance
from tessera.operators.rowid import stable_ids
from tessera.operators.split import hash_sample, hash_split
from tessera.operators.tandem import combine_by_key
from tessera.sources.fixtures import particles
from tessera.sources.tables import read_table

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "lineitem", *cols)


def metric_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_quantity", "l_returnflag")
    return M.auc(li, "l_quantity", F.col("l_returnflag") == "R").withColumn("auc", F.round("auc", 12))


def metric_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_quantity", "l_returnflag")
    return M.accuracy(li, F.col("l_quantity") > 25, F.col("l_returnflag") == "R")


def metric_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_extendedprice")
    return M.rmse(li, F.col("l_extendedprice") * 0.9, "l_extendedprice").withColumn("rmse", F.round("rmse", 6))


def metric_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_extendedprice")
    return M.mae(li, F.col("l_extendedprice") * 0.9, "l_extendedprice").withColumn("mae", F.round("mae", 6))


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_quantity", "l_returnflag")
    return balance(li, F.col("l_quantity") > 25, F.col("l_returnflag") == "R")


def tandem_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line gets the gate's decision; gated lines get the severity
    prediction from a separate table, joined back on a row id.

    (orderkey, linenumber, partkey, suppkey) repeats in small tables, so the
    lines get stable ids first; the severity table carries only the id."""
    key, row_id = LINE_KEY + ["l_quantity", "l_extendedprice"], ["row_hash", "row_nth"]
    li = stable_ids(_lines(spark, sf_dir, *key))
    all_rows = li.select(*LINE_KEY, *row_id, (F.col("l_quantity") > 25).cast("double").alias("prediction1"),
                         F.col("l_extendedprice").alias("Claim_Amount"))
    severity = (li.filter(F.col("l_quantity") > 25)
                .select(*row_id, F.col("l_extendedprice").alias("prediction2")))
    return combine_by_key(all_rows, severity, row_id).drop(*row_id)


def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of rows that repeat many times: the ordinals of equal rows, and
    whether the id occurs once."""
    li = stable_ids(_lines(spark, sf_dir, "l_returnflag", "l_linestatus", "l_quantity"))
    once = li.groupBy("row_hash", "row_nth").agg((F.count(F.lit(1)) == 1).alias("unique"))
    return li.join(once, ["row_hash", "row_nth"]).drop("row_hash")


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = particles(spark, sf_dir).select("vec_id", "label")
    return hash_split(p, ["vec_id"], 0.7, 123)


def subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = particles(spark, sf_dir).select("vec_id", "label", "f1", "f28")
    return hash_sample(p, ["vec_id"], 0.05, 123)


QUERIES = {
    "metric_auc": metric_auc,
    "metric_accuracy": metric_accuracy,
    "metric_rmse": metric_rmse,
    "metric_mae": metric_mae,
    "class_balance": class_balance,
    "tandem_combine": tandem_combine,
    "row_ids": row_ids,
    "holdout_split": holdout_split,
    "subsample": subsample,
}
