"""Registered feature queries: assembled vectors, one-hot slots, factor
vectors, nearest-centre assignment and the saturated gamma GLM."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import features as X
from tessera.operators.models import persisted
from tessera.sources.fixtures import PARTICLE_FEATURES, particles
from tessera.sources.tables import read_table

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = [f"f{i}" for i in range(1, PARTICLE_FEATURES + 1)]


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = X.assemble(particles(spark, sf_dir), FEATURES, keep=["vec_id"])
    return X.vector_long(v, ["vec_id"]).select("vec_id", F.col("pos").cast("int"), "value")


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", *LINE_KEY)
    enc, (col,) = X.one_hot(li, ["l_linenumber"])
    return enc.select(*LINE_KEY, F.size(vector_to_array(col)).alias("ohe_size"),
                      X.one_hot_position(col).alias("ohe_index"))


def factor_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-factor table (id, features ARRAY<FLOAT>) -> vectors; shown long."""
    f = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    v = X.factor_vectors(f)
    return X.vector_long(v, ["movieId"]).select("movieId", F.col("pos").cast("int"), "value")


def centroid_table(spark: SparkSession, sf_dir: str, k: int = 5) -> list[list[float]]:
    """Stand-in model centres: the first k embeddings by id. A k-row read, so
    collecting it is bounded by k, not by the data."""
    rows = (read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
            .filter(F.col("vec_id") < k).orderBy("vec_id").collect())
    return [[float(x) for x in r["embedding"]] for r in rows]


def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    centres = centroid_table(spark, sf_dir)
    emb = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return emb.select("vec_id", X.nearest_centre("embedding", centres).alias("prediction"))


def glm_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gamma GLM with log link on a one-hot group indicator (plus intercept):
    a saturated model, so its prediction per group is the group mean."""
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_extendedprice")
    si = StringIndexer(inputCol="l_returnflag", outputCol="flag_idx", stringOrderType="alphabetAsc")
    prepare = Pipeline(stages=[si, OneHotEncoder(inputCols=["flag_idx"], outputCols=["flag_ohe"]),
                               VectorAssembler(inputCols=["flag_ohe"], outputCol="features")]).fit(li)
    data = prepare.transform(li)
    glm = GeneralizedLinearRegression(family="gamma", link="log", labelCol="l_extendedprice",
                                      maxIter=50, regParam=0.0, tol=1e-12)
    with persisted(data):
        model = glm.fit(data)
    # one prediction per group: score the distinct groups, not every line
    groups = prepare.transform(li.select("l_returnflag").distinct())
    return model.transform(groups).select("l_returnflag", F.round("prediction", 4).alias("prediction"))


QUERIES = {
    "assemble_features": assemble_features,
    "one_hot": one_hot,
    "factor_vectors": factor_vectors,
    "nearest_centroid": nearest_centroid,
    "glm_group_mean": glm_group_mean,
}
