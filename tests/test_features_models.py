import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import features as X
from tessera.operators import models as M
from tessera.operators.tandem import combine_by_key, gate
from tests.conftest import SF_SMALL


def test_nearest_centre_matches_numpy(spark):
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(50, 4))
    centres = rng.normal(size=(3, 4)).tolist()
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "i int, v array<double>")
    got = {r.i: r.c for r in df.select("i", X.nearest_centre("v", centres).alias("c")).collect()}
    want = {i: int(np.argmin(((np.array(centres) - p) ** 2).sum(1))) for i, p in enumerate(pts)}
    assert got == want


def test_one_hot_keeps_every_seen_category(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "c double")
    enc, (col,) = X.one_hot(df, ["c"])
    got = [(r.c, r.pos) for r in enc.select("c", X.one_hot_position(col).alias("pos")).collect()]
    assert sorted(got) == [(0.0, 0), (1.0, 1), (3.0, 3)]


def test_tandem_gate_and_join_agree(spark):
    rows = spark.createDataFrame([(1, 1.0, 5.0), (2, 0.0, 7.0), (3, 1.0, 2.0)], "k int, prediction1 double, prediction2 double")
    g = {r.k: r.p for r in rows.select("k", gate().alias("p")).collect()}
    sev = rows.filter("prediction1 = 1").select("k", "prediction2")
    j = {r.k: r.prediction for r in combine_by_key(rows.select("k"), sev, ["k"]).collect()}
    assert g == j == {1: 5.0, 2: 0.0, 3: 2.0}


def test_kmeans_assignment_equals_nearest_centre(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    vecs = X.factor_vectors(emb)
    model = M.kmeans(k=4, max_iter=5).fit(vecs)
    centres = [c.tolist() for c in model.clusterCenters()]
    out = model.transform(vecs).select(
        "prediction", X.nearest_centre(vector_to_array("features"), centres).alias("mine"))
    assert out.filter(F.col("prediction") != F.col("mine")).count() == 0


def test_als_prediction_is_factor_dot_product(spark):
    from tessera.plans.recommend import rating_folds
    folded = rating_folds(spark, SF_SMALL)
    model = M.als(0.1, rank=3, max_iter=2).fit(folded)
    pred = model.transform(folded).limit(20).collect()
    uf = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    itf = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for r in pred:
        assert abs(r.prediction - float(uf[r.userId] @ itf[r.movieId])) < 1e-4


def test_tree_importances_and_glm_positive(spark):
    from tessera.plans.models import _fit_gbt
    model, _ = _fit_gbt(spark, SF_SMALL)
    imp = model.stages[-1].featureImportances.toArray()
    assert (imp >= 0).all() and abs(imp.sum() - 1.0) < 1e-9
    from tessera.plans.features import glm_group_mean
    assert all(r.prediction > 0 for r in glm_group_mean(spark, SF_SMALL).collect())
