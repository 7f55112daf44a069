import random

from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import recommend as R


def brute_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    credit = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return credit / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 20)), rnd.random() < 0.4) for _ in range(400)]
    df = spark.createDataFrame(rows, "s double, y boolean")
    got = M.auc(df, "s", "y").first().auc
    assert abs(got - brute_auc(rows)) < 1e-12
    flipped = M.auc(df, -F.col("s"), "y").first().auc
    assert abs(got + flipped - 1.0) < 1e-12


def test_auc_by_group(spark):
    rows = [("a", 1.0, True), ("a", 0.0, False), ("b", 0.0, True), ("b", 1.0, False), ("b", 1.0, True)]
    df = spark.createDataFrame(rows, "g string, s double, y boolean")
    got = {r.g: r.auc for r in M.auc(df, "s", "y", by=["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.25}


def test_regression_metrics_and_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (float("nan"), 1.0), (None, 1.0)], "p double, y double")
    r = M.regression_metrics(df, "p", "y").first()
    assert r.n_scored == 2 and abs(r.rmse - (0.5 ** 0.5)) < 1e-12 and r.mae == 0.5 and r.rmse >= r.mae
    cells = spark.createDataFrame([(1, f, float(f), 1.0) for f in (1, 2, 3)], "model int, fold int, rmse double, mae double")
    m = M.fold_metric_matrix(cells).first()
    assert (m.rmse_1, m.rmse_3, m.mean_rmse) == (1.0, 3.0, 2.0)
    assert abs(m.std_rmse - (2 / 3) ** 0.5) < 1e-12 and m.std_mae == 0.0


def scores(spark):
    rows = [(1, 1, 0.5), (1, 2, 0.9), (1, 3, 0.9), (2, 1, 0.7), (3, 9, 0.8), (4, 2, 0.1)]
    return spark.createDataFrame(rows, "movieId long, tagId int, relevance double")


def test_best_tag_ties_to_smallest_id(spark):
    got = {r.movieId: (r.max_relevance, r.tagId) for r in R.item_best_tag(scores(spark)).collect()}
    assert got == {1: (0.9, 2), 2: (0.7, 1), 3: (0.8, 9), 4: (0.1, 2)}
    c = R.complete_items(scores(spark), full=3).first()
    assert (c.n_items, c.n_complete) == (4, 1)


def test_cluster_top_tags_ranks_before_dropping_unnamed(spark):
    assign = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, 2)], "movieId long, prediction int")
    tags = spark.createDataFrame([(1, "one"), (2, "two")], "tagId int, tag string")  # 9 has no name
    best = R.item_best_tag(scores(spark))
    out = R.cluster_top_tags(assign, best, tags, k_clusters=1, k_tags=2).orderBy("rank").collect()
    # cluster 0: tag 2 (0.9), tag 9 (0.8, unnamed, dropped), tag 1 (0.7) not in top 2
    assert [(r.prediction, r.rank, r.tagId, r.tag) for r in out] == [(0, 1, 2, "two")]
    cov = R.cluster_coverage(assign, best, k=2).orderBy("prediction").collect()
    assert [(r.prediction, r.n_members, r.n_scored) for r in cov] == [(0, 3, 3), (1, 1, 1)]


def test_weighted_metrics_equal_expanded_rows(spark):
    rows = [(1.0, 2.0, 3), (3.0, 2.5, 1), (0.0, 1.0, 2)]
    w = M.regression_metrics(spark.createDataFrame(rows, "p double, y double, c long"), "p", "y", weight="c").first()
    flat = [(p, y) for p, y, c in rows for _ in range(c)]
    u = M.regression_metrics(spark.createDataFrame(flat, "p double, y double"), "p", "y").first()
    assert w.n_scored == u.n_scored == 6
    assert abs(w.rmse - u.rmse) < 1e-12 and abs(w.mae - u.mae) < 1e-12


def test_degenerate_groups_give_null_not_errors(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("a", 2.0, True), ("b", 0.5, False), ("b", 0.7, True)],
                               "g string, s double, y boolean")
    got = {r.g: r.auc for r in M.auc(df, "s", "y", by=["g"]).collect()}
    assert got == {"a": None, "b": 1.0}


def test_log_bands_with_no_parseable_lines(spark):
    from tessera.operators import logs as L
    lines = spark.createDataFrame([("garbage /Jan/2024",)], "value string")
    assert L.hour_band_averages(L.parse_access_log(lines, "Jan", 2024)).count() == 0
    assert L.daily_counts(L.parse_access_log(lines, "Jan", 2024)).count() == 0


def test_cluster_without_scored_members(spark):
    assign = spark.createDataFrame([(7, 0), (8, 0), (1, 1)], "movieId long, prediction int")
    tags = spark.createDataFrame([(2, "two")], "tagId int, tag string")
    best = R.item_best_tag(scores(spark))  # scores items 1-4 only
    cov = {r.prediction: (r.n_members, r.n_scored) for r in R.cluster_coverage(assign, best, k=2).collect()}
    assert cov == {0: (2, 0), 1: (1, 1)}
    top = R.cluster_top_tags(assign, best, tags, k_clusters=2).collect()
    assert [(r.prediction, r.tagId) for r in top] == [(1, 2)]


def test_empty_stratum_split(spark):
    from tessera.operators.split import stratified_split
    df = spark.createDataFrame([(i, 0) for i in range(20)], "k int, y int")
    out = stratified_split(df, ["k"], "y")
    assert out.filter("y = 1").count() == 0 and out.count() == 20
