"""Row ids, training layout, model equations, calendars, and what stays held."""

import math
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import diagnostics as D
from tessera.operators import logs as L
from tessera.operators import models as M
from tessera.operators.rowid import stable_ids
from tessera.session import held_audit, held_tables, releasing
from tessera.sources.fixtures import genome_scores
from tessera.sources.tables import bucket_count, fit_layout, fit_tasks
from tests.conftest import SF_SMALL


# --- ids and layout -----------------------------------------------------------------

def repeated(spark):
    rows = [(1, "a", None)] * 500 + [(1, "a", 0.5)] * 3 + [(None, None, None)] * 7 + [(i, "b", float(i)) for i in range(100)]
    return spark.createDataFrame(rows, "k int, s string, x double")


@pytest.mark.parametrize("copies", [10, 100_000])
def test_ids_are_unique_and_survive_another_layout(spark, copies):
    df = repeated(spark)
    got = [sorted((tuple(r) for r in stable_ids(df.repartition(n), copies=copies).collect()), key=str) for n in (1, 3, 40)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 610
    assert len({r[-2:] for r in got[0]}) == 610
    assert sorted(r[-1] for r in got[0] if r[:3] == (1, "a", None)) == list(range(500))
    assert Counter(r[:3] for r in got[0]) == Counter(tuple(r) for r in df.collect())


def test_ids_of_rows_that_share_a_hash(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    got = stable_ids(repeated(spark)).collect()
    assert {r.row_hash for r in got} == {7} and sorted(r.row_nth for r in got) == list(range(610))


def test_ids_of_common_rows_are_not_broadcast(spark):
    li = stable_ids(spark.range(5_000).select((F.col("id") % 3).alias("k")), copies=100)
    assert li.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))  # not one task for all copies
    joined = li.join(li.groupBy("row_hash", "row_nth").count(), ["row_hash", "row_nth"])
    assert len(joined.collect()) == 5_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_ids_do_not_overwrite_columns(spark):
    with pytest.raises(ValueError, match="row_nth"):
        stable_ids(spark.range(1).withColumn("row_nth", F.lit(1)))
    clash = spark.range(3).selectExpr("id as copies", "id as before", "id as start")
    assert stable_ids(clash).select("copies", "before", "start").distinct().count() == 3
    assert stable_ids(spark.range(0)).count() == 0


def test_bucket_count_follows_the_rows():
    assert [bucket_count(n) for n in (0, 1, 10_000, 10_001, 600_000)] == [1, 1, 1, 2, 60]
    assert bucket_count(10 ** 9) == 10_000 and bucket_count(10 ** 11) == 50_000
    assert all(math.ceil(n / bucket_count(n)) <= 2_000_000 for n in (10 ** k for k in range(1, 14)))


def test_tasks_of_a_fit_do_not_follow_the_buckets(spark):
    assert [fit_tasks(n) for n in (0, 10_001, 240_000)] == [bucket_count(n) for n in (0, 10_001, 240_000)]
    assert [fit_tasks(n) for n in (600_000, 36_000_000, 216_000_000)] == [24, 24, 108]
    data = fit_layout(spark.range(300_000), ["id"])
    sizes = Counter(i for i, _ in placed(data))
    assert len(sizes) == data.rdd.getNumPartitions() == 24 and sum(sizes.values()) == 300_000


def placed(df):
    return df.rdd.mapPartitionsWithIndex(lambda i, rows: [(i, tuple(r)) for r in rows]).collect()


def test_layout_depends_on_the_rows_only(spark):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("k"), F.col("id").alias("v"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = []
        for splits, shuffle in ((1, 4), (4, 4), (64, 13)):
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
            seen.append(placed(fit_layout(df.repartition(splits), ["k"])))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2]
    assert max(Counter(i for i, _ in seen[0]).values()) < 1.1 * 10_000


@pytest.mark.parametrize("equal", [True, False])
def test_layout_splits_a_hot_key(spark, equal):
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    value = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")) if equal else F.col("id")
    df = spark.range(60_000).select(hot.alias("k"), value.alias("bucket"))
    seen = [placed(fit_layout(df.repartition(n), ["k"])) for n in (1, 16)]
    assert seen[0] == seen[1]
    sizes = Counter(i for i, _ in seen[0])
    assert len(sizes) == 6 and max(sizes.values()) < 1.2 * 10_000
    assert sorted(r for _, r in seen[0]) == sorted(tuple(r) for r in df.collect())


def test_als_blocks_follow_the_ratings():
    assert [M.als_blocks(n) for n in (0, 50_000, 50_001, 10 ** 12)] == [1, 1, 2, 4_000]


def test_als_blocks_stay_few_and_shuffles_are_dropped():
    assert [M.als_blocks(n) for n in (1_200_000, 36_000_000, 216_000_000)] == [24, 24, 54]
    assert M.als().getCheckpointInterval() == 1


def test_scored_items_are_spread_before_they_are_exploded(spark, monkeypatch):
    want = sorted(map(tuple, genome_scores(spark, SF_SMALL).collect()))
    monkeypatch.setattr("tessera.sources.fixtures.SCORED_ITEMS_PER_TASK", 50)
    got = genome_scores(spark, SF_SMALL)
    assert got.rdd.getNumPartitions() == math.ceil(spark.read.parquet(f"{SF_SMALL}/part.parquet").count() / 50) > 1
    assert sorted(map(tuple, got.collect())) == want


# --- equations ----------------------------------------------------------------------

def brute_gains(rows, max_bins):
    """(threshold, n_left, gain) by trying every border."""
    def entropy(ys):
        p = sum(ys) / len(ys)
        return -sum(q * math.log2(q) for q in (p, 1 - p) if q > 0)
    values = sorted({x for x, _ in rows})
    if len(values) <= max_bins:
        bins = {v: i for i, v in enumerate(values)}
    else:
        bins = {v: sum(x < v for x, _ in rows) * max_bins // len(rows) for v in values}
    out = []
    for a, b in zip(values, values[1:]):
        if bins[a] != bins[b]:
            left, right = [y for x, y in rows if x <= a], [y for x, y in rows if x > a]
            out.append(((a + b) / 2, len(left), entropy([y for _, y in rows]) - (len(left) * entropy(left) + len(right) * entropy(right)) / len(rows)))
    return out


@pytest.mark.parametrize("max_bins", [4, 1000])
def test_split_gains_equal_trying_every_border(spark, max_bins):
    rows = [(float((i * i) % 37) / 4, (i * 7) % 11, int((i * 31) % 5 > (i % 3))) for i in range(300)]
    df = spark.createDataFrame([*rows, (None, 3, 1), (float("nan"), None, 1), (1.0, 1, None)], "x double, z int, y int")
    got = D.split_gains(df, ["x", "z"], "y", max_bins).collect()
    known = {"x": [(x, y) for x, _, y in rows], "z": [(z, y) for _, z, y in rows] + [(3, 1)]}
    for f in ("x", "z"):
        ours = sorted((r.threshold, r.n_left, round(r.gain, 9)) for r in got if r.feature == f)
        assert ours == [(t, n, round(g, 9)) for t, n, g in brute_gains(known[f], max_bins)]
    assert D.best_split(D.split_gains(df, ["x", "z"], "y", max_bins)).count() == 1


def test_no_split_without_two_values(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0)], "x double, y int")
    assert D.split_gains(df, ["x"], "y").count() == 0
    assert D.split_gains(df.limit(0), ["x"], "y").count() == 0


def test_normal_residual_of_exact_and_of_wrong_factors(spark):
    p = {1: [1.0, 0.5], 2: [0.0, 2.0]}
    reg, n = 0.1, 2
    a = [[1.0 + reg * n, 0.5], [0.5, 4.25 + reg * n]]  # sum p p' + reg n
    b = [3.0, 1.5 + 8.0]  # sum r p for ratings 3 and 4
    det = a[0][0] * a[1][1] - a[0][1] ** 2
    q = [(b[0] * a[1][1] - b[1] * a[0][1]) / det, (a[0][0] * b[1] - a[0][1] * b[0]) / det]
    ratings = spark.createDataFrame([(1, 9, 3.0), (2, 9, 4.0)], "u int, i int, rating double")
    fixed = spark.createDataFrame(list(p.items()), "id int, features array<double>")

    def residual(features):
        solved = spark.createDataFrame([(9, features)], "id int, features array<double>")
        return D.normal_residuals(ratings, fixed, solved, "u", "i", reg, 2).first()
    assert residual(q).n == 2 and residual(q).residual < 1e-12
    assert residual([q[0] + 0.1, q[1]]).residual > 1e-2


def test_centre_gaps(spark):
    v = spark.createDataFrame([(i, Vectors.dense([float(i), 1.0])) for i in range(4)], ["k", "features"])
    a = spark.createDataFrame([(i, i // 2) for i in range(4)], "k long, prediction int")
    got = {r.prediction: (r.n, round(r.gap, 12)) for r in D.centre_gaps(v, a, [[0.5, 1.0], [2.5, 4.0]], "k").collect()}
    assert got == {0: (2, 0.0), 1: (2, 3.0)}


def test_score_equations_find_a_wrong_coefficient(spark):
    rows = [(float(i % 3), float(i % 7), 5.0 + i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "c double, x double, Claim_Amount double")
    model = M.fit_claim_severity(df, ["c"], ["x"], reg_param=0.01)
    good = D.score_equations(df, model, ["c"], ["x"], "Claim_Amount", "prediction2", 0.01).collect()
    assert {(r.feature, r.level, r.n) for r in good} == {("c", "0.0", 67), ("c", "1.0", 67), ("c", "2.0", 66), ("x", None, 200), (D.GLM_INTERCEPT, None, 200)}
    assert max(abs(r.residual) for r in good) < 1e-6
    wrong = D.score_equations(df, model, ["c"], ["x"], "Claim_Amount", "prediction2", 0.5).collect()
    assert max(abs(r.residual) for r in wrong) > 1e-4


# --- calendar -----------------------------------------------------------------------

def test_calendar_has_every_band_of_every_day(spark):
    lines = ["[05/Jan/2024:23:59:59]", "[05/Jan/2024:00:00:00]", "[05/Jan/2024:00:10:00]", "[10/Mar/2024:12:00:00]", "nothing", "[31/Feb/2024:00:00:00]"]
    rows = L.traffic_calendar(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert len(rows) == 6 * (31 + 29 + 31)
    found = {(str(r.date), r.hour_band): r for r in rows}
    assert sum(r.requests for r in rows) == 4 and found["2024-01-05", "1"].requests == 2
    assert found["2024-02-29", "4"].requests == 0 and found["2024-01-31", "1"].month_requests == 2
    assert found["2024-01-31", "1"].month_average == pytest.approx(2 / 31)
    assert L.traffic_calendar(spark.createDataFrame([("x",)], "value string")).count() == 0


# --- what stays held ------------------------------------------------------------------

MODEL_QUERIES = ["gbt_holdout", "feature_importance", "claim_classifier", "claim_severity", "tandem_model", "als_fold_grid", "item_clusters",
                 "tree_families", "cv_cells", "als_scored", "two_centres", "gate_report"]


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_queries_leave_nothing_held(spark, name):
    with held_audit(spark) as left:
        E.queries()[name](spark, SF_SMALL).collect()
    assert left == {}


def test_releasing_keeps_the_callers_tables(spark):
    mine = spark.range(10).persist()
    mine.count()
    before = held_tables(spark)
    ratings = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(8) for i in range(8)], "userId int, movieId int, rating float")
    with held_audit(spark) as left, releasing(spark):
        other = spark.range(20).persist()
        other.count()
        M.als(rank=2, max_iter=2, num_blocks=2).fit(ratings).itemFactors.count()
    assert set(before) <= set(held_tables(spark)) and len(left) == 1  # the caller's second table only
    mine.unpersist()
    other.unpersist()
