import random

from pyspark.sql import functions as F

from tessera.operators import split as S
from tessera.operators.ranking import dense_ids, ordered_prefix


def test_split_disjoint_exhaustive_and_layout_invariant(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in S.hash_split(df, ["k"], 0.7).collect()}
    b = {r.k: r.split for r in S.hash_split(df.repartition(7), ["k"], 0.7).collect()}
    assert a == b and len(a) == 2000
    train, test = S.train_test(df, ["k"], 0.7)
    tr = {r.k for r in train.collect()}
    te = {r.k for r in test.collect()}
    assert not (tr & te) and len(tr | te) == 2000
    assert 0.65 < len(tr) / 2000 < 0.75


def test_folds_and_sample(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    f = S.assign_folds(df, ["k"], 3)
    counts = {r.fold: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == {1, 2, 3} and all(900 < c < 1100 for c in counts.values())
    train, test = S.fold_train_test(f, 2)
    assert train.count() + test.count() == 3000
    n = S.hash_sample(df, ["k"], 0.05).count()
    assert 100 < n < 200


def test_stratified_split_per_stratum(spark):
    df = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = S.stratified_split(df, ["k"], "y", 0.7)
    for y in (0, 1):
        part = out.filter(F.col("y") == y)
        frac = part.filter(F.col("split") == "train").count() / part.count()
        assert 0.62 < frac < 0.78


def test_ordered_prefix_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 3), float(i), rnd.randint(0, 5)) for i in range(300)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double, w long")
    got = {(r.g, r.x): r.prefix for r in ordered_prefix(df, ["g"], ["x"], weight="w", partitions=5).collect()}
    for g, x, _ in rows:
        want = sum(w for g2, x2, w in rows if g2 == g and x2 < x)
        assert got[(g, x)] == want


def test_dense_ids(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", "b"), ("c", "m")], "grp string, v string")
    got = {(r.grp, r.v): r.id for r in dense_ids(df, "grp", "v").collect()}
    assert got == {("a", "b"): 1, ("a", "z"): 2, ("c", "m"): 1}


def test_null_keys_still_get_a_split(spark):
    df = spark.createDataFrame([(None,), ("a",), (None,)], "k string")
    train, test = S.train_test(df, ["k"], 0.5)
    assert train.count() + test.count() == 3


def test_spread_only_when_far_fewer_splits_than_slots(spark):
    from tessera.sources.tables import spread
    slots = spark.sparkContext.defaultParallelism
    one = spark.range(0, 100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == slots
    many = spark.range(0, 100, numPartitions=slots)
    assert spread(many).rdd.getNumPartitions() == slots
    assert spread(many).count() == 100
