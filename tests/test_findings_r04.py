"""Findings of round 4: what fits write, deal, hold and leave on disk."""

import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera import session as S
from tessera.operators import models as M
from tessera.operators.split import in_train, train_test
from tessera.plans import models as PM
from tessera.sources import tables as T
from tests.conftest import SF_SMALL


def placed(df):
    return df.rdd.mapPartitionsWithIndex(lambda i, rows: [(i, tuple(r)) for r in rows]).collect()


@pytest.mark.parametrize("hot", [False, True])
def test_kept_rows_lie_as_among_all(spark, hot):
    k = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")) if hot else F.col("id")
    rows = T.stored(spark.range(40_000).select(k.alias("k"), (F.col("id") % 7).alias("x"), (F.col("id") % 5).alias("y")))
    part = F.col("x") > 2
    every = placed(T.laid_out(rows, ["k"]))
    assert placed(T.laid_out(rows, ["k"], keep=part)) == [(i, r) for i, r in every if r[1] > 2]
    if not hot:
        assert placed(T.laid_out(rows, ["k"], keep=part, columns=["y"])) == [(i, r[2:]) for i, r in every if r[1] > 2]


def test_keys_are_counted_one_by_one_only_where_one_may_be_hot(spark, monkeypatch):
    rows = spark.range(60_000).select(F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id")).alias("k"))
    assert T._key_sizes(rows, ["k"]) == (60_000, 15_000)  # the NULL key
    even = spark.range(60_000).select(F.col("id").alias("k"))
    total, most = T._key_sizes(even, ["k"])
    assert total == 60_000 and most <= 5_000
    monkeypatch.setattr(T, "KEY_CELLS", 1)  # every cell is too large: exact
    assert T._key_sizes(even, ["k"]) == (60_000, 1) and T._key_sizes(even.limit(0), ["k"]) == (0, 0)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


def test_finished_shuffles_leave_the_disk_within_a_fit(spark, monkeypatch):
    monkeypatch.setattr(S, "DROP_EVERY_S", 0.2)
    S.drop_finished(spark)
    df = spark.range(10)
    with M.persisted(df):
        before = shuffle_files(spark)
        spark.range(1000).repartition(7).groupBy("id").count().collect()
        made = shuffle_files(spark) - before
        until = time.time() + 30
        while made & shuffle_files(spark) and time.time() < until:
            time.sleep(0.2)
        assert made and not made & shuffle_files(spark)
        n = threading.active_count()
    assert threading.active_count() == n - 1  # and ends with it


def test_train_draw_is_that_of_the_split(spark):
    df = spark.range(500).select(F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id")).alias("k"))
    train, test = train_test(df, ["k"], 0.7, 5)
    assert Counter(train.collect()) == Counter(df.filter(in_train(["k"], 0.7, 5)).collect())
    assert train.count() + test.count() == 500


def test_severity_keeps_every_actual_claim_and_no_other_column(spark):
    positives, test, cat, num = PM.encoded_claims(spark, SF_SMALL, actual_only=True)
    train_all, test_all, _, _ = PM.encoded_claims(spark, SF_SMALL)
    assert positives.columns == [*cat, *num, "y", "Claim_Amount"] == train_all.columns
    for some, every in ((positives, train_all), (test.select(*positives.columns), test_all.select(*positives.columns))):
        assert Counter(map(tuple, some.collect())) == Counter(tuple(r) for r in every.collect() if r["y"] == 1)


def test_many_ratings_are_fitted_one_model_at_a_time():
    assert [M.als_at_once(n, 3) for n in (0, 600_000, 36_000_000, 216_000_000)] == [3, 3, 1, 1]
