"""Randomised properties (hypothesis, few examples: every example is a Spark
job) and a hot-key case where one value holds a third of the rows."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import encode as E
from tessera.operators import metrics as M
from tessera.operators import recommend as R

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

scores_labels = st.lists(st.tuples(st.integers(0, 6), st.booleans()), min_size=2, max_size=60).filter(
    lambda rows: any(y for _, y in rows) and not all(y for _, y in rows))


@settings(**SETTINGS)
@given(scores_labels)
def test_auc_equals_pair_count(spark, rows):
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "s double, y boolean")
    got = M.auc(df, "s", "y").first().auc
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


@settings(**SETTINGS)
@given(st.lists(st.sampled_from(list("abcdefg")), min_size=1, max_size=80), st.integers(1, 5))
def test_top_n_ids_dense_and_by_frequency(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = {r.value: r.id for r in E.top_n_mapping(df, ["c"], n=n).collect()}
    ranked = sorted(Counter(values).items(), key=lambda kv: (-kv[1], kv[0]))[:n]
    assert got == {v: i for i, (v, _) in enumerate(ranked, start=1)}
    assert sorted(got.values()) == list(range(1, len(got) + 1))


def test_hot_key_third_of_rows(spark):
    rows = [(1, t, 0.5) for t in range(300)] + [(m, t, (m * t % 7) / 7) for m in range(2, 62) for t in range(10)]
    scores = spark.createDataFrame(rows, "movieId long, tagId int, relevance double")
    assert sum(1 for r in rows if r[0] == 1) * 3 >= len(rows)
    best = {r.movieId: r.tagId for r in R.item_best_tag(scores).collect()}
    assert best[1] == 0  # all 300 tags tie: the smallest id wins
    counts = {(r.column_name, r.value): r.n for r in
              E.category_counts(scores.selectExpr("cast(movieId as string) as m"), ["m"]).collect()}
    assert counts[("m", "1")] == 300 and len(counts) == 61
    auc = M.auc(scores, "relevance", F.col("movieId") == 1).first().auc
    pos = [r[2] for r in rows if r[0] == 1]
    neg = [r[2] for r in rows if r[0] != 1]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(auc - want) < 1e-12
