from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import encode as E


def wide(spark):
    rows = [("a", "x"), ("a", "y"), ("b", None), ("b", "y"), ("c", "y"), ("a", "z")]
    return spark.createDataFrame(rows, "c1 string, c2 string")


def as_dict(df):
    return {(r.column_name, r.value): r.id for r in df.collect()}


def test_top_n_ranks_by_count_then_value(spark):
    m = as_dict(E.top_n_mapping(wide(spark), ["c1"], n=2))
    assert m == {("c1", "a"): 1, ("c1", "b"): 2}


def test_ordinal_dense_sorted_whole_domain(spark):
    df = C.fill_missing_category(wide(spark), ["c2"])
    m = as_dict(E.ordinal_mapping(df, ["c1", "c2"]))
    assert m[("c2", "ZZZ")] == 1 and m[("c2", "x")] == 2 and m[("c2", "z")] == 4
    assert sorted(v for (c, _), v in m.items() if c == "c1") == [1, 2, 3]


def test_overrides(spark):
    learned = E.fixed_mapping(spark, [("Cat12", "A", 1), ("Cat12", "B", 2), ("M", "q", 5)])
    forced, domains = E.reference_overrides(spark)
    out = as_dict(E.apply_overrides(learned, forced=forced, domains=domains))
    # no 'ZZZ' learned for Cat12 -> the replacement domain is used
    assert out[("Cat12", "ZZZ")] == 1 and out[("Cat12", "A")] == 7 and ("Cat12", "B") in out
    assert out[("Blind_Submodel", "AE.3.0")] == 0 and out[("M", "q")] == 5
    # sentinel present -> learned dictionary kept
    learned2 = E.fixed_mapping(spark, [("Cat12", "ZZZ", 1), ("Cat12", "A", 2)])
    out2 = as_dict(E.apply_overrides(learned2, domains=domains))
    assert out2 == {("Cat12", "ZZZ"): 1, ("Cat12", "A"): 2}


def test_encode_unseen_is_zero_and_plan_broadcasts(spark):
    m = E.fixed_mapping(spark, [("c1", "a", 1), ("c1", "b", 2)])
    enc = E.encode(wide(spark), m, ["c1"])
    assert sorted(r.c1 for r in enc.collect()) == [0.0, 1.0, 1.0, 1.0, 2.0, 2.0]
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_null_profile_and_clean(spark):
    df = spark.createDataFrame([("1.5", None, None), ("x", "B", "10")],
                               "v string, cat string, Claim_Amount string")
    prof = {r.column_name: r.n_null for r in C.null_profile(df).collect()}
    assert prof == {"v": 1 - 1, "cat": 1, "Claim_Amount": 1}
    out = C.clean_claims(df, [], [], ["v"], ["cat"]).collect()
    assert [(r.v, r.cat, r.Claim_Amount, r.y) for r in out] == [(1.5, "ZZZ", 0.0, 0.0), (0.0, "B", 10.0, 1.0)]


def test_dropped_columns(spark):
    assert C.dropped_columns(wide(spark), ["c2"]) == ["c1"]


def test_encode_shuffle_paths_equal_broadcast(spark):
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(
        [("a", "x"), ("b", "y"), ("a", None), ("z", "x"), ("c", "q")])], "k int, c1 string, c2 string")
    m = E.fixed_mapping(spark, [("c1", "a", 1), ("c1", "b", 2), ("c2", "x", 1), ("c2", "y", 2)])
    def rows(out):
        return sorted((r.k, r.c1, r.c2) for r in out.collect())
    want = rows(E.encode(df, m, ["c1", "c2"]))
    assert want == [(0, 1.0, 1.0), (1, 2.0, 2.0), (2, 1.0, 0.0), (3, 0.0, 1.0), (4, 0.0, 0.0)]
    assert rows(E.encode(df, m, ["c1", "c2"], max_broadcast=0)) == want
    assert rows(E.encode(df, m, ["c1", "c2"], max_broadcast=2)) == want  # one of the two fits


def test_one_dictionary_per_column(spark):
    import pytest
    with pytest.raises(ValueError):
        E.learn_dictionaries(wide(spark), ["c1"], ["c1", "c2"])
