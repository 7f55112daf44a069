"""Results that must not depend on layout, size limits, the launcher or odd text."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tessera.functions import logs as FL
from tessera.operators import clean as C
from tessera.operators import encode as E
from tessera.operators import metrics as MT
from tessera.operators import models as M
from tessera.operators.tandem import combine_by_key
from tessera.sources import files
from tessera.sources.fixtures import particles
from tessera.sources.tables import fit_layout
from tests.conftest import ROOT, SF_SMALL


def test_launcher_settings_are_kept():
    code = ("from tessera.session import build_session\n"
            "s = build_session('local[2]', shuffle_partitions=4, extra={'spark.driver.memory': '1g'})\n"
            "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.sparkContext.master,"
            " s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.ui.enabled'))")
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS":
                        "--master local[1] --conf spark.sql.shuffle.partitions=400 pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "GOT 400 local[1] UTC false" in out


def test_missing_columns_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.columns_of(df, ["b", "a"]) == ["b", "a"]
    with pytest.raises(ValueError, match="'c'"):
        C.columns_of(df, ["a", "c"])
    assert C.columns_of(df, ["a", "c"], optional=("c",)) == ["a"]
    assert C.dropped_profile(df, ["a", "b"]).count() == 0


def test_encode_agrees_on_repeated_and_null_values(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None)], "k int, c string")
    m = E.fixed_mapping(spark, [("c", "a", 1), ("c", "b", 2)])
    want = [0.0, 1.0, 1.0, 1.0, 2.0]
    for limits in ({"max_broadcast": 0}, {"max_broadcast": 10}, {"max_bytes": 1}, {"max_bytes": 2}):
        got = E.encode(df, m, ["c"], **limits)
        assert sorted(r.c for r in got.collect()) == want
        # a hint is given only within both bounds
        assert ("ResolvedHint" in got._jdf.queryExecution().analyzed().toString()) == (limits in ({"max_broadcast": 10}, {"max_bytes": 2}))


def test_top_n_gives_no_id_to_null(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",)], "c string")
    for got in (E.top_n_mapping(df, ["c"], 2), E.learn_dictionaries(df, ["c"], [], 2)):
        assert {(r.value, r.id) for r in got.collect()} == {("a", 1), ("b", 2)}


def test_conflicting_severities_fail(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    same = spark.createDataFrame([(1, 5.0), (1, 5.0)], "k int, prediction2 double")
    assert sorted(r.prediction for r in combine_by_key(rows, same, ["k"]).collect()) == [0.0, 5.0]
    with pytest.raises(Exception, match="differs for one key"):
        combine_by_key(rows, same.withColumn("prediction2", F.rand(1)), ["k"]).collect()


def test_metrics_count_unscored_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 0.0), (0.2, 0.0)], "p double, y double")
    r = MT.accuracy(df.limit(2), "p", "y").first()
    assert (r.accuracy, r.n_scored, r.n_rows) == (1.0, 1, 2)
    r = MT.auc(df, "p", F.col("y") == 1).first()
    assert (r.auc, r.n_scored, r.n_rows) == (1.0, 2, 3)
    r = MT.regression_metrics(df, "p", "y").first()
    assert (r.n_scored, r.n_rows) == (2, 3)
    r = MT.regression_metrics(df, "p", "y", weight=F.lit(2)).first()
    assert (r.n_scored, r.n_rows) == (4, 6)


def test_leap_seconds_are_malformed(spark):
    lines = ["[05/Jan/2024:23:59:60]", "[05/Jan/2024:23:59:59]", "[45/Jan/2024:00:00:00]", "/Jan/2024", "[05/Jan/2024:25:00:00]"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [str(r[0]) for r in df.select(FL.line_time("value", "Jan", 2024)).collect()]
    assert got == ["None", "2024-01-05 23:59:59", "None", "None", "None"]
    text = spark.createDataFrame([("05/Jan/2024:23:59:60",), ("05/Jan/2024:23:59:59",)], "t string")
    assert [r[0] is None for r in text.select(FL.parse_log_time("t")).collect()] == [True, False]


@pytest.mark.parametrize("name", ["log_parse", "log_filter_count", "log_daily_counts", "log_hour_bands"])
def test_each_line_is_parsed_once(spark, name):
    import __spark_entry__ as entry
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_csv_round_trip_of_odd_text(spark, tmp_path):
    rows = [(" a ",), ('q"uo"te',), ("back\\slash",), ("a,b",), ("",), (None,), ('"',), ("\\",), ("\t",), ("é'",)]
    df = spark.createDataFrame(rows, "v string")
    path = str(tmp_path / "csv")
    files.write_csv(df, path)
    key = lambda r: (r[0] is None, r[0] or "")
    assert sorted(map(tuple, files.read_csv(spark, path, "v string").collect()), key=key) == sorted(rows, key=key)
    multi = spark.createDataFrame([*rows, ("x\ny",), ("\r\n",), ('a"\n"b',)], "v string")
    files.write_csv(multi, path + "2", multi_line=True)
    back = files.read_csv(spark, path + "2", "v string", multi_line=True)
    assert sorted(map(tuple, back.collect()), key=key) == sorted(map(tuple, multi.collect()), key=key)


def test_escaped_csv_keeps_any_text_on_one_line(spark, tmp_path):
    rows = [("x\ny",), ("\r\n",), ("\\n",), ("\\\\n\n",), ("\\N",), (None,), ("",), ('"\n,"',), ("\\",), ("\\\\",), ("\\r\\\r",)]
    df = spark.createDataFrame(rows, "v string")
    path = str(tmp_path / "csv")
    files.write_csv(df, path, escaped=True)
    assert spark.read.text(path).filter("value <> '\"v\"'").count() == len(rows)
    key = lambda r: (r[0] is None, r[0] or "")
    assert sorted(map(tuple, files.read_csv(spark, path, "v string", escaped=True).collect()), key=key) == sorted(rows, key=key)


@pytest.mark.parametrize("text", ["x\ny", "\\N"])
def test_csv_refuses_what_it_would_lose(spark, tmp_path, text):
    with pytest.raises(Exception, match="would not give back|USER_RAISED"):
        files.write_csv(spark.createDataFrame([(text,)], "v string"), str(tmp_path / "csv"))


def test_csv_names_the_column_it_refuses_in_one_check(spark, tmp_path):
    wide = spark.createDataFrame([(None, "", "a\\n", "x\ry", 1)], "a string, b string, c string, d string, n int")
    with pytest.raises(Exception, match="column d holds text"):
        files.write_csv(wide, str(tmp_path / "bad"))
    assert str(files._refusing(wide.columns[:4], False)).count("raise_error") == 1  # not one a column
    files.write_csv(wide.drop("d"), str(tmp_path / "good"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "good"), wide.drop("d").schema).collect()] == [(None, "", "a\\n", 1)]


def test_forest_does_not_depend_on_input_splits(spark):
    from pyspark.ml.feature import VectorAssembler
    cols = [f"f{i}" for i in range(1, 29)]
    p = particles(spark, SF_SMALL)
    found = set()
    for splits in (1, 4, 16):
        data = VectorAssembler(inputCols=cols, outputCol="features").transform(
            fit_layout(p.repartition(splits), ["vec_id"])).select("features", F.col("label_signal").alias("label"))
        model = M.forest("label", max_depth=3, num_trees=5).fit(data)
        found.add(tuple(model.featureImportances.toArray().round(12)))
    assert len(found) == 1


def test_severity_width_and_labels(spark):
    rows = [(float(i % 3), float(i % 2), float(i), 10.0 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, n double, Claim_Amount double")
    model = M.fit_claim_severity(df, ["a", "b"], ["n"], max_iter=5)
    labels = model.stages[0].labelsArray
    assert M.glm_width(labels, ["n"]) == model.stages[-1].numFeatures == 6
    unseen = spark.createDataFrame([(9.0, 0.0, 1.0)], "a double, b double, n double")
    assert model.transform(unseen).first()["prediction2"] > 0
    with pytest.raises(ValueError, match="not positive"):
        M.fit_claim_severity(df.withColumn("Claim_Amount", F.col("Claim_Amount") - 10), ["a"], ["n"])


def test_tied_grid_cells_name_the_fitted_model(spark):
    rows = [(i, float(i % 2), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, x double, label double")
    est = M.forest("label", max_depth=1, num_trees=1)
    model, cells = M.cross_validate(df, ["x"], est, M.param_grid(est, numTrees=[3, 2]), ["k"], folds=2)
    best = M.grid_best(cells).collect()
    assert len(best) == 1 and best[0].params == {"numTrees": "3"}
    assert model.stages[-1].getNumTrees == 3
