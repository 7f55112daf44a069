"""Every registered query with an oracle equals DuckDB on sf0.001, and the
relational plans stay in the JVM."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import compare

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    r = compare(got, want)
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["exact"], r


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    df = E.entry(spark)
    assert df.columns[:3] == ["hour_band", "band_range", "requests"] and df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_relational_plans_have_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_top_files_is_take_ordered(spark):
    df = E.queries()["log_top_files"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in _plan(df)


def test_topn_window_limited_before_shuffle(spark):
    df = E.queries()["encode_topn"](spark, SF_SMALL)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scans_are_pruned(spark):
    df = E.queries()["metric_auc"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan


@pytest.mark.parametrize("name", ["cluster_top_tags", "cluster_coverage", "encode_roundtrip"])
def test_bounded_lookups_are_broadcast(spark, name):
    assert "BroadcastHashJoin" in _plan(E.queries()[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["gbt_holdout", "tandem_model", "feature_importance"])
def test_model_plans_have_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
