"""Malformed CSV lines kept apart, ordered result files, schemas as data."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tessera.sources import files
from tessera.sources import quarantine as Q
from tessera.sources import schemas as S

SCHEMA = "a bigint, b int, c double, d string, e date"
LINES = ["1,2,3.5,x,2024-01-31", "x,2,3.5,x,2024-01-31", "1,2", "1,2,3,4,2024-01-31,6", "1,y,z,x,2024-13-01", '"1","2",3.5,"a,b ""q""",2024-01-31',
         '"1,2,3.5,x,2024-01-31', ",,,,", "1,2,3.5,in\"side,2024-01-31", "", "99999999999999999999,2,3.5,x,2024-01-31", "1,2,NaN, x ,2024-01-31"]
WANT = {LINES[1]: ("type", ["type:a"], 5), LINES[2]: ("short", ["short"], 2), LINES[3]: ("long", ["long"], 6),
        LINES[4]: ("type", ["type:b", "type:c", "type:e"], 5), LINES[6]: ("quote", None, None), LINES[10]: ("type", ["type:a"], 5)}


def write(path, lines, header=None):
    os.makedirs(path)
    for i in range(2):  # two files, both with the header
        with open(f"{path}/part-{i}.csv", "w") as f:
            f.write("\n".join(([header] if header else []) + lines[i::2]) + "\n")
    return path


@pytest.fixture(scope="module", params=[None, "a,b,c,d,e"])
def checked(request, spark, tmp_path_factory):
    path = write(str(tmp_path_factory.mktemp("csv") / "in"), LINES, request.param)
    return Q.read_checked_csv(spark, path, SCHEMA, header=request.param is not None)


def test_bad_lines_are_kept_with_their_reasons(checked):
    bad = {r.line: r for r in checked.bad.collect()}
    assert set(bad) == set(WANT)
    for line, (outcome, reasons, n) in WANT.items():
        assert bad[line].outcome == outcome
        assert reasons is None or (bad[line].reasons, bad[line].n_fields) == (reasons, n)


def test_good_rows_do_not_depend_on_what_is_selected(checked):
    rows = {tuple(r) for r in checked.good.select("a", "d").collect()}
    assert rows == {(1, "x"), (1, 'a,b "q"'), (None, None), (1, 'in"side'), (1, " x ")}
    assert checked.good.select("d").count() == checked.good.count() == 5


def test_counts_add_up(checked):
    counts = {r.outcome: r.n for r in checked.counts().collect()}
    assert counts == {"good": 5, "type": 3, "short": 1, "long": 1, "quote": 1}
    assert sum(counts.values()) == sum(1 for x in LINES if x)
    assert {r.column_name: r.n for r in checked.type_faults().collect()}["a"] >= 2


def test_a_limit_of_bad_lines(checked):
    assert checked.good_or_fail(6).count() == 5
    with pytest.raises(ValueError, match="6 malformed lines, 5 allowed"):
        checked.good_or_fail(5)


@pytest.mark.parametrize("column", ["a", "b", "c", "d", "e"])
@pytest.mark.parametrize("line", list(WANT))
def test_plain_reads_fail_on_any_fault(spark, tmp_path, column, line):
    path = write(str(tmp_path / "in"), [LINES[0], line])
    with pytest.raises(Exception, match="malformed line"):
        files.read_csv(spark, path, SCHEMA, header=False, null_text="").select(column).collect()


def test_a_header_must_name_the_columns(spark, tmp_path):
    path = write(str(tmp_path / "in"), LINES[:1], "a,c,b,d,e")
    with pytest.raises(Exception, match="header does not conform"):
        files.read_csv(spark, path, SCHEMA, null_text="").collect()
    assert files.read_string_csv(spark, path).columns == ["a", "c", "b", "d", "e"]


def test_named_columns_may_stand_anywhere(spark, tmp_path):
    path = write(str(tmp_path / "in"), ["x,2,1.5", "y,3,2.5"], "other,b,a")
    assert sorted(map(tuple, files.read_named_csv(spark, path, {"a": "double", "b": "int"}).collect())) == [(1.5, 2), (2.5, 3)]
    with pytest.raises(ValueError, match="'c'"):
        files.read_named_csv(spark, path, {"a": "double", "c": "int"})


def test_names_of_the_quarantine_do_not_clash(spark, tmp_path):
    path = write(str(tmp_path / "in"), ["1,2,3", "1,x,3"])
    got = Q.read_checked_csv(spark, path, "csv_line bigint, CSV_OUTCOME int, csv_reasons string", header=False)
    assert [tuple(r) for r in got.good.collect()] == [(1, 2, "3")] and got.bad.first().reasons == ["type:CSV_OUTCOME"]


def test_an_empty_file_has_no_outcome(spark, tmp_path):
    got = Q.read_checked_csv(spark, write(str(tmp_path / "in"), []), SCHEMA, header=False)
    assert got.counts().count() == got.good.count() == got.bad.count() == 0


# --- one ordered result file --------------------------------------------------------

def test_result_file_keeps_order_and_replaces_the_old_one(spark, tmp_path):
    path = str(tmp_path / "out" / "r.csv")
    df = spark.range(1000).repartition(7).select("id", F.concat(F.lit("v,"), "id").alias("t"), F.lit(None).cast("string").alias("n"))
    os.makedirs(tmp_path / "out")
    assert files.write_result_file(df, path, [F.desc("id")]) == path
    lines = open(path).read().splitlines()
    assert lines[0] == "id,t,n" and lines[1] == '999,"v,999",' and len(lines) == 1001
    files.write_result_file(df.limit(0), path, ["id"])
    assert open(path).read() == "id,t,n\n"
    assert [f for f in os.listdir(tmp_path / "out") if not f.startswith(".")] == ["r.csv"]


def test_result_file_has_a_bound_and_failures_leave_the_old_file(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    files.write_result_file(spark.range(3), path, ["id"])
    with pytest.raises(ValueError, match="more than 5 rows"):
        files.write_result_file(spark.range(6), path, ["id"], max_rows=5)
    broken = spark.range(3).withColumn("x", F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="broken"):
        files.write_result_file(broken, path, ["id"])
    assert open(path).read() == "id\n0\n1\n2\n"
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["r.csv"]


def test_readers_never_see_half_a_file(spark, tmp_path):
    path, seen, stop = str(tmp_path / "r.csv"), set(), threading.Event()

    def look():
        while not stop.is_set():
            if os.path.exists(path):
                seen.add(len(open(path).read().splitlines()))

    reader = threading.Thread(target=look)
    reader.start()
    for _ in range(3):
        files.write_result_file(spark.range(20_000), path, ["id"])
    stop.set()
    reader.join()
    assert seen <= {20_001}


# --- schemas ------------------------------------------------------------------------

def test_schema_differences(spark):
    actual = S.schema_table(spark, "a bigint, b string, C double, extra int")
    want = S.schema_table(spark, "a int, c double, b string, gone date")
    got = {(r.column_name, r.problem, r.actual, r.expected) for r in S.compare_schemas(actual, want).collect()}
    assert got == {("a", "type", "bigint", "int"), ("C", "position", "3", "2"), ("b", "position", "2", "3"), ("extra", "extra", "int", None),
                   ("gone", "missing", None, "date")}
    assert S.compare_schemas(actual, actual).count() == 0
    assert {r.problem for r in S.compare_schemas(actual, want, order=False).collect()} == {"type", "extra", "missing"}


def test_schema_assertion_and_nullability(spark):
    df = spark.range(3)
    assert S.assert_schema(df, "id bigint") is df
    with pytest.raises(ValueError, match="id: type .bigint, expected int"):
        S.assert_schema(df, "id int")
    strict, loose = S.schema_table(spark, "id bigint not null"), S.schema_table(spark, "id bigint")
    assert S.compare_schemas(strict, loose).count() == 0
    assert [r.problem for r in S.compare_schemas(loose, strict).collect()] == ["nullable"]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, [1.0])], "a int, `b.c` array<float>")
    assert [tuple(r) for r in S.column_profile(df).orderBy("position").collect()] == [("a", 1, "int", 1, 3), ("b.c", 2, "array<float>", 2, 3)]
