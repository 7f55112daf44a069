"""Schemas as data: what a table's columns are, compared with what they should
be. A schema is a table (column_name, position, data_type, nullable), so it can
be stored, joined and queried like any other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.quarantine import as_schema

SCHEMA_TABLE = "column_name string, position int, data_type string, nullable boolean"
PROBLEMS = ("missing", "extra", "type", "nullable", "position")


def schema_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """One row per column; a schema is metadata of a bounded width."""
    rows = [(f.name, i, f.dataType.simpleString(), f.nullable) for i, f in enumerate(as_schema(schema).fields, start=1)]
    return spark.createDataFrame(rows, SCHEMA_TABLE)


def compare_schemas(actual: DataFrame, expected: DataFrame, order: bool = True) -> DataFrame:
    """(column_name, problem, actual, expected): what differs between two
    schema tables; no rows if nothing does. A column that may be NULL where
    NULL is not expected is a problem, the reverse is not; ``order`` compares
    positions too. Names are compared without regard to case, as Spark does."""
    a = actual.select(F.lower("column_name").alias("k"), F.struct("*").alias("a"))
    e = expected.select(F.lower("column_name").alias("k"), F.struct("*").alias("e"))
    both = a.join(e, "k", "full")
    none = F.lit(None).cast("string")

    def differs(when: F.Column, problem: str, ours: F.Column, theirs: F.Column) -> F.Column:
        return F.when(when, F.struct(F.lit(problem).alias("problem"), ours.alias("actual"), theirs.alias("expected")))

    found = F.array_compact(F.array(
        differs(F.col("a").isNull(), "missing", none, F.col("e.data_type")),
        differs(F.col("e").isNull(), "extra", F.col("a.data_type"), none),
        differs(F.col("a.data_type") != F.col("e.data_type"), "type", F.col("a.data_type"), F.col("e.data_type")),
        differs(F.col("a.nullable") & ~F.col("e.nullable"), "nullable", F.col("a.nullable").cast("string"), F.col("e.nullable").cast("string")),
        differs(F.lit(order) & (F.col("a.position") != F.col("e.position")), "position",
                F.col("a.position").cast("string"), F.col("e.position").cast("string"))))
    return (both.select(F.coalesce("a.column_name", "e.column_name").alias("column_name"), F.explode(found).alias("f"))
            .select("column_name", "f.problem", "f.actual", "f.expected"))


def assert_schema(df: DataFrame, expected: T.StructType | str, order: bool = True) -> DataFrame:
    """``df`` unchanged if its schema is as expected; else an error that lists
    every difference."""
    spark = df.sparkSession
    found = compare_schemas(schema_table(spark, df.schema), schema_table(spark, expected), order).orderBy("column_name", "problem").collect()
    if found:
        raise ValueError("unexpected schema: " + "; ".join(
            f"{r['column_name']}: {r['problem']} ({r['actual']}, expected {r['expected']})" for r in found))
    return df


def column_profile(df: DataFrame) -> DataFrame:
    """The schema table with, for every column, the rows of the table and how
    many of them are NULL: one pass over the data."""
    names = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.struct(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}")
                                                                  for i, c in enumerate(names)]).alias("nulls"))
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("position"), F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"nulls.c{i}").alias("n_null")) for i, (c, f) in enumerate(zip(names, df.schema.fields))])
    return counts.select(F.explode(each).alias("c"), "n_rows").select("c.*", "n_rows")
