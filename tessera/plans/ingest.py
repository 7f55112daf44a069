"""Registered queries on reading: malformed lines kept apart, schemas as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import quarantine as Q
from tessera.sources import schemas as S
from tessera.sources.fixtures import RATING_LINE_SCHEMA, rating_lines
from tessera.sources.tables import TABLES, read_table


def _checked(spark: SparkSession, sf_dir: str) -> tuple[Q.CheckedCsv, str]:
    """The rating lines as a text file of other origin, read with checks."""
    path = scratch_path(spark, "rating-lines")
    rating_lines(spark, sf_dir).select("line").write.text(path)
    return Q.read_checked_csv(spark, path, RATING_LINE_SCHEMA, header=False), path


def csv_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(outcome, n): good rows, bad lines by what is wrong, faults by column,
    and all lines of the file, counted without the CSV reader."""
    checked, path = _checked(spark, sf_dir)
    faults = checked.type_faults().select(F.concat(F.lit("type of "), "column_name").alias("outcome"), "n")
    lines = spark.read.text(path).agg(F.lit("lines").alias("outcome"), F.count(F.lit(1)).alias("n"))
    return checked.counts().unionByName(faults).unionByName(lines)


def csv_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows; -1 stands for an empty field."""
    good = _checked(spark, sf_dir)[0].good
    return good.withColumns({c: F.coalesce(c, F.lit(-1).cast("bigint")) for c in ("userId", "timestamp")})


def csv_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantined lines, unchanged, with every reason."""
    bad = _checked(spark, sf_dir)[0].bad
    return bad.select("line", "outcome", F.concat_ws(",", "reasons").alias("reasons"), "n_fields")


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, types, rows and NULLs of every input table."""
    out = None
    for name in TABLES:
        rows = S.column_profile(read_table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {
    "csv_outcomes": csv_outcomes,
    "csv_good_rows": csv_good_rows,
    "csv_bad_lines": csv_bad_lines,
    "table_schemas": table_schemas,
}
