"""Registered web-log queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import logs as L
from tessera.session import ensure_checkpoint_dir, scratch_path
from tessera.sources import files
from tessera.sources.fixtures import access_log, long_access_log


# The month of the stand-in log.
MONTH, YEAR = "Jan", 2024


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as the analyses receive it — gzip text files — read back as
    lines and parsed. Lines without a valid timestamp are counted by
    ``log_filter_count`` (n_unparsed) and left out here."""
    path = scratch_path(spark, "access-log")
    files.write_lines(access_log(spark, sf_dir), path)
    return L.parse_access_log(files.read_lines(spark, path), MONTH, YEAR, valid_only=True)


def log_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.log_filter_counts(access_log(spark, sf_dir), MONTH, YEAR)


def log_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.daily_counts(L.parse_access_log(access_log(spark, sf_dir), MONTH, YEAR))


def log_hour_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.hour_band_averages(L.parse_access_log(access_log(spark, sf_dir), MONTH, YEAR))


def log_top_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.top_files(L.month_lines(access_log(spark, sf_dir), MONTH, YEAR), n=20)


def log_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per day and band over several months, days without traffic
    included."""
    ensure_checkpoint_dir(spark)
    out = L.traffic_calendar(long_access_log(spark, sf_dir))
    return out.withColumn("date", F.col("date").cast("string")).withColumn("month_average", F.round("month_average", 9))


def log_report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result tables as single ordered files, read back line by line:
    (file, line_no, line)."""
    lines = L.month_lines(access_log(spark, sf_dir), MONTH, YEAR)
    daily = L.daily_counts(L.parse_access_log(access_log(spark, sf_dir), MONTH, YEAR))
    tables = {"top_files": L.top_files(lines, n=20), "daily": daily}
    paths = files.write_report(tables, scratch_path(spark, "log-report"),
                               order_by={"top_files": [F.desc("requests"), "file_name"], "daily": ["day"]})
    out = None
    for name, path in paths.items():
        rows = spark.read.text(path, wholetext=True).select(
            F.lit(name).alias("file"), F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")).alias("line_no", "line"))
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {
    "log_calendar": log_calendar,
    "log_report_file": log_report_file,
    "log_parse": log_parse,
    "log_filter_count": log_filter_count,
    "log_daily_counts": log_daily_counts,
    "log_hour_bands": log_hour_bands,
    "log_top_files": log_top_files,
}
