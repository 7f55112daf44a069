"""Parquet inputs. Reads always name the columns they need so that the scan's
``ReadSchema`` is pruned and later filters reach ``PushedFilters``."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def fresh_name(taken: list[str], wanted: str) -> str:
    """A column name that no column of ``taken`` has."""
    have = {c.lower() for c in taken}
    while wanted.lower() in have:
        wanted += "_"
    return wanted


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one input table; with ``columns`` only those are scanned."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


# Training rows of one bucket: small tables still give every core work, very
# large ones do not get more buckets than a cluster schedules well, and no
# bucket grows beyond what a task holds.
BUCKET_ROWS, MAX_BUCKETS, MAX_BUCKET_ROWS = 10_000, 10_000, 2_000_000
# Tasks of a pass over a training table, until one would hold more than
# MAX_BUCKET_ROWS rows: a task takes several buckets.
FIT_TASKS = 24


def bucket_count(rows: int) -> int:
    """Buckets of a training table, from its row count alone."""
    each = min(max(BUCKET_ROWS, ceil(rows / MAX_BUCKETS)), MAX_BUCKET_ROWS)
    return max(1, ceil(rows / each))


def fit_tasks(rows: int) -> int:
    """Partitions of a training table, from its row count alone. Every task of a
    pass sends a whole histogram or matrix, however few its rows, and a fit makes
    hundreds of passes: what it shuffles, sends to the driver and schedules grows
    with the tasks, so they grow with the rows only where memory asks for it."""
    return max(min(bucket_count(rows), FIT_TASKS), ceil(rows / MAX_BUCKET_ROWS))


# Cells that rows are counted in by a hash of their key, to find out whether one
# key could fill a bucket: bounded, whatever the number of keys. A bucket has
# three times the rows of a cell at least while MAX_BUCKETS holds.
KEY_CELLS = 65_536


def _key_sizes(rows: DataFrame, key: list[str], buckets: int | None = None) -> tuple[int, int]:
    """(rows, rows of the most frequent key or a number that is not above half a
    bucket). Rows are counted by cells of keys; only the keys of cells above
    half a bucket are counted one by one."""
    cell = fresh_name(rows.columns, "cell")
    by_cell = rows.withColumn(cell, F.pmod(F.xxhash64(*key), F.lit(KEY_CELLS)))
    cells = by_cell.groupBy(cell).agg(F.count(F.lit(1)).alias("n"))
    total, most = cells.agg(F.sum("n"), F.max("n")).first()
    total, most = total or 0, most or 0
    half = total / (buckets or bucket_count(total)) / 2
    if most > half:
        large = cells.filter(F.col("n") > half).select(cell)
        among = by_cell.join(large, cell, "left_semi")
        most = among.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return total, most


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, "training-rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_layout(df: DataFrame, key: list[str], buckets: int | None = None, keep: Column | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """One layout for model fits: rows dealt by a hash of ``key`` into buckets,
    several of them to a partition (``fit_tasks``), in key order inside each.
    Sampling inside tree ensembles and the sums of iterative solvers depend on
    the layout; this one follows from the rows and their number, so the same
    rows give the same model however the input was split and whatever cluster it
    is fitted on. With ``buckets`` given, each is a partition.

    The rows are written to the shared scratch folder first (they are counted,
    dealt and read in every pass of a fit; a lost executor re-reads them
    instead of what they were made from). A key that alone would fill a bucket
    is split: its equal rows, which nothing tells apart, are dealt in turn, its
    differing rows by a hash of all columns."""
    return laid_out(stored(df), key, buckets, keep, columns)


def laid_out(rows: DataFrame, key: list[str], buckets: int | None = None, keep: Column | None = None,
             columns: list[str] | None = None) -> DataFrame:
    """The layout of ``fit_layout`` for rows that are ``stored`` already. All
    rows decide on it; with ``keep`` only rows for which it holds are dealt (they
    lie and follow one another as they would among all), and with ``columns``
    only these are handed on."""
    total, most = _key_sizes(rows, key, buckets)
    tasks = buckets or fit_tasks(total)
    buckets = buckets or bucket_count(total)
    bucket = fresh_name(rows.columns, "bucket")
    hot = total > 1 and buckets > 1 and most > total / buckets / 2
    rows = rows if keep is None else rows.filter(keep)
    if hot:
        turn = fresh_name([*rows.columns, bucket], "turn")
        same = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(turn))
        dealt = same.withColumn(turn, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(turn))))
        dealt = dealt.withColumn(bucket, ((F.pmod(F.xxhash64(*rows.columns), F.lit(buckets)) + F.col(turn)) % buckets).cast("int")).drop(turn)
    else:
        dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    columns = columns or rows.columns
    order = [*key, *[c for c in columns if c not in key]]
    # several buckets to a partition are one after the other in it
    return (dealt.select(*order, bucket).repartitionById(tasks, F.pmod(F.col(bucket), F.lit(tasks)).cast("int"))
            .sortWithinPartitions(bucket, *order).select(*columns))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin rows that sit in far fewer partitions than the cluster has
    task slots (a single Parquet row group or a gzip file is one split)
    before heavy parsing. Only for file scans, whose splits are known without
    running a job; big inputs already have many splits and are returned
    unchanged, so this adds no shuffle at scale. Set ``tessera.spreadScans=false`` to disable."""
    spark = df.sparkSession
    if spark.conf.get("tessera.spreadScans", "true") != "true":
        return df
    slots = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 <= slots:
        return df.repartition(slots)
    return df

