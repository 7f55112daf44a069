"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: short lineage that
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    thin(df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def thin(df: DataFrame) -> DataFrame:
    """Links and labels are a small part of the texts they come from: an eighth
    of the shuffle partitions writes them, so that the many short steps over
    them are not mostly task overhead."""
    return df.coalesce(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every u has one v and no v is a u: then v are the roots."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or (up > 0 and down > 0)").limit(1).count() == 0


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the least node
    of its component. Least neighbours are aggregates (combined before the
    shuffle) joined back to the links, so a node with very many links is a
    skewed join key, not a group in one task. Ends when the links are a forest
    of stars, after about log2(n) rounds."""
    edges = _kept(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while not _is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _kept(large.filter("u <> v"), "cc")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = _kept(small.filter("u <> v").distinct(), "cc")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


#: Bits of a filter: its table has at most a 64th as many rows, of two numbers.
FILTER_BITS = 1 << 24


def maybe_in(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in ``wanted`` (same column): a hash
    filter of fixed size, broadcast, so that most of the rest needs no shuffle.
    A join must follow, as other keys pass by chance (the more, the larger
    ``wanted`` is)."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    words = wanted.select(bit(key).alias("b")).groupBy(F.floor(F.col("b") / 64).alias("__w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("__bits"))
    df = df.withColumn("__b", bit(key)).join(F.broadcast(words), F.floor(F.col("__b") / 64) == F.col("__w"))
    return df.filter(F.expr("shiftrightunsigned(__bits, cast(__b % 64 as int)) & 1 = 1")).drop("__b", "__w", "__bits")
