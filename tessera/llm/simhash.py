"""Document fingerprints: SimHash with permuted block tables.

A text's terms are its three-word shingles, weighted by how often they occur.
Each term's 64-bit hash votes on every bit with its weight; a bit is set where
the votes for it outnumber those against. All of it is built-in SQL: shingles
are exploded and 32 packed ``sum`` aggregates (two 32-bit counters in a long)
gather the 64 votes with codegen. Rows are already grouped by where they come
from, so the aggregation adds no shuffle.

Defined results: NULL and blank texts have no terms and get fingerprint 0;
texts of one or two words have one term; equal texts get equal fingerprints;
repeated rows are fingerprinted one by one; an empty table gives no rows; only
the named columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.text import add_shingle_hashes, clean_text
from tessera.session import scratch_path
from tessera.sources.tables import read_table

SHINGLE_WORDS = 3
RADIUS = 3
BLOCKS = 5
ROWS_PER_RANGE = 1000
MAX_RANGES = 20_000
LOW = 0xFFFFFFFF


def fingerprints(df: DataFrame, text: str, keys: list[str], out: str = "fingerprint",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per distinct ``keys`` with the 64-bit SimHash ``out`` (long) of
    its text. ``keys`` must identify a row. When the input is already
    partitioned by some of the keys no shuffle is added."""
    terms = add_shingle_hashes(df.select(*keys, text), text, "__terms", shingle_words)
    votes = terms.select(*keys, F.explode_outer("__terms").alias("__h"))
    pair = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("__h", k).bitwiseAND(pair)).alias(f"__s{k}") for k in range(32)]
    counted = votes.groupBy(*keys).agg(F.count("__h").alias("__n"), *sums)
    bits = []
    for k in range(32):
        s = F.coalesce(F.col(f"__s{k}"), F.lit(0).cast("bigint"))
        for bit, votes_for in ((k, s.bitwiseAND(F.lit(LOW))), (k + 32, F.shiftrightunsigned(s, 32))):
            one = F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("bigint")
            bits.append(F.when(2 * votes_for > F.col("__n"), one).otherwise(F.lit(0).cast("bigint")))
    return counted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias(out))


def as_hex(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: str | Column, b: str | Column) -> Column:
    """1 for equal fingerprints, 0 when all 64 bits differ."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Masks of the permuted block tables. The 64 bits are cut into
    ``blocks`` blocks; at most ``radius`` of them can hold a differing bit, so
    the others agree: one table for each choice of ``blocks - radius``."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("need 0 <= radius < blocks <= 64")
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS,
                  blocks: int = BLOCKS) -> DataFrame:
    """All pairs (query_fp, fp, distance, n) of the distinct fingerprints in
    ``queries.fp`` and ``corpus.fp`` at most ``radius`` bits apart; ``n`` is
    the number of corpus rows with that fingerprint. Exact. Copies collapse
    before the tables are built, a pair comes out of one table only (the first
    in which it agrees), and a crowded table entry is an ordinary skewed join
    key that adaptive execution splits."""
    masks = block_masks(radius, blocks)

    def tables(df: DataFrame, fp: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col(fp).bitwiseAND(F.lit(m).cast("bigint")).alias("k"))
                         for t, m in enumerate(masks)])
        return df.withColumn("__e", F.explode(keys)).select("*", "__e.*").drop("__e")

    q = tables(queries.filter(F.col("fp").isNotNull()).select(F.col("fp").alias("query_fp")).distinct(), "query_fp")
    c = tables(corpus.filter(F.col("fp").isNotNull()).groupBy("fp").agg(F.count("*").alias("n")), "fp")
    differ = F.col("query_fp").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m).cast("bigint")) == 0, F.lit(t))
                         for t, m in enumerate(masks)])
    joined = q.alias("q").join(c.alias("c"), (F.col("q.t") == F.col("c.t")) & (F.col("q.k") == F.col("c.k"))
                               & (F.bit_count(differ) <= radius) & (first == F.col("c.t")))
    return joined.select("query_fp", "fp", F.bit_count(differ).alias("distance"), "n")


def _ranges(df: DataFrame, rows_per_range: int) -> DataFrame:
    """Add ``range`` to (doc_id, text, tie): consecutive numbers in order of
    (doc_id, NULLs first, tie). Ids are cut at approximate quantiles; an id that
    many rows share (or NULL) gets ranges of its own, cut by ``tie``. At most
    about twice MAX_RANGES numbers come to the driver."""
    n = df.count()
    each = max(rows_per_range, ceil(n / MAX_RANGES))
    wanted = max(1, ceil(n / each))
    found = df.agg(F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)], max(10_000, 20 * wanted))).first()[0] if wanted > 1 else []
    common = df.groupBy("doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * each).collect()  # at most n / each / 2 rows
    # bounds are compared as doubles: larger ids would not be told apart
    shared = {float("-inf") if r["doc_id"] is None else float(r["doc_id"]): r["n"] for r in common if abs(r["doc_id"] or 0) < 1 << 53}
    splits = [float("-inf"), *sorted({float(x) for x in found or []} | set(shared) - {float("-inf")}), float("inf")]
    pieces = [ceil(shared.get(x, 0) / each) for x in splits[:-1]]
    first = [0]
    for k in pieces:
        first.append(first[-1] + k + 1)
    df = df.withColumn("d", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    if len(splits) > 2:
        df = Bucketizer(splits=splits, inputCol="d", outputCol="r").transform(df).withColumn("r", F.col("r").cast("int"))
    else:
        df = df.withColumn("r", F.lit(0))

    def of(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("r"))

    part = F.floor((F.col("tie").cast("double") / 2.0 ** 64 + 0.5) * of(pieces))
    own = (of(pieces) > 0) & (of(splits[:-1]) == F.col("d"))
    place = of(first[:-1]) + F.when(own, F.least(part, of(pieces) - 1)).otherwise(of(pieces))
    return df.withColumn("range", place.cast("int")).drop("d", "r")


def next_text(df: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """For (doc_id, text): add ``next``, the text of the next row in order of
    (doc_id, NULLs first, then text hash), the first row's for the last.

    Rows are cut into ranges of that order; one first row of every range is also
    sent to the range before it, so one shuffle of the texts and a window inside
    each range suffice. Returns (range, rn, copy, doc_id, text, next); rows with
    ``copy > 0`` are those helpers. Rows that are equal in id and text lie in one
    range."""
    rows = _ranges(df.select("doc_id", clean_text("text").alias("text")).withColumn("tie", F.xxhash64("text")), rows_per_range)
    least = rows.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "tie")).alias("least"))
    order = Window.orderBy("range")  # one row a range
    to = least.select(F.col("range").alias("of"), "least.doc_id", "least.tie", F.lag("range").over(order).alias("before"),
                      F.max("range").over(Window.partitionBy()).alias("last"))
    to = F.broadcast(to.select("of", F.col("doc_id").alias("head_id"), F.col("tie").alias("head_tie"),
                               F.coalesce("before", "last").alias("to"), F.when(F.col("before").isNull(), 2).otherwise(1).alias("copy")))
    heads = rows.join(to, (F.col("range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
    heads = heads.groupBy("to", "copy", "doc_id", "tie").agg(F.first("text").alias("text"))
    both = rows.select("range", F.lit(0).alias("copy"), "doc_id", "text", "tie").unionByName(
        heads.select(F.col("to").alias("range"), "copy", "doc_id", "text", "tie"))
    # An explicit count: the work per byte is heavy, so partitions must not be
    # merged by size.
    both = both.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "range")
    w = Window.partitionBy("range").orderBy(F.col("copy") == 2, F.col("doc_id").asc_nulls_first(), "tie", "copy")
    return both.select("range", F.row_number().over(w).alias("rn"), "copy", "doc_id", "text",
                       F.lead("text").over(w).alias("next"))


def edited_fingerprints(df: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text (the last half of its
    code points replaced by the beginning of the next document) and how alike
    they are: doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited,
    near_next."""
    rows = next_text(df)
    half = F.col("n_chars") - F.floor(F.col("n_chars") / 2)
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), half.cast("int")),
        F.substring(F.coalesce("next", F.lit("")), F.lit(1), (F.col("n_chars") - half).cast("int"))))
    keys = ["range", "rn", "copy", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.withColumn("edited_sha256", F.when(F.col("copy") == 0, F.sha2("edited", 256)))
    side = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")),
                   F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))
    sides = F.when(F.col("copy") == 0, side).otherwise(F.slice(side, 1, 1))
    rows = rows.withColumn("__s", F.explode(sides)).select(*keys, "__s.*")
    fps = fingerprints(rows, "body", [*keys, "side"], "fp")
    both = fps.groupBy(*keys).agg(F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"),
                                  F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fp"))
    w = Window.partitionBy("range").orderBy("rn")
    both = both.withColumn("next_fp", F.lead("fp").over(w)).filter(F.col("copy") == 0)
    return both.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp",
                       likeness("fp", "edited_fp").alias("near_edited"),
                       likeness("fp", "next_fp").alias("near_next"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of all documents; ``n_within``: for query rows
    (doc_id divisible by 100) how many other documents lie within RADIUS bits,
    found through the block tables, NULL for the rest."""
    path = scratch_path(spark, "simhash")
    edited_fingerprints(read_table(spark, sf_dir, "documents", "doc_id", "text")).write.parquet(path)
    fps = spark.read.parquet(path)
    is_query = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    near = within_radius(fps.filter(is_query).select("fp"), fps.select("fp"))
    near = near.groupBy(F.col("query_fp").alias("fp")).agg((F.sum("n") - 1).alias("__near"))
    out = fps.join(near, "fp", "left")
    return out.select("doc_id", "n_chars", "edited_sha256", as_hex("fp").alias("fingerprint"),
                      as_hex("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next",
                      F.when(is_query, F.col("__near")).alias("n_within"))
