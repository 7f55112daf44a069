"""Mixing sources to target weights by weighted fair queueing.

Every source's documents stand in a hash-shuffled queue. A document's virtual
finish time is the words of its source up to and including it, divided by the
source's target; each repeat of the queue (up to MAX_REPEATS) continues the
sum. All copies are sorted by finish time across the sources and cut where
their words reach the budget, the sum of all sizes. Only thin rows (ids, sizes
and hashes) are sorted; running sums over a hot source or over everything use
range partitions and offsets, never one task.

Defined results: NULL text has size 0; documents of size 0 are never taken;
NULL is a source of its own, last in order; rows repeating id and text are
queued each; an empty table gives no rows; texts may have any length; other
columns may have any name; order depends on ids and texts only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.ranking import ordered_prefix
from tessera.session import scratch_path
from tessera.sources.tables import read_table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def thin_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the hashes that order a queue."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{SEED}"))).alias("h"),
        F.md5(F.coalesce("text", F.lit(""))).alias("t"))


def source_targets(thin: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """source, idx, source_size, target. Weights repeat over the sources in
    code point order; a target stops at ``cap`` times its source's size and
    the excess is shared again by weight. That is ``min(cap * size, level *
    weight)`` for one level, found from running sums over the sources sorted
    by ``cap * size / weight``: no iteration, and sources may be many."""
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    idx = ordered_prefix(sizes, [], [F.col("source").isNull(), F.col("source")], out="idx")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    full = F.col("source_size") * cap
    s = idx.withColumn("w", w.cast("bigint")).withColumn("full", full)
    s = s.withColumn("ratio", F.col("full") / F.col("w"))
    s = ordered_prefix(s, [], ["ratio", "idx"], weight="full", out="full_before")
    s = ordered_prefix(s, [], ["ratio", "idx"], weight="w", out="w_before")
    total, weight = s.agg(F.sum("source_size"), F.sum("w")).first()
    level = (F.lit(total) - F.col("full_before")) / (F.lit(weight) - F.col("w_before"))
    first = s.withColumn("level", level).filter(F.col("level") <= F.col("ratio")).agg(
        F.min(F.struct("ratio", "idx", "level"))).first() if total is not None else None
    lam = float(first[0]["level"]) if first and first[0] else 0.0
    return s.select("source", "idx", "source_size",
                    F.least(F.col("full").cast("double"), F.lit(lam) * F.col("w")).alias("target"))


def mixed(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """doc_id, t (text hash), source, size, source_size, target, copies: how
    often the mix takes each document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "mixing")
    thin_rows(docs).write.parquet(path)
    thin = spark.read.parquet(path)
    targets = source_targets(thin, weights, cap)
    rows = thin.join(targets.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    queue = ordered_prefix(rows, ["idx"], ["h", "doc_id", "t"], weight="size", out="before")
    # kept, as it is read twice: for the cut and for the result
    spot = scratch_path(spark, "mixing-queue")
    queue.write.parquet(spot)
    queue = spark.read.parquet(spot)

    def copy(e: Column) -> Column:
        finish = (e * F.col("source_size") + F.col("before") + F.col("size")) / F.col("target")
        return F.struct(finish.alias("finish"), F.col("idx"), e.alias("e"), F.col("h"), F.col("doc_id"), F.col("t"))

    copies = F.when(F.col("size") > 0, F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), copy))
    total = queue.agg(F.sum("size")).first()[0] or 0
    line = queue.select("size", F.explode(copies).alias("c"))
    line = ordered_prefix(line, [], ["c"], weight="size", out="words_before")
    cut = line.filter(F.col("words_before") + F.col("size") <= total).agg(F.max("c").alias("c")).first()
    if cut is None or cut["c"] is None:
        taken = F.lit(0)
    else:
        last = cut["c"]
        types = {"finish": "double", "idx": "bigint", "e": "int", "h": "string", "doc_id": "bigint", "t": "string"}
        limit = F.struct(*[F.lit(last[k]).cast(t).alias(k) for k, t in types.items()])
        taken = F.coalesce(F.size(F.filter(copies, lambda c: c <= limit)), F.lit(0))
    return queue.select("doc_id", "t", "source", "size", "source_size", "target",
                        F.greatest(taken, F.lit(0)).alias("copies"))


def apply_mix(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: ``docs`` with each document as often as it is taken; all
    columns stay as they are, whatever their names."""
    plan = mixed(docs, weights, cap).groupBy("doc_id", "t").agg(
        F.count("*").alias("n"), F.sum("copies").alias("k")).filter("k > 0")
    path = scratch_path(docs.sparkSession, "mixing-plan")
    plan.write.parquet(path)
    plan = docs.sparkSession.read.parquet(path)
    repeated = plan.filter("n > 1").limit(1).count() > 0
    names = [f"c{i}" for i in range(len(docs.columns))]  # no name of the input's own clashes
    plain = docs.toDF(*names)
    at = {c: F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text")}
    joined = plain.join(plan, at["doc_id"].eqNullSafe(F.col("doc_id")) & (F.md5(F.coalesce(at["text"], F.lit(""))) == F.col("t")))
    times = F.col("k")
    if repeated:
        # rows that repeat id and text share their copies, the first rows more
        nth = F.row_number().over(Window.partitionBy("doc_id", "t").orderBy(F.lit(0)))
        joined = joined.withColumn("nth", nth)
        times = F.floor(F.col("k") / F.col("n")) + F.when(F.col("nth") <= F.col("k") % F.col("n"), 1).otherwise(0)
    out = joined.withColumn("times", times.cast("int")).filter("times > 0")
    out = out.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: size, its source's size and target, and the
    words that the mix takes of it (repeats counted)."""
    m = mixed(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return m.select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).cast("bigint").alias("taken"), "copies")


OP8_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5(coalesce(cast(doc_id as varchar), '') || ':17') as h, md5(coalesce(text, '')) as t
  from documents),
s as (
  select *, row_number() over (order by source is null, source) - 1 as idx
  from (select source, cast(sum(size) as bigint) as source_size from d group by source)),
s1 as (select *, case idx % 3 when 0 then 5 when 1 then 2 else 1 end as w from s),
s2 as (select *, 3 * source_size / w as ratio from s1),
s3 as (
  select *, coalesce(sum(3 * source_size) over o, 0) as full_before, coalesce(sum(w) over o, 0) as w_before,
         sum(source_size) over () as total, sum(w) over () as weight
  from s2 window o as (order by ratio, idx rows between unbounded preceding and 1 preceding)),
lv as (
  select cast(total - full_before as double) / cast(weight - w_before as double) as level
  from s3 where cast(total - full_before as double) / cast(weight - w_before as double) <= ratio
  order by ratio, idx limit 1),
tg as (select source, idx, source_size, least(cast(3 * source_size as double), level * w) as target from s3, lv),
q as (
  select d.*, idx, source_size, target,
         coalesce(sum(size) over (partition by idx order by h, doc_id nulls first, t
                                  rows between unbounded preceding and 1 preceding), 0) as before
  from d join tg on d.source is not distinct from tg.source),
c as (
  select *, cast(e * source_size + before + size as double) / target as finish
  from q, (select unnest([0, 1, 2]) as e) where size > 0),
k as (
  select *, sum(size) over (order by finish, idx, e, h, doc_id nulls first, t
                            rows between unbounded preceding and current row) as words
  from c),
n as (
  select idx, h, doc_id, t, count(*) as copies from k where words <= (select sum(size) from d) group by all)
select q.doc_id, q.size, q.source_size, q.target, cast(q.size * coalesce(n.copies, 0) as bigint) as taken,
       cast(coalesce(n.copies, 0) as int) as copies
from q left join n on q.idx = n.idx and q.h = n.h and q.t = n.t and q.doc_id is not distinct from n.doc_id
"""
