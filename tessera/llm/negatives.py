"""Hard negatives by exact inner products from Kronecker-packed integers.

Components are biased by a common bound to be non-negative and those of
several candidates are put into separated fields of one wide integer. One
multiplication by an anchor's (biased) component then serves all of them; a
field is wide enough for the whole sum (at most the largest squared length of a
biased row), so fields never run into each other.
The sum over the components is unpacked field by field, and the bias, known
from the sums of either side's components, is taken off: the exact score.

Rows that are equal in id, label and vector collapse into one point with a
count before anything is shuffled, so a very common row costs one point.
Points are dealt by hash into chunks, anchors into blocks, both of bounded
size and independent of the label, so a hot label is spread like any other.
Every (chunk, block) pair is scored twice, first among rows of one label for
the positives, then against the other labels for the negatives, and sends on
at most ``positives`` (``negatives``) rows an anchor (and positive); windows
over one anchor pick the best of all chunks.

Defined results: rows with a null label, a null vector, or a null or
non-finite component take no part; shorter vectors count as padded with
zeros; repeated rows are rows of their own, as anchors, positives and
negatives; a row without id takes part, but is no anchor, and comes last among
ties; an anchor without positives, or a positive without negatives in its
range, gives no rows; an empty table gives none. Components whose products
would not fit 64 bits fail the job. Only the named columns are read, so others
may have any name. Texts do not occur here.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources.tables import read_table

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
CHUNK_POINTS, ANCHOR_BLOCK = 16_384, 4_096
TILE = 1 << 21  # scores held at a time
WORD = 63  # bits of a machine integer that fields may use
WIDE_FIELDS = 8  # fields of an integer beyond a machine word


class Packed:
    """Candidates' components in fields of wide integers: ``words[j, g]`` holds
    component j of the candidates of group g."""

    def __init__(self, points: np.ndarray, bound: int, most: int):
        """``bound``: no component is less than its negative; ``most``: no
        biased inner product is greater."""
        self.n, self.dim = points.shape
        self.bound = bound
        self.width = max(1, most.bit_length())
        machine = 2 * self.width <= WORD
        self.fields = WORD // self.width if machine else WIDE_FIELDS
        self.dtype = np.dtype(np.uint64) if machine else np.dtype(object)
        self.sums = points.sum(axis=1, dtype=np.int64)
        groups = max(1, ceil(self.n / self.fields))
        biased = np.zeros((groups * self.fields, self.dim), self.dtype)
        biased[:self.n] = (points + bound).astype(self.dtype)
        self.words = np.zeros((self.dim, groups), self.dtype)
        for f in range(self.fields):
            self.words += biased[f::self.fields].T * self._number(1 << (f * self.width))

    def _number(self, value: int):
        return np.uint64(value) if self.dtype != object else value

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors x candidates."""
        biased = (anchors + self.bound).astype(self.dtype)
        total = np.zeros((len(anchors), self.words.shape[1]), self.dtype)
        for j in range(self.dim):  # one product an anchor component and word
            total += biased[:, j, None] * self.words[j]
        out = np.empty((len(anchors), self.words.shape[1], self.fields), np.int64)
        mask = self._number((1 << self.width) - 1)
        offset = self.bound * anchors.sum(axis=1, dtype=np.int64) + self.dim * self.bound ** 2
        for f in range(self.fields):
            out[:, :, f] = ((total >> self._number(f * self.width)) & mask).astype(np.int64)
        flat = out.reshape(len(anchors), -1)[:, :self.n]
        return flat - offset[:, None] - self.bound * self.sums[None, :]


def best(scores: np.ndarray, allowed: np.ndarray | None, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the first position."""
    at = np.arange(len(scores)) if allowed is None else np.flatnonzero(allowed)
    v = scores[at]
    if len(at) > k:
        near = v >= np.partition(v, len(v) - k)[len(v) - k]
        at, v = at[near], v[near]
    return at[np.argsort(-v, kind="stable")[:k]]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class _Side:
    """Candidates of one task in order of their ids (rows without id last),
    each as often as its row repeats."""

    def __init__(self, table: pa.Table, dim: int):
        null = table.column("vec_id").is_null().to_numpy()
        ids = table.column("vec_id").fill_null(0).to_numpy()
        order = np.lexsort((ids, null))
        order = np.repeat(order, table.column("copies").to_numpy()[order])
        self.ids, self.null = ids[order], null[order]
        self.label = table.column("label").to_numpy()[order]
        self.q = _matrix(table.column("q"), dim)[order]

    def id_array(self, at: list[np.ndarray]) -> pa.Array:
        where = np.concatenate(at) if at else np.zeros(0, np.int64)
        return pa.array(self.ids[where], pa.int64(), mask=self.null[where])


def _tiles(anchors: int, candidates: int):
    step = max(1, TILE // max(1, candidates))
    return [(a, min(anchors, a + step)) for a in range(0, anchors, step)]


def points_of(df: DataFrame, label: Column, scale: float = SCALE) -> DataFrame:
    """(vec_id, label, q, copies): distinct valid rows with integer components,
    padded to one length, as a written table."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad
    # beyond a long, the conversion of the floor is an error
    q = F.transform(x, lambda v: F.floor(F.when(F.abs(v) < 2.0 ** 31, F.lit(scale) * v)
                                         .otherwise(F.raise_error(F.lit("a component of 2**31 or more")).cast("double"))).cast("bigint"))
    rows = df.filter(valid).select("vec_id", label.cast("bigint").alias("label"), q.alias("q"))
    grouped = rows.groupBy("vec_id", "label", "q").agg(F.count(F.lit(1)).alias("copies"))
    spark = df.sparkSession
    path = scratch_path(spark, "negatives-points")
    grouped.write.parquet(path)
    grouped = spark.read.parquet(path)
    dim = max(1, grouped.agg(F.max(F.size("q"))).first()[0] or 0)
    return grouped.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("q"))))


def mine(points: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for ``points`` as ``points_of`` gives them."""
    spark = points.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("q")).alias("dim"),
                       F.min(F.array_min("q")).alias("least"), F.max(F.array_max("q")).alias("top")).first()
    if not facts["n"] or not facts["anchors"]:
        return spark.createDataFrame([], schema)
    dim, bound = facts["dim"], max(0, -(facts["least"] or 0))
    if (dim * (2 * max(bound, facts["top"] or 0)) ** 2).bit_length() > WORD:
        raise ValueError(f"inner products of components from {facts['least']} to {facts['top']} do not fit 64 bits")
    # no biased product exceeds the largest squared length of a biased row
    square = F.aggregate("q", F.lit(0).cast("bigint"), lambda a, v: a + (v + bound) * (v + bound))
    most = points.agg(F.max(square)).first()[0]
    slots = spark.sparkContext.defaultParallelism
    chunks = max(ceil(facts["n"] / CHUNK_POINTS), min(slots, ceil(facts["n"] / 1024)))
    blocks = ceil(facts["anchors"] / ANCHOR_BLOCK)

    # anchors get a number of their own: ids can repeat; the written table fixes it
    path = scratch_path(spark, "negatives-anchors")
    points.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()).write.parquet(path)
    anchors = spark.read.parquet(path)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    spot = F.xxhash64("vec_id", "label", "q")
    # more copies than a list has places change nothing; one may be the anchor itself
    dealt = (points.withColumn("copies", F.least("copies", F.lit(max(positives, negatives) + 1)))
             .withColumn("chunk", F.pmod(spot, F.lit(chunks)).cast("int")).withColumn("block", every(blocks)))

    def asked(df: DataFrame) -> DataFrame:
        return df.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")).withColumn("chunk", every(chunks))

    def paired(right: DataFrame, task, out: str) -> DataFrame:
        key = ["chunk", "block"]
        return dealt.groupBy(*key).cogroup(asked(right).groupBy(*key)).applyInArrow(task, out)

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["anchor", "positive_id", "positive_score"]
        who, score, at = [], [], []
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        side = _Side(left, dim)
        q, label = _matrix(right.column("q"), dim), right.column("label").to_numpy()
        number, ids = right.column("anchor").to_numpy(), right.column("vec_id").to_numpy()
        for value in np.intersect1d(label, side.label):
            mine_, theirs = np.flatnonzero(label == value), np.flatnonzero(side.label == value)
            packed = Packed(side.q[theirs], bound, most)
            for a, b in _tiles(len(mine_), len(theirs)):
                found = packed.scores(q[mine_[a:b]])
                for i, row in zip(mine_[a:b], found):
                    allowed = None
                    same = np.flatnonzero((side.ids[theirs] == ids[i]) & ~side.null[theirs])
                    same = same[(side.q[theirs[same]] == q[i]).all(axis=1)]
                    if len(same):  # the anchor's own row; its copies are others
                        allowed = np.ones(len(theirs), bool)
                        allowed[same[0]] = False
                    top = best(row, allowed, positives)
                    who.append(np.full(len(top), number[i]))
                    score.append(row[top])
                    at.append(theirs[top])
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, score)]
        return pa.table([pa.array(flat[0], pa.int64()), side.id_array(at), pa.array(flat[1], pa.int64())], names=names)

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["anchor", "place", "negative_id", "negative_score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int32()), *[pa.array([], pa.int64())] * 2], names=names)
        side = _Side(left, dim)
        q, label = _matrix(right.column("q"), dim), right.column("label").to_numpy()
        number, wanted = right.column("anchor").to_numpy(), right.column("positive_scores").to_pylist()
        who, place, score, at = [], [], [], []
        packed = Packed(side.q, bound, most)
        for a, b in _tiles(len(q), len(side.q)):
            for i, row in zip(range(a, b), packed.scores(q[a:b])):
                other = side.label != label[i]
                for p, target in enumerate(wanted[i], start=1):
                    # low% <= score <= high%, in whole numbers
                    top = best(row, other & (row >= -(-low * target // 100)) & (row <= high * target // 100), negatives)
                    who.append(np.full(len(top), number[i]))
                    place.append(np.full(len(top), p))
                    score.append(row[top])
                    at.append(top)
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, place, score)]
        return pa.table([pa.array(flat[0], pa.int64()), pa.array(flat[1].astype(np.int32)), side.id_array(at),
                         pa.array(flat[2], pa.int64())], names=names)

    first = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last())
    near = (paired(anchors.select("anchor", "vec_id", "label", "q"), find_positives, "anchor bigint, positive_id bigint, positive_score bigint")
            .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives))
    path = scratch_path(spark, "negatives-positives")
    near.write.parquet(path)
    near = spark.read.parquet(path)
    targets = near.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))),
                                                     lambda s: s["positive_score"]).alias("positive_scores"))
    hard = paired(anchors.join(targets, "anchor").select("anchor", "label", "q", "positive_scores"), find_negatives,
                  "anchor bigint, place int, negative_id bigint, negative_score bigint")
    then = Window.partitionBy("anchor", "place").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    hard = hard.withColumn("rank", F.row_number().over(then)).filter(F.col("rank") <= negatives)
    own = anchors.select("anchor", F.col("vec_id").alias("anchor_id"), F.col("copies").alias("times"))
    return (hard.join(near, ["anchor", "place"]).join(own, "anchor")
            .withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))  # an anchor row that repeats
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100, among all
    vectors; every seventh label is moved by one first."""
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return mine(points_of(rows, moved), F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))


OP13_SQL = """
with v as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.row, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    cast(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) as bigint) as score
  from v a join v b on a.row <> b.row where a.vec_id % 100 = 0),
p as (
  select *, row_number() over (partition by row order by score desc, vec_id nulls last) as place from s where same),
n as (
  select p.row, p.place, p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
    cast(row_number() over (partition by p.row, p.place order by s.score desc, s.vec_id nulls last) as int) as rank
  from p join s on s.row = p.row and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
  where p.place <= 5)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
