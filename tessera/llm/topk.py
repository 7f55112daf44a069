"""Exact top-k inner products by dual-tree search over cover trees.

Equal vectors collapse into one point that carries its k + 1 least ids (no
more can be among any k best), so a very common vector costs one point. Points
are dealt to cells around pivots, the top level of the index: a farthest-first
cover of a bounded sample (the index is fitted on the sample, every point is
indexed). Cells are cut into chunks of bounded size. Each query gets a first
lower bound of its k-th score from the sample, and visits only cells whose
covering radius lets them reach it. For every (chunk, block of queries) a task
builds a cover tree of each side and walks both together: a pair of nodes is
pruned when ``<cq, cr> + |cq| rr + |cr| rq + rq rr`` is below the worst k-th
score of the query node. Two leaves meet in one product of matrices, of which
only the scores that reach a query's bound are looked at. Only strictly lower
scores are pruned, so ties (to the smaller id) are exact.

Defined results: vectors that are null, or hold null or non-finite components,
take no part, nor do rows without id; an id that repeats keeps its least
vector; shorter vectors count as padded with zeros; components whose inner
products could leave 64 bits fail the job; with fewer than k candidates all are
returned; an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources.tables import read_table

K = 10
SCALE = 1024.0
SAMPLE_POINTS = 4096  # bound of the index sample and of what is broadcast
MAX_CELLS = 256
CELL_POINTS, CHUNK_POINTS, QUERY_BLOCK = 2048, 8192, 4096
# points of a leaf: two leaves meet in one product of matrices; pairs that wait
# until only the k best of a query are kept
LEAF, FANOUT, MAX_PENDING = 512, 16, 1_000_000


class CoverTree:
    """Nodes have a centre, the radius that covers their points, and children
    whose centres are a farthest-first cover of the node at half its radius (at
    most FANOUT of them; radii are then what they are). Leaves list points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.nodes: list[tuple[np.ndarray, float, list[int], np.ndarray]] = []
        if len(points):
            self._build(np.arange(len(points)))

    def _build(self, idx: np.ndarray) -> int:
        x = self.points[idx]
        centre = x[0]
        dist = np.sqrt(((x - centre) ** 2).sum(axis=1))
        radius = float(dist.max())
        at = len(self.nodes)
        self.nodes.append((centre, radius, [], idx))
        if len(idx) > LEAF and radius > 0:
            owner = np.zeros(len(idx), np.int64)
            for child in range(1, FANOUT):
                far = int(dist.argmax())
                if dist[far] <= radius / 2:
                    break
                to = np.sqrt(((x - x[far]) ** 2).sum(axis=1))
                owner = np.where(to < dist, child, owner)
                dist = np.minimum(to, dist)
            for child in np.unique(owner):
                self.nodes[at][2].append(self._build(idx[owner == child]))
        return at


def _bounds(q: tuple, refs: list[tuple]) -> np.ndarray:
    """Upper bounds of the inner products of a query node with each node."""
    c = np.array([r[0] for r in refs])
    rr = np.array([r[1] for r in refs])
    return c @ q[0] + np.linalg.norm(q[0]) * rr + np.linalg.norm(c, axis=1) * q[1] + q[1] * rr


def dual_tree(points: np.ndarray, ids: list[np.ndarray], queries: np.ndarray, query_ids: np.ndarray,
              floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids), each queries x k, by falling score, then id; unused
    places hold the least integer. ``floor``: known lower bounds of the k-th
    scores. Of two leaves only the pairs that reach the floor are kept; when
    MAX_PENDING of them wait, only the k best of a query stay and floors rise."""
    none = np.iinfo(np.int64).min
    # exact in floating point while products stay below 2**53
    big = max(float(np.abs(points).max(initial=0)), float(np.abs(queries).max(initial=0)))
    exact = big * big * points.shape[1] < 2.0 ** 53
    p, q = points.astype(np.float64), queries.astype(np.float64)
    floor = floor.astype(np.float64).copy()
    flat = np.concatenate(ids) if len(ids) else np.zeros(0, np.int64)
    reps = np.array([len(i) for i in ids], np.int64)
    starts = np.cumsum(reps) - reps
    qt, rt = CoverTree(q), CoverTree(p)
    kept = [(np.zeros(0, np.int64),) * 3]
    pending = 0

    def shrink() -> None:
        nonlocal kept, pending
        row, score, found = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((found, ~score, row))
        row, score, found = row[order], score[order], found[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        last = nth == k - 1
        floor[row[last]] = np.maximum(floor[row[last]], score[last].astype(np.float64))
        kept, pending = [(row[nth < k], score[nth < k], found[nth < k])], 0

    def meet(qi: np.ndarray, ri: np.ndarray) -> None:
        nonlocal pending
        score = q[qi] @ p[ri].T if exact else queries[qi] @ points[ri].T
        least = floor[qi] if exact else floor[qi] - 1e-9 * np.abs(floor[qi])  # a float of it may be rounded upwards
        at, to = np.nonzero(score >= least[:, None])
        if not len(at):
            return
        score, row, to = score[at, to].astype(np.int64), qi[at], ri[to]
        n = reps[to]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row, score, found = np.repeat(row, n), np.repeat(score, n), flat[np.repeat(starts[to], n) + nth]
        other = found != query_ids[row]
        kept.append((row[other], score[other], found[other]))
        pending += int(other.sum())
        if pending > MAX_PENDING:
            shrink()

    heap: list[tuple[float, int, int]] = []

    def push(qn: int, rns: list[int]) -> None:
        node = qt.nodes[qn]
        worst = floor[node[3]].min()
        for rn, b in zip(rns, _bounds(node, [rt.nodes[r] for r in rns])):
            if b + 1e-6 * (1 + abs(b)) >= worst:
                heappush(heap, (-b, qn, rn))

    if qt.nodes and rt.nodes:
        push(0, [0])
    while heap:
        b, qn, rn = heappop(heap)
        qnode, rnode = qt.nodes[qn], rt.nodes[rn]
        if -b + 1e-6 * (1 + abs(b)) < floor[qnode[3]].min():
            continue
        if rnode[2] and (rnode[1] >= qnode[1] or not qnode[2]):
            push(qn, rnode[2])
        elif qnode[2]:
            for child in qnode[2]:
                push(child, [rn])
        else:
            meet(qnode[3], rnode[3])
    shrink()
    row, score, found = kept[0]
    best = np.full((len(queries), k), none, np.int64)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    best[row, nth], best_id[row, nth] = score, found
    return best, best_id


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose rows have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """Row numbers of a greedy cover of at most ``n`` rows."""
    out, dist = [0], np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(out) < n and dist.max() > 0:
        out.append(int(dist.argmax()))
        dist = np.minimum(dist, np.sqrt(((x - x[out[-1]]) ** 2).sum(axis=1)))
    return np.array(out)


def first_floor(queries: np.ndarray, query_ids: np.ndarray, sample: np.ndarray, sample_ids: list[np.ndarray], k: int) -> np.ndarray:
    """k-th best score of each query within the sample, its own id aside."""
    owner = np.repeat(np.arange(len(sample)), [len(i) for i in sample_ids])
    flat = np.concatenate(sample_ids)
    if len(flat) <= k:
        return np.full(len(queries), -np.inf)
    score = (queries.astype(np.float64) @ sample.astype(np.float64).T)[:, owner]
    score = np.where(flat[None, :] == query_ids[:, None], -np.inf, score)
    # what rounding may add to a product of large components
    slack = 1e-9 * np.linalg.norm(queries.astype(np.float64), axis=1) * np.linalg.norm(sample.astype(np.float64), axis=1).max()
    exact = max(np.abs(queries).max(initial=0), np.abs(sample).max()) ** 2.0 * sample.shape[1] < 2.0 ** 53
    return np.partition(score, len(flat) - k, axis=1)[:, len(flat) - k] - (0 if exact else slack)


def quantised(df: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, q): valid vectors with integer components, one row an id,
    padded to one length."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    valid = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True))
    # the floor of a larger number would be cut to a long without notice
    q = F.transform(x, lambda v: F.when(F.abs(v) < 2.0 ** 52 / scale, F.floor(F.lit(scale) * v).cast("bigint"))
                    .otherwise(F.raise_error(F.lit("a component is too large for an integer form")).cast("bigint")))
    rows = df.filter(valid).groupBy("vec_id").agg(F.min(q).alias("q"))
    path = scratch_path(df.sparkSession, "topk-vectors")
    rows.write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    dim, top = rows.agg(F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs)))).first()
    dim, top = max(1, dim or 0), top or 0
    if dim * top * top >= 1 << 63:
        raise ValueError(f"inner products of {dim} components up to {top} do not fit 64 bits")
    return rows.select("vec_id", F.concat("q", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("q"))).alias("q"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` the k best
    rows of ``vectors`` but its own. Both are (vec_id, q) as ``quantised``
    gives."""
    spark = vectors.sparkSession
    w = Window.partitionBy("q").orderBy("vec_id")
    points = vectors.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k + 1)
    points = points.groupBy("q").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    path = scratch_path(spark, "topk-points")
    points.write.parquet(path)
    points = spark.read.parquet(path)
    n = points.count()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not n:
        return spark.createDataFrame([], schema)
    drawn = points.orderBy(F.xxhash64("q"), "q").limit(SAMPLE_POINTS).collect()
    sample = np.array([r["q"] for r in drawn], np.int64)
    sample_ids = [np.array(r["ids"], np.int64) for r in drawn]
    pivots = sample[farthest_first(sample.astype(np.float64), min(MAX_CELLS, max(1, n // CELL_POINTS)))].astype(np.float64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = (pivots ** 2).sum(axis=1)
        for b in batches:
            x = _matrix(b.column("q")).astype(np.float64)
            if not len(x):
                continue
            cell = (norms[None, :] - 2 * x @ pivots.T).argmin(axis=1)
            radius = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("ids"), pa.array(cell.astype(np.int32)), pa.array(radius)],
                                             names=["q", "ids", "cell", "radius"])

    placed = points.mapInArrow(place, "q array<bigint>, ids array<bigint>, cell int, radius double")
    path = scratch_path(spark, "topk-cells")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    radii, chunks = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    for r in placed.groupBy("cell").agg(F.max("radius").alias("r"), F.count("*").alias("n")).collect():
        radii[r["cell"]], chunks[r["cell"]] = r["r"], ceil(r["n"] / CHUNK_POINTS)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("q"))
            if not len(x):
                continue
            floor = first_floor(x, b.column("vec_id").to_numpy(), sample, sample_ids, k)
            reach = x.astype(np.float64) @ pivots.T + np.linalg.norm(x.astype(np.float64), axis=1)[:, None] * radii[None, :]
            go = (reach + 1e-6 * (1 + np.abs(reach)) >= floor[:, None]) & (radii >= 0)[None, :]
            cells = pa.array([np.flatnonzero(g).astype(np.int32) for g in go], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("q"), pa.array(floor), cells],
                                             names=["query_id", "q", "floor", "cells"])

    routed = queries.select("vec_id", "q").mapInArrow(visit, "query_id bigint, q array<bigint>, floor double, cells array<int>")
    blocks = max(1, ceil(queries.count() / QUERY_BLOCK))
    n_chunks = F.element_at(F.array(*[F.lit(int(c)) for c in chunks]), F.col("cell") + 1)
    routed = routed.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("cell", F.explode("cells"))
    routed = routed.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks.cast("bigint") - 1))).drop("cells")
    dealt = placed.withColumn("chunk", F.pmod(F.xxhash64("q"), n_chunks.cast("bigint")))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))).drop("radius")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        lists = left.column("ids").combine_chunks()
        ids = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
        query_ids = right.column("query_id").to_numpy()
        score, found = dual_tree(_matrix(left.column("q")), ids, _matrix(right.column("q")), query_ids,
                                 right.column("floor").to_numpy(), k)
        used = score != np.iinfo(np.int64).min
        return pa.table([pa.array(np.repeat(query_ids, k)[used.reshape(-1)]), pa.array(found[used]), pa.array(score[used])], names=names)

    key = ["cell", "chunk", "block"]
    found = dealt.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products of every vector whose id is divisible by
    100 with all other vectors."""
    vectors = quantised(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


OP4_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""
