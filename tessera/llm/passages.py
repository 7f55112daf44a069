"""Near-duplicate passages: compact windows and verification.

Tokens are five-word shingles. For each of BANDS pairs of hash functions:

1. The Cartesian tree of the first function's values cuts a document into
   compact windows (l, c, r): all subsequences [i, j] with l <= i <= c <= j <= r
   have the minimum at c. Windows shorter than the shortest passage are left
   out. The second function refines each window by the minima of its
   subsequences around c, so a cell stands for all subsequences that share
   both minima. Cells whose minima are farther apart than the shortest passage
   add nothing and are dropped; a key's places in a document are all kept.
   Range minima come from sparse tables, a batch
   of documents at a time.
2. Cells of different documents with equal minima are joined: those of a group
   with one hub, as intervals (from the first to the last cell that two
   documents share). Groups are kept small: what meets in one batch of documents
   gets a group of its own, tied to the others by its hub.
3. Each interval pair is verified on the shingles themselves: the passage is a
   stretch of shared shingles, at least MIN_WORDS long, whose shingle sets
   have Jaccard similarity >= 0.8; gaps are bridged, on both sides, as long
   as that can be reached. Where a cell's place is not
   verified with its hub (they share a shorter passage), all cells of its key
   are grouped anew by the content of the shortest windows that hold them, so
   that no exact repeat is lost to an unlike hub, and by min-hashes of their
   neighbourhoods, so that near copies find like hubs; these groups are
   verified, too.
4. Verified stretches that overlap in a document are one passage; links make
   classes of passages (connected components).

Exact copies collapse first; a copied document of at least MIN_WORDS words is
a passage as a whole. An identical passage shares every cell inside it, so
exact repeats of MIN_WORDS words are found for certain, near ones with the
probability that two minima agree, for each band and each stretch.

Defined results: NULL and blank texts, and texts under MIN_WORDS words, have
no passages; a passage that repeats inside one document only is no result;
repeated rows count as copies; rows without id are listed with NULL id; an
empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.components import connected_components, maybe_in, thin
from tessera.llm.shingles import GOLDEN, list_array, list_parts, mix64, row_chunks, shingles
from tessera.llm.text import clean_text, lower_words
from tessera.session import drop_finished, scratch_path
from tessera.sources.tables import read_table

SHINGLE_WORDS = 5
MIN_WORDS = 50
MIN_SHINGLES = MIN_WORDS - SHINGLE_WORDS + 1
BANDS = 5
NEAR_HASHES = 4  # by which the neighbourhoods of failed cells are compared
THRESHOLD = 0.8
MARGIN = 2 * MIN_SHINGLES  # shingles around an interval that verification sees
CHUNK_WORDS, CHUNK_ROWS = 400_000, 4_000
VERIFY_ROWS = 100  # pairs of documents that are first compared at once
RANGE_WORDS = 4_000_000  # words (half as many cells) for each range of keys


def possible_minima(values: np.ndarray, least: int) -> np.ndarray:
    """Positions that hold the minimum of any ``least`` neighbours, ascending:
    only these are minima of longer ranges."""
    n = len(values)
    if least > n:
        return np.zeros(0, np.int64)

    def slide(of, x, width):  # of every ``width`` neighbours
        size = 1
        while 2 * size <= width:
            x = of(x[size:], x[:-size])
            size *= 2
        return of(x[:len(x) - width + size], x[width - size:]) if size < width else x

    minima = slide(np.minimum, values, least)
    edge = np.zeros(least - 1, values.dtype)
    return np.flatnonzero(slide(np.maximum, np.concatenate([edge, minima, edge]), least) == values)


class RangeMinimum:
    """Position of the leftmost minimum of any range of at least ``least``
    positions (a sparse table over those that are possible minima)."""

    def __init__(self, values: np.ndarray, longest: int, least: int = 1):
        self.at = possible_minima(values, least)
        self.rank = np.zeros(len(values) + 1, np.int64)
        self.rank[self.at + 1] = 1
        np.cumsum(self.rank, out=self.rank)
        self.values = values[self.at]
        at, low = np.arange(len(self.at), dtype=np.int32), self.values
        rows, half = [at], 1
        while 2 * half <= min(longest, len(at)):
            right = low[half:] < low[:-half]
            at = np.append(np.where(right, at[half:], at[:-half]), at[-half:])
            low = self.values[at]
            rows.append(at)
            half *= 2
        self.table = np.stack(rows)

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        lo, hi = self.rank[lo], self.rank[hi + 1]
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        a = self.table[level, lo]
        b = self.table[level, hi - (1 << level)]
        return self.at[np.where(self.values[b] < self.values[a], b, a)]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """For each possible minimum the place of the nearest one before that is
        no larger and of the nearest one after that is smaller (-1 and the number
        of all values where there is none as near as the longest range)."""
        n = len(self.at)
        before, after = np.arange(n), np.arange(1, n + 1)
        for level in range(len(self.table) - 1, -1, -1):
            low, step = self.values[self.table[level]], 1 << level
            to = before - step
            before = np.where((to >= 0) & (low[to] > self.values), to, before)
            go = (after + step <= n) & (low[np.minimum(after, n - 1)] >= self.values)
            after = np.where(go, after + step, after)
        return np.append(self.at, -1)[before - 1], np.append(self.at, len(self.rank) - 1)[after]


def compact_windows(first: RangeMinimum, lo: np.ndarray, hi: np.ndarray, least: int):
    """(l, c, r) of all nodes of the Cartesian trees over the given ranges
    (ascending, apart) whose windows are at least ``least`` long: c is the
    leftmost minimum of what reaches to the nearest smaller ones."""
    c = first.at
    if not len(c) or not len(lo):
        none = np.zeros(0, np.int64)
        return none, none, none
    of = np.maximum(np.searchsorted(lo, c, side="right") - 1, 0)
    before, after = first.windows()
    left, right = np.maximum(before + 1, lo[of]), np.minimum(after - 1, hi[of])
    keep = (right - left + 1 >= least) & (c >= left) & (c <= right)
    return left[keep], c[keep], right[keep]


def cells(hashes: np.ndarray, offsets: np.ndarray, band: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c1, c2, key) of one band: subsequences of length ``least`` or more
    whose minima under the band's two functions are at c1 and c2, less than
    ``least`` apart."""
    longest = int(np.diff(offsets).max(initial=0))
    with np.errstate(over="ignore"):
        values = [mix64(hashes + np.uint64(2 * band + f + 1) * GOLDEN) for f in range(2)]
        one, two = (RangeMinimum(v, n, least) for v, n in zip(values, (longest, min(longest, 2 * least))))
        full = np.diff(offsets) >= least
        lo, c, hi = compact_windows(one, offsets[:-1][full], offsets[1:][full] - 1, least)
        # What lies farther from c adds no cell and hides none: it only goes first.
        lo, hi = np.maximum(lo, c - least + 1), np.minimum(hi, c + least - 1)
        found = []
        while len(lo):
            d = two(lo, hi)
            found.append((c, d))
            # left: subsequences that hold c but not d
            lo, hi = np.where(d < c, d + 1, lo), np.where(d > c, d - 1, hi)
            keep = (d != c) & (hi - lo + 1 >= least)
            lo, c, hi = lo[keep], c[keep], hi[keep]
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64)
        c, d = (np.concatenate(x) for x in zip(*found))
        return c, d, mix64(mix64(hashes[c] + np.uint64(band + 1)) * GOLDEN + hashes[d])


def _windows(batches: Iterator[pa.RecordBatch], least: int, bands: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows (range, part, key[], doc[], lo[], width[]): cells with their key,
    group (0, or one of the chunk's own), document and span of shingles; a row
    for each chunk, group and range of keys. Cells of a document stand together,
    which makes the shuffled rows smaller."""
    for batch in batches:
        values, offsets = list_parts(batch.column("hashes"))
        docs = batch.column("doc").to_numpy()
        for a, b in row_chunks(offsets, CHUNK_WORDS, CHUNK_ROWS):
            doc = docs[a:b]
            once = np.zeros(b - a, bool)
            once[np.unique(doc, return_index=True)[1]] = True  # copies in the chunk
            h, ends = shingles(values[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], SHINGLE_WORDS)
            row_of = np.repeat(np.arange(b - a), np.diff(ends))
            parts = []
            for band in range(bands):
                c, d, key = cells(h, ends, band, least)
                row = row_of[c]
                parts.append((key, row, ((np.minimum(c, d) - ends[row]) << 32) | (np.maximum(c, d) - ends[row])))
            key, row, pos = (np.concatenate(x) for x in zip(*parts))
            keep = once[row]
            key, row, pos = key[keep], row[keep], pos[keep]
            key, row, pos = _sorted_cells(key, row, pos)
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            group, start = np.cumsum(first) - 1, np.flatnonzero(first)
            head = row == row[start[group]]  # the places of a group's first document
            many = (np.bincount(group, ~head)[group] > 0) if len(group) else head
            with np.errstate(over="ignore"):
                # cells that meet in this chunk: a group of their own, whose head also joins the others
                local = np.int64(mix64(np.uint64(doc[0].astype(np.int64).view(np.uint64)) + GOLDEN) >> np.uint64(1)) | 1
            for part, of in ((0, head), (local, many)):
                in_range = ((key[of] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(in_range * (b - a) + row[of])
                of, in_range = np.flatnonzero(of)[order], in_range[order]
                some, at = np.unique(in_range, return_index=True)
                at = np.append(at, len(of))
                lo, hi = pos[of] >> 32, pos[of] & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), part, np.int64)),
                     *(list_array(x, at) for x in (key[of].view(np.int64), doc[row[of]], lo.astype(np.int32), (hi - lo).astype(np.int16)))],
                    names=["range", "part", "key", "doc", "lo", "width"])


def _sorted_cells(key: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """The cells by key and the other columns, each once. Few keys repeat: only
    these are compared by more than the key."""
    order = np.argsort(key)
    key, *others = (x[order] for x in (key, *others))
    tie = np.zeros(len(key) + 1, bool)
    tie[1:-1] = key[1:] == key[:-1]
    at = np.flatnonzero(tie[1:] | tie[:-1])
    order = at[np.lexsort((*(x[at] for x in reversed(others)), key[at]))]
    for x in others:
        x[at] = x[order]
    new = np.ones(len(key), bool)
    new[1:] = ~np.logical_and.reduce([x[1:] == x[:-1] for x in (key, *others)])
    return tuple(x[new] for x in (key, *others))


def _met(table: pa.Table) -> pa.Table:
    """Cells (key, part, doc, pos) of a range of keys that other documents of
    their group have, too, with the group's hub as in ``_with_hub``."""
    lists = {c: table.column(c).combine_chunks() for c in ("key", "doc", "lo", "width")}
    key, doc, lo, width = (x.flatten().to_numpy(zero_copy_only=False) for x in lists.values())
    part = np.repeat(table.column("part").to_numpy(), lists["key"].value_lengths().to_numpy(zero_copy_only=False))
    order = np.argsort(key)
    again = np.zeros(len(key) + 1, bool)
    again[1:-1] = key[order[1:]] == key[order[:-1]]
    order = order[again[1:] | again[:-1]]
    lo = lo[order].astype(np.int64)
    key, part, doc, pos = _sorted_cells(key[order], part[order], doc[order], (lo << 32) | (lo + width[order]))
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    group, start = np.cumsum(first) - 1, np.flatnonzero(first)
    hub = doc[start[group]]  # the rows are in order
    hub_last = np.maximum.reduceat(np.where(doc == hub, pos & 0xFFFFFFFF, 0), start)[group] if len(group) else pos
    keep = (np.bincount(group, doc != hub)[group] > 0) if len(group) else first
    return pa.table([pa.array(x[keep]) for x in (key, part, doc, pos, hub, pos[start[group]] >> 32, hub_last)],
                    names=["key", "part", "doc", "pos", "hub", "hub_first", "hub_last"])


def _shingle_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, offsets = list_parts(batch.column("hashes"))
        for a, b in row_chunks(offsets, CHUNK_WORDS, CHUNK_ROWS):
            h, ends = shingles(values[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], SHINGLE_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column("doc").slice(a, b - a), list_array(h.view(np.int64), ends)], names=["doc", "s"])


def _weights(threshold: float) -> tuple[int, int]:
    """What a shared position adds and another takes: a stretch whose sum is
    negative can't reach the threshold."""
    return round(1000 * (1 - threshold)), round(1000 * threshold)


def _runs(hit: np.ndarray, start: int = 0) -> tuple[list[int], list[int]]:
    """First and last places of the runs of true values, counted from ``start``."""
    wide = np.zeros(len(hit) + 2, bool)
    wide[1:-1] = hit
    edge = np.flatnonzero(wide[1:] != wide[:-1]) + start
    return edge[::2].tolist(), (edge[1::2] - 1).tolist()


def _stretches(first: list[int], last: list[int], least: int, threshold: float) -> list[tuple[int, int]]:
    """Longest intervals of at least ``least`` positions, of which those in the
    runs first..last are at least ``threshold``. Ends that hold more other
    positions than those are cut off and looked at on their own. (Runs are
    few: plain lists are faster than arrays.)"""
    up, down = _weights(threshold)
    out, todo = set(), [(first, last)]
    while todo:
        a, b = todo.pop()
        if not a or b[-1] - a[0] + 1 < least:
            continue
        if len(a) == 1:
            out.add((a[0], b[0]))
            continue
        start, end, low, even, total, level, before = [], [], [], [], 0, 0, a[0] - 1
        for p, q in zip(a, b):
            gap, n, before = p - before - 1, q - p + 1, q
            start.append(total - down * gap)
            low.append(level - gap)
            total += up * n - down * gap
            level += n - gap
            end.append(total)
            even.append(level)
        best = end[:]
        for i in range(len(a) - 2, -1, -1):
            best[i] = max(best[i], best[i + 1])
        reach = -1
        for i in range(len(a)):
            if reach + 1 == len(a):
                break
            if best[reach + 1] < start[i]:
                continue
            while reach + 1 < len(a) and best[reach + 1] >= start[i]:
                reach += 1  # the last run that each can reach
            if b[reach] - a[i] + 1 < least:
                continue
            part = even[i:reach + 1]
            hi = i + part.index(max(part))
            part = low[i:hi + 1]
            lo = i + part.index(min(part))
            if b[hi] - a[lo] + 1 < least:
                lo, hi = i, reach
            out.add((a[lo], b[hi]))
            if a[lo] - a[i] >= least:
                todo.append((a[i:lo], b[i:lo]))
            if b[reach] - b[hi] >= least:
                todo.append((a[hi + 1:reach + 1], b[hi + 1:reach + 1]))
    return sorted(out)


def _widest(first: list[int], last: list[int]) -> tuple[int, int, int]:
    """The widest step between neighbouring positions of the runs, and its ends."""
    steps = [p - q for p, q in zip(first[1:], last)]
    if not steps:
        return 1, first[0], first[0] + 1
    i = steps.index(max(steps))
    return steps[i], last[i], first[i + 1]


def _solved(x: np.ndarray, y: np.ndarray, s: int, e: int, least: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """Verified (first, last) of x within s..e and of y: both sides are
    narrowed to what they share, and split where that is too unlike. x and y
    hold small numbers, equal for equal shingles."""
    out, todo, seen = [], [(s, e, 0, len(y) - 1)], set()
    met, turn = np.zeros(1 + max(int(x.max()), int(y.max())), np.int64), 0  # when a shingle was last marked
    while todo:
        here = s, e, u, v = todo.pop()
        if here in seen or min(e - s, v - u) + 1 < least:
            continue
        seen.add(here)
        part, other = x[s:e + 1], y[u:v + 1]
        if len(part) == len(other) and (part == other).all():
            out.append(here)
            continue
        turn += 1
        met[other] = turn
        at = _runs(met[part] == turn, s)
        mine = _stretches(*at, least, threshold)
        if mine != [(s, e)]:
            todo += [(*m, u, v) for m in mine]
            continue
        turn += 1
        met[part] = turn
        there = _runs(met[other] == turn, u)
        others = _stretches(*there, least, threshold)
        if others != [(u, v)]:
            todo += [(s, e, *o) for o in others]
            continue
        one, two = np.zeros(len(met), bool), np.zeros(len(met), bool)
        one[part] = two[other] = True
        if np.count_nonzero(one & two) >= threshold * np.count_nonzero(one | two):
            out.append(here)
            continue
        gap, hole = _widest(*at), _widest(*there)  # cut at the widest gap of either and try both parts
        if gap[0] >= hole[0]:
            todo += [(s, gap[1], u, v), (gap[2], e, u, v)]
        else:
            todo += [(s, e, u, hole[1]), (s, e, hole[2], v)]
    return out


def shared_passages(x: np.ndarray, y: np.ndarray, least: int = MIN_SHINGLES, threshold: float = THRESHOLD,
                    shared: np.ndarray | None = None):
    """Verified near-duplicate stretches of two shingle sequences, as
    (first, last) of x and of y, ends inclusive. ``shared``: the positions of
    x that y has, where they are known."""
    out, known = [], {}
    shared = np.flatnonzero(np.isin(x, y)) if shared is None else shared
    hit = np.zeros(len(x), bool)
    hit[shared] = True
    stretches = _stretches(*_runs(hit), least, threshold)
    if not stretches:
        return out
    number = np.unique(np.concatenate([x, y]), return_inverse=True)[1]
    x, y = number[:len(x)], number[len(x):]
    for s, e in stretches:
        content = x[s:e + 1].tobytes()
        if content in known:  # a repeat in x: one partner for each stretch ties it to the rest
            first, found = known[content]
            out += [(a + s - first, b + s - first, u, v) for (a, b), (u, v) in found.items()]
            continue
        found = _solved(x, y, s, e, least, threshold)
        known[content] = s, {(a, b): (u, v) for a, b, u, v in reversed(found)}
        out += found
    return out


def _hopeful(xs: tuple, ys: tuple, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows where a stretch of x of at least ``least`` is in y to THRESHOLD, and the
    positions of x that y has, found for all rows at once."""
    row_x, row_y = (np.repeat(np.arange(len(o) - 1), np.diff(o)).astype(np.uint64) for _, o in (xs, ys))
    at = np.flatnonzero(np.isin(mix64(xs[0] ^ mix64(row_x + GOLDEN)), mix64(ys[0] ^ mix64(row_y + GOLDEN))))
    if not len(at):
        return
    # least .. sums over stretches that end at each position; a row lies far below the one before
    up, down = _weights(THRESHOLD)
    weight = np.full(len(xs[0]), -down)
    weight[at] = up
    row = row_x.astype(np.int64)
    total = np.concatenate([[0], np.cumsum(weight)])
    far = 2 * (up + down) * (len(weight) + 1)
    before = np.minimum.accumulate(total[:-1] - far * row)
    good = (total[least:] - far * row[least - 1:] >= before[:len(before) - least + 1]) if len(weight) >= least else np.zeros(0, bool)
    hopeful = np.unique(row[least - 1:][good])
    row = row[at]
    for i in hopeful:
        yield int(i), at[np.searchsorted(row, i):np.searchsorted(row, i, side="right")] - xs[1][int(i)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(i, VERIFY_ROWS) for b in batches for i in range(0, b.num_rows, VERIFY_ROWS)):
        xs, ys = list_parts(batch.column("x")), list_parts(batch.column("y"))
        cols = [batch.column(c).to_numpy() for c in ("doc", "hub", "x0", "y0")]
        rows = []
        for i, shared in _hopeful(xs, ys, MIN_SHINGLES):
            x, y = (v[o[i]:o[i + 1]] for v, o in (xs, ys))
            doc, hub, x0, y0 = (int(c[i]) for c in cols)
            rows += [(doc, x0 + s, x0 + e, hub, y0 + u, y0 + v) for s, e, u, v in shared_passages(x, y, shared=shared)]
        names = ["doc", "s", "e", "hub", "hs", "he"]
        data = np.array(rows, np.int64).reshape(-1, 6)
        yield pa.RecordBatch.from_arrays([pa.array(data[:, i].copy()) for i in range(6)], names=names)


def _kept(df: DataFrame, name: str, small: bool = True, codec: str = "snappy") -> DataFrame:
    path = scratch_path(df.sparkSession, f"passages-{name}")
    (thin(df) if small else df).write.parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


def _first(pos: str):
    return F.shiftrightunsigned(pos, 32)


def _last(pos: str):
    return F.col(pos).bitwiseAND(F.lit(0xFFFFFFFF))


def _accepted(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """Verified stretches (doc, s, e, hub, hs, he) of cell pairs (doc, pos,
    hub, hub_first, hub_last): one verification for each pair of documents, over the
    interval that their cells span."""
    hull = pairs.groupBy("doc", "hub").agg(
        F.min(_first("pos")).alias("p"), F.max(_last("pos")).alias("q"),
        F.min("hub_first").alias("hp"), F.max("hub_last").alias("hq"))
    hull = _kept(hull, "hulls")
    drop_finished(lists.sparkSession)

    def crop(lo: str, hi: str, first: str, out: str):
        start = F.greatest(F.col(lo) - MARGIN, F.lit(0))
        return [start.alias(first), F.slice("s", (start + 1).cast("int"), (F.col(hi) + MARGIN - start + 1).cast("int")).alias(out)]

    def lists_of(side: str) -> DataFrame:
        return maybe_in(lists.withColumnRenamed("doc", side), side, hull.select(side).distinct())

    both = hull.join(lists_of("hub"), "hub").select("doc", "hub", "p", "q", *crop("hp", "hq", "y0", "y"))
    both = both.join(lists_of("doc"), "doc").select("doc", "hub", "y0", "y", *crop("p", "q", "x0", "x"))
    found = both.mapInArrow(_verify, "doc bigint, s bigint, e bigint, hub bigint, hs bigint, he bigint")
    found = _kept(found.distinct(), "accepted", small=False)
    drop_finished(lists.sparkSession)
    return found


def _near_places(s: np.ndarray, lo: np.ndarray, hi: np.ndarray, start: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, place) of the minima of ``least`` shingles before, around and
    after each cell, within its document (start..end), under NEAR_HASHES functions."""
    keys, places = [], []
    first = np.concatenate([np.maximum(hi - least + 1, start), np.maximum(lo - least // 2, start), lo])
    last = np.concatenate([hi, np.minimum(hi + least // 2, end), np.minimum(lo + least - 1, end)])
    for f in range(NEAR_HASHES):
        m = np.unique(RangeMinimum(mix64(s ^ mix64(GOLDEN + np.uint64(f))), min(len(s), 2 * least))(first, last))
        keys.append(mix64(mix64(s[m] + np.uint64(f + 1)) + GOLDEN))
        places.append(m)
    return np.concatenate(keys), np.concatenate(places)


def _new_groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc, pos) of all windows of ``least`` shingles that hold one
    of a document's cells, the key a hash of the window's content; and of the
    minima near the cells."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(least, np.uint64(0x5851F42D4C957F2D)))
        for batch in batches:
            lists, spots = list_parts(batch.column("s")), list_parts(batch.column("spots"))
            docs = batch.column("doc").to_numpy()
            for a, b in row_chunks(lists[1], CHUNK_WORDS, CHUNK_ROWS):
                s, offsets = lists[0][lists[1][a]:lists[1][b]], lists[1][a:b + 1] - lists[1][a]
                row_of = np.repeat(np.arange(b - a), np.diff(offsets))
                pos = spots[0][spots[1][a]:spots[1][b]]
                row = np.repeat(np.arange(b - a), np.diff(spots[1][a:b + 1]))
                start, end = offsets[row], offsets[row + 1] - 1
                lo, hi = start + (pos >> np.uint64(32)).astype(np.int64), start + (pos & np.uint64(0xFFFFFFFF)).astype(np.int64)
                near, m = _near_places(s, lo, hi, start, end, least)
                first, last = np.maximum(hi - least + 1, start), np.minimum(lo, end - least + 1)
                ok = first <= last
                edge = np.bincount(first[ok], minlength=len(s) + 1) - np.bincount(last[ok] + 1, minlength=len(s) + 1)
                starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)  # starts covered by any cell
                content = np.zeros(len(starts), np.uint64)
                mixed = mix64(s)
                for i in range(least if len(starts) else 0):
                    content += mixed[starts + i] * powers[i]
                key = np.concatenate([near, mix64(content)])
                from_, to = np.concatenate([m, starts]), np.concatenate([m, starts + least - 1])
                doc, back = docs[a:b][row_of[from_]], offsets[row_of[from_]]
                pos = ((from_ - back) << 32) | (to - back)
                for i in range(0, len(key), 100_000):
                    j = i + 100_000
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[i:j].view(np.int64)), pa.array(doc[i:j]), pa.array(pos[i:j])], names=["key", "doc", "pos"])


def _with_hub(windows: DataFrame) -> DataFrame:
    """(key, part, doc, pos, hub, hub_first, hub_last): the least document of
    each group as hub, with the span of its places in the group."""
    least = windows.groupBy("key", "part").agg(
        F.min(F.struct("doc", "pos")).alias("h"), F.max("doc").alias("z"),
        F.max(F.struct(F.bitwise_not("doc").alias("d"), _last("pos").alias("last"))).alias("l"))
    hubs = least.filter(F.col("h.doc") < F.col("z")).select(
        "key", "part", F.col("h.doc").alias("hub"), _first("h.pos").alias("hub_first"), F.col("l.last").alias("hub_last"))
    return windows.join(hubs, ["key", "part"]).filter("doc <> hub")


def _all_accepted(windows: DataFrame, lists: DataFrame) -> list[DataFrame]:
    """Verified stretches of all groups of cells (key, part, doc, pos) with their hubs."""
    pairs = windows.filter("doc <> hub")
    found = _accepted(pairs, lists)
    # A cell is settled once its place lies in a stretch verified with the hub
    # of its own group. Where one is not, it shares something short with the
    # hub, and may share more with any cell of that key, settled or not: all of
    # them are grouped anew, however many they are: by the whole content of the
    # shortest windows around them, and (for near copies) by minima near them,
    # which gives them hubs that are alike beyond the cell.
    inside = (F.col("s") <= _first("pos")) & (F.col("e") >= _last("pos"))
    settled = found.select(F.col("doc").alias("d"), F.col("hub").alias("h"), "s", "e")
    unlike = pairs.join(settled, (F.col("doc") == F.col("d")) & (F.col("hub") == F.col("h")) & inside, "left_anti")
    failed = windows.join(unlike.select("key").distinct(), "key", "left_semi").select("doc", "pos").distinct()
    failed = _kept(failed.groupBy("doc").agg(F.collect_list("pos").alias("spots")), "failed")
    more = maybe_in(lists, "doc", failed.select("doc")).join(failed, "doc").select("doc", "s", "spots")
    exact = more.mapInArrow(lambda it: _new_groups(it, MIN_SHINGLES), "key bigint, doc bigint, pos bigint")
    exact = _kept(exact.withColumn("part", F.lit(0).cast("bigint")), "windows", small=False)
    return [found, _accepted(_kept(_with_hub(exact), "pairs"), lists)]


def repeated_passages(docs: DataFrame, bands: int = BANDS) -> DataFrame:
    """One row for each passage of each document that (nearly) repeats in
    another: doc_id, start_word, end_word (exclusive), class_doc_id,
    class_start_word (the class's least document and place), n_docs."""
    rows = docs.select("doc_id", clean_text("text").alias("text")).withColumn("w", lower_words(F.col("text")))
    # A document's key is the hash of its words: copies are one document. Texts
    # are cut into words once; what follows reads their hashes. (The words are
    # used several times, so no filter on them here: it would be pushed down and
    # cut every text again.)
    rows = _kept(rows.select(
        "doc_id", F.xxhash64(F.concat_ws(" ", "w"), F.size("w")).alias("doc"), F.size("w").alias("n_words"),
        F.transform("w", lambda v: F.xxhash64(v)).alias("hashes")), "words", small=False, codec="zstd").filter(F.col("n_words") >= MIN_WORDS)
    ids = rows.select("doc_id", "doc", "n_words")
    n_words = ids.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_words // RANGE_WORDS)
    windows = rows.select("doc", "hashes").mapInArrow(
        lambda it: _windows(it, MIN_SHINGLES, bands, ranges),
        "range int, part bigint, key array<bigint>, doc array<bigint>, lo array<int>, width array<smallint>")
    met = windows.groupBy("range").applyInArrow(
        _met, "key bigint, part bigint, doc bigint, pos bigint, hub bigint, hub_first bigint, hub_last bigint")
    met = _kept(met, "cells", small=False)
    drop_finished(docs.sparkSession)
    copies = ids.groupBy("doc").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("one"), F.first("n_words").alias("n_words"))
    needed = met.select("doc").distinct().join(copies, "doc").select(F.col("doc").alias("d"), F.col("one.doc_id").alias("one"))
    needed = _kept(needed, "needed")
    texts = maybe_in(rows.drop("n_words"), "doc", needed.select(F.col("d").alias("doc"))).join(needed, (F.col("doc") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("one")))
    lists = texts.select("doc", "hashes").mapInArrow(_shingle_lists, "doc bigint, s array<bigint>")
    if ids.groupBy("doc", "doc_id").count().filter("count > 1").limit(1).count():  # rows that repeat id and text
        lists = lists.groupBy("doc").agg(F.first("s").alias("s"))
    lists = _kept(lists, "lists", small=False)
    drop_finished(docs.sparkSession)
    accepted = _all_accepted(met, lists)
    links = accepted[0]
    for more in accepted[1:]:
        links = links.unionByName(more)
    links = _kept(links.distinct(), "links")
    whole = copies.filter("n > 1").select("doc", F.lit(0).cast("bigint").alias("s"), (F.col("n_words") - SHINGLE_WORDS).cast("bigint").alias("e"))
    spans = links.select("doc", "s", "e").unionByName(links.select(F.col("hub").alias("doc"), F.col("hs").alias("s"), F.col("he").alias("e")))
    # The longest stretch from each place is enough to see what overlaps, and
    # bounds a document's rows by its length, however many documents match it.
    spans = spans.unionByName(whole).groupBy("doc", "s").agg(F.max("e").alias("e"))
    order = Window.partitionBy("doc").orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("fresh", F.when(F.col("s") > F.coalesce(reach, F.lit(-2)), 1).otherwise(0))
    spans = spans.withColumn("island", F.sum("fresh").over(order))
    spans = _kept(spans.withColumn("node", F.concat_ws(":", "doc", "island")), "spans")
    side = spans.select("doc", "s", "node")
    edges = links.select("doc", "s", "hub", "hs").distinct()
    edges = edges.join(side.withColumnRenamed("node", "a"), ["doc", "s"]).join(
        side.select(F.col("doc").alias("hub"), F.col("s").alias("hs"), F.col("node").alias("b")), ["hub", "hs"])
    roots = connected_components(edges.select("a", "b").distinct())
    found = spans.groupBy("node", "doc").agg(F.min("s").alias("start_word"), (F.max("e") + SHINGLE_WORDS).alias("end_word"))
    found = found.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = _kept(found.join(ids.select("doc_id", "doc"), "doc"), "found")
    classes = found.groupBy("root").agg(F.min(F.struct("doc_id", "start_word")).alias("least"), F.count_distinct("doc_id").alias("n_docs"))
    return found.join(classes, "root").select(
        "doc_id", "start_word", "end_word", F.col("least.doc_id").alias("class_doc_id"),
        F.col("least.start_word").alias("class_start_word"), "n_docs")


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents."""
    return repeated_passages(read_table(spark, sf_dir, "documents", "doc_id", "text"))
