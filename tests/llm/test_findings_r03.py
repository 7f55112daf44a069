"""Tests for the findings of FINDINGS_r03.md that changed the code."""

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from tessera.llm import passages


def test_cells_of_repeated_words_take_few_steps(monkeypatch):
    calls, plain = [], passages.RangeMinimum.__call__

    def counted(self, lo, hi):
        calls.append(len(lo))
        return plain(self, lo, hi)

    monkeypatch.setattr(passages.RangeMinimum, "__call__", counted)
    hashes = np.concatenate([np.full(20_000, 7), np.tile(np.arange(1, 61), 100)]).astype(np.uint64)
    c, d, key = passages.cells(hashes, np.array([0, 20_000, 26_000]), 0, 46)
    assert len(calls) <= 100 and len(key) and (np.abs(c - d) < 46).all()


def test_pairs_are_verified_without_sorting_each_step(monkeypatch):
    rng, calls, plain = np.random.default_rng(1), [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **k: calls.append(1) or plain(*a, **k))
    blocks = [rng.integers(1, 1 << 60, 60) for _ in range(20)]
    x = np.concatenate([np.concatenate([b, rng.integers(1, 1 << 60, 80)]) for b in blocks]).astype(np.uint64)
    y = np.concatenate([np.concatenate([rng.integers(1, 1 << 60, 90), b]) for b in blocks[::-1]]).astype(np.uint64)
    found = passages.shared_passages(x, y, shared=np.flatnonzero(np.isin(x, y)))
    assert sorted(found) == [(140 * i, 140 * i + 59, 150 * (19 - i) + 90, 150 * (19 - i) + 149) for i in range(20)]
    assert len(calls) <= 5


def test_cells_are_shuffled_as_ranges_and_meet():
    rng = np.random.default_rng(2)
    common = rng.integers(1, 1 << 60, 80)
    docs = [np.concatenate([rng.integers(1, 1 << 60, 100), common, rng.integers(1, 1 << 60, 100)]) for _ in range(3)]
    # the first batch holds a copy of a document within it, the second one again
    sent = []
    for ids in ([5, 9, 5], [9, 7]):
        lists = pa.array([docs[{5: 0, 9: 1, 7: 2}[i]] for i in ids], pa.list_(pa.int64()))
        batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["doc", "hashes"])
        out = list(passages._windows(iter([batch]), 46, 2, 8))
        sent += out
        assert sum(b.num_rows for b in out) <= 16  # a row for each group and range, not for each cell
    table = pa.Table.from_batches(sent)
    met = [passages._met(table.filter(pa.compute.equal(table["range"], r))) for r in range(8)]
    rows = pa.concat_tables(met).to_pylist()
    groups = {}
    for r in rows:
        groups.setdefault((r["key"], r["part"]), []).append(r)
    assert len({(r["key"], r["part"], r["doc"], r["pos"]) for r in rows}) == len(rows) > 0
    for members in groups.values():
        hub = min(r["doc"] for r in members)
        places = [r["pos"] for r in members if r["doc"] == hub]
        assert len({r["doc"] for r in members}) > 1
        assert all(r["hub"] == hub and r["hub_first"] == min(places) >> 32 for r in members)
        assert all(r["hub_last"] == max(p & 0xFFFFFFFF for p in places) for r in members)
    assert {r["doc"] for r in rows} == {5, 7, 9}
    empty = passages._met(table.slice(0, 0))
    assert empty.num_rows == 0 and empty.schema.types == [pa.int64()] * 7
