
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import near_dup, passages


def words(rng, n):
    return [f"w{i}" for i in rng.integers(0, 10**9, n)]


def passage_rows(spark, texts, **settings):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id bigint, text string")
    return passages.repeated_passages(docs, **settings).collect()


def test_passages_that_overlap_in_a_third_document_are_all_found(spark):
    rng, texts = np.random.default_rng(1), {}
    for i in range(60):  # in some of them all minima fall into b, and the hub lacks c
        a, b, c = words(rng, 10), words(rng, 40), words(rng, 10)
        for k, body in enumerate((a + b + c, a + b, b + c)):
            texts[3 * i + k] = words(rng, 60) + body + words(rng, 60)
    rows = passage_rows(spark, texts, bands=2)
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all(r["class_doc_id"] == r["doc_id"] // 3 * 3 for r in rows)


def test_passages_with_inserted_words_are_one_stretch():
    rng = np.random.default_rng(3)
    for n in (64, 76, 90):
        plain = rng.integers(1, 1 << 60, n).astype(np.uint64)
        gap = rng.integers(1, 1 << 60, 12).astype(np.uint64)  # 8 words, as shingles
        more = np.concatenate([plain[:n // 2], gap, plain[n // 2:]])
        around = [rng.integers(1, 1 << 60, 60).astype(np.uint64) for _ in range(4)]
        x, y = np.concatenate([around[0], plain, around[1]]), np.concatenate([around[2], more, around[3]])
        assert passages.shared_passages(x, y) == [(60, 59 + n, 60, 71 + n)]
        assert passages.shared_passages(y, x) == [(60, 71 + n, 60, 59 + n)]
        lists = [(v, np.array([0, len(v)])) for v in (y, x)]
        assert [i for i, _ in passages._hopeful(*lists, passages.MIN_SHINGLES)] == [0]


def test_unlike_text_on_one_side_splits_a_stretch():
    rng = np.random.default_rng(4)
    a, b, other = (rng.integers(1, 1 << 60, n).astype(np.uint64) for n in (60, 60, 300))
    x, y = np.concatenate([a, b]), np.concatenate([a, other, b])
    assert sorted(passages.shared_passages(x, y)) == [(0, 59, 0, 59), (60, 119, 360, 419)]
    assert sorted(passages.shared_passages(y, x)) == [(0, 59, 0, 59), (360, 419, 60, 119)]
    assert sorted(passages.shared_passages(a, y[np.r_[0:360, 0:60]])) == [(0, 59, 0, 59), (0, 59, 360, 419)]


def test_an_80_word_passage_with_8_words_inserted_is_found(spark):
    rng, texts = np.random.default_rng(5), {}
    for i in range(20):
        body, more = words(rng, 80), words(rng, 8)
        pair = [body, body[:40] + more + body[40:]]
        for k in range(2):
            texts[2 * i + k] = words(rng, 60) + pair[(i + k) % 2] + words(rng, 60)
    rows = passage_rows(spark, texts)
    assert len({r["doc_id"] for r in rows}) >= 36  # as far as the bands propose them


def test_a_passage_is_found_after_an_earlier_partial_copy(spark):
    rng, texts = np.random.default_rng(2), {}
    for i in range(20):
        body = words(rng, 50)
        texts[2 * i] = words(rng, 30) + body[:45] + words(rng, 200) + body + words(rng, 30)
        texts[2 * i + 1] = words(rng, 60) + body + words(rng, 20) + body[:45] + words(rng, 300) + body
    got = {}
    for r in passage_rows(spark, texts, bands=2):
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    for i, t in texts.items():
        places = [275] if i % 2 == 0 else [60, len(t) - 50]
        assert all(set(range(p, p + 50)) <= got.get(i, set()) for p in places)


def test_recall_of_edited_passages(spark):
    rng, texts = np.random.default_rng(6), {}
    hot = words(rng, 20)
    for i in range(400):  # 50 words with one changed: Jaccard 41 / 51
        body = words(rng, 30) + (hot if i % 2 else words(rng, 20))
        copy = list(body)
        copy[25 if i % 4 < 2 else 12] = f"edit{i}"
        texts[3 * i + 1], texts[3 * i + 2] = words(rng, 60) + body + words(rng, 60), words(rng, 60) + copy + words(rng, 60)
        texts[3 * i] = words(rng, 60) + hot + words(rng, 60)  # unlike documents with the frequent line
    found = {r["doc_id"] for r in passage_rows(spark, texts)}
    for kind in range(4):
        pairs = [i for i in range(400) if i % 4 == kind]
        recall = np.mean([3 * i + 1 in found and 3 * i + 2 in found for i in pairs])
        print("recall", kind, recall)
        assert recall >= 0.98
    assert not {3 * i for i in range(400)} & found


def test_near_copies_with_repeated_lines_share_bands():
    rng, lost = np.random.default_rng(7), 0
    for _ in range(60):
        base = rng.integers(1, 1 << 60, 104)
        copy = np.concatenate([base[:50], np.tile(base[50:65], 300), base[65:]])
        hashes = pa.array([base, copy], pa.list_(pa.int64()))
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a", "b"]), hashes], names=["doc_id", "digest", "hashes"])
        (out,) = near_dup._signatures(iter([batch]), near_dup.BANDS, near_dup.ROWS, near_dup.SHINGLE_WORDS)
        one, two = (set(x) for x in out.column("bands").to_pylist())
        lost += not one & two
    assert lost == 0


def test_a_member_that_resembles_only_a_member_of_another_component_is_linked(spark):
    names = [f"d{i}" for i in range(10)]
    m, h, x, y, *rest = names
    items = {h: range(100), m: range(10, 110), x: range(20, 120), y: range(30, 130)}
    items |= {f: range(1000 * i, 1000 * i + 100) for i, f in enumerate(rest, 1)}
    for hubs in (names, names[::-1]):
        entries = [(1, 0, d) for d in hubs] + [(5, 35, d) for d in (m, x)]
        members = spark.createDataFrame(entries, "key bigint, band int, digest string")
        sets = spark.createDataFrame([(d, list(items[d])) for d in items], "digest string, items array<bigint>")
        roots = {r["node"]: r["root"] for r in near_dup._classes_of(members, sets, 0.8).collect()}
        assert roots[h] == roots[m] == roots[x] == roots[y] and not set(rest) & set(roots)

