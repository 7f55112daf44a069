"""Queries against plain Python on whole small tables."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tessera.llm import pieces
from tessera.llm.registry import QUERIES

from .conftest import SMALL


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def rows_of(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SMALL).collect()}


def luhn(s):
    v = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
    return sum(x - 9 if x > 9 else x for x in v) % 10 == 0


def base_spans(t):
    patterns = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for k, (kind, p) in enumerate(patterns):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_pii(spark, texts):
    got = rows_of(spark, "op3_pii")
    for i, t in texts.items():
        spans = base_spans(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(got[i]["spans"].split(",")) or not spans


def test_pii_hard_cases(spark):
    from pyspark.sql import functions as F

    from tessera.llm.pii import joined, with_spans
    cases = ["a@b.c_x@d.e", "x@y", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.255", "+1-2", "é\U0001F600 a@b.co \U0001F600 +1 202 555 0143 9",
             "4111111111111111 4111-1111-1111-1112 12345678901234567890123", "+" * 300 + "1" * 14, "a" * 3000 + "@", "1 " * 3000,
             "5500 0000 0000 0004-", "q@w.e.r.t.@y.u", "--@--.--", "1.1.1.1@a.b"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, text string")
    for r in with_spans(df).select("text", joined(F.filter("pii_spans", lambda s: s["base"])).alias("s")).collect():
        assert r["s"] == ",".join(base_spans(r["text"])), r["text"]


def test_licences(spark, texts):
    got = rows_of(spark, "op6_licences")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    for i, t in texts.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(lower))
        found = [(j, k) for k, p in phrases.items() for j in range(len(w)) if w[j:j + len(p)] == p]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(found))
        assert r["first_word"] == min((j for j, _ in found), default=None) and r["last_word"] == max((j for j, _ in found), default=None)
        assert r["base_labels"] == ",".join(sorted({k for _, k in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def simhash(text):
    w = text.lower().split()
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]

    def chain(a, b):  # Spark's hash of (a, b) seeds b's with a's
        signed = int.from_bytes(b.to_bytes(8, "little"), "little")
        return xxhash.xxh64_intdigest(signed.to_bytes(8, "little"), a)

    if not w:
        terms = []
    elif len(w) < 3:
        terms = [xxhash.xxh64_intdigest(" ".join(w).encode(), 42)]
    else:
        two = [xx_two(a, b) for a, b in zip(h, h[1:])]
        terms = [xx_two(a, b) for a, b in zip(two, h[2:])]
    bits = 0
    for k in range(64):
        if 2 * sum(t >> k & 1 for t in terms) > len(terms):
            bits |= 1 << k
    return bits


def xx_two(a, b):
    first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)
    return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), first)


def test_simhash(spark, texts):
    got = rows_of(spark, "op10_simhash")
    ids = sorted(texts)
    prints = {i: simhash(texts[i]) for i in ids}
    for i, j in zip(ids, ids[1:] + ids[:1]):
        t, r = texts[i], got[i]
        half = len(t) // 2
        edited = t[:len(t) - half] + texts[j][:half]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == f"{prints[i]:016x}" and r["edited_fingerprint"] == f"{simhash(edited):016x}"
        assert r["near_next"] == 1 - bin(prints[i] ^ prints[j]).count("1") / 64
        assert r["near_edited"] == 1 - bin(prints[i] ^ simhash(edited)).count("1") / 64
        if i % 100 == 0:
            assert r["n_within"] == sum(bin(prints[i] ^ p).count("1") <= 3 for p in prints.values()) - 1


def test_near_duplicates(spark, texts):
    sets, root = {}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, t in texts.items():
        w = t.lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if (both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)) or texts[a].lower().split() == texts[b].lower().split():
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = rows_of(spark, "op9_near_dup")
    assert {i: got[i]["class_id"] for i in ids} == {i: find(i) for i in ids}


def test_passages_hold_every_exact_repeat(spark, texts):
    seen, want = defaultdict(set), set()
    for i, t in texts.items():
        w = t.lower().split()
        for j in range(len(w) - 49):
            seen[tuple(w[j:j + 50])].add(i)
    for owners in seen.values():
        if len(owners) > 1:
            want |= owners
    got = {r["doc_id"] for r in QUERIES["op1_passages"](spark, SMALL).collect()}
    assert want <= got
    # documents that share no five-word sequence with another are left alone
    grams = defaultdict(set)
    for i, t in texts.items():
        w = t.lower().split()
        for j in range(len(w) - 4):
            grams[tuple(w[j:j + 5])].add(i)
    shared = set().union(*(o for o in grams.values() if len(o) > 1))
    assert got <= shared


def test_pieces_match_the_library(spark, texts):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = rows_of(spark, "op5_pieces")
    for i, t in texts.items():
        assert got[i]["ids"] == lib.encode(t) and got[i]["round_trip"] and got[i]["n_tokens"] == len(lib.encode(t))


def test_random_strings_match_the_library():
    import random

    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    t = pieces.PieceTransducer.compile(pieces.MODEL)
    rng = random.Random(5)
    for _ in range(3000):
        s = "".join(rng.choice(" ab▁eéth\n\t你\U0001F600.,inx  0123") for _ in range(rng.randint(0, 50)))
        ids = np.frombuffer(t.encode(s), np.int32).tolist()
        assert ids == lib.encode(s) and t.decode(ids) == lib.decode(ids)


def test_bounded_caches_change_nothing(monkeypatch):
    t = pieces.PieceTransducer.compile(pieces.MODEL)
    text = "the theory of things and other words " * 5
    want = t.encode(text)
    t.words.limit = t.cut.limit = 2
    t.words.clear(), t.cut.clear()
    assert t.encode(text) == want
