"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model (BPE with byte fallback) is compiled once into

* the normaliser: dummy prefix and white space as U+2581,
* the piece transducer: arcs that read a piece's characters and write its id
  at weight 0, and byte-fallback arcs that read a character without a piece and
  write its bytes at weight BYTE_COST each,
* a pair acceptor: two neighbouring pieces have weight 0 if merging their
  joined text gives just these two, else infinity.

An input is composed with them and the shortest path in the tropical semiring
(min, +) gives its ids. Merging a text's prefix gives a prefix of its pieces,
so one finite path at most leads to a position, and all that reach the end
weigh the same: the search visits a position once and is linear in the text. As pieces hold U+2581 only at
their front, a text is the concatenation of its words' paths, and words are
looked up in a cache of bounded size.

Defined results: NULL text is empty; empty text has no ids; U+2581 in a text
is white space, as in the library, so it decodes to a blank; every other text
decodes to itself. Rows are encoded one by one, repeated or not; an empty
table gives no rows.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shingles import list_array
from tessera.llm.text import clean_text
from tessera.sources.tables import read_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 64_000_000
SPACE = "▁"
BYTE_COST = 1.0
INFINITY = float("inf")
MAX_WORDS, MAX_PAIRS = 1_000_000, 500_000
BATCH_CHARS = 4_000_000


class Bounded(dict):
    """Values computed on first use; emptied when it holds ``limit`` of them."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class PieceTransducer:
    def __init__(self, pieces: list[tuple[str, float]], bytes_first: dict[int, int], dummy_prefix: bool, ids: dict[str, int]):
        self.score = dict(pieces)
        self.ids = ids
        self.byte_ids = bytes_first
        self.dummy_prefix = dummy_prefix
        self.prefixes = {p[:i] for p in ids for i in range(2, len(p) + 1)}
        self.line_ends_apart = not any("\n" in p for p in ids)
        self.spelled: dict[int, bytes] = {i: p.replace(SPACE, " ").encode() for p, i in ids.items()}
        self.spelled |= {i: bytes([b]) for b, i in bytes_first.items()}
        self._caches()

    def _caches(self) -> None:
        self.cut = Bounded(self._cut, MAX_PAIRS)
        self.words = Bounded(self._word, MAX_WORDS)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("cut", "words")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._caches()

    @classmethod
    def compile(cls, path: str) -> PieceTransducer:
        """Compile a model file (read on the driver; its size is bounded)."""
        from sentencepiece import sentencepiece_model_pb2 as pb

        if os.path.getsize(path) > MAX_MODEL_BYTES:
            raise ValueError("the model file is too large to broadcast")
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are compiled")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only the identity normaliser is compiled")
        kind = pb.ModelProto.SentencePiece
        pieces, bytes_first, ids = [], {}, {}
        for i, p in enumerate(model.pieces):
            if p.type == kind.NORMAL:
                pieces.append((p.piece, p.score))
                ids[p.piece] = i
            elif p.type == kind.BYTE:
                bytes_first[int(p.piece[3:5], 16)] = i
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("pieces must hold white space at their front only")
        return cls(pieces, bytes_first, rules.add_dummy_prefix, ids)

    def merged(self, text: str) -> list[str]:
        """The model's merges on a short text: the best-scored neighbours
        first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -INFINITY, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1], -INFINITY)
                if s > best:
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _word(self, w: str) -> bytes:
        """A word after a blank, or after a line end that no piece holds."""
        return self.path(w if w[:1] == "\n" else SPACE + w)

    def _cut(self, text: str) -> int:
        """Where merging ``text`` leaves one cut: 0 if it is one piece, -1 if
        it has several cuts. Neighbours (left, right) have weight 0 if the cut
        of their joined text is ``len(left)``, else infinity."""
        parts = self.merged(text)
        return 0 if len(parts) == 1 else len(parts[0]) if len(parts) == 2 else -1

    def path(self, text: str) -> bytes:
        """Ids (int32 bytes) on the shortest path of a normalised text: a
        search that takes the longest arc first. A position that no finite
        path leaves is on none, so it is visited once."""
        n, ids, cut, prefixes = len(text), self.ids, self.cut, self.prefixes
        pieces: list[str] = []
        dead: set[int] = set()
        pos, last, end = 0, "", n
        while pos < n:
            if end > pos + 1 and text[pos:pos + 2] in prefixes:  # the longest arc from here
                far = pos + 2
                while far < end and text[pos:far + 1] in prefixes:
                    far += 1
                end = far
            else:
                end = min(end, pos + 1)
            while end > pos:
                piece = text[pos:end]
                # a lone character always has an arc
                if (piece in ids or end == pos + 1) and end not in dead and cut[last + piece] == len(last):
                    break
                end -= 1
            if end > pos:
                pieces.append(piece)
                pos, last, end = end, piece, n
            else:
                dead.add(pos)
                end = pos - 1
                pos -= len(pieces.pop())
                last = pieces[-1] if pieces else ""
        out: list[int] = []
        for piece in pieces:
            at = ids.get(piece)
            if at is None:  # byte-fallback arcs
                out.extend(map(self.byte_ids.__getitem__, piece.encode()))
            else:
                out.append(at)
        return array("i", out).tobytes()

    def weight(self, ids: list[int]) -> float:
        """Tropical weight of a path: what its fallback arcs cost."""
        fallback = set(self.byte_ids.values())
        return sum(BYTE_COST for i in ids if i in fallback)

    def encode(self, text: str) -> bytes:
        """Ids (int32 bytes) of a text."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")
        if self.dummy_prefix:
            text = " " + text
        if self.line_ends_apart:  # a line end starts a word of its own
            text = text.replace("\n", " \n")
        if text[0] == " " and "  " not in text and text[-1] != " ":
            return b"".join(map(self.words.__getitem__, text[1:].split(" ")))
        # runs of blanks belong to the word that follows, or stand alone; the
        # blank that was put before a line end is taken out again
        out = []
        for w in re.findall(r" *[^ ]+| +", text):
            blanks = len(w) - len(w.lstrip(" "))
            if self.line_ends_apart and w[blanks:blanks + 1] == "\n":
                out.append(self.path(SPACE * (blanks - 1)) + self.words[w[blanks:]])
            else:
                out.append(self.words[w[1:]] if blanks == 1 and len(w) > 1 else self.path(w.replace(" ", SPACE)))
        return b"".join(out)

    def decode(self, ids) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


def encode_texts(df: DataFrame, keys: list[str], text: str = "text", model: str = MODEL, check: bool = True) -> DataFrame:
    """``keys`` with ``ids`` (array<int>), ``n_tokens`` and, with ``check``,
    ``round_trip``: whether decoding gives the text back."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(PieceTransducer.compile(model))
    df = df.select(*keys, clean_text(text).alias("__body"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in batches:
            body = batch.column(batch.num_columns - 1)
            lo = 0
            while lo < len(body):
                hi, chars, coded, same = lo, 0, [], []
                while hi < len(body) and chars < BATCH_CHARS:
                    s = body[hi].as_py()
                    chars += len(s)
                    coded.append(t.encode(s))
                    if check:
                        same.append(t.decode(np.frombuffer(coded[-1], np.int32).tolist()) == s.replace(SPACE, " "))
                    hi += 1
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                ids = list_array(np.frombuffer(b"".join(coded), np.int32), np.concatenate([[0], np.cumsum(sizes)]))
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)]
                columns += [ids, pa.array(sizes)] + ([pa.array(same)] if check else [])
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
                lo = hi

    extra = "ids array<int>, n_tokens bigint" + (", round_trip boolean" if check else "")
    names = [f.strip().split(" ")[0].strip("`") for f in extra.split(",")]
    out_schema = f"{schema}, {extra}" if schema else extra

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(batches):
            yield b.rename_columns([*keys, *names])

    return df.mapInArrow(named, out_schema)


def op5_pieces(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return encode_texts(docs, ["doc_id"], "text", model)
