"""Language identification by Bayesian evidence fusion.

The posterior of a text's language multiplies

* the text's likelihood: byte trigrams hashed to BUCKETS counters for each
  language, counted over all labelled documents (Laplace-smoothed; a trigram
  shares its bytes with two others, so log likelihoods count a third),
* the likelihoods of the declared markup language and of the address suffix,
  from grouped sums of text posteriors (smoothed towards independence),
* a prior of its host, smoothed hierarchically: host towards its domain,
  domain towards the whole corpus; a row's own text is left out of the sums.

Counters are added up in each task and combined by grouped aggregation; the
model has languages x BUCKETS numbers, whatever the input's size. Evidence
tables are joined, not broadcast, so hosts may be many; sums are combined
before the shuffle, so a hot host is no group in one task.

Defined results: NULL text is empty, and a text without trigrams has no text
evidence; missing markup, suffix or host give no evidence; equal posteriors
resolve to the language first in order; repeated rows are scored each; empty
tables give no rows; without labelled documents language is NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import clean_text
from tessera.session import scratch_path
from tessera.sources.tables import read_table

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
CHUNK_BYTES = 4_000_000
OVERLAP = 3.0
SMOOTHING = 0.5
PRIOR_STRENGTH = 5.0
MAX_ROW_EVIDENCE = 60.0  # log odds beyond this change no decision and overflow exp


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the byte trigram at every position but the last two; ASCII
    capitals count as small letters."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    with np.errstate(over="ignore"):
        return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of a string column in chunks."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, side="right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def spans_of(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end position of each row's trigrams."""
    return offsets[:-1], np.maximum(offsets[1:] - 2, offsets[:-1])


@dataclass
class TextModel:
    languages: list[str]
    log_likelihood: np.ndarray  # languages x BUCKETS


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> TextModel:
    """Count trigrams of all documents with a language."""
    docs = docs.filter(F.col(lang).isNotNull()).select(clean_text(text).alias("text"), F.col(lang).alias("lang"))
    languages = sorted(r["lang"] for r in docs.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        at = {v: i for i, v in enumerate(languages)}
        for batch in batches:
            which = np.array([at[v] for v in batch.column("lang").to_pylist()], np.int64)
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                if len(data) < 3:
                    continue
                bucket = trigram_buckets(data)
                begin, end = spans_of(offsets)
                row = np.repeat(np.arange(hi - lo), end - begin)
                pos = np.arange(len(row)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + begin[row]
                total += np.bincount(which[lo:hi][row] * BUCKETS + bucket[pos], minlength=total.size).reshape(total.shape)
        x, y = np.nonzero(total)
        for part in range(0, len(x), 50_000):
            a, b = x[part:part + 50_000], y[part:part + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[a, b])],
                                             names=["l", "b", "n"])

    counts = docs.mapInArrow(count, "l int, b int, n bigint").groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(languages), BUCKETS))
    table[counts["l"].to_numpy(), counts["b"].to_numpy()] = counts["n"].to_numpy()
    table += SMOOTHING
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def text_evidence(df: DataFrame, model: TextModel, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``ll``: the text's log likelihood by language."""
    shared = df.sparkSession.sparkContext.broadcast(model.log_likelihood.astype(np.float32))
    k = len(model.languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            out = np.zeros((len(column), k))
            for lo, hi, data, offsets in text_chunks(column):
                if len(data) < 3:
                    continue
                bucket = trigram_buckets(data)
                begin, end = spans_of(offsets)
                for i in range(k):
                    total = np.concatenate([[0.0], np.cumsum(table[i][bucket], dtype=np.float64)])
                    out[lo:hi, i] = total[np.minimum(end, len(bucket))] - total[np.minimum(begin, len(bucket))]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * k), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*keys, "ll"])

    rows = df.select(*keys, clean_text(text).alias("__body"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(score, f"{schema}, ll array<double>")


def _softmax(logs: Column) -> Column:
    raised = F.transform(logs, lambda v: F.exp(F.greatest(v - F.array_max(logs), F.lit(-10 * MAX_ROW_EVIDENCE))))
    return F.transform(raised, lambda v: v / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _mass(df: DataFrame, key: str, k: int, out: str) -> DataFrame:
    """Summed text posteriors by ``key``."""
    sums = [F.sum(F.col("p")[i]) for i in range(k)]
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"__{key}")).agg(F.array(*sums).alias(out))


def identify(rows: DataFrame, model: TextModel, keys: list[str], text: str = "text") -> DataFrame:
    """``rows`` need ``keys``, ``text``, ``declared``, ``suffix``, ``host`` and
    ``domain`` (any may be NULL). Returns keys, lang, confidence, text_lang,
    declared, host."""
    evidence = ["declared", "suffix", "host", "domain"]
    k = len(model.languages)
    if not k:
        none = F.lit(None).cast("string")
        return rows.select(*keys, none.alias("lang"), F.lit(None).cast("double").alias("confidence"), none.alias("text_lang"), "declared", "host")
    path = scratch_path(rows.sparkSession, "language-text")
    text_evidence(rows, model, [*keys, *evidence], text).write.parquet(path)
    df = rows.sparkSession.read.parquet(path)
    df = df.withColumn("ll", F.transform("ll", lambda v: v / F.lit(OVERLAP)))
    df = df.withColumn("p", _softmax(F.col("ll")))
    overall = df.agg(*[F.sum(F.col("p")[i]) for i in range(k)]).first()
    total = sum(v or 0.0 for v in overall) + k
    base = F.array(*[F.lit(((v or 0.0) + 1.0) / total) for v in overall])
    one = F.lit(1.0)

    def spread(key: str, out: str) -> None:
        nonlocal df
        df = df.join(_mass(df, key, k, out), F.col(key) == F.col(f"__{key}"), "left").drop(f"__{key}")

    for key, out in (("host", "n_host"), ("domain", "n_domain"), ("declared", "n_declared"), ("suffix", "n_suffix")):
        spread(key, out)

    def shrink(mass: str, parent: Column) -> Column:
        """(sums without this row + strength x parent) / (rows + strength)"""
        rest = F.zip_with(mass, "p", lambda n, p: F.greatest(n - p, F.lit(0.0)))
        size = F.aggregate(rest, F.lit(0.0), lambda a, b: a + b)
        return F.when(F.col(mass).isNull(), parent).otherwise(F.zip_with(
            rest, parent, lambda n, q: (n + PRIOR_STRENGTH * q) / (size + PRIOR_STRENGTH)))

    df = df.withColumn("prior_domain", shrink("n_domain", base))
    df = df.withColumn("prior", shrink("n_host", F.col("prior_domain")))

    def likelihood(mass: str) -> Column:
        """log P(value | language), up to a constant: how much more often the
        value goes with the language than on the whole."""
        size = F.aggregate(mass, F.lit(0.0), lambda a, b: a + b)
        lift = F.zip_with(mass, base, lambda n, q: F.log((n + PRIOR_STRENGTH * q) / ((size + PRIOR_STRENGTH) * q)))
        return F.coalesce(F.when(F.col(mass).isNotNull(), lift), F.array_repeat(F.lit(0.0), k))

    parts = [F.col("ll"), F.transform("prior", lambda v: F.log(v)), likelihood("n_declared"), likelihood("n_suffix")]
    df = df.withColumn("post", _softmax(reduce(_plus, parts)))
    names = F.array(*[F.lit(v) for v in model.languages])
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    blank = F.forall("ll", lambda v: v == 0)
    return df.select(*keys, best(F.col("post")).alias("lang"), F.round(F.array_max("post") * one, 4).alias("confidence"),
                     F.when(~blank, best(F.col("p"))).alias("text_lang"), "declared", "host")


def page_evidence(pages: DataFrame) -> DataFrame:
    """page_id, text (markup taken out), declared, suffix, host, domain of web
    pages (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    text = html
    for tag in ("script", "style"):
        text = F.regexp_replace(text, rf"(?i)<{tag}\b[^<]*+(?:<(?!/{tag})[^<]*+)*+</{tag}\s*+>", " ")
    text = F.regexp_replace(F.regexp_replace(text, "<[^>]*+>", " "), "&#?[A-Za-z0-9]+;", " ")
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    meta = F.lower(F.regexp_extract(html, r"(?i)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    some = lambda c: F.when(c != "", c)
    return pages.select("page_id", text.alias("text"), F.coalesce(some(declared), some(meta)).alias("declared"),
                        some(F.substring_index(host, ".", -1)).alias("suffix"), some(host).alias("host"),
                        some(F.substring_index(host, ".", -2)).alias("domain"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all pages (page_id) and all documents (doc_id; their
    source is the host, they have no markup or address)."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    none = F.lit(None).cast("string")
    rows = page_evidence(read_table(spark, sf_dir, "pages", "page_id", "url", "html")).withColumn("doc_id", F.lit(None).cast("bigint"))
    rows = rows.unionByName(docs.select(F.lit(None).cast("bigint").alias("page_id"), "doc_id", "text", none.alias("declared"),
                                        none.alias("suffix"), F.concat(F.lit("source:"), "source").alias("host"), none.alias("domain")))
    return identify(rows, train(docs), ["doc_id", "page_id"])
