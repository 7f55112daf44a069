"""Word and shingle expressions shared by the operators (all native SQL)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_text(text: str | Column) -> Column:
    """NULL text counts as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string")


def lower_words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; none for blank text."""
    return F.array_remove(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), "")


def add_shingle_hashes(df: DataFrame, text: str, out: str, width: int) -> DataFrame:
    """Add ``out``: 64-bit hashes of all ``width``-word shingles, repeats
    included. A text of fewer words (but at least one) is one shingle; blank
    text has none."""
    words, hashes = f"{out}__w", f"{out}__h"
    df = df.withColumn(words, lower_words(F.col(text)))
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    acc = F.col(hashes)
    for i in range(1, width):
        n = F.greatest(F.size(hashes) - i, F.lit(0))
        acc = F.zip_with(F.slice(acc, F.lit(1), n), F.slice(hashes, F.lit(i + 1), n),
                         lambda a, b: F.xxhash64(a, b))
    short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(F.concat_ws(" ", words))))
    return df.withColumn(
        out, F.when(F.size(hashes) >= width, acc)
        .otherwise(F.coalesce(short, F.array().cast("array<bigint>")))).drop(words, hashes)
