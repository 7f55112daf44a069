"""Licence scan with a positional index of rare words.

Templates are licence notices as word lists. Each template keeps postings of
the rarest words of its key phrases (highest inverse document frequency,
counted over the whole corpus): word -> position. A file's occurrences of such a word, less the
posting's position, propose where the template starts; the postings of the
template's second rare word at the matching relative position must agree where
there is one. A proposed place counts when every mandatory key phrase stands at
its place; its score is the share of the template's IDF mass found there.

Base phrases are templates whose key phrase is the whole template, so every
place of theirs is found: it holds the phrase's rarest word.

Defined results: NULL and empty text have no words; overlapping places all
count; documents repeat as rows do; an empty table gives no rows; only the
named columns are read.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import clean_text
from tessera.sources.tables import read_table

# Words are what stands between runs of these, once A-Z are lower-cased. Before
# that, A-Z are word characters too: the words are the same.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Phrases and labels that every scan reports.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Short public notices and the key phrases they must hold.
NOTICES = {
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2 0"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",
            ["redistribution and use", "source and binary forms"]),
    "cc-by-4.0": ("licensed under cc by 4 0", ["cc by 4 0"]),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    "gpl-2.0": ("licensed under the gnu general public license version 2", ["general public license version 2"]),
    "gpl-3.0": ("licensed under the gnu general public license version 3", ["general public license version 3"]),
    "mit": ("released under the mit license", ["mit license"]),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software",
                 ["permission is hereby granted", "free of charge"]),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
}
MIN_SCORE = 0.5
RARE_WORDS = 2


def templates() -> list[tuple[str, list[str], list[list[str]], bool]]:
    """(label, words, key phrases, is it a base phrase)"""
    base = [(k, v.split(), [v.split()], True) for k, v in BASE.items()]
    return base + [(k, t.split(), [p.split() for p in ph], False) for k, (t, ph) in NOTICES.items()]


def words_of(text: Column) -> Column:
    """Words of a text whose A-Z are lower-cased (other letters stay)."""
    return F.array_remove(F.split(F.translate(text, UPPER, UPPER.lower()), BETWEEN, -1), "")


def vocabulary() -> list[str]:
    return sorted({w for _, words, _, _ in templates() for w in words})


def document_frequencies(df: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Rows of ``df`` and, for each template word, how many rows hold it. The
    result is bounded by the templates' vocabulary."""
    vocab = F.array(*[F.lit(w) for w in vocabulary()])
    words = F.split(F.lower(clean_text(text)), BETWEEN, -1)
    seen = df.select(F.array_intersect(words, vocab).alias("w"))
    counts = {r["w"]: r["n"] for r in
              seen.select(F.explode("w").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    return df.count(), counts


def idf(n: int, counts: dict[str, int]) -> dict[str, float]:
    return {w: log((1 + n) / (1 + counts.get(w, 0))) + 0.001 for w in vocabulary()}


def rare_postings(words: list[str], phrases: list[list[str]], weight: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest words of the template's key phrases (every place holds
    them) with their first positions. A word that repeats in the template
    cannot say where it starts, so it comes last."""
    key = {w for p in phrases for w in p}
    order = sorted(key, key=lambda w: (words.count(w), -weight[w], w))
    return [(w, words.index(w)) for w in order[:RARE_WORDS]]


def scan(df: DataFrame, weight: dict[str, float], text: str = "text", out: str = "licence_places") -> DataFrame:
    """Add ``out``: places found, as structs (label, base, start, score), and
    ``out``_words: the number of words."""
    found = templates()
    words = F.col("__lic_words")
    anchors = sorted({rare_postings(t, phrases, weight)[0][0] for _, t, phrases, _ in found})
    body = clean_text(text)
    # Look-up: positions of words that lead a template. Most files hold none,
    # and only those that may are cut into words.
    holds = body.rlike(f"(?i)(?<!{IN_WORD})(?:{'|'.join(anchors)})(?!{IN_WORD})")
    df = df.withColumn("__lic_words", F.when(holds, words_of(body)))
    at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(anchors), F.struct(i.alias("p"), w.alias("w")))),
                  lambda h: h.isNotNull())
    df = df.withColumn("__lic_hits", at)

    def place(label: str, t: list[str], phrases: list[list[str]], base: bool) -> Column:
        (first, q1), *more = rare_postings(t, phrases, weight)
        mass = sum(weight[w] for w in t)

        def word_at(s: Column, j: int) -> Column:
            i = s + j + 1
            return F.when((i > 0) & (i <= F.size(words)), F.try_element_at(words, i))

        def found_at(s: Column, j: int, w: str) -> Column:
            return F.coalesce(word_at(s, j) == w, F.lit(False))

        starts = F.transform(F.filter("__lic_hits", lambda h: h["w"] == first), lambda h: h["p"] - q1)
        if more:  # the second posting at the same relative position
            second, q2 = more[0]
            if t.count(second) == 1:
                starts = F.filter(starts, lambda s: found_at(s, q2, second))
        for p in phrases:
            offset = next(i for i in range(len(t)) if t[i:i + len(p)] == p)
            starts = _phrase_filter(starts, p, offset, found_at)

        def score(s: Column) -> Column:
            hit = reduce(lambda a, b: a + b, [F.when(found_at(s, j, w), weight[w]).otherwise(0.0) for j, w in enumerate(t)])
            return F.round(F.least(hit / mass, F.lit(1.0)), 6)

        return F.filter(F.transform(starts, lambda s: F.struct(
            F.lit(label).alias("label"), F.lit(base).alias("base"), s.cast("bigint").alias("start"), score(s).alias("score"))),
            lambda x: x["score"] >= MIN_SCORE)

    none = F.array().cast("array<struct<label:string,base:boolean,start:bigint,score:double>>")
    all_places = F.when(F.size("__lic_hits") > 0, F.concat(*[place(*t) for t in found])).otherwise(none)
    return (df.withColumn(out, all_places).withColumn(f"{out}_words", _count_words(body))
            .drop("__lic_words", "__lic_hits"))


def _count_words(body: Column) -> Column:
    """Parts between separators, less an empty first or last one."""
    ends = [F.when(x.rlike(BETWEEN), 1).otherwise(0) for x in (F.left(body, F.lit(1)), F.right(body, F.lit(1)))]
    n = F.size(F.split(body, BETWEEN, -1)) - ends[0] - ends[1]
    # a text without a word is one empty part, or two that both count as ends
    return F.when(body == "", 0).otherwise(F.greatest(n, F.lit(0))).cast("bigint")


def _phrase_filter(starts: Column, phrase: list[str], offset: int, found_at) -> Column:
    return F.filter(starts, lambda s: reduce(
        lambda a, b: a & b, [found_at(s, offset + i, w) for i, w in enumerate(phrase)]))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places of all documents."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    weight = idf(*document_frequencies(docs))
    df = scan(docs, weight)
    base = F.filter("licence_places", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["start"])

    def labels(places: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))))

    return df.select(
        "doc_id", F.col("licence_places_words").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("licence_places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licence_places", lambda x: x["score"])), F.lit(0.0)).alias("score"))
