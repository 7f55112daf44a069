"""Personal data: patterns propose spans, checksums confirm them, nearby words
adjust the score. Built-in SQL functions only.

Kinds: ``email ip card phone`` are base spans and always stay; ``iban``
(mod-97) and ``ssn`` (needs a context word) are added when their score reaches
MIN_SCORE. Every pattern runs in time linear in the text: runs are possessive
and start only where a run starts (``\\G``: or where the last match ended), so
the matches are the leftmost non-overlapping ones of the plain patterns.

Defined results: NULL and empty text have no spans; offsets are code points,
end exclusive; repeated rows are scanned one by one; an empty table gives no
rows; input columns stay (``out`` replaces one of its name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import clean_text
from tessera.sources.tables import read_table

LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = list(PATTERNS)
BASE_KINDS = KINDS[:4]
CONTEXT = {
    "email": "mail|contact|write", "ip": r"\bip\b|address|host|server", "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax", "iban": "iban|account|bank", "ssn": "ssn|social|security",
}
PRIOR = {"email": 0.7, "ip": 0.6, "card": 0.5, "phone": 0.5, "iban": 0.5, "ssn": 0.4}
CHECKSUM_BONUS, CONTEXT_BONUS, MIN_SCORE = 0.3, 0.2, 0.6
CONTEXT_BEFORE, CONTEXT_AFTER = 40, 20
SPAN = "struct<kind:string,start:int,end:int,base:boolean,score:double,text:string>"


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn_valid(number: Column) -> Column:
    """Luhn check of a short string of digits."""
    n = F.length(number)
    digit = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        (F.ascii(F.substring(number, i, F.lit(1))) - 48).alias("v"), ((n - i) % 2 == 1).alias("twice")))
    total = F.aggregate(digit, F.lit(0), lambda a, d: a + F.when(
        d["twice"], d["v"] * 2 - F.when(d["v"] > 4, 9).otherwise(0)).otherwise(d["v"]))
    return total % 10 == 0


def mod97_valid(iban: Column) -> Column:
    """ISO 7064 mod-97 check of an account number without blanks."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def step(a: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 58, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        n = F.length(digits(hit))
        return F.when(n.between(12, 19), luhn_valid(digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(hit)).between(9, 15)
    if kind == "iban":
        bare = F.replace(hit, F.lit(" "), F.lit(""))
        return F.when(F.length(bare).between(15, 34), mod97_valid(bare)).otherwise(F.lit(False))
    return F.lit(True)


def _spans(kind: str, text: Column, hits: Column, gaps: Column) -> Column:
    """Matches with offsets: a running sum over (text before, match)."""
    n = F.size(hits)
    parts = F.zip_with(F.zip_with(F.slice(gaps, F.lit(1), n), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit"))),
                       F.slice(gaps, F.lit(2), n), lambda p, after: F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"), after.alias("after")))
    bonus = CHECKSUM_BONUS if kind in ("card", "iban") else 0.0

    def step(acc: Column, p: Column) -> Column:
        start = acc["pos"] + F.length(p["gap"])
        end = start + F.length(p["hit"])
        # words of the text before, earlier matches included
        before = F.right(F.concat(acc["tail"], p["gap"]), F.lit(CONTEXT_BEFORE))
        near = F.concat(before, F.lit(" "), F.left(p["after"], F.lit(CONTEXT_AFTER)))
        score = F.lit(PRIOR[kind] + bonus) + F.when(F.lower(near).rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                        F.lit(kind in BASE_KINDS).alias("base"), F.round(F.least(score, F.lit(1.0)), 3).alias("score"),
                        p["hit"].alias("text"))
        tail = F.right(F.concat(before, p["hit"]), F.lit(CONTEXT_BEFORE))
        return F.struct(end.alias("pos"), tail.alias("tail"), F.concat(acc["out"], F.array(span)).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("tail"), F.array().cast(f"array<{SPAN}>").alias("out"))
    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.filter(found, lambda s: _valid(kind, s["text"]) & (s["base"] | (s["score"] >= MIN_SCORE)))


def _add_spans(df: DataFrame, text: str) -> DataFrame:
    """Add ``spans`` to a table whose columns are named c0, c1, ..."""
    df = df.withColumn("body", clean_text(text))
    for kind, pattern in PATTERNS.items():
        # the cheap test keeps the two passes that follow off most texts
        has = F.col("body").rlike(pattern)
        hits, gaps = f"{kind}_hits", f"{kind}_gaps"
        df = df.withColumn(hits, F.when(has, F.regexp_extract_all("body", F.lit(pattern), F.lit(0))))
        df = df.withColumn(gaps, F.when(F.col(hits).isNotNull(), F.split("body", pattern, -1)))
    none = F.array().cast(f"array<{SPAN}>")
    each = [F.when(F.col(f"{k}_hits").isNotNull(), _spans(k, F.col("body"), F.col(f"{k}_hits"), F.col(f"{k}_gaps"))).otherwise(none) for k in KINDS]
    rank = F.array(*[F.lit(k) for k in KINDS])

    def before(a: Column, b: Column) -> Column:
        return (F.when(a["start"] != b["start"], a["start"] - b["start"])
                .otherwise(F.array_position(rank, a["kind"]) - F.array_position(rank, b["kind"])).cast("int"))

    df = df.withColumn("every", F.concat(*each))
    df = df.withColumn("spans", F.when(F.size("every") > 1, F.array_sort("every", before)).otherwise(F.col("every")))
    return df.drop("body", "every", *[f"{k}_{x}" for k in KINDS for x in ("hits", "gaps")])


def _plain(df: DataFrame, text: str) -> tuple[DataFrame, str]:
    """``df`` with columns c0, c1, ..., and which of them is ``text``: names of
    the input's own cannot clash with those of the work."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), f"c{df.columns.index(text)}"


def with_spans(df: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """Add ``out``: all spans as structs (kind, start, end, base, score, text),
    by start, then kind as listed."""
    plain, at = _plain(df, text)
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c != out]
    return _add_spans(plain, at).select(*keep, F.col("spans").alias(out))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in brackets, e.g. ``[EMAIL]``; of
    overlapping spans the first names the whole stretch. Texts without spans
    (and NULL) stay as they are, and so do all other columns."""
    plain, at = _plain(df, text)
    found, body = _add_spans(plain, at), F.col(at)

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["pos"]
        piece = F.concat(F.substring(body, acc["pos"] + 1, s["start"] - acc["pos"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.concat(acc["out"], F.when(fresh, piece).otherwise(F.lit(""))).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(body, acc["pos"] + 1, F.length(body))))
    clean = F.when(F.size("spans") > 0, clean).otherwise(body)
    return found.select(*[(clean if f"c{i}" == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(df.columns)])


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All personal data in all documents: counts of base spans, the digest of
    the base spans, all spans, and the sum of their scores."""
    df = with_spans(read_table(spark, sf_dir, "documents", "doc_id", "text"), "text", "pii_spans")
    spans = F.col("pii_spans")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(spans) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    risk = F.round(F.aggregate(spans, F.lit(0.0), lambda a, s: a + s["score"]), 3)
    return df.select("doc_id", *counts, F.sha2(joined(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
                     joined(spans).alias("spans"), risk.alias("risk"))
