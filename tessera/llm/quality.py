"""Quality classifier by co-training.

Two logistic regressions see different views of a document: its content
(symbols, capitals, repeated words, ...) and its metadata (source, language,
length, layout). Over ROUNDS rounds each labels the unlabelled documents it is
sure of, and these join the other's training rows at half weight. Labelled rows
held out by a hash of their id then calibrate both views (Platt) and weigh them
against each other. Features are built-in SQL over whole texts; all labelled
and all unlabelled documents take part in the fit; scoring is a plain SQL
expression with the fitted numbers in it.

Defined results: NULL text is empty; a document without label (or whose label
rows disagree evenly, or hold NULL) is unlabelled; where the labelled rows hold
one class only, or there are none, nothing can be learned: every document
scores that class's share (1.0 without labels), so none is rejected for want of
labels; repeated rows are scored each; an empty table gives no rows; texts may
have any length; other columns may have any name. Scores are rounded to 4
digits, as parallel sums differ in the last bits.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import clean_text
from tessera.session import scratch_path
from tessera.sources.tables import read_table

ROUNDS = 3
CONFIDENT = 0.97  # a view passes on labels it gives at least this probability
PSEUDO_WEIGHT = 0.5
HELD_OUT = 4  # one labelled row in so many calibrates
SOURCE_BUCKETS, LANG_BUCKETS = 32, 8
THRESHOLD = 0.5
MAX_ITER, REG = 25, 0.001


def features(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> tuple[DataFrame, dict[str, list[str]]]:
    """Add the columns of both views (names start with ``__a_`` and ``__b_``),
    computed from the three named columns. ``df`` has no column whose name
    starts with two underscores (``_scored`` sees to that)."""
    body = F.col("__q_text")
    df = df.withColumn("__q_text", clean_text(text))
    df = df.withColumn("__q_words", F.array_remove(F.split(body, r"[ \t\n\x0B\f\r]+"), ""))
    chars = F.greatest(F.length(body), F.lit(1))
    words = F.greatest(F.size("__q_words"), F.lit(1))

    def share(pattern: str) -> Column:
        return (F.length(body) - F.length(F.regexp_replace(body, pattern, ""))) / chars

    same = F.zip_with(F.slice("__q_words", F.lit(1), F.greatest(F.size("__q_words") - 1, F.lit(0))),
                      F.slice("__q_words", 2, F.greatest(F.size("__q_words") - 1, F.lit(0))), lambda a, b: a == b)
    a = {
        "symbols": share(r"[!#$%&*+/<=>@\\^_`|~]"), "capitals": share(r"\p{Lu}"), "digits": share("[0-9]"),
        "distinct": F.size(F.array_distinct("__q_words")) / words,
        "same_next": (F.size(same) - F.size(F.array_remove(same, True))) / words,
        "word_length": F.least(F.length(body) / words, F.lit(50.0)), "blank": (F.size("__q_words") == 0).cast("double"),
    }
    lines = (F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit("")))) + 1
    stops = F.length(body) - F.length(F.replace(body, F.lit("."), F.lit("")))
    b = {"log_chars": F.log1p(F.length(body)), "line_length": F.log1p(F.length(body) / lines),
         "stops": F.least(stops / words, F.lit(1.0)), "ends": F.right(body, F.lit(1)).isin(".", "!", "?").cast("double")}
    for name, column, buckets in (("source", source, SOURCE_BUCKETS), ("lang", lang, LANG_BUCKETS)):
        at = F.pmod(F.xxhash64(F.coalesce(F.col(column), F.lit(""))), F.lit(buckets))
        b |= {f"{name}{i}": (at == i).cast("double") for i in range(buckets)}
    df = df.select("*", *[x.cast("double").alias(f"__a_{k}") for k, x in a.items()],
                   *[x.cast("double").alias(f"__b_{k}") for k, x in b.items()])
    return df.drop("__q_text", "__q_words"), {"a": [f"__a_{k}" for k in a], "b": [f"__b_{k}" for k in b]}


@dataclass
class Linear:
    columns: list[str]
    weights: list[float]
    intercept: float

    def logit(self) -> Column:
        return reduce(lambda x, y: x + y, [F.col(c) * F.lit(w) for c, w in zip(self.columns, self.weights)], F.lit(self.intercept))


@dataclass
class CoTrained:
    views: dict[str, Linear] = field(default_factory=dict)
    platt: dict[str, Linear] = field(default_factory=dict)
    joint: Linear | None = None
    share: float = 1.0  # of good documents among the labelled ones
    pseudo: dict[str, int] = field(default_factory=dict)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Add the calibrated score of ``features`` rows, and each view's."""
        if self.joint is None:
            return df.withColumns({out: F.lit(self.share), "content_score": F.lit(self.share), "metadata_score": F.lit(self.share)})
        df = df.withColumns({f"__z_{v}": m.logit() for v, m in self.views.items()})
        df = df.withColumns({f"__c_{v}": m.logit() for v, m in self.platt.items()})
        p = lambda z: F.round(1 / (1 + F.exp(-z)), 4)
        df = df.withColumns({out: p(self.joint.logit()), "content_score": p(F.col("__c_a")), "metadata_score": p(F.col("__c_b"))})
        return df.drop("__z_a", "__z_b", "__c_a", "__c_b")


def _fit(rows: DataFrame, columns: list[str], reg: float = REG) -> Linear:
    """Logistic regression of ``y`` (weights ``w``) on ``columns``."""
    x = VectorAssembler(inputCols=columns, outputCol="__x").transform(rows).select("__x", "y", "w")
    m = LogisticRegression(featuresCol="__x", labelCol="y", weightCol="w", maxIter=MAX_ITER, regParam=reg, family="binomial").fit(x)
    return Linear(columns, [float(v) for v in m.coefficients], float(m.intercept))


def label_table(labels: DataFrame) -> DataFrame:
    """One label an id: the majority of its rows, none where they tie."""
    mean = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.avg("quality").alias("m"))
    return mean.filter("m <> 0.5").select(F.col("doc_id").alias("__label_id"), (F.col("m") > 0.5).cast("double").alias("y"))


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> CoTrained:
    spark = docs.sparkSession
    rows, views = features(docs.select("doc_id", "text", "lang", "source"))
    rows = rows.drop("text", "lang", "source").join(label_table(labels), F.col("doc_id") == F.col("__label_id"), "left").drop("__label_id")
    path = scratch_path(spark, "quality-features")
    rows.write.parquet(path)
    rows = spark.read.parquet(path).withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)
    seen = {(r["held"], r["y"]): r["count"] for r in rows.filter("y is not null").groupBy("held", "y").count().collect()}
    good, bad = (sum(n for (_, y), n in seen.items() if y == k) for k in (1.0, 0.0))
    model = CoTrained(share=good / (good + bad) if good + bad else 1.0)
    # both parts need both classes; a tiny table calibrates on its training rows
    if not good or not bad:
        return model
    apart = all(seen.get((h, y), 0) > 0 for h in (True, False) for y in (0.0, 1.0))
    train = rows.filter(F.col("y").isNotNull() & (~F.col("held") if apart else F.lit(True))).withColumn("w", F.lit(1.0))
    held = rows.filter(F.col("y").isNotNull() & (F.col("held") if apart else F.lit(True))).withColumn("w", F.lit(1.0))
    pool = rows.filter(F.col("y").isNull())
    kept = [d.persist(StorageLevel.MEMORY_AND_DISK) for d in (train, held, pool)]
    try:
        given: dict[str, DataFrame | None] = {"a": None, "b": None}
        for turn in range(rounds + 1):
            model.views = {v: _fit(train if given[v] is None else train.unionByName(given[v]), c) for v, c in views.items()}
            if turn == rounds:
                break
            for teacher, pupil in (("a", "b"), ("b", "a")):
                p = 1 / (1 + F.exp(-model.views[teacher].logit()))
                sure = pool.withColumn("__p", p).filter((F.col("__p") >= CONFIDENT) | (F.col("__p") <= 1 - CONFIDENT))
                given[pupil] = sure.withColumn("y", (F.col("__p") >= 0.5).cast("double")).withColumn("w", F.lit(PSEUDO_WEIGHT)).drop("__p")
        model.pseudo = {v: d.count() for v, d in given.items() if d is not None}
        z = held.withColumns({f"__z_{v}": m.logit() for v, m in model.views.items()})
        model.platt = {v: _fit(z, [f"__z_{v}"]) for v in views}
        c = z.withColumns({f"__c_{v}": m.logit() for v, m in model.platt.items()})
        model.joint = _fit(c, ["__c_a", "__c_b"])
    finally:
        for d in kept:
            d.unpersist()
    return model


def _scored(docs: DataFrame, labels: DataFrame, rounds: int) -> DataFrame:
    """Columns of ``docs`` as c0, c1, ... and the three scores: names of the
    input's own cannot clash with those of the work."""
    model = co_train(docs, labels, rounds)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{docs.columns.index(c)}" for c in ("text", "lang", "source")}
    rows, views = features(plain, at["text"], at["lang"], at["source"])
    return model.score(rows, "score").drop(*views["a"], *views["b"])


def score_documents(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``score`` (probability of being good), ``content_score``
    and ``metadata_score``, which replace columns of these names."""
    scores = ["score", "content_score", "metadata_score"]
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in scores]
    return _scored(docs, labels, rounds).select(*own, *scores)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """The documents that score at least ``threshold``; all columns stay as
    they are."""
    good = _scored(docs, labels, rounds).filter(F.col("score") >= threshold)
    return good.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, and whether they pass."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    scored = score_documents(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return scored.select("doc_id", "score", "content_score", "metadata_score", (F.col("score") >= THRESHOLD).alias("good"))
