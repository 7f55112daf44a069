"""Stand-ins for the analyses' raw inputs, derived from the driver tables.

Each builder is ``(spark, sf_dir) -> DataFrame`` and reads only the
columns it needs. The same derivations in DuckDB SQL live in
``tessera.plans.oracle`` so every query can be checked independently.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# Number of tags a fully scored item carries in the stand-in genome table
# (the real genome table uses 1128).
FIXTURE_TAGS = 40
PARTICLE_FEATURES = 28
# Items that one task scores for every tag.
SCORED_ITEMS_PER_TASK = 50_000


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web-log lines, one ``value`` column, like ``spark.read.text``."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    line = F.concat(
        F.lit("host"), F.col("user_id").cast("string"), F.lit(".example.com - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'),
        F.col("event_type"), F.lit("/f"), ((F.col("event_id") * 7) % 97).cast("string"),
        F.when(F.col("event_id") % 5 == 0, F.lit(".gif")).otherwise(F.lit(".html")),
        F.lit(' HTTP/1.0" 200 '), F.floor(F.col("value") * 100).cast("bigint").cast("string"),
    )
    garbage = F.concat(F.lit("garbage /Jan/2024 row "), F.col("event_id").cast("string"))
    stray = F.concat(F.lit('stray - - [01/Feb/2024:00:00:01 -0400] "GET /x/stray.html" '),
                     F.col("event_id").cast("string"))  # another month
    return ev.select(
        F.when(F.col("event_id") % 1000 == 7, garbage)
        .when(F.col("event_id") % 1000 == 11, stray).otherwise(line).alias("value"))


def long_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log over several months: each event is moved on by up to four months,
    and every sixth day of a month is without traffic."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    moved = F.add_months(F.to_date("ts"), (F.col("event_id") % 5).cast("int"))
    stamp = F.concat(F.date_format(moved, "dd/MMM/yyyy"), F.lit(":"), F.date_format("ts", "HH:mm:ss"))
    line = F.concat(F.lit("host - - ["), stamp, F.lit(' -0400] "GET /'), F.col("event_type"), F.lit('.html HTTP/1.0" 200 '),
                    F.col("event_id").cast("string"))
    broken = F.concat(F.lit("host - - [31/Feb/2024:00:00:00] "), F.col("event_id").cast("string"))
    return ev.filter(F.dayofmonth(moved) % 6 != 0).select(
        F.when(F.col("event_id") % 500 == 3, broken).otherwise(line).alias("value"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId, movieId, rating): one row per (customer, part)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
            .agg(F.max((F.col("l_quantity").cast("int") % 10 + 1) / 2).alias("rating")))


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movieId, tagId, relevance): a third of the items unscored, every
    seventh scored item one tag short, ties for the maximum."""
    part = read_table(spark, sf_dir, "part", "p_partkey")
    # each key becomes a row a tag: one split of keys is far more than a split of rows
    tasks = ceil(part.count() / SCORED_ITEMS_PER_TASK)
    if part.rdd.getNumPartitions() < tasks:
        part = part.repartition(tasks, "p_partkey")
    part = part.filter(F.col("p_partkey") % 3 != 0)
    scored = part.select(F.col("p_partkey").alias("movieId"),
                         F.explode(F.sequence(F.lit(1), F.lit(FIXTURE_TAGS))).alias("tagId"))
    scored = scored.filter((F.col("movieId") % 7 != 0) | (F.col("tagId") <= FIXTURE_TAGS - 1))
    return scored.select(
        "movieId", "tagId",
        (((F.col("movieId") * 31 + F.col("tagId") * 17) % 37) / 36).alias("relevance"))


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tagId, tag): tag names; multiples of 9 have none."""
    ids = spark.range(1, FIXTURE_TAGS + 1).select(F.col("id").cast("int").alias("tagId"))
    return (ids.filter(F.col("tagId") % 9 != 0)
            .select("tagId", F.concat(F.lit("tag_"), F.col("tagId").cast("string")).alias("tag")))


def particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide numeric table: key, two labels and 28 double features f1..f28."""
    emb = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    e = F.col("embedding")
    feats = [e[i].cast("double").alias(f"f{i + 1}") for i in range(PARTICLE_FEATURES)]
    return emb.select(
        "vec_id",
        (F.col("label") >= 5).cast("int").alias("label"),
        ((e[0].cast("double") + e[1].cast("double")) > 0).cast("int").alias("label_signal"),
        *feats)


RATING_LINE_SCHEMA = "userId bigint, movieId bigint, rating double, timestamp bigint"


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key columns, m, line): one CSV line per order line as other tools
    write ratings, with faults by the residue m: too short, too long, text in
    one or two number columns, a quote that does not end; then good lines with
    quoted and with empty fields."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    m = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7 + F.col("l_partkey")) % 97
    s = lambda c: F.col(c).cast("string")
    user, movie, rating, stamp = s("l_orderkey"), s("l_partkey"), s("l_quantity"), s("l_linenumber")
    cases = [(user, movie), (user, movie, rating, stamp, F.lit("extra")), (F.concat(F.lit("x"), user), movie, rating, stamp),
             (user, movie, F.lit("abc"), F.concat(stamp, F.lit(".5"))), (F.concat(F.lit('"'), user), movie, rating, stamp),
             (F.concat(F.lit('"'), user, F.lit('"')), F.concat(F.lit('"'), movie, F.lit('"')), rating, stamp),
             (F.lit(""), movie, rating, F.lit(""))]
    line = F.concat_ws(",", user, movie, rating, stamp)
    for i, fields in enumerate(cases):
        line = F.when(F.col("m") == i, F.concat_ws(",", *fields)).otherwise(line)
    return li.withColumn("m", m).withColumn("line", line)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string claims table keyed by (l_orderkey, l_linenumber, l_partkey,
    l_suppkey): the analyses' 2 integer, 8 numeric, 13 string and 4 large
    columns, with NULLs in Var2, Cat12 and Claim_Amount."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
                    "l_suppkey", "l_shipdate", "l_quantity", "l_tax", "l_discount", "l_returnflag",
                    "l_linestatus", "l_extendedprice")
    od = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority",
                    "o_orderstatus", "o_totalprice", "o_orderdate")
    pt = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand", "p_name", "p_size",
                    "p_retailprice")
    cu = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    # customers join the orders, so that lines are dealt anew twice, not three times
    j = (li.join(od.join(cu, od.o_custkey == cu.c_custkey), li.l_orderkey == od.o_orderkey)
         .join(pt, li.l_partkey == pt.p_partkey))
    s = lambda c: F.col(c).cast("string")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.year("l_shipdate").cast("string").alias("Calendar_Year"),
        F.substring("o_orderpriority", 1, 1).alias("OrdCat"),
        s("l_quantity").alias("Var1"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("string")).otherwise(s("l_tax")).alias("Var2"),
        s("l_discount").alias("Var3"), s("l_linenumber").alias("Var4"), s("p_size").alias("Var5"),
        s("p_retailprice").alias("Var6"), s("c_acctbal").alias("Var7"), s("o_totalprice").alias("Var8"),
        F.col("p_type").alias("Cat1"),
        F.col("c_mktsegment").alias("Cat2"),
        F.col("o_orderstatus").alias("Cat3"), F.col("l_linestatus").alias("Cat4"),
        F.col("l_returnflag").alias("Cat5"), (F.col("p_size") % 5).cast("string").alias("Cat6"),
        F.substring("p_type", 1, 3).alias("Cat7"), s("c_nationkey").alias("Cat8"),
        (F.col("l_linenumber") % 3).cast("string").alias("Cat9"),
        F.month("l_shipdate").cast("string").alias("Cat10"),
        (F.col("l_suppkey") % 7).cast("string").alias("Cat11"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("l_returnflag")).alias("Cat12"),
        (F.col("l_orderkey") % 4).cast("string").alias("NVCat"),
        F.col("p_brand").alias("Blind_Make"),
        F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand")).alias("Blind_Model"),
        F.concat(F.col("p_name"), F.lit("/"), F.col("p_brand")).alias("Blind_Submodel"),
        F.year("o_orderdate").cast("string").alias("Model_Year"),
        F.when(F.col("l_orderkey") % 97 == 1, F.lit(None).cast("string"))
         .when(F.col("l_orderkey") % 10 == 0, s("l_extendedprice"))
         .otherwise(F.lit("0")).alias("Claim_Amount"),
    )


CLAIM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
