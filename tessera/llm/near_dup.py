"""Near-duplicate documents: ProbMinHash, banding, verification.

1. Exact copies (equal word sequences, case and white space aside) collapse
   by digest.
2. The five-word shingles of each document get ProbMinHash signatures: element
   arrivals of a Poisson process whose rate is the weight fall into random
   registers, the earliest arrival names the register; an element stops as soon
   as its next arrival is later than all registers' (early termination).
   Registers of two documents agree with their probability Jaccard similarity.
   One signature gives every shingle weight 1, as the verified measure counts
   it, so its registers agree with the Jaccard similarity of the sets; a second,
   shorter one weighs a shingle by 1 + log2(its count) and proposes documents
   whose repeated parts are alike.
3. Bands of registers propose buckets. The pairs of a bucket are never
   enumerated:
   a. members of the first bands are verified against their bucket's hub, and
      links form components;
   b. in buckets that still hold several components, members outside the
      largest one are verified against its hub, the member with the most links;
   c. what is left is settled exactly by symmetric differences. If d(x) is the
      difference of x from the hub's set, then x and y differ by
      |d(x)| + |d(y)| - 2 |d(x) & d(y)|, so a pair that is similar enough must
      share a known number of elements of their differences. These are small and
      mostly the documents' own edits: ordered by how often they occur in the
      hub's group, pairs must meet in a short prefix of rare ones, and what
      follows the places where they meet must suffice for the rest, as must the
      parities of the differences' elements in PARITY_WORDS words of bits (an
      odd number in one place is one differing element at least). Pairs that
      pass are verified, each member's most promising ones first; pairs of
      components that these join add nothing to the classes and are left out.
4. Verification is exact: Jaccard similarity of the shingle sets >= 0.8.
5. Linked documents form classes (connected components).

With BANDS x ROWS = 36 x 5 a pair of similarity 0.8 shares a bucket with
probability > 0.9999999 (more similar ones surely).

Defined results: NULL and blank texts are copies of each other; a text of
fewer than five words is one shingle; repeated rows are copies; texts may have
any length; an empty table gives no rows; NULL ids take part, a class's id is
its least id that is not NULL. Other columns are not touched, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.components import connected_components, maybe_in, thin
from tessera.llm.shingles import GOLDEN, list_array, list_parts, mix64, row_chunks, row_sets, shingles, word_hashes
from tessera.llm.text import clean_text, lower_words
from tessera.session import scratch_path
from tessera.sources.tables import fresh_name, read_table

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 36, 5
WEIGHTED_BANDS = 4  # of the signature that weighs repeated shingles more
FIRST_BANDS = 4  # whose buckets make the first components
CHUNK_WORDS, CHUNK_ROWS = 400_000, 4_000
# Classes of members of a hub's group, by difference and by size: ratios of
# neighbouring classes.
DIFFERENCE_STEP, SIZE_STEP = 1.1, 1.15
PARITY_WORDS = 16
PROMISING = 4  # pairs of each member, in either place, that are verified first


def prob_min_hash(row: np.ndarray, key: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """Signatures (rows x registers) of weighted sets given as (row, element,
    weight), sorted by row. Rows without elements keep zeros."""
    first = np.full(rows * registers, np.inf)
    name = np.zeros(rows * registers, np.uint64)
    time = np.zeros(len(row))
    turn = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(row):
            turn += np.uint64(1)
            bits = mix64(key + turn * GOLDEN)
            time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 1.0) / 2.0 ** 53) / weight
            register = (mix64(bits ^ GOLDEN) % np.uint64(registers)).astype(np.int64)
            at = row * registers + register
            np.minimum.at(first, at, time)
            won = first[at] == time
            name[at[won]] = key[won]
            latest = first.reshape(rows, registers).max(axis=1)
            going = time < latest[row]  # later arrivals can change nothing
            row, key, weight, time = row[going], key[going], weight[going], time[going]
    return name.reshape(rows, registers)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        parts = signatures.reshape(len(signatures), bands, rows)
        acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
        for i in range(rows):
            acc = mix64(acc * GOLDEN + parts[:, :, i])
        return acc


def _signatures(batches: Iterator[pa.RecordBatch], bands: int, rows: int, width: int,
                weighted_bands: int = WEIGHTED_BANDS) -> Iterator[pa.RecordBatch]:
    every = bands + weighted_bands
    for batch in batches:
        values, offsets = list_parts(batch.column("hashes"))
        for lo, hi in row_chunks(offsets, CHUNK_WORDS, CHUNK_ROWS):
            part, base = offsets[lo:hi + 1] - offsets[lo], values[offsets[lo]:offsets[hi]]
            row, key, count = row_sets(*shingles(base, part, width))
            keys = band_keys(prob_min_hash(row, key, np.ones(len(key)), hi - lo, bands * rows), bands, rows)
            if weighted_bands:
                more = prob_min_hash(row, mix64(key), 1.0 + np.log2(count), hi - lo, weighted_bands * rows)
                keys = np.concatenate([keys, mix64(band_keys(more, weighted_bands, rows))], axis=1)
            some = np.diff(part) > 0
            ends = np.concatenate([[0], np.cumsum(np.where(some, every, 0))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("digest").slice(lo, hi - lo),
                 list_array(keys[some].reshape(-1).view(np.int64), ends)], names=["doc_id", "digest", "bands"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, offsets = list_parts(batch.column("hashes"))
        for lo, hi in row_chunks(offsets, CHUNK_WORDS, CHUNK_ROWS):
            part, base = offsets[lo:hi + 1] - offsets[lo], values[offsets[lo]:offsets[hi]]
            row, key, _ = row_sets(*shingles(base, part, width))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=hi - lo))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").slice(lo, hi - lo), list_array(key.view(np.int64), ends)], names=["digest", "items"])


def digest(text: str = "text"):
    """Key of a word sequence: equal for exact copies."""
    return F.md5(F.concat_ws(" ", lower_words(clean_text(text))))


def _kept(df: DataFrame, name: str, small: bool = True) -> DataFrame:
    path = scratch_path(df.sparkSession, f"near-{name}")
    (thin(df) if small else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _with_items(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with the sets x of a and y of b. The side b, which
    repeats (hubs), is joined while the rows are still thin."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("digest"))
    sets = maybe_in(sets.select("digest", "items"), "digest", ends)
    for c, out in (("b", "y"), ("a", "x")):
        pairs = pairs.join(sets.select(F.col("digest").alias(c), F.col("items").alias(out)), c)
    return pairs


def _similar(difference: Column, x: Column, y: Column, threshold: float) -> Column:
    """Whether sets of sizes x and y that differ by so many elements have the
    wanted Jaccard similarity."""
    both = ((x + y - difference) / 2).cast("bigint")
    return both / (x + y - both) >= threshold


def _links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose Jaccard similarity reaches the threshold."""
    both = F.size(F.array_intersect("x", "y"))
    found = _with_items(pairs.distinct(), sets)
    return found.filter(both / (F.size("x") + F.size("y") - both) >= threshold).select("a", "b")


def _info(links: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root, size, rep) of all linked nodes: rep is the node of the
    component with the most links."""
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    best = roots.join(degree, "node").groupBy("root").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.struct("degree", F.xxhash64("node").alias("h"), "node"))["node"].alias("rep"))
    return _kept(roots.join(best, "root").select("node", "root", "size", "rep"), "info")


def _mixed(members: DataFrame, info: DataFrame) -> DataFrame:
    """(hub, digest, root, hub_root): members of buckets that hold several
    components, each with the hub of the bucket's largest component (which need
    not stand in the bucket)."""
    alone = F.col("digest")
    labelled = members.join(info.withColumnRenamed("node", "digest"), "digest", "left").select(
        "key", "digest", F.coalesce("root", alone).alias("root"), F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("rep", alone).alias("rep"))
    labelled = _kept(labelled, "labelled", small=False)
    top = labelled.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"),
                                      F.max(F.struct("size", F.xxhash64("root").alias("h"), "root", "rep")).alias("top"))
    top = top.filter("least <> most").select("key", F.col("top.rep").alias("hub"), F.col("top.root").alias("hub_root"))
    found = labelled.join(top, "key").filter("digest <> hub").select("hub", "digest", "root", "hub_root").distinct()
    return _kept(found, "mixed", small=False)


def _classes_of(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(node, root) of the linked documents, from bucket entries (key, band,
    digest) of buckets with at least two members, and (digest, items)."""
    first = members.filter(F.col("band") < FIRST_BANDS)
    place = F.struct(F.xxhash64("digest").alias("h"), "digest")
    hubs = first.groupBy("key").agg(F.min(place)["digest"].alias("b"))
    links = _kept(_links(first.join(hubs, "key").select(F.col("digest").alias("a"), "b").filter("a <> b"), sets, threshold), "links")
    for _ in range(2):  # the second time hardly anything is left
        info = _info(links, connected_components(links))
        outside = _mixed(members, info).filter("root <> hub_root").select(F.col("digest").alias("a"), F.col("hub").alias("b"))
        links = _kept(links.unionByName(_links(outside, sets, threshold)), "links")
    info = _info(links, connected_components(links))
    near = _kept(_by_difference(_mixed(members, info), sets, threshold), "near")
    return connected_components(_kept(links.unionByName(near), "all-links"))


def _by_difference(grouped: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members of different components of each hub's group
    (hub, digest, root, hub_root): all that join components, not all others."""
    kappa = (1 - threshold) / (1 + threshold)  # similar pairs differ by at most this share of their sizes
    pairs = grouped.select(F.col("digest").alias("a"), F.col("hub").alias("b"), "root", "hub_root")
    diff = _with_items(pairs, sets).select(
        F.xxhash64("b").alias("group"), "a", "b", F.xxhash64("root").alias("root"), F.xxhash64("hub_root").alias("hub_root"),
        F.size("x").alias("size"), F.size("y").alias("hub_size"),
        F.concat(F.array_except("x", "y"), F.array_except("y", "x")).alias("d"))
    diff = diff.withColumn("n", F.size("d")).withColumn("linked", _similar(F.col("n"), F.col("size"), F.col("hub_size"), threshold))
    parity = F.expr(f"""transform(sequence(0, {PARITY_WORDS - 1}), w -> aggregate(d, 0L, (bits, t) ->
        if(pmod(shiftright(t, 6), {PARITY_WORDS}) = w, bits ^ shiftleft(1L, cast(t & 63 as int)), bits)))""")
    diff = diff.withColumn("parity", parity)
    diff = _kept(diff.withColumn("id", F.monotonically_increasing_id()), "differences", small=False)  # written: ids are fixed
    joined = diff.filter("linked").select("a", "b")
    outside = diff.filter(~F.col("linked"))
    if not outside.limit(1).count():
        return joined
    # classes of members outside the hub's reach, by their differences and sizes
    step = lambda c, by: F.floor(F.log(F.greatest(F.col(c), F.lit(1)).cast("double")) / F.log(F.lit(by))).cast("int")
    outside = outside.drop("d", "parity").withColumns({"dc": step("n", DIFFERENCE_STEP), "sc": step("size", SIZE_STEP)})
    kinds = outside.groupBy("group", "dc", "sc").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("size").alias("small"),
                                                     F.max("size").alias("large"), F.min("root").alias("r1"), F.max("root").alias("r2"))
    kinds = kinds.groupBy("group").agg(F.collect_list(F.struct("dc", "sc", "least", "most", "small", "large", "r1", "r2")).alias("kinds"))
    size, n = F.col("size"), F.col("n")

    def at_least(shared: Column) -> Column:
        return F.greatest(F.ceil(shared - 1e-9).cast("int"), F.lit(1))

    def needed(k: Column) -> Column:
        return at_least((k["least"] + n - kappa * (F.least(k["large"].cast("double"), size / threshold) + size)) / 2)

    def fits(k: Column) -> Column:
        """Whether a member could resemble one of the class, of another component."""
        return ((needed(k) <= n) & (needed(k) <= k["most"]) & (k["large"] >= threshold * size) & (k["small"] <= size / threshold)
                & ((k["r1"] != F.col("root")) | (k["r2"] != F.col("root"))))

    probes = diff.drop("d", "parity").join(kinds, "group").withColumn("kind", F.explode(F.filter("kinds", fits)))
    probes = _kept(probes.select("group", F.col("kind.dc").alias("dc"), F.col("kind.sc").alias("sc"), F.col("id").alias("v"), "n",
                                 F.col("root").alias("root_v"), needed(F.col("kind")).alias("need")), "probes", small=False)
    index = _kept(outside.join(probes.select("group", "dc", "sc").distinct(), ["group", "dc", "sc"], "left_semi").select(
        "group", "dc", "sc", F.col("id").alias("u"), "n", F.col("root").alias("root_u"),
        at_least(n - kappa * size * (1 + 1 / threshold)).alias("need")), "index", small=False)
    # elements of their differences by how many of them have these; an element
    # that nobody else has only takes a place in the order
    taking_part = probes.select(F.col("v").alias("id")).unionByName(index.select(F.col("u").alias("id"))).distinct()
    tokens = _kept(diff.join(taking_part, "id", "left_semi").select("group", "id", F.explode("d").alias("token")), "tokens", small=False)
    often = tokens.groupBy("group", "token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    ranked = tokens.join(often, ["group", "token"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("ranked"))
    ranked = _kept(ranked, "ranked", small=False)

    def prefix(rows: DataFrame, who: str) -> DataFrame:
        """The rarest elements of each row's member, among which two that share
        ``need`` must meet, without those that nobody else has, and their places
        in the member's order."""
        alone = n - F.size("ranked")
        head = F.slice("ranked", F.lit(1), F.greatest(n - F.col("need") + 1 - alone, F.lit(0)))
        rows = rows.join(ranked.withColumnRenamed("id", who), who).withColumn("alone", alone)
        rows = rows.select("*", F.posexplode(F.transform(head, lambda t: t["token"])).alias("at", "token"))
        return rows.withColumn(f"at_{who}", F.col("at") + F.col("alone")).drop("ranked", "n", "need", "alone", "at")

    met = prefix(index, "u").join(prefix(probes, "v"), ["group", "dc", "sc", "token"])
    met = met.filter("u <> v and root_u <> root_v").groupBy("u", "v").agg(
        F.count(F.lit(1)).alias("shared"), F.max("at_u").alias("at_u"), F.max("at_v").alias("at_v"))
    for who in ("u", "v"):
        met = met.join(diff.select(F.col("id").alias(who), *(F.col(c).alias(f"{c}_{who}") for c in ("a", "n", "size", "root", "parity"))), who)
    # what two share is what met and, at most, all that follows the last place
    most = F.col("shared") + F.least(*(F.col(f"n_{w}") - F.col(f"at_{w}") - 1 for w in ("u", "v")))
    far = kappa * (F.col("size_u") + F.col("size_v"))
    odd = F.expr("aggregate(zip_with(parity_u, parity_v, (x, y) -> bit_count(x ^ y)), 0, (sum, n) -> sum + n)")
    ends = [F.struct(F.col(f"a_{w}").alias("a"), F.col(f"root_{w}").alias("r")) for w in ("u", "v")]
    met = met.filter(most >= at_least((F.col("n_u") + F.col("n_v") - far) / 2)).withColumn("hope", 1 - odd / far)
    met = met.filter("hope >= -1e-9").withColumns({"x": F.least(*ends), "y": F.greatest(*ends)})
    met = met.groupBy(F.col("x.a").alias("a"), F.col("y.a").alias("b"), F.col("x.r").alias("root_a"), F.col("y.r").alias("root_b")).agg(
        F.max("hope").alias("hope"))
    found = _joining(_kept(met, "met"), diff.filter("linked").select(F.col("root").alias("a"), F.col("hub_root").alias("b")), sets, threshold)
    return joined.unionByName(found)


def _joining(met: DataFrame, joined: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links among the pairs met (a, b, root_a, root_b, hope) that join
    components; ``joined`` (a, b) are roots whose components are joined already.
    Each member's most promising pairs are verified first, then those of the
    rest that still lie between different components."""
    def best(end: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(end).orderBy(F.desc("hope"), "a", "b"))
        return met.withColumn("nth", nth).filter(F.col("nth") <= PROMISING).select("a", "b")

    first = _kept(best("a").unionByName(best("b")).distinct(), "promising")
    links = _kept(_links(first, sets, threshold), "promised")
    again = met.join(links, ["a", "b"], "left_semi").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    roots = connected_components(again.unionByName(joined).distinct())
    rest = met.join(first, ["a", "b"], "left_anti")
    for end in ("root_a", "root_b"):
        rest = rest.join(roots.toDF(end, f"{end}_now"), end, "left").withColumn(f"{end}_now", F.coalesce(f"{end}_now", end))
    rest = _kept(rest.filter("root_a_now <> root_b_now").select("a", "b"), "rest")
    return links.unionByName(_links(rest, sets, threshold))


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
            width: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows, map): doc_id and digest of every row, and for every digest its
    class: digest, class_id, class_size, keep (the digest of the class's row
    to keep) and repeats (rows that repeat the kept id and digest)."""
    docs = docs.select("doc_id", clean_text("text").alias("text"))
    words = docs.withColumn("w", lower_words(F.col("text")))  # used twice, cut once
    hashed = words.select("doc_id", F.md5(F.concat_ws(" ", "w")).alias("digest"),
                          F.transform("w", lambda v: F.xxhash64(v)).alias("hashes"))
    docs = docs.withColumn("digest", digest())
    sig = _kept(hashed.mapInArrow(lambda it: _signatures(it, bands, rows, width),
                                  "doc_id bigint, digest string, bands array<bigint>"), "signatures", small=False)
    reps = _kept(sig.groupBy("digest").agg(F.min("doc_id").alias("rep_id"), F.count("*").alias("n"),
                                           F.first("bands").alias("bands")), "reps", small=False)
    entries = reps.select("digest", "rep_id", F.posexplode("bands").alias("band", "key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = _kept(entries.join(shared, "key"), "members", small=False)
    needed = _kept(members.select(F.col("digest").alias("d2"), "rep_id").distinct(), "needed")
    texts = maybe_in(docs, "digest", needed.select(F.col("d2").alias("digest"))).join(
        needed, (F.col("digest") == F.col("d2")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
    texts = texts.dropDuplicates(["digest", "doc_id"])  # rows may repeat id and text
    sets = texts.select("digest", word_hashes(F.col("text")).alias("hashes")).mapInArrow(
        lambda it: _sets(it, width), "digest string, items array<bigint>")
    roots = _classes_of(members.select("key", "band", "digest"), _kept(sets, "sets", small=False), threshold)
    merged = reps.select("digest", "rep_id", "n").join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    merged = _kept(merged.withColumn("root", F.coalesce("root", "digest")), "merged")
    least = F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "digest"))
    by_class = merged.groupBy("root").agg(least.alias("keep"), F.sum("n").alias("class_size"))
    by_class = by_class.select("root", F.col("keep.rep_id").alias("class_id"), F.col("keep.digest").alias("keep"), "class_size")
    return sig.select("doc_id", "digest"), _kept(merged.join(by_class, "root").select("digest", "class_id", "class_size", "keep"), "map")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: the one of its least id."""
    rows, found = classes(docs, threshold)
    names: list[str] = []
    for wanted in ("own_digest", "kept_digest", "kept_id", "nth"):  # that no column of docs has
        names.append(fresh_name([*docs.columns, *names], wanted))
    own, kept, kept_id, nth = names
    keep = found.filter(F.col("digest") == F.col("keep")).select(F.col("digest").alias(kept), F.col("class_id").alias(kept_id))
    again = rows.join(keep, (F.col("digest") == F.col(kept)) & F.col("doc_id").eqNullSafe(F.col(kept_id)))
    repeated = again.groupBy("digest").count().filter("count > 1").limit(1).count() > 0
    out = docs.withColumn(own, digest()).join(keep, (F.col(own) == F.col(kept)) & F.col("doc_id").eqNullSafe(F.col(kept_id)))
    if repeated:
        w = Window.partitionBy(own, kept_id).orderBy(F.lit(0))
        out = out.withColumn(nth, F.row_number().over(w)).filter(F.col(nth) == 1)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class (the least id of its near duplicates)."""
    rows, found = classes(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.join(found.drop("keep"), "digest").select("doc_id", "class_id", "class_size")
