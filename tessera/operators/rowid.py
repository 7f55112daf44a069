"""Row ids that do not depend on where a row happens to lie.

``monotonically_increasing_id`` numbers rows by partition, so a plan that is
computed again, or on another cluster, gives other ids, and a join on them pairs
the wrong rows. An id here is the hash of all of the row's columns and an
ordinal among the rows of that hash. Rows that are equal in every column are
interchangeable, so a table is reduced to its different rows with their counts
(map-side first: a row that makes up a third of the table is one row a task)
and written out again from the counts, each copy with its own ordinal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir
from tessera.sources.tables import fresh_name

# Copies of one row that a task writes out.
COPIES_PER_TASK = 100_000


def stable_ids(df: DataFrame, hash_col: str = "row_hash", nth_col: str = "row_nth", copies: int = COPIES_PER_TASK) -> DataFrame:
    """Add ``hash_col`` (64 bits) and ``nth_col`` (from 0): together they are
    unique, and the same for the same rows whatever the layout. Different rows
    that share a hash (about n^2 / 2^65 of them) take successive ordinals in the
    order of their columns. One shuffle of the different rows on all columns, one
    on the hash; columns must be of comparable types. Joins with the result are
    merge joins unless the caller asks for another kind: what the planner knows
    is the size of the different rows, however many copies they stand for."""
    taken = [c for c in (hash_col, nth_col) if c in df.columns]
    if taken:
        raise ValueError(f"columns exist already: {taken}")
    ensure_checkpoint_dir(df.sparkSession)
    names = df.columns
    n, before, start = (fresh_name([*names, hash_col, nth_col], c) for c in ("copies", "before", "start"))
    rows = df.groupBy(*names).agg(F.count(F.lit(1)).alias(n)).withColumn(hash_col, F.xxhash64(*names))
    same_hash = Window.partitionBy(hash_col).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(before, F.coalesce(F.sum(n).over(same_hash), F.lit(0))).checkpoint(eager=True)
    most, total, different = rows.agg(F.max(n), F.sum(n), F.count(F.lit(1))).first()
    parts = rows.withColumn(start, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1, F.lit(copies).cast("bigint"))))
    if different and (most > copies or total > max(copies, 10 * different)):
        # deal the parts of common rows to different tasks; they are few and
        # small until they are written out, so the number of tasks is stated
        parts = parts.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), hash_col, start)
    last = F.least(F.col(start) + copies, F.col(n)) - 1
    out = parts.withColumn(nth_col, F.explode(F.sequence(F.col(start) + F.col(before), last + F.col(before))))
    return out.select(*names, hash_col, nth_col).hint("merge")
