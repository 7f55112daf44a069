"""Deterministic splits, samples and folds from a hash of a business key.

Every row's draw is ``u(key, seed)`` (see ``functions.hashing``), so a split
is a filter on a column expression: no shuffle, no sort, no dependence on
partition layout or retries, and train/test are disjoint and exhaustive by
construction. Stratification comes for free: the draw is independent of the
stratum, so every stratum is split in the same proportion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform

TRAIN, TEST = "train", "test"


def hash_split(df: DataFrame, key: list[str], train_fraction: float = 0.7,
               seed: int = 123, out: str = "split") -> DataFrame:
    """Add ``split`` = 'train' for u(key) < train_fraction, else 'test'."""
    return df.withColumn(out, F.when(uniform(*key, seed=seed) < train_fraction, F.lit(TRAIN))
                         .otherwise(F.lit(TEST)))


def in_train(key: list[str], train_fraction: float = 0.7, seed: int = 123) -> Column:
    """The draw of ``train_test``; it is never NULL."""
    return uniform(*key, seed=seed) < train_fraction


def train_test(df: DataFrame, key: list[str], train_fraction: float = 0.7,
               seed: int = 123) -> tuple[DataFrame, DataFrame]:
    """(train, test): two filters on the same draw, disjoint and exhaustive."""
    train = in_train(key, train_fraction, seed)
    return df.filter(train), df.filter(~train)


def stratified_split(df: DataFrame, key: list[str], stratum: str, train_fraction: float = 0.7,
                     seed: int = 123, out: str = "split") -> DataFrame:
    """Split each stratum train/test in the same proportion (one pass; the
    strata are never separated and re-unioned)."""
    return hash_split(df, key + [stratum], train_fraction, seed, out)


def hash_sample(df: DataFrame, key: list[str], fraction: float, seed: int = 123) -> DataFrame:
    """Rows with u(key) < fraction: a repeatable Bernoulli sample."""
    return df.filter(uniform(*key, seed=seed) < fraction)


def assign_folds(df: DataFrame, key: list[str], k: int = 3, seed: int = 123,
                 out: str = "fold") -> DataFrame:
    """Add ``fold`` in 1..k with equal probability."""
    return df.withColumn(out, (F.floor(uniform(*key, seed=seed) * k) + 1).cast("int"))


def fold_train_test(df: DataFrame, fold: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Training rows (all other folds) and test rows of one fold: two filters
    over the same input instead of a union of the other folds."""
    return df.filter(F.col(fold_col) != fold), df.filter(F.col(fold_col) == fold)
