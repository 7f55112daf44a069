"""Profiling and cleaning of all-string tables (claims-style inputs).

Everything is one projection or one aggregate over the table: the null
profile of N columns is a single pass (not N count jobs), casts are
``try_cast`` so text in a numeric column becomes NULL instead of failing
the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The category written for a missing value, and the claims
# column families of the two-part claim model.
MISSING_CATEGORY = "ZZZ"
CLAIM_TARGET = "Claim_Amount"
INT_CATEGORIES = ["Calendar_Year", "OrdCat"]
NUMERIC_FEATURES = [f"Var{i}" for i in range(1, 9)]
STRING_CATEGORIES = [f"Cat{i}" for i in range(1, 13)] + ["NVCat"]
LARGE_CATEGORIES = ["Blind_Submodel", "Model_Year"]


def columns_of(df: DataFrame, wanted: list[str], optional: tuple[str, ...] = ()) -> list[str]:
    """The wanted columns, in order. A missing one is an error unless it is
    listed as ``optional``: a misspelt header must not shrink a model."""
    have = set(df.columns)
    missing = [c for c in wanted if c not in have and c not in optional]
    if missing:
        raise ValueError(f"columns missing from the table: {missing}")
    return [c for c in wanted if c in have]


def dropped_columns(df: DataFrame, kept: list[str]) -> list[str]:
    """Columns of the source that a projection to ``kept`` leaves out."""
    keep = set(kept)
    return [c for c in df.columns if c not in keep]


def dropped_profile(df: DataFrame, kept: list[str]) -> DataFrame:
    """(column_name, n_values): each column a projection to ``kept`` leaves
    out, with how many non-NULL values it held (one aggregate pass)."""
    dropped = dropped_columns(df, kept)
    if not dropped:
        return df.sparkSession.createDataFrame([], "column_name string, n_values bigint")
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in dropped])
    return counts.unpivot([], dropped, "column_name", "n_values")


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, n_null) for every column, in one aggregate pass."""
    cols = cols or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "n_null")


def fill_missing_category(df: DataFrame, cols: list[str], sentinel: str = MISSING_CATEGORY) -> DataFrame:
    """NULL -> sentinel in the given string columns (one projection)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(sentinel)) for c in cols})


def to_double_or_zero(col: str) -> F.Column:
    """Text -> double; NULL or unparseable text -> 0.0."""
    return F.coalesce(F.col(col).try_cast("double"), F.lit(0.0))


def claim_indicator(amount: str = CLAIM_TARGET) -> F.Column:
    """1.0 for a non-zero amount, else 0.0 (double, like the amount)."""
    return (F.col(amount) != 0).cast("double")


def clean_claims(raw: DataFrame, key: list[str], int_categories: list[str], numeric: list[str],
                 categorical: list[str], target: str = CLAIM_TARGET) -> DataFrame:
    """Key columns, numeric columns as doubles (NULL/text -> 0), categorical
    columns as text with NULL -> sentinel, target as double (NULL -> 0)
    and the binary target ``y``."""
    num = int_categories + numeric
    out = raw.select(
        *key,
        *[to_double_or_zero(c).alias(c) for c in num],
        *[F.coalesce(F.col(c), F.lit(MISSING_CATEGORY)).alias(c) for c in categorical],
        to_double_or_zero(target).alias(target),
    )
    return out.withColumn("y", claim_indicator(target))


def class_balance(df: DataFrame, predicted: str | F.Column, actual: str | F.Column) -> DataFrame:
    """Predicted ones, actual ones and all rows, in one pass."""
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    a = F.col(actual) if isinstance(actual, str) else actual
    return df.agg(F.count_if(p).alias("predicted_ones"),
                  F.count_if(a).alias("actual_ones"),
                  F.count(F.lit(1)).alias("n_rows"))
