"""Deterministic per-row randomness.

``randomSplit``/``sample`` draw from a per-partition generator, so the same
seed gives different rows when the input layout changes (and after an
executor is lost and a partition is recomputed from a differently ordered
shuffle). Hashing a business key instead gives the same uniform number for
the same row everywhere, and the formula is portable to plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def key_text(*cols: str | Column) -> Column:
    """Text form of a (possibly composite) key: values joined with '|'. Never
    NULL, so a row with a NULL key still gets a draw (and a split)."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.coalesce(text, F.lit(""))


def uniform(*cols: str | Column, seed: int = 123) -> Column:
    """u(key, seed) in [0, 1): first 32 bits of md5('<key>:<seed>')."""
    digest = F.md5(F.concat(key_text(*cols), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)

