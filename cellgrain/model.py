"""Checks and small helpers that all operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def need(df: DataFrame, *names: str) -> DataFrame:
    """``df``; ValueError names the columns that it lacks."""
    if lacking := [x for x in names if x not in df.columns]:
        raise ValueError(f"missing columns {lacking}; there are {df.columns}")
    return df


def first_of(df: DataFrame, *names: str | None) -> str | None:
    """The first of the names that is a column: a fallback chain, settled when the plan is made."""
    return next((x for x in names if x and x in df.columns), None)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null: such a row fails every filter."""
    return F.when(b != 0, a / b)


def hash_rank(*parts: Column | str, seed: int = 42) -> Column:
    """A text that shuffles rows the same way in every run: the digest of the parts and the seed."""
    return F.md5(F.concat_ws(":", *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts), F.lit(str(seed))))


def hash_int(text: Column) -> Column:
    """The first 32 bits of a text's digest."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
