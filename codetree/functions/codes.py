"""Column helpers for code strings such as ``S42.271A``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dotless_length(code: Column) -> Column:
    """Length of the code without its first dot."""
    return F.length(code) - F.contains(code, F.lit(".")).cast("int")


def parent_code(code: Column) -> Column:
    """The code without its last character and without a dot left at the end."""
    return F.regexp_replace(F.substring(code, F.lit(1), F.length(code) - 1), r"\.$", "")


def insert_dot(code: Column) -> Column:
    """Dot after the third character of codes longer than three."""
    return F.regexp_replace(code, "^(.{3})(.+)$", "$1.$2")


def pad_code(code: Column, width: int = 7, filler: str = "X") -> Column:
    """Right-pad to ``width``; longer codes stay whole, where plain ``rpad`` would cut them."""
    return F.rpad(code, F.greatest(F.lit(width), F.length(code)), F.lit(filler))


def prefix(code: Column, n: int) -> Column:
    return F.substring(code, 1, n)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the keys come out once, from the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])
