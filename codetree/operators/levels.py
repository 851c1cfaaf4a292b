"""Level tables of a release and their assembly into one row per leaf code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetree.functions.ascii import ascii_lower
from codetree.functions.codes import dotless_length, parent_code, prefix

# (characters without the dot, level, level above), longest first.
LEVELS = (
    (7, "extension", "subcategory_3"),
    (6, "subcategory_3", "subcategory_2"),
    (5, "subcategory_2", "subcategory_1"),
    (4, "subcategory_1", "category"),
    (3, "category", "supercategory"),
)

# Levels that name a code of their own, from the top.
PARENTS = ("category", "subcategory_1", "subcategory_2", "subcategory_3")


def code_levels(nodes: DataFrame) -> DataFrame:
    """(year, level, code, desc, parent) of every node that counts for a level.

    The level is the length of the code; a node nested too shallowly for its
    length belongs to no level.
    """
    length = dotless_length(F.col("code"))
    names = F.create_map(*[F.lit(x) for n, title, _ in LEVELS for x in (n, title)])
    return nodes.filter(length.between(3, 7) & (F.col("depth") >= length - 2)).select(
        "year",
        F.element_at(names, length).alias("level"),
        "code",
        "desc",
        parent_code(F.col("code")).alias("parent"),
    )


def _level_table(levels: DataFrame, title: str, above: str) -> DataFrame:
    return levels.filter(F.col("level") == title).select(
        "year",
        F.col("code").alias(title),
        F.col("desc").alias(f"{title}_desc"),
        F.col("parent").alias(above),
    )


def leaf_table(nodes: DataFrame) -> DataFrame:
    """One row per leaf code with its ancestors, descriptions in lower-case ASCII.

    A code whose parent is missing stays as a row without ancestors.
    """
    plain = F.when(F.col("level") == "extension", F.col("desc")).otherwise(ascii_lower(F.col("desc")))
    levels = code_levels(nodes).withColumn("desc", plain)
    tables = [(_level_table(levels, title, above), title) for _, title, above in LEVELS]
    joined = reduce(
        lambda left, right: (left[0].join(right[0], ["year", right[1]], "full"), right[1]), tables
    )[0]
    code = F.coalesce(*[F.col(title) for _, title, _ in LEVELS])
    columns = [c for level in (*PARENTS, "extension") for c in (level, f"{level}_desc")]
    return joined.select("year", code.alias("icd10_code"), *columns)


def char_positions(df: DataFrame, code: str = "code") -> DataFrame:
    """Add the single characters of a dotted code and its prefixes."""
    c = F.col(code)
    singles = {"C1": 1, "N1": 2, "N2": 3, "D1": 5, "D2": 6, "D3": 7, "D4": 8}
    return df.withColumns(
        {
            **{name: F.substring(c, at, 1) for name, at in singles.items()},
            "code_3": prefix(c, 3),
            **{f"code_{n}": prefix(c, n) for n in (5, 6, 7, 8)},
        }
    )
