"""Checks on finished code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetree.functions.codes import insert_dot


def code_quality(df: DataFrame, by: Sequence[str], code: str = "icd10_code") -> DataFrame:
    """Rows, distinct codes and surplus rows per group.

    Codes are counted first, so the distinct count is an aggregate over one row
    per code instead of a set per group.
    """
    per_code = df.groupBy(*by, code).agg(F.count(F.lit(1)).alias("_rows"))
    return per_code.groupBy(*by).agg(
        F.sum("_rows").alias("n"),
        F.count(F.lit(1)).alias("n_codes"),
        (F.sum("_rows") - F.count(F.lit(1))).alias("dupes"),
    )


def coverage_gap(official: DataFrame, built: DataFrame, pattern: str | None = None) -> DataFrame:
    """Official codes, given without a dot, that the built table lacks.

    ``official`` is (icd10_code, description), ``built`` has icd10_code.
    """
    dotted = official.withColumn("icd10_code", insert_dot(F.col("icd10_code")))
    if pattern is not None:
        dotted = dotted.filter(F.col("icd10_code").rlike(pattern))
    return dotted.join(built.select("icd10_code").distinct(), "icd10_code", "left_anti")
