"""Adaptive prefix roll-up: shorten codes until each group is large enough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetree.functions.codes import join_null_safe, prefix
from codetree.staging import stage

# Long codes climb in parts, so that no plan grows with their length.
_STEPS_PER_STAGE = 8


def rollup_map(
    df: DataFrame,
    field: str = "field",
    threshold: int = 20,
    min_len: int = 3,
    max_len: int | None = None,
    by: Sequence[str] = (),
    strip_dot: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """(by, field, rows, shorten, n) per distinct code; a staged table.

    From the longest prefix down, a prefix with at least ``threshold`` rows that
    no longer prefix has claimed becomes a group; whatever is left at
    ``min_len`` becomes one as well. ``n`` counts the claimed rows. Null codes
    are dropped; null ``by`` keys are groups of their own. Where all codes are shorter than
    ``min_len`` the result is empty. ``max_len`` is the length of the longest code; it is looked up
    when not given. ``weight`` names a column with the rows each input row
    stands for, when rows have been counted before.

    Rows are counted per code once. The counts of unclaimed prefixes then climb
    one character at a time, so a group never holds more rows than there are
    characters, and a code finds its group by joining its own prefixes.
    """
    keys = list(by)
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = stage(
        df.filter(F.col(field).isNotNull())
        .groupBy(*keys, F.col(field).alias("field"))
        .agg(size.alias("rows")),
        "code-counts",
    )
    if max_len is None:
        max_len = counts.agg(F.max(F.length("field"))).first()[0] or 0
    if max_len < min_len:
        empty = counts.limit(0).withColumns({"shorten": F.lit(""), "n": F.lit(0).cast("long")})
        return empty
    lengths = range(max_len, min_len - 1, -1)
    # One table climbs: a prefix is cut until a length claims it, and keeps that length.
    state = counts.select(
        *keys, F.col("field").alias("shorten"), F.col("rows").alias("n"), F.lit(None).cast("int").alias("length")
    )
    for step, length in enumerate(lengths, 1):
        shorter = F.when(F.col("length").isNull(), prefix(F.col("shorten"), length)).otherwise(F.col("shorten"))
        large = F.col("n") >= (threshold if length > min_len else 0)
        state = (
            state.groupBy(*keys, shorter.alias("shorten"), "length")
            .agg(F.sum("n").alias("n"))
            .withColumn("length", F.coalesce("length", F.when(large, F.lit(length))))
        )
        if step % _STEPS_PER_STAGE == 0:
            state = stage(state, "prefixes")

    steps = F.array(*[F.lit(n) for n in lengths]) if len(lengths) == 1 else F.sequence(F.lit(max_len), F.lit(min_len))
    candidates = counts.select("*", F.explode(steps).alias("length")).withColumn(
        "shorten", F.substring("field", F.lit(1), F.col("length"))
    )
    group = F.max_by(F.struct("shorten", "n"), "length").alias("group")
    mapped = (
        join_null_safe(candidates, state, [*keys, "length", "shorten"])
        .groupBy(*keys, "field", "rows")
        .agg(group)
        .select(*keys, "field", "rows", "group.*")
    )
    if strip_dot:
        mapped = mapped.withColumn("shorten", F.regexp_replace("shorten", r"\.$", ""))
    return stage(mapped, "rollup")


def prefix_rollup(
    df: DataFrame, field: str = "field", threshold: int = 20, by: Sequence[str] = (), **options
) -> DataFrame:
    """(by, field, shorten, n), one row per input row with a code."""
    groups = rollup_map(df, field, threshold, by=by, **options).drop("rows")
    return join_null_safe(df.select(*by, F.col(field).alias("field")), groups, [*by, "field"])


def rollup_enrich(
    df: DataFrame,
    field: str = "field",
    subject: str = "custkey",
    day: str = "day",
    threshold: int = 20,
    by: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Facts per rolled-up group, of each ``by`` if given: rows, distinct subjects, first and last day.

    Facts are read once and shrink to one row per code and subject. The roll-up
    counts from there, and no code, however frequent, has to be moved row by row.
    """
    per_subject = stage(
        df.filter(F.col(field).isNotNull())
        .groupBy(*by, F.col(field).alias("field"), F.col(subject).alias("subject"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(day).alias("first"), F.max(day).alias("last")),
        "subjects",
    )
    groups = rollup_map(per_subject, threshold=threshold, by=by, weight="rows", **options)
    per_group_subject = (
        join_null_safe(per_subject, groups.select(*by, "field", "shorten"), [*by, "field"])
        .groupBy(*by, "shorten", "subject")
        .agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return per_group_subject.groupBy(*by, "shorten").agg(
        F.sum("rows").alias("n_rows"),
        F.count("subject").alias("n_subjects"),
        F.min("first").alias("first_day"),
        F.max("last").alias("last_day"),
    )


def rollup_profile(rolled: DataFrame) -> DataFrame:
    """Rows per first letter and length of the rolled-up code, with the letter's total.

    ``rolled`` is a roll-up map: (field, rows, shorten, n).
    """
    profile = rolled.groupBy(
        prefix(F.col("field"), 1).alias("start"), F.length("shorten").alias("nchar")
    ).agg(F.sum("rows").alias("n"))
    totals = profile.groupBy("start").agg(F.sum("n").alias("start_total"))
    return profile.join(totals, "start").orderBy(F.desc("start_total"), "start", "nchar")
