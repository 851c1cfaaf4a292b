"""Chapters and sections of codes, from the code ranges in their descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetree.functions.codes import prefix
from codetree.functions.text import trim_ws
from codetree.operators.ordered import fill_down, last_per_group, number_rows
from codetree.staging import stage


def range_endpoints(df: DataFrame, name: str) -> DataFrame:
    """(year, category, ord, pos, name, name_desc) for each end of a range text.

    ``df`` is (year, ord, desc); the range is what the last parentheses hold.
    """
    text = F.regexp_replace("desc", r".*\(|\)", "")
    return df.select("year", "ord", text.alias(name), F.col("desc").alias(f"{name}_desc")).select(
        "year",
        "ord",
        F.posexplode(F.split(name, "[^0-9A-Za-z.]+")).alias("pos", "category"),
        trim_ws(F.col(name)).alias(name),
        trim_ws(F.col(f"{name}_desc")).alias(f"{name}_desc"),
    )


def range_assign(codes: DataFrame, chapters: DataFrame, sections: DataFrame) -> DataFrame:
    """Give every code the chapter and section that was opened last before it.

    A range counts only where the category at one of its ends has codes; rows
    then inherit in code order. Sections that share an end: the last one in the
    document holds. Chapters that share an end repeat the codes of that category.
    """
    chapter = range_endpoints(chapters, "chapter").withColumn("_at", F.struct("ord", "pos"))
    section = last_per_group(range_endpoints(sections, "section"), ["year", "category"], ["ord", "pos"])
    opened = codes.join(chapter.drop("ord", "pos"), ["year", "category"], "left").join(
        section.drop("ord", "pos"), ["year", "category"], "left"
    )
    filled = fill_down(
        opened,
        ["chapter", "chapter_desc", "section", "section_desc"],
        order_by=["icd10_code", "_at"],
        by=["year"],
        bucket=prefix(F.col("icd10_code"), 5),
    )
    return filled.select(*codes.columns, "chapter", "chapter_desc", "section", "section_desc")


# Places per block, blocks per larger block, and so on.
FAN = 8


def _placed(codes: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Codes with their ``place`` and ranges with theirs from ``low`` to ``high``, in one order of codes and ends.

    Ranges that begin alike stand in the order in which they hold less: the later end first, then
    document order. So of the ranges round a code the narrowest is the one with the highest ``low``.
    """
    ends = ranges.select(
        "year", "_range", "last", "ord", "id",
        F.explode(F.array(
            F.struct(F.col("first").alias("value"), F.lit(0).alias("kind")),
            F.struct(F.col("last").alias("value"), F.lit(2).alias("kind")),
        )).alias("end"),
    ).select("year", "end.*", "_range", F.when(F.col("end.kind") == 0, F.col("last")).alias("last"), "ord", "id")
    stacked = ends.unionByName(codes.select("year", F.col("code").alias("value"), F.lit(1).alias("kind")), allowMissingColumns=True)
    order = ["year", "value", "kind", F.desc("last"), "ord", F.desc("id"), "_range"]
    placed = stage(number_rows(stacked, order, "place").select("year", "value", "kind", "_range", "place"), "places")
    spans = placed.filter("kind <> 1").groupBy("_range").agg(
        F.min(F.when(F.col("kind") == 0, F.col("place"))).alias("low"), F.max(F.when(F.col("kind") == 2, F.col("place"))).alias("high")
    )
    return placed.filter("kind = 1").select("year", F.col("value").alias("code"), "place"), spans


def _blocks(spans: DataFrame, level: int, top: int) -> DataFrame:
    """(block, best): the blocks of a level that lie inside a range, but in no larger block that does; the best range of each."""
    size = FAN**level
    first = F.ceil((F.col("low") + 1) / F.lit(size))
    end = F.floor(F.col("high") / F.lit(size))
    wide_first = F.ceil((F.col("low") + 1) / F.lit(size * FAN)) * FAN
    wide_end = F.floor(F.col("high") / F.lit(size * FAN)) * FAN
    has_wide = (wide_first < wide_end) if level < top else F.lit(False)

    def run(low: Column, high: Column) -> Column:
        return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))

    parts = F.when(has_wide, F.concat(run(first, wide_first), run(wide_end, end))).otherwise(run(first, end))
    own = spans.select("low", "_range", F.explode(parts).alias("block"))
    return own.groupBy("block").agg(F.max(F.struct("low", "_range")).alias("best"))


def range_assign_interval(codes: DataFrame, ranges: DataFrame, code: str = "category") -> DataFrame:
    """Assign each code, of any length, to the narrowest range that contains it.

    ``ranges`` is (year, ord, id, first, last). The narrowest is the one with the latest start, then the earliest
    end, then the last in document order (of several with one ``ord``, the smallest ``id``). Ranges that
    end before they start hold nothing, null codes are in none.

    Distinct codes and the ends of ranges get places in one common order, and a range covers a run of
    places. Places are cut into blocks of 8, these into blocks of 64, and so on; a range is cut into the largest blocks that
    it covers, at most 14 of each size, and a block keeps only its best range. From the
    largest blocks down, each block then hands its best range to the 8 inside it. So the work is (ranges + codes) times
    the number of sizes, which grows with the logarithm; no code meets a range but its own, and no block is met by more than 8.
    """
    kept = ranges.filter(F.col("first") <= F.col("last")).withColumn("_range", F.monotonically_increasing_id())
    kept = stage(kept.select("year", "ord", "id", "first", "last", "_range"), "ranges")
    distinct = codes.select("year", F.col(code).alias("code")).dropna().distinct()
    places, spans = _placed(distinct, kept)
    spans = stage(spans, "spans")
    total = places.agg(F.max("place")).first()[0] or 0
    top = 0
    while FAN ** (top + 1) <= total + 1:
        top += 1
    best = _blocks(spans, top, top)
    for level in range(top - 1, -1, -1):
        handed = best.select(
            F.explode(F.sequence(F.col("block") * FAN, F.col("block") * FAN + (FAN - 1))).alias("block"), "best"
        )
        best = _blocks(spans, level, top).unionByName(handed).groupBy("block").agg(F.max("best").alias("best"))
    found = (
        places.join(best.withColumnRenamed("block", "place"), "place")
        .select("year", F.col("code").alias(code), F.col("best._range").alias("_range"))
        .join(kept.select("_range", "id", "first", "last"), "_range")
        .drop("_range")
    )
    return codes.join(found, ["year", code], "left")
