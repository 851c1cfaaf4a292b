"""The hierarchy table of all years, from nodes and rules to the finished rows."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetree.functions.text import trim_ws, word_diff
from codetree.operators.levels import PARENTS, leaf_table
from codetree.operators.ranges import range_assign
from codetree.operators.rules import apply_rules, distinct_rules, rule_mentions
from codetree.sources import incremental
from codetree.sources import tabular_xml as xml
from codetree.sources.files import write_hierarchy
from codetree.staging import stage

LEVEL_COLUMNS = [c for p in PARENTS for c in (p, f"{p}_desc")]
DIFFS = ["subcategory_1_diff", "subcategory_2_diff", "subcategory_3_diff"]
RANGE_COLUMNS = ["chapter", "chapter_desc", "section", "section_desc"]
OUTPUT = [
    "icd10_code", "description", *RANGE_COLUMNS, *LEVEL_COLUMNS, "extension", "extension_desc",
    *DIFFS, "year", "derived_code_ind", "update_date",
]


def level_texts(leaves: DataFrame, missing: str = "na") -> DataFrame:
    """Add what depends on the levels alone, before rules multiply the rows.

    The words each level's description has over the level above, and the deepest
    description as ``level_desc``. ``missing`` stands in for a code without
    described ancestors. Level descriptions are trimmed after they were used.
    """
    diffs = {
        f"{low}_diff": word_diff(F.col(f"{low}_desc"), F.col(f"{high}_desc"))
        for high, low in zip(PARENTS, PARENTS[1:])
    }
    deepest = F.coalesce(*[F.col(f"{p}_desc") for p in reversed(PARENTS)], F.lit(missing))
    trimmed = {f"{p}_desc": trim_ws(F.col(f"{p}_desc")) for p in PARENTS}
    return leaves.withColumns({**diffs, "level_desc": deepest, **trimmed})


def describe(assigned: DataFrame) -> DataFrame:
    """Add the description, lower case: the level's and the 7th character's; trim the rest."""
    text = F.concat("level_desc", F.lit(" "), F.coalesce("extension_desc", F.lit("")))
    full = assigned.withColumn("description", F.lower(text))
    raw = ["icd10_code", "description", *PARENTS, "extension", "extension_desc"]
    return full.select(
        "year", *[trim_ws(F.col(c)).alias(c) if c in raw else c for c in OUTPUT if c in full.columns and c != "year"]
    )


def derived_parents(built: DataFrame) -> DataFrame:
    """Codes that only occur as an ancestor, as rows of their own; columns below their level stay empty.

    Ancestors are made distinct from the bottom up: what differs in the 7th character alone becomes one row
    first, the level above is taken from those rows, and so on. So built rows are shuffled
    once, without their codes, and every level works on the few rows of the one below, which are staged so
    that the levels above do not make them again. A row whose parent is empty offers nothing, but its other levels may.
    """
    levels = [[c for c in (p, f"{p}_desc", f"{p}_diff") if c in built.columns] for p in PARENTS]
    own = {"icd10_code", "description", "extension", "extension_desc", *(c for level in levels for c in level)}
    shared = [c for c in built.columns if c not in own]
    types = {f.name: f.dataType for f in built.schema}
    rows, offered = built, []
    for depth in reversed(range(len(PARENTS))):
        kept = [*shared, *(c for level in levels[: depth + 1] for c in level)]
        rows = stage(rows.select(kept).distinct(), f"parents-{depth}")
        values = {"icd10_code": F.col(PARENTS[depth]), "description": F.col(f"{PARENTS[depth]}_desc")}
        values |= {c: F.lit(None).cast(types[c]) for c in built.columns if c not in kept and c not in values}
        offered.append(rows.filter(F.col(PARENTS[depth]).isNotNull()).select(*[values.get(c, F.col(c)).alias(c) for c in built.columns]))
    missing = reduce(DataFrame.unionAll, offered).join(
        built.select("year", "icd10_code").distinct(), ["year", "icd10_code"], "left_anti"
    )
    return missing.withColumns(
        {c: F.regexp_replace(c, ",$", "") for c in built.columns if "desc" in c}
    ).select(*built.columns)


def hierarchy(
    nodes: DataFrame,
    chapters: DataFrame,
    sections: DataFrame,
    rules: DataFrame,
    update_date: date | None = None,
    missing: str = "na",
) -> DataFrame:
    """The finished table for every year at once.

    ``nodes`` is (year, depth, code, desc), ``chapters`` and ``sections`` are
    (year, ord, desc), ``rules`` is (year, ord, name, note, char, text).
    """
    # A code given twice in the same words counts once.
    nodes = stage(nodes.groupBy("year", "code", "desc").agg(F.max("depth").alias("depth")), "nodes")
    # Descriptions that differ only in case or accents have become equal.
    leaves = stage(level_texts(leaf_table(nodes), missing).distinct(), "leaves")
    extended = stage(apply_rules(leaves, rule_mentions(distinct_rules(rules)), unique_leaves=True), "extended")
    built = stage(describe(range_assign(extended, chapters, sections)), "built")
    day = F.current_date() if update_date is None else F.lit(update_date)
    return (
        built.withColumn("derived_code_ind", F.lit(0))
        .unionByName(derived_parents(built).withColumn("derived_code_ind", F.lit(1)))
        .withColumn("update_date", day)
        .select(*OUTPUT)
    )


def hierarchy_from_releases(docs: DataFrame, update_date: date | None = None, missing: str = "na") -> DataFrame:
    """The finished table straight from release documents."""
    nodes = stage(xml.node_table(docs), "node-table")
    return hierarchy(
        nodes, xml.chapters(docs), xml.sections(docs), xml.extension_rules(nodes), update_date, missing
    )


def refresh_hierarchy(
    spark: SparkSession, path: str, store: str, target: str, several_files: bool = False, **reading: str
) -> tuple[list[int], list[int]]:
    """Bring a written hierarchy up to a release folder: (years built, years removed).

    Only new and changed files are read, and only years whose files differ from those they were
    built from are built and replaced. ``reading`` is the name filter and year pattern of the scan.
    """
    incremental.load(spark, path, store, **reading)
    docs, _ = incremental.releases(spark, store, several_files)
    prints = incremental.year_prints(spark, store, several_files)
    log = incremental.table(spark, f"{store}/built", "build int, year int, print string")
    built = log.groupBy("year").agg(F.max_by("print", "build").alias("print")).filter("print IS NOT NULL")
    number = (log.agg(F.max("build")).first()[0] or 0) + 1
    fresh = stage(prints.join(built, ["year", "print"], "left_anti"), "changed-years")
    gone = stage(built.join(prints, "year", "left_anti").select("year", F.lit(None).cast("string").alias("print")), "gone-years")
    years, lost = (sorted(r["year"] for r in df.select("year").collect()) for df in (fresh, gone))
    if years:
        write_hierarchy(hierarchy_from_releases(docs.filter(F.col("year").isin(years))), target)
    for year in lost:
        incremental.remove(spark, f"{target}/year={year}")
    fresh.unionByName(gone).write.mode("overwrite").parquet(f"{store}/built/build={number}")
    return years, lost
