"""Yearly tabular XML releases as DataFrames.

``read_releases`` reads every file of a folder in one scan, one row per file.
From there on a document is only ever exploded: chapters, sections and one
*node table* with a row per code, each keyed by ``year`` and by its position in
the document (``path``), so document order never depends on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codetree.functions.text import strip_revision_tags
from codetree.staging import stage

ROOT_TAG = "ICD10CM.tabular"
CORRUPT = "_corrupt_record"
# The last folder name that holds a year.
FOLDER_YEAR = r"^.*(?<!\d)((?:19|20)\d{2})(?!\d)[^/]*/[^/]*$"
# Levels of nesting read at a time: codes have three to seven characters, one level for
# each. What is nested deeper comes as raw text and is parsed in turn.
DIAG_DEPTH = 5


def _diag_schema(depth: int) -> str:
    nested = f", diag: array<{_diag_schema(depth - 1) if depth > 1 else 'string'}>"
    return (
        "struct<name: string, desc: string, _placeholder: string, "
        "sevenChrNote: array<struct<note: array<string>>>, "
        f"sevenChrDef: array<string>{nested}>"
    )


# Only what the operators read. Elements with mixed text are declared as
# strings, which keeps their inner mark-up for `strip_revision_tags`.
DOCUMENT_SCHEMA = (
    "version string, chapter array<struct<name: string, desc: string, "
    "sectionIndex: struct<sectionRef: array<struct<"
    "_VALUE: string, _first: string, _last: string, _id: string>>>, "
    "section: array<struct<_id: string, desc: string, "
    f"diag: array<{_diag_schema(DIAG_DEPTH)}>>>>>"
)


# The year in a file name.
NAME_YEAR = r"(\d{4})[^/]*$"


def read_raw(spark: SparkSession, paths: str | list[str], name_filter: str = "*.xml", year_pattern: str = NAME_YEAR) -> DataFrame:
    """(version, chapter, corrupt text, file, year), one row per document, not yet judged.

    The year comes from the file name, else from the version element, else from the folder.
    """
    return (
        spark.read.format("xml")
        .option("rowTag", ROOT_TAG)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", name_filter)
        .schema(f"{DOCUMENT_SCHEMA}, {CORRUPT} string")
        .load(paths)
        .select("version", "chapter", CORRUPT, F.col("_metadata.file_path").alias("file"))
        .withColumn(
            "year",
            F.coalesce(
                F.regexp_extract("file", year_pattern, 1).try_cast("int"),
                F.col("version").try_cast("int"),
                F.regexp_extract("file", FOLDER_YEAR, 1).try_cast("int"),
            ),
        )
    )


def judge(raw: DataFrame, several_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantined) of what ``read_raw`` gives.

    Where a year may not come in ``several_files``, the first of them by name holds.
    """
    parsed = raw.filter(F.col(CORRUPT).isNull() & F.col("year").isNotNull())
    first = parsed.groupBy(F.col("year").alias("_year")).agg(F.min("file").alias("_first"))
    reason = F.when(F.col(CORRUPT).isNotNull(), "not parsed").when(F.col("year").isNull(), "no year")
    if not several_files:
        raw = raw.join(first, F.col("year") == F.col("_year"), "left")
        reason = reason.when(F.col("file") != F.col("_first"), "another file of the year")
    marked = raw.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull()).select("year", "file", "version", "chapter")
    bad = marked.filter(F.col("reason").isNotNull()).select("year", "file", F.col(CORRUPT).alias("text"), "reason")
    return good, bad


def read_releases(
    spark: SparkSession,
    path: str,
    name_filter: str = "*.xml",
    year_pattern: str = NAME_YEAR,
) -> tuple[DataFrame, DataFrame]:
    """All release files below ``path``: (documents, quarantined files).

    A file that does not parse, that has no year, or whose year an earlier file (by name) has as well lands in
    the second frame, ``(year, file, text, reason)``, and leaves the others alone. The parsed files are
    staged, since every later operator starts from them. ``sources.incremental`` reads only what has changed.
    """
    return judge(stage(read_raw(spark, path, name_filter, year_pattern), "releases"))


def parse_documents(df: DataFrame, xml: str, *keep: str) -> DataFrame:
    """Documents from a string column, for releases that arrive inside a table."""
    parsed = F.from_xml(F.col(xml), T.StructType.fromDDL(DOCUMENT_SCHEMA), {"rowTag": ROOT_TAG})
    return df.select(*keep, parsed.alias("doc")).select(*keep, "doc.version", "doc.chapter")


def _chapter_rows(docs: DataFrame) -> DataFrame:
    return docs.select("year", F.posexplode("chapter").alias("chapter_pos", "chapter"))


def _section_rows(docs: DataFrame) -> DataFrame:
    return _chapter_rows(docs).select(
        "year", "chapter_pos", F.posexplode("chapter.section").alias("section_pos", "section")
    )


def chapters(docs: DataFrame) -> DataFrame:
    """(year, ord, name, desc) per chapter; ``ord`` is the document position."""
    return _chapter_rows(docs).select(
        "year",
        F.array(F.col("chapter_pos")).alias("ord"),
        F.trim("chapter.name").alias("name"),
        strip_revision_tags(F.col("chapter.desc")).alias("desc"),
    )


def sections(docs: DataFrame) -> DataFrame:
    """(year, ord, id, desc) per section."""
    return _section_rows(docs).select(
        "year",
        F.array("chapter_pos", "section_pos").alias("ord"),
        F.col("section._id").alias("id"),
        strip_revision_tags(F.col("section.desc")).alias("desc"),
    )


def section_ranges(docs: DataFrame) -> DataFrame:
    """(year, ord, id, first, last, text) per entry of the chapters' section index."""
    refs = _chapter_rows(docs).select(
        "year", "chapter_pos", F.posexplode("chapter.sectionIndex.sectionRef").alias("ref_pos", "ref")
    )
    return refs.select(
        "year",
        F.array("chapter_pos", "ref_pos").alias("ord"),
        F.col("ref._id").alias("id"),
        F.col("ref._first").alias("first"),
        F.col("ref._last").alias("last"),
        F.col("ref._VALUE").alias("text"),
    )


def _node_fields(diag: str) -> dict[str, Column]:
    given = F.array_compact(F.transform(f"{diag}.sevenChrNote", lambda n: n["note"]))
    notes = F.array_compact(F.flatten(given))
    return {
        "code": strip_revision_tags(F.col(f"{diag}.name")),
        "desc": strip_revision_tags(F.col(f"{diag}.desc")),
        "note": strip_revision_tags(F.get(notes, F.lit(0))),
        "definitions": F.col(f"{diag}.sevenChrDef"),
    }


def node_table(docs: DataFrame) -> DataFrame:
    """(year, path, depth, code, desc, note, definitions), one row per code element.

    A chain of explodes: each step turns a node into itself (position 0)
    and its children, and carries only the children on to the next step.
    Elements nested deeper than the schema are parsed from their text, as many
    levels again each time, until none are left; looking for them runs a job.
    ``definitions`` holds the raw 7th-character definitions.
    """
    top = (
        _section_rows(docs)
        .select("year", "chapter_pos", "section_pos", F.posexplode("section.diag").alias("pos", "diag"))
        .select(
            "year",
            F.array("chapter_pos", "section_pos", "pos").alias("path"),
            F.lit(1).alias("depth"),
            *[c.alias(n) for n, c in _node_fields("diag").items()],
            F.col("diag.diag").alias("children"),
        )
    )
    nodes = _family(top)
    out = nodes.drop("children")
    deeper = nodes.filter(F.size("children") > 0)
    while not deeper.isEmpty():
        each = stage(deeper, "deeper").select(
            "year", "path", "depth", F.posexplode("children").alias("pos", "raw")
        )
        whole = F.concat(F.lit("<diag>"), "raw", F.lit("</diag>"))
        parsed = each.withColumn(
            "diag", F.from_xml(whole, T.StructType.fromDDL(f"d {_diag_schema(DIAG_DEPTH)}")["d"].dataType, {"rowTag": "diag"})
        )
        nodes = _family(
            parsed.select(
                "year",
                F.array_append("path", F.col("pos")).alias("path"),
                (F.col("depth") + 1).alias("depth"),
                *[c.alias(n) for n, c in _node_fields("diag").items()],
                F.col("diag.diag").alias("children"),
            )
        )
        out = out.unionByName(nodes.drop("children"))
        deeper = nodes.filter(F.size("children") > 0)
    return out


def _family(nodes: DataFrame) -> DataFrame:
    """The nodes and all below them that the schema covers; ``children`` of the deepest are raw text."""
    for level in range(2, DIAG_DEPTH + 1):
        itself = F.array(F.lit(None))
        family = F.coalesce(F.concat(itself, "children"), itself)
        fields = _node_fields("child")
        is_child = F.col("pos") > 0
        nodes = nodes.select(
            "year", "path", "depth", *fields, F.posexplode(family).alias("pos", "child")
        ).select(
            "year",
            F.when(is_child, F.array_append("path", F.col("pos") - 1)).otherwise(F.col("path")).alias("path"),
            F.when(is_child, F.col("depth") + 1).otherwise(F.col("depth")).alias("depth"),
            *[F.when(is_child, c).otherwise(F.col(n)).alias(n) for n, c in fields.items()],
            F.col("child.diag").alias("children"),
        )
    return nodes


def extension_rules(nodes: DataFrame) -> DataFrame:
    """(year, ord, name, note, char, text) per 7th-character definition of a code."""
    extension = r'(?s)<extension\b([^>]*)>(.*?)</extension>'
    each = nodes.filter(F.col("definitions").isNotNull()).select(
        "year",
        "path",
        F.col("code").alias("name"),
        "note",
        F.posexplode(
            F.regexp_extract_all(F.array_join("definitions", ""), F.lit(extension), F.lit(0))
        ).alias("pos", "element"),
    )
    char = F.regexp_extract("element", r'''^<extension\b[^>]*?\bchar\s*=\s*["']([^"']*)["']''', 1)
    return each.select(
        "year",
        F.concat("path", F.array("pos")).alias("ord"),
        "name",
        "note",
        F.nullif(char, F.lit("")).alias("char"),
        strip_revision_tags(F.regexp_extract("element", extension, 2)).alias("text"),
    )
