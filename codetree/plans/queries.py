"""The registered queries: every operator over the sample tables, in full."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetree.functions.codes import prefix
from codetree.functions.text import tokens, word_diff
from codetree.operators.levels import PARENTS, code_levels, leaf_table
from codetree.operators.ordered import fill_down, neighbour
from codetree.operators.phrases import code_spine, neighbour_diff, tokenize
from codetree.operators.quality import code_quality, coverage_gap
from codetree.operators.ranges import range_assign, range_assign_interval
from codetree.operators.rollup import prefix_rollup, rollup_enrich, rollup_map, rollup_profile
from codetree.operators.rules import apply_rules, apply_rules_broadest_first, distinct_rules, rule_mentions, rule_summary
from codetree.operators.reshape import element_records
from codetree.plans.flattened import aligned_names, export_rules, filled_names, flattened_hierarchy, shifted_hierarchy
from codetree.plans.hierarchy import DIFFS, RANGE_COLUMNS, derived_parents, describe, hierarchy, level_texts
from codetree.plans.phrase_table import listed_codes, phrase_table
from codetree.plans.views import view
from codetree.sources import incremental
from codetree.sources.tabular_xml import (
    ROOT_TAG,
    chapters,
    extension_rules,
    node_table,
    parse_documents,
    section_ranges,
    sections,
)
from codetree.staging import scratch, stage

THRESHOLD = 40
EXPORT_YEAR = 2031
# Line numbers repeat in the sample tables.
LINE_ORDER = ("line", "partkey", "quantity", "flag", "linestatus")
UPDATE_DATE = date(2025, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__.removeprefix("q_")] = f
    return f


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return stage(view(spark, d, "nodes"), "nodes")


def _leaves(spark: SparkSession, d: str) -> DataFrame:
    return stage(leaf_table(_nodes(spark, d)), "leaves")


def _extended(spark: SparkSession, d: str) -> DataFrame:
    return stage(apply_rules(_leaves(spark, d), rule_mentions(view(spark, d, "rules"))), "extended")


@query
def q_prefix_rollup(spark: SparkSession, d: str) -> DataFrame:
    return prefix_rollup(view(spark, d, "visit_codes"), threshold=THRESHOLD)


@query
def q_rollup_enrich(spark: SparkSession, d: str) -> DataFrame:
    return rollup_enrich(view(spark, d, "visits"), threshold=THRESHOLD)


@query
def q_rollup_profile(spark: SparkSession, d: str) -> DataFrame:
    return rollup_profile(rollup_map(view(spark, d, "visits_by_type"), threshold=THRESHOLD))


@query
def q_multi_year(spark: SparkSession, d: str) -> DataFrame:
    return rollup_map(view(spark, d, "visits"), threshold=THRESHOLD, by=["year"])


@query
def q_code_levels(spark: SparkSession, d: str) -> DataFrame:
    return code_levels(view(spark, d, "nodes")).withColumnRenamed("desc", "title")


@query
def q_level_assembly(spark: SparkSession, d: str) -> DataFrame:
    return leaf_table(_nodes(spark, d))


@query
def q_code_quality(spark: SparkSession, d: str) -> DataFrame:
    coded = range_assign(
        _extended(spark, d), view(spark, d, "chapters"), view(spark, d, "sections")
    ).withColumn("nchar", F.length("icd10_code"))
    return code_quality(coded, ["year", "nchar"])


@query
def q_coverage_gap(spark: SparkSession, d: str) -> DataFrame:
    official = (
        view(spark, d, "visit_codes")
        .select(F.replace("field", F.lit("."), F.lit("")).alias("icd10_code"), F.lit("visited").alias("description"))
        .distinct()
    )
    built = view(spark, d, "nodes").select(F.col("code").alias("icd10_code"))
    return coverage_gap(official, built, pattern=r"^[PQR]\d\d\.")


@query
def q_rule_mentions(spark: SparkSession, d: str) -> DataFrame:
    return rule_mentions(view(spark, d, "rules"))


@query
def q_rule_summary(spark: SparkSession, d: str) -> DataFrame:
    return rule_summary(rule_mentions(view(spark, d, "rules")), shorten=True)


@query
def q_seventh_char_apply(spark: SparkSession, d: str) -> DataFrame:
    return apply_rules(_leaves(spark, d), rule_mentions(view(spark, d, "rules")))


@query
def q_broadest_rule_apply(spark: SparkSession, d: str) -> DataFrame:
    names = dict(zip((*PARENTS, "extension"), ("first_3", "first_5", "first_6", "first_7", "first_8")))
    rows = _leaves(spark, d).select("year", *[F.col(c).alias(n) for c, n in names.items()])
    return apply_rules_broadest_first(rows, rule_mentions(view(spark, d, "rules")))


@query
def q_range_assign(spark: SparkSession, d: str) -> DataFrame:
    codes = _leaves(spark, d).select("year", "icd10_code", "category")
    return range_assign(codes, view(spark, d, "chapters"), view(spark, d, "sections"))


@query
def q_range_assign_interval(spark: SparkSession, d: str) -> DataFrame:
    ranges = view(spark, d, "sections").select(
        "year", "ord", F.col("desc").alias("id"), F.col("low").alias("first"), F.col("high").alias("last")
    )
    codes = _leaves(spark, d).select("year", "icd10_code", "category")
    return range_assign_interval(codes, ranges)


@query
def q_fill_down(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "export").select("row", "name", "id6", "name8", "desc9")
    return fill_down(rows, ["name", "id6", "name8", "desc9"], ["row"])


@query
def q_align_offset(spark: SparkSession, d: str) -> DataFrame:
    return aligned_names(view(spark, d, "export"))


@query
def q_fill_cascade(spark: SparkSession, d: str) -> DataFrame:
    return filled_names(aligned_names(view(spark, d, "export")))


@query
def q_text_diff(spark: SparkSession, d: str) -> DataFrame:
    return level_texts(leaf_table(_nodes(spark, d))).select("year", "icd10_code", *DIFFS)


@query
def q_text_diff_documents(spark: SparkSession, d: str) -> DataFrame:
    """Words of a document that the document numbered before it lacks."""
    texts = view(spark, d, "listing").select("doc_id", "description")
    before = texts.select((F.col("doc_id") + 1).alias("doc_id"), F.col("description").alias("reference"))
    return texts.join(before, "doc_id", "left").select(
        "doc_id", word_diff(F.col("description"), F.col("reference")).alias("diff")
    )


@query
def q_derived_parents(spark: SparkSession, d: str) -> DataFrame:
    leaves = stage(level_texts(leaf_table(_nodes(spark, d))), "leaves")
    extended = apply_rules(leaves, rule_mentions(distinct_rules(view(spark, d, "rules"))))
    plain = extended.withColumns({c: F.lit(None).cast("string") for c in RANGE_COLUMNS})
    derived = derived_parents(stage(describe(plain), "built"))
    return derived.select("year", "icd10_code", "description", *PARENTS, *DIFFS)


@query
def q_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    parts = [view(spark, d, name) for name in ("nodes", "chapters", "sections", "rules")]
    return hierarchy(*parts, update_date=UPDATE_DATE)


@query
def q_tokenize(spark: SparkSession, d: str) -> DataFrame:
    return tokenize(view(spark, d, "listing").select("doc_id", "original", "description"))


@query
def q_phrase_mine(spark: SparkSession, d: str) -> DataFrame:
    return phrase_table(
        view(spark, d, "listing").select("original", "description"), view(spark, d, "categories")
    )


@query
def q_code_spine(spark: SparkSession, d: str) -> DataFrame:
    return code_spine(view(spark, d, "categories"))


def _leaf_chapter() -> Column:
    """The chapter of a document that holds a leaf code and its ancestors, nested."""
    chain = [("extension", "extension_desc")] + [(p, f"{p}_desc") for p in reversed(PARENTS)]
    nested = None
    for name, desc in chain:
        fields = [F.col(name).alias("name"), F.col(desc).alias("desc")]
        nested = F.struct(*fields, *([nested.alias("diag")] if nested is not None else []))
    return F.struct(F.struct(nested.alias("diag")).alias("section"))


def _titled_nodes(docs: DataFrame) -> DataFrame:
    nodes = node_table(docs).filter(F.col("code").isNotNull())
    return nodes.select("year", "depth", "code", F.col("desc").alias("title")).distinct()


@query
def q_xml_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes read back from one XML document per leaf code and its ancestors."""
    text = F.to_xml(F.struct(_leaf_chapter().alias("chapter")), {"rowTag": ROOT_TAG})
    # Documents are parsed once, though whether there are deeper nodes is asked before the rows are read.
    docs = stage(parse_documents(_leaves(spark, d).select("year", text.alias("xml")), "xml", "year"), "leaf-documents")
    return _titled_nodes(docs)


@query
def q_incremental_releases(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of release files that are loaded twice, and the load in which each year was read.

    Between the loads the first year's texts are revised and the last year appears; only these are read again.
    """
    folder, store = scratch(spark, "release-files"), scratch(spark, "release-store")
    leaves = _leaves(spark, d)
    years = leaves.agg(F.min("year").alias("first"), F.max("year").alias("last")).first()
    texts = [f"{p}_desc" for p in PARENTS] + ["extension_desc"]
    revised = leaves.withColumns({c: F.concat(c, F.lit(" revised")) for c in texts})
    new = revised.filter(F.col("year") == years["first"]).unionByName(leaves.filter(F.col("year") == years["last"]))
    for release in (leaves.filter(F.col("year") != years["last"]), new.filter(F.lit(years["first"] != years["last"]))):
        files = release.select(F.col("year").alias("release"), _leaf_chapter().alias("chapter"))
        # Blanks between elements would be more than half of what is written, hashed and parsed.
        writer = files.write.format("xml").option("rootTag", "releases").option("rowTag", ROOT_TAG).option("indent", "")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release").save(folder)
        incremental.load(spark, folder, store, "part-*", r"release=(\d{4})/[^/]*$")
    docs, _ = incremental.releases(spark, store, several_files=True)
    loads = docs.groupBy("year").agg(F.max("load").alias("load"))
    return _titled_nodes(docs).join(loads, "year")


def _escaped(text: Column | str) -> Column:
    """Text as XML holds it."""
    col = F.col(text) if isinstance(text, str) else text
    return F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _written(lines: Column, write: Callable[[Column], Column]) -> Column:
    """What is written of each line, as one text, in order of their places."""
    return F.array_join(F.transform(F.array_sort(lines), write), "")


def _line_values() -> Column:
    """The lines of a group, as values; texts are made of them once they are together."""
    return F.collect_list(F.struct(*LINE_ORDER)).alias("lines")


def _chapter(order: Column) -> Column:
    """The chapter of an order: its lines are sections, each with a rule."""

    def section(x: Column) -> Column:
        return F.format_string(
            """<section id="%d-%d"><desc>part <new>%d</new> of <old rev='1'>line</old></desc><diag><name>L%02d.%d</name><desc>x</desc>"""
            "<sevenChrNote><note>add to L%02d</note></sevenChrNote><sevenChrDef><extension char=\"%s\">flag <new>%s</new></extension>"
            "<extension char='Z'>status %s</extension></sevenChrDef></diag></section>",
            order["orderkey"], x["line"], x["partkey"], x["quantity"], x["line"], x["quantity"], x["flag"], x["flag"], x["linestatus"],
        )

    def ref(x: Column) -> Column:
        text = """<sectionRef first="%d" last='%d' id="%d-%d">part %d</sectionRef>"""
        return F.format_string(text, x["line"], x["quantity"], order["orderkey"], x["line"], x["partkey"])

    title = F.concat_ws(" & ", order["priority"], order["status"])
    return F.concat(
        F.lit("<chapter><name> "), order["orderkey"].cast("string"), F.lit(" </name><desc>"), _escaped(title), F.lit("</desc><sectionIndex>"),
        _written(order["lines"], ref), F.lit("</sectionIndex>"), _written(order["lines"], section), F.lit("</chapter>"),
    )


def _customer_documents(spark: SparkSession, d: str) -> DataFrame:
    """A release document per customer: orders are its chapters, lines their sections, each with a rule.

    ``year`` is the number of the customer. A customer's orders and an order's lines are few at every scale. The values
    are brought together as they are, and what is written of them, which is many times larger, stays where it is read.
    """
    orders = view(spark, d, "order_lines").groupBy("custkey", "orderkey", "priority", "status").agg(_line_values())
    whole = orders.groupBy(F.col("custkey").alias("year")).agg(F.collect_list(F.struct("orderkey", "priority", "status", "lines")).alias("orders"))
    chapters = F.array_sort(F.transform("orders", lambda o: F.struct(o["orderkey"].alias("place"), _chapter(o).alias("xml"))))
    body = F.array_join(F.transform(chapters, lambda c: c["xml"]), "")
    xml = F.concat(F.lit(f"<{ROOT_TAG}><version>1</version>"), body, F.lit(f"</{ROOT_TAG}>"))
    return parse_documents(whole.select("year", xml.alias("xml")), "xml", "year")


@query
def q_document_chapters(spark: SparkSession, d: str) -> DataFrame:
    found = chapters(_customer_documents(spark, d))
    return found.select("year", F.get("ord", F.lit(0)).alias("chapter_pos"), "name", F.col("desc").alias("title"))


@query
def q_document_sections(spark: SparkSession, d: str) -> DataFrame:
    found = sections(_customer_documents(spark, d))
    places = [F.get("ord", F.lit(i)).alias(name) for i, name in enumerate(("chapter_pos", "section_pos"))]
    return found.select("year", *places, "id", F.col("desc").alias("title"))


@query
def q_section_index(spark: SparkSession, d: str) -> DataFrame:
    found = section_ranges(_customer_documents(spark, d))
    places = [F.get("ord", F.lit(i)).alias(name) for i, name in enumerate(("chapter_pos", "ref_pos"))]
    return found.select("year", *places, "id", F.col("first").alias("low"), F.col("last").alias("high"), "text")


@query
def q_extension_rules(spark: SparkSession, d: str) -> DataFrame:
    # Whether there are deeper nodes is asked before the rows are read.
    found = extension_rules(node_table(stage(_customer_documents(spark, d), "customer-documents")))
    places = [F.get("ord", F.lit(i)).alias(name) for i, name in ((0, "chapter_pos"), (1, "section_pos"), (3, "pos"))]
    return found.select("year", *places, "name", "note", F.col("char").alias("chr"), F.col("text").alias("txt"))


@query
def q_element_records(spark: SparkSession, d: str) -> DataFrame:
    """Elements of a text per order: both kinds of quotes, empty elements, entities, mixed content, character data."""

    def line(x: Column) -> Column:
        text = """<line no='%d'>part <b k="p">%d</b> of <q>%d</q><!-- <q>0</q> -->!</line>"""
        return F.format_string(text, x["line"], x["partkey"], x["quantity"])

    orders = view(spark, d, "order_lines").groupBy("orderkey", "priority", "status").agg(_line_values())
    xml = F.concat(
        F.format_string("<?xml version='1.0'?>\n<order key='%d' note=\"a > &quot;b&#34;\">", "orderkey"),
        F.lit("<mark>A&amp;B &lt;"), F.col("priority"), F.lit("&gt; &#233;&#xe9; <![CDATA[<raw/> &amp;]]></mark>"),
        F.when(F.col("status") == "F", F.lit("<closed/>")).otherwise(F.lit("<open ></open>")),
        F.lit("<lines>"), _written(F.col("lines"), line), F.lit("</lines></order >\n"),
    )
    found = element_records(orders.withColumn("xml", xml), "xml", ["orderkey"])
    attributes = F.array_join(
        F.transform(F.array_sort(F.map_entries("attributes")), lambda a: F.concat_ws("=", a["key"], a["value"])), ";"
    )
    return found.select(
        "orderkey", F.col("pos").cast("int").alias("pos"), F.col("parent").cast("int").alias("parent"),
        F.array_join("path", "/").alias("path"), "name", attributes.alias("attributes"), "text",
    )


@query
def q_export_rules(spark: SparkSession, d: str) -> DataFrame:
    found = export_rules(view(spark, d, "export_full"), EXPORT_YEAR)
    return found.withColumnsRenamed({"char": "chr", "text": "txt"})


@query
def q_flattened_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    return flattened_hierarchy(view(spark, d, "export_full"), EXPORT_YEAR)


@query
def q_shifted_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    return shifted_hierarchy(view(spark, d, "export_full"), no_region="C1.")


@query
def q_range_assign_codes(spark: SparkSession, d: str) -> DataFrame:
    """Full codes in the narrowest of many ranges: sections, every group of five characters, and runs of six."""
    leaves = _leaves(spark, d).select("year", "icd10_code")
    wide = view(spark, d, "sections").select("year", "ord", F.col("desc").alias("id"), F.col("low").alias("first"), F.col("high").alias("last"))
    five, six = prefix(F.col("icd10_code"), 5), prefix(F.col("icd10_code"), 6)
    groups = leaves.groupBy("year", five.alias("first")).agg(F.count("*").alias("ord"), F.max(six).alias("last"))
    runs = leaves.groupBy("year", prefix(F.col("icd10_code"), 4).alias("four")).agg(
        F.count("*").alias("ord"), F.min("icd10_code").alias("first"), F.max(five).alias("last")
    )
    narrow = [r.select("year", "ord", F.concat_ws(" to ", "first", "last").alias("id"), "first", "last") for r in (groups, runs)]
    ranges = wide.unionByName(narrow[0]).unionByName(narrow[1])
    return range_assign_interval(leaves, ranges, "icd10_code").withColumnsRenamed({"first": "low", "last": "high"})


@query
def q_neighbour_diff_signs(spark: SparkSession, d: str) -> DataFrame:
    """Texts full of brackets, dots and stars against the text of the same user before them."""
    rows = view(spark, d, "signs")
    bucket = F.floor(F.col("event_id") / 4096)
    near = neighbour(stage(rows, "signs"), "body", "near", ["event_id"], ["user_id"], bucket)
    return neighbour_diff(near, "body", "near", "user").drop("near")


@query
def q_neighbour_diff(spark: SparkSession, d: str) -> DataFrame:
    """Part names against the next code's, in the 5-character group and 8th character, then in the group."""
    rows = view(spark, d, "nodes").select(
        "year",
        "code",
        F.array_join(tokens(F.col("desc")), " ").alias("search_base"),
        prefix(F.col("code"), 5).alias("code_5"),
        F.substring("code", 8, 1).alias("char_8"),
    )
    for suffix, group in (("8", ["code_5", "char_8"]), ("5", ["code_5"])):
        rows = neighbour(
            stage(rows, "neighbours"), "search_base", "near", ["code"], ["year", *group], prefix(F.col("code"), 6)
        )
        rows = neighbour_diff(rows, "search_base", "near", suffix).drop("near")
    return rows
