import random
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from codetree.operators.reshape import all_empty, cells, decode_entities, element_records, ill_formed, keep_filled
from codetree.sources import files
from codetree.sources import tabular_xml as xml
from tests import releases


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("xml")
    (folder / "icd10_2031_tabular.xml").write_text(releases.FULL, encoding="utf8")
    (folder / "icd10_2032_tabular.xml").write_text(releases.SMALL, encoding="utf8")
    (folder / "icd10_2033_tabular.xml").write_text(releases.BROKEN, encoding="utf8")
    (folder / "notes.xml").write_text("<x/>")
    return xml.read_releases(spark, str(folder), "*abular.xml", r"_(\d{4})_[^/]*$")


def test_broken_file_is_quarantined(read):
    docs, bad = read
    assert sorted(r.year for r in docs.collect()) == [2031, 2032]
    (row,) = bad.collect()
    assert row.file.endswith("icd10_2033_tabular.xml") and "cut off" in row.text


def test_missing_releases(spark, read):
    table = files.release_table(spark, [{"year": y} for y in (2031, 2032, 2033)])
    assert [r.year for r in files.missing_releases(table, read[0]).collect()] == [2033]


def test_chapters_and_sections(read):
    docs = read[0].filter("year = 2031")
    assert [tuple(r) for r in xml.chapters(docs).orderBy("ord").collect()] == [
        (2031, [0], "1", "Bones (L00-L99)"),
        (2031, [1], "2", "Necks and ears (M40-S12)"),
    ]
    assert [r.id for r in xml.sections(docs).orderBy("ord").collect()] == ["L20-L29", "L25-L30", "M40-M49", "S10-S19"]
    assert [(r.id, r.first, r.last, r.text) for r in xml.section_ranges(docs).orderBy("ord").collect()] == [
        ("L20-L29", "L20", "L29", "Brittle bones"),
        ("L25-L30", "L25", "L30", "Broken things"),
    ]


def test_node_table_keeps_document_order(read):
    nodes = xml.node_table(read[0].filter("year = 2031")).orderBy("path").collect()
    assert [(r.code, r.depth) for r in nodes] == [
        ("L20", 1), ("L20.0", 2), ("L20.00", 3), ("L20.01", 3), ("L20.011", 4), ("L23", 1), ("L25", 1), ("L25.1", 2),
        ("M12", 1), ("M40", 1), ("M40.1", 2), ("M40.11", 3), ("M40.111", 4),
        ("M41", 1), ("M41.1", 2), ("M41.10", 3), ("M41.101", 4), ("M41.1011", 5),
        ("S12", 1), ("S12.0", 2), ("S12.00", 3), ("S12.000", 4), ("S12.8", 2),
    ]
    assert [r.desc for r in nodes if r.code == "L25.1"] == ["Broken bone, néw type,"]


def test_extension_rules(read):
    rules = xml.extension_rules(xml.node_table(read[0].filter("year = 2031"))).orderBy("ord").collect()
    assert [(r.char, r.text) for r in rules if r.name == "S12"] == [("A", "closed"), ("B", "open")]
    assert {r.note for r in rules if r.name == "L25.1"} == {"added to code L25.1"}


def test_mixed_extension_text(spark):
    text = releases.release(
        "1",
        releases.chapter(
            "1", "x", releases.section("a", "b", releases.diag("A00", "c", note="A00", extensions=[("A", "first <new>big</new> visit")]))
        ),
    )
    docs = xml.parse_documents(spark.createDataFrame([(7, text)], "year int, xml string"), "xml", "year")
    (rule,) = xml.extension_rules(xml.node_table(docs)).collect()
    assert (rule.year, rule.char, rule.text) == (7, "A", "first big visit")


def test_delimited_inputs(spark, tmp_path):
    (tmp_path / "a.csv").write_text('code,description\nA00,"Chol, ""x"""\nA01,\n')
    (tmp_path / "a.tsv").write_text("code\tdescription\nA00\tplain\n")
    schema = "code string, description string"
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), schema).collect()
    assert [tuple(r) for r in rows] == [("A00", 'Chol, "x"'), ("A01", None)]
    assert [tuple(r) for r in files.read_tsv(spark, str(tmp_path / "a.tsv"), schema).collect()] == [("A00", "plain")]
    assert files.official_list(files.read_csv(spark, str(tmp_path / "a.csv"), schema)).columns == ["icd10_code", "description"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('code,description\nA00,"two\nlines"\nA01,x\n')
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), "code string, description string").collect()
    assert [tuple(r) for r in rows] == [("A00", "two\nlines"), ("A01", "x")]


def test_releases_from_files_to_tables(spark, tmp_path):
    """Several years, one of them by its folder; a file without a year, a second one of a year, a re-run of one year."""
    def one(code, text, version="x"):
        return releases.release(version, releases.chapter("1", "Bones (L00-L99)", releases.section("a", "b", releases.diag(code, text))))

    folder = tmp_path / "in"
    for name, text in {
        "y2031/Tabular.xml": one("L20", "Ménière"), "tabular_2032.xml": one("L21", "b"), "tabular_2033.xml": one("L22", "c"),
        "none/Tabular.xml": one("L23", "d"), "z_tabular_2032.xml": one("L24", "e"), "tabular_2034.xml": "<ICD10CM.tabular><version>",
    }.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)
    docs, bad = xml.read_releases(spark, str(folder), "*abular*.xml")
    good_years = {r.year for r in docs.collect()}
    reasons = {r.file.rpartition("/in/")[2]: r.reason for r in bad.collect()}
    assert {2032, 2033} <= good_years
    assert reasons.get("z_tabular_2032.xml") == "another file of the year"
    docs, bad = xml.read_releases(spark, str(folder / "*"), "Tabular.xml")
    assert {r.year for r in docs.collect()} == {2031} and [r.reason for r in bad.collect()] == ["no year"]


def test_a_year_is_written_again_and_others_stay(spark, tmp_path):
    schema = "icd10_code string, description string, year int"
    both = spark.createDataFrame([("A00", "x", 2031), ("A01", "y", 2032)], schema)
    again = spark.createDataFrame([("A02", "z", 2032)], schema)
    for kind in ("csv", "parquet"):
        for df in (both, again):
            files.write_hierarchy(df, str(tmp_path / kind), kind)
    assert {(r.year, r.icd10_code) for r in spark.read.parquet(str(tmp_path / "parquet")).collect()} == {(2031, "A00"), (2032, "A02")}
    assert {(r.year, r.icd10_code) for r in files.read_csv(spark, str(tmp_path / "csv"), schema).collect()} == {(2031, "A00"), (2032, "A02")}


def test_elements_nested_deeper_than_a_schema(spark):
    deep = ""
    for i in range(13, 0, -1):
        deep = releases.diag(f"L{i}", f"level {i}", deep, note=f"note {i}")
    docs = xml.parse_documents(spark.createDataFrame([(7, releases.release("1", releases.chapter("1", "x", releases.section("a", "b", deep))))], "year int, xml string"), "xml", "year")
    rows = xml.node_table(docs).collect()
    assert {(r.code, r.depth, r.desc, r.note) for r in rows} == {(f"L{i}", i, f"level {i}", f"note {i}") for i in range(1, 14)}
    assert {len(r.path) for r in rows} == set(range(3, 16))


def test_an_empty_note_does_not_hide_the_next(spark):
    diag = "<diag><name>L20</name><desc>x</desc><sevenChrNote></sevenChrNote><sevenChrNote><note>to L20</note></sevenChrNote></diag>"
    text = releases.release("1", releases.chapter("1", "x", releases.section("a", "b", diag)))
    docs = xml.parse_documents(spark.createDataFrame([(7, text)], "year int, xml string"), "xml", "year")
    assert [r.note for r in xml.node_table(docs).collect()] == ["to L20"]


def test_fixed_width(spark, tmp_path):
    (tmp_path / "a.txt").write_text("A000    Cholera due to x\nA0000000Next\n        \n")
    rows = files.read_code_descriptions(spark, str(tmp_path / "a.txt")).collect()
    assert [tuple(r) for r in rows] == [("A000", "Cholera due to x"), ("A0000000", "Next"), (None, None)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("A00", None, 2031), ("A01", "x, y", 2032)], "icd10_code string, description string, year int")
    files.write_hierarchy(df, str(tmp_path / "csv"), "csv")
    files.write_hierarchy(df, str(tmp_path / "parquet"))
    lines = [p.read_text() for p in sorted((tmp_path / "csv").glob("release=*/*.csv"))]
    assert lines == ["icd10_code,description,year\nA00,,2031\n", 'icd10_code,description,year\nA01,"x, y",2032\n']
    assert spark.read.parquet(str(tmp_path / "parquet")).filter("year = 2032").count() == 1
    files.write_phrases(df.drop("year"), str(tmp_path / "phrases"))
    assert files.read_csv(spark, str(tmp_path / "phrases"), "icd10_code string, description string").count() == 2


def test_reshape(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "a", "b")], "row int, x string, y string")
    assert [r.row for r in keep_filled(df, ["row"]).collect()] == [2, 3]
    assert [r.row for r in keep_filled(df, ["row"], need="all").collect()] == [3]
    assert [r.row for r in df.filter(all_empty(df, ["x", "y"])).collect()] == [1]
    assert df.filter(all_empty(df, [])).count() == 3
    assert [tuple(r) for r in cells(df.filter("row = 2"), "row").collect()] == [(2, 1, "x", "a"), (2, 2, "y", None)]


def records(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, xml string").repartition(2)
    found = element_records(df, "xml", ["id"]).orderBy("id", "pos").collect()
    return [[tuple(r)[2:] for r in found if r.id == i] for i in range(len(texts))]


def test_element_records(spark):
    text = """<r><a x='1' y = "p 'q' > &lt;&#x41;">t</a><b y="2"/><c>1 &amp; 2 &amp;lt; &#233;&nbsp;</c><d>p<e>q<!-- <z> --></e>r<![CDATA[<f>&amp;</f>]]></d><e ></e></r>"""
    (found,) = records(spark, [text])
    assert found == [
        (None, ["r"], "r", None, "t1 & 2 &lt; é&nbsp;pqr<f>&amp;</f>"),
        (1, ["r", "a"], "a", {"x": "1", "y": "p 'q' > <A"}, "t"),
        (1, ["r", "b"], "b", {"y": "2"}, ""),
        (1, ["r", "c"], "c", None, "1 & 2 &lt; é&nbsp;"),
        (1, ["r", "d"], "d", None, "pqr<f>&amp;</f>"),
        (5, ["r", "d", "e"], "e", None, "q"),
        (1, ["r", "e"], "e", None, ""),
    ]


def test_element_records_against_a_parser(spark):
    """Random trees, written with all kinds of markup, against the standard library's parser."""
    def tree(depth):
        name = rng.choice(["a", "b", "n:c", "d-e", "é"])
        own = "".join(f" {k}{rng.choice(['=', ' = '])}{q}{rng.choice(['', 'x', '&amp;>', '&#65;'])}{q}" for k, q in (("k", '"'), ("l.m", "'")) if rng.random() < 0.4)
        if rng.random() < 0.2:
            return f"<{name}{own}/>"
        inside = [rng.choice(["", "t ", "&gt;", "\n", "<!-- <q> -->", "<![CDATA[ ]] <x/> ]]>", "<?pi <?>"]) if rng.random() < 0.5 or depth > 9 else tree(depth + 1) for _ in range(rng.randrange(5))]
        return f"<{name}{own}>{''.join(inside)}</{name}{rng.choice(['', ' '])}>"

    rng = random.Random(5)
    texts = ["<?xml version='1.0'?><!DOCTYPE r [<!ELEMENT r ANY>]>\n<root>" + "".join(tree(1) for _ in range(8)) + "</root>\n" for _ in range(30)]

    def walk(node, up, path, out):
        path = [*path, node.tag]
        me = len(out) + 1
        out.append((up, path, node.tag, dict(node.attrib) or None, "".join(node.itertext())))
        for child in node:
            walk(child, me, path, out)
        return out

    want = [walk(ElementTree.fromstring(t.replace("n:c", "n_c")), None, [], []) for t in texts]
    got = [[(u, [p.replace("n:c", "n_c") for p in path], n.replace("n:c", "n_c"), a, x) for u, path, n, a, x in rows] for rows in records(spark, texts)]
    assert got == want and max(len(r[1]) for rows in want for r in rows) > 8


def test_ill_formed_texts_are_left_out(spark):
    bad = ["<r>", "</r>", "<r></s>", "<r/><s/>", "x<r/>", "<r>a < b</r>", "<a><b></a></b>", "<r a='1' a='2'/>", "plain", "<r", "<r><!-- </r>"]
    good = [None, "", "<r/>", "\ufeff<r></r> "]
    df = spark.createDataFrame(list(enumerate(bad + good)), "id int, xml string")
    assert [len(x) for x in records(spark, bad + good)] == [0] * len(bad) + [0, 0, 1, 1]
    assert sorted(r.id for r in ill_formed(df, "xml", ["id"]).collect()) == list(range(len(bad)))
    assert element_records(df.limit(0), "xml", ["id"]).count() == 0


def test_element_records_stay_where_the_texts_lie(spark):
    """No exchange, no staged table and no copy of an event per level: disk is the input's alone."""
    df = spark.createDataFrame([(1, "<r><a>t</a></r>"), (1, "<r><a>t</a></r>")], "id int, xml string")
    found = element_records(df, "xml", ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Window", "FileScan"))
    assert sorted((r.id, r.pos) for r in found.collect()) == [(1, 1), (1, 1), (1, 2), (1, 2)]


def test_entities_within_texts(spark):
    texts = ["a&amp;lt;b", "&#233;&#xE9;&#x1F600;", "&unknown;", "& ;", "&;", "a&b", "&#xD800;", "&#0;", "&quot;&apos;&lt;&gt;", "&amp", "&#65\n;", "&#x41\u2028;", "&#65\u2028;"]
    df = spark.createDataFrame([(f"<r>{t}</r>", t) for t in texts], "xml string, t string").select("xml", decode_entities(F.col("t")).alias("t"))
    assert all(r.text == r.t for r in element_records(df, "xml", ["t"]).collect())


def test_entities(spark):
    texts = ["a&amp;lt;b", "&#233;&#xE9;&#x1F600;", "&unknown;", "& ;", "&;", "a&b", "&#xD800;", "&#0;", "&quot;&apos;&lt;&gt;", "&amp", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert [r[0] for r in df.select(decode_entities(F.col("t"))).collect()] == [
        "a&lt;b", "éé\U0001f600", "&unknown;", "& ;", "&;", "a&b", "&#xD800;", "&#0;", "\"'<>", "&amp", "x",
    ]
