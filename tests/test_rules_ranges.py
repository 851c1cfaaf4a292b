import random

import pytest
from pyspark.sql import functions as F

from codetree.operators import ranges as ranges_module
from codetree.operators.ranges import range_assign, range_assign_interval
from codetree.operators.rules import MENTION_STRICT, apply_rules_broadest_first, rule_mentions, rule_summary

RULE = "year int, ord int, name string, note string, char string, text string"


def mentions(spark, note, **options):
    rules = spark.createDataFrame([(1, 0, "x", note, "A", "Té")], RULE)
    return rule_mentions(rules, **options).orderBy("pos").collect()


@pytest.mark.parametrize(
    "note, want",
    [
        ("each code from category M80:", ["M80"]),
        ("category M1A, S42, T49.123.", ["M1A", "S42", "T49.123"]),
        ("subcategories S12.0-S12.6", [f"S12.{i}" for i in range(7)]),
        ("codes O30.1 and O31", ["O31"]),
        ("codes A10-A12", ["A10", "A12"]),
        ("nothing", []),
        (None, [None]),
    ],
)
def test_mentions(spark, note, want):
    assert [r.applies_to for r in mentions(spark, note)] == want


def test_strict_pattern_wants_two_digits(spark):
    assert [r.applies_to for r in mentions(spark, "M1A, S42.", pattern=MENTION_STRICT)] == ["S42"]


def test_summary_lists_in_first_seen_order(spark):
    rows = [(1, 0, "x", "Z99 then A10", "S", "t"), (1, 1, "x", "Z99 then A10", "A", "t")]
    (row,) = rule_summary(rule_mentions(spark.createDataFrame(rows, RULE)), several_only=True).collect()
    assert (row.n, row.codes, row.chars) == (2, "Z99, A10", "S, A")


def test_summary_shortens_set_phrases(spark):
    note = "One of the following 7th characters is to be assigned to codes in subcategory H40.1"
    (row,) = rule_summary(rule_mentions(spark.createDataFrame([(1, 0, "x", note, "S", "t")], RULE)), shorten=True).collect()
    assert row.note == " H40.1"


def test_broadest_rule_first(spark):
    rules = rule_mentions(
        spark.createDataFrame([(1, 0, "x", "K10", "A", "wide"), (1, 1, "x", "K10.1", "B", "narrow")], RULE)
    )
    rows = spark.createDataFrame(
        [(1, "K10", "K10.1", None, None, None), (1, "K11", "K11.1", None, None, None)],
        "year int, first_3 string, first_5 string, first_6 string, first_7 string, first_8 string",
    )
    got = {r.icd10_code: r.extension for r in apply_rules_broadest_first(rows, rules).collect()}
    assert got == {"K10.1XXA": "wide", "K11.1": None}


def test_narrower_rules_multiply_rows_after_the_joins(spark):
    notes = [("K10", "A", "a"), ("K10", "B", "b"), ("K10.1", "C", "c"), ("K10.1", "D", "d"), ("K10.1", "E", "e"), ("K10.12", "F", "f"), ("K10.12", "G", "g"), ("L10.1", "H", "h"), ("L10.12", "I", "i"), ("L10.12", "J", "j"), ("M10.12", "K", "k")]
    rules = rule_mentions(spark.createDataFrame([(1, i, "x", *n) for i, n in enumerate(notes)], RULE))
    rows = spark.createDataFrame(
        [(1, f"{k}10", f"{k}10.1", f"{k}10.12", None, None) for k in "KKLMN"] + [(1, None, "K10.1", None, None, None)],
        "year int, first_3 string, first_5 string, first_6 string, first_7 string, first_8 string",
    )
    found = apply_rules_broadest_first(rows, rules)
    assert found.columns == ["year", "first_6", "first_5", "first_3", "first_7", "first_8", "last_char", "extension", "icd10_code"]
    got = sorted((r.first_3 or "", r.icd10_code, r.last_char or "", r.extension or "") for r in found.collect())
    want = 12 * [("K10", "K10.12XA", "A", "a"), ("K10", "K10.12XB", "B", "b")] + 2 * [("L10", "L10.12XH", "H", "h")]
    want += [("M10", "M10.12XK", "K", "k"), ("N10", "N10.12", "", "")] + [("", f"K10.1XX{c}", c, c.lower()) for c in "CDE"]
    assert got == sorted(want)
    # One row per code and level is joined, however many rules mention it.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Join ") > plan.rindex("Generate ")


def literal_fill(codes, ends):
    """Sort by code, copy the range of an end category, carry it down."""
    out, current = [], None
    for code, category in sorted(codes):
        hits = [(name, desc) for cat, name, desc in ends if cat == category]
        for hit in hits or [None]:
            current = hit or current
            out.append((code, *(current or (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_range_assign_is_the_literal_fill(spark, seed):
    rng = random.Random(seed)
    codes = set()
    for _ in range(120):
        category = f"{rng.choice('AB')}{rng.randrange(30):02d}"
        code = category + rng.choice(["", ".1", ".12", ".123", ".1234"])
        codes.add((code, None if len(code) > 6 and rng.random() < 0.5 else category))
    codes = list({c: k for c, k in codes}.items())
    ranges = []
    for i in range(8):
        low, high = sorted(f"{rng.choice('AB')}{rng.randrange(30):02d}" for _ in range(2))
        ranges.append((1, i, f"Range {i} ({low}-{high})"))
    chapters = spark.createDataFrame(ranges[:4], "year int, ord int, desc string")
    sections = spark.createDataFrame(ranges[4:], "year int, ord int, desc string")
    df = spark.createDataFrame([(1, *c) for c in codes], "year int, icd10_code string, category string")
    got = range_assign(df, chapters, sections).collect()

    def ends(rows, last_only):
        found = []
        for _, _, desc in rows:
            text = desc.rsplit("(", 1)[1].rstrip(")")
            for cat in text.split("-"):
                if last_only:
                    found = [f for f in found if f[0] != cat]
                found.append((cat, text, desc))
        return found

    want = literal_fill(codes, ends(ranges[:4], False))
    assert sorted(((r.icd10_code, r.chapter, r.chapter_desc) for r in got), key=str) == want
    sections_want = dict((c, (a, b)) for c, a, b in literal_fill(codes, ends(ranges[4:], True)))
    assert {r.icd10_code: (r.section, r.section_desc) for r in got} == sections_want


def test_interval_takes_the_narrowest(spark):
    codes = spark.createDataFrame([(1, "A10.1", "A10"), (1, "B20", "B20"), (1, "C1", None)], "year int, icd10_code string, category string")
    ranges = spark.createDataFrame(
        [(1, 0, "wide", "A00", "B99"), (1, 1, "ten", "A10", "A19"), (1, 2, "five", "A10", "A15"), (1, 3, "again", "A10", "A15")],
        "year int, ord int, id string, first string, last string",
    )
    got = {r.icd10_code: r.id for r in range_assign_interval(codes, ranges).collect()}
    assert got == {"A10.1": "again", "B20": "wide", "C1": None}


@pytest.mark.parametrize("seed", range(2))
def test_interval_is_the_narrowest_of_all(spark, seed):
    rng = random.Random(seed)

    def name():
        return (rng.choice("ABCDE") + rng.choice("0129") + rng.choice("019A"))[: rng.choice([1, 2, 3, 3, 3])]

    codes = sorted({name() for _ in range(60)} | {""})
    ranges = [(1, i, f"r{i}", *sorted((name(), name()))) for i in range(25)] + [(1, 25, "whole", "", "F")]
    df = spark.createDataFrame([(1, c, c) for c in codes], "year int, icd10_code string, category string")
    got = range_assign_interval(df, spark.createDataFrame(ranges, "year int, ord int, id string, first string, last string"))

    def narrowest(code):
        held = [r for r in ranges if r[3] <= code <= r[4]]
        start = max(r[3] for r in held)
        end = min(r[4] for r in held if r[3] == start)
        return [r[2] for r in held if r[3:] == (start, end)][-1]

    assert {r.icd10_code: r.id for r in got.collect()} == {c: narrowest(c) for c in codes}


def swept(codes, ranges):
    """The narrowest range of each code, by looking at all of them."""
    out = {}
    for code in codes:
        held = [r for r in ranges if r[3] <= code <= r[4]]
        start = max((r[3] for r in held), default=None)
        end = min((r[4] for r in held if r[3] == start), default=None)
        out[code] = max(((r[1], r[2]) for r in held if r[3:] == (start, end)), default=(0, None))[1]
    return out


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_interval_of_codes_of_any_length(spark, monkeypatch, fan):
    monkeypatch.setattr(ranges_module, "FAN", fan)
    rng = random.Random(fan)

    def name():
        return "".join(rng.choice("AB01") for _ in range(rng.randrange(1, 8)))

    codes = sorted({name() for _ in range(300)})
    ranges = [(1, i, f"r{i}", *(sorted((name(), name())) if i % 9 else (name(), name()))) for i in range(200)]
    df = spark.createDataFrame([(1, c, c) for c in codes] + [(2, "A", "A"), (1, "none", None)], "year int, icd10_code string, category string")
    got = {(r.year, r.icd10_code): r.id for r in range_assign_interval(df, spark.createDataFrame(ranges, "year int, ord int, id string, first string, last string")).collect()}
    assert got == {(1, c): i for c, i in swept(codes, ranges).items()} | {(2, "A"): None, (1, "none"): None}


def test_many_ranges_in_one_pair_of_characters(spark):
    """100,000 ranges, nested and side by side, that all begin with the same two characters."""
    n = 100_000
    numbers = spark.range(n).select("id", F.lpad(F.col("id").cast("string"), 6, "0").alias("low"), F.lpad((2 * n - F.col("id")).cast("string"), 6, "0").alias("high"))
    ranges = numbers.select(
        F.lit(1).alias("year"), F.col("id").alias("ord"), F.concat(F.lit("r"), "id").alias("id"),
        F.concat(F.lit("A1"), "low").alias("first"),
        F.concat(F.lit("A1"), F.when(F.col("id") % 2 == 0, F.col("high")).otherwise(F.col("low"))).alias("last"),
    )
    codes = spark.range(0, 2 * n, 7).select(F.lit(1).alias("year"), F.concat(F.lit("A1"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("code"))
    found = range_assign_interval(codes, ranges, "code").select("code", "id")
    got = {int(r.code[2:]): int(r.id[1:]) for r in found.collect()}
    # An odd range holds its own number; an even one all from it to its mirror.
    assert got == {c: c if c < n else next(i for i in range(min(2 * n - c, n - 1), -1, -1) if i % 2 == 0) for c in range(0, 2 * n, 7)}


def test_summary_keeps_rules_without_a_note(spark):
    rules = spark.createDataFrame([(7, 1, "L20", None, "A", "x"), (7, 2, "L21", "to L21", "B", "y")], "year int, ord int, name string, note string, char string, text string")
    got = {tuple(r) for r in rule_summary(rule_mentions(rules)).collect()}
    assert got == {(7, None, 1, "NA", "A"), (7, "to L21", 1, "L21", "B")}


def test_rules_are_matched_once_per_wording(spark):
    """A note repeated for many codes is one rule; the longest mention gives its characters, without a window over the matches."""
    from codetree.operators import rules as r

    note = "to be added to each code from category P45:"
    said = [(2020, i, f"P45.{i}", note, c, t) for i in range(200) for c, t in (("A", "first"), ("D", "later"))]
    said += [(2020, 900, "x", "to be added to codes in subcategory P45.1", "S", "narrow"), (2020, 901, "x", None, "Q", "no note")]
    rules = spark.createDataFrame(said, "year int, ord int, name string, note string, char string, text string")
    assert r.distinct_rules(rules).count() == 4
    columns = "year int, icd10_code string, category string, subcategory_1 string, subcategory_2 string, extension string, extension_desc string"
    rows = [
        (2020, "P45.1", "P45", "P45.1", None, None, None),
        (2020, "P45.2", "P45", "P45.2", None, None, None),
        (2020, "P46", "P46", None, None, None, None),
        (2020, "P45.21XA", "P45", "P45.2", None, "P45.21XA", None),
    ]
    leaves = spark.createDataFrame(rows, columns)
    plan = r._matches(leaves, r.rule_mentions(rules))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    want = {
        ("P45.1XXS", "S", "narrow"), ("P45.2XXA", "A", "first"), ("P45.2XXD", "D", "later"), ("P46", None, None),
        ("P45.21XA", "A", "first"), ("P45.21XA", "A", "later"),
    }
    for mentions in (r.rule_mentions(rules), r.rule_mentions(r.distinct_rules(rules))):
        got = [(x["icd10_code"], x["extension"], x["extension_desc"]) for x in r.apply_rules(leaves, mentions, unique_leaves=True).collect()]
        assert len(got) == len(want) and set(got) == want
