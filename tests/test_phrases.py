import random
import re
from collections import Counter, defaultdict

import pytest

from codetree.operators import phrases
from codetree.operators.phrases import code_spine, neighbour_diff, phrase_mine
from codetree.plans.phrase_table import OUTPUT, phrase_table

KEYS = {5: lambda c: c[:5], 6: lambda c: c[:6], 8: lambda c: (c[:5], c[7:8]), 7: lambda c: c[:7]}


def mined(texts):
    """Words per level by regular expressions, each level without the words used before."""
    words = [(code, w) for code, text in texts for w in text.split()]
    lookups, phrases = {}, {}
    for level, key in KEYS.items():
        counts = defaultdict(Counter)
        for code, word in words:
            patterns = [lookups[m].get(KEYS[m](code)) for m in lookups]
            if all(p is not None and not re.search(p, word) for p in patterns):
                counts[key(code)][word] += 1
        phrases[level] = {
            k: " ".join(sorted(w for w, n in c.items() if n == max(c.values()))) for k, c in counts.items()
        }
        lookups[level] = {k: rf"\b({p.replace(' ', '|')})\b" for k, p in phrases[level].items()}
    return {
        code: tuple(phrases[level].get(KEYS[level](code)) for level in (5, 6, 7, 8)) for code, _ in words
    }


@pytest.mark.parametrize("seed", range(3))
def test_phrases_equal_the_regex_form(spark, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        code = f"{rng.choice('AB')}1{rng.choice('12')}.{rng.choice('12')}{rng.choice('12')}{rng.choice('12')}"
        texts.append((code + rng.choice(["", "A", "D"]), " ".join(rng.choices("arm leg eye ear toe lip".split(), k=5))))
    df = spark.createDataFrame(texts, "code string, description string")
    got = {r[0]: tuple(r[1:]) for r in phrase_mine(df).collect()}
    assert got == mined(texts)


CATEGORIES = [
    (1, "A00-B99", "I. Infections and parasites"),
    (2, "A00-A09", "Gut infections"),
    (3, "A00-A03", "Early gut"),
    (4, "A01", "Fever and chills"),
    (5, "C00-D48", "II. Growths"),
]


def test_spine(spark):
    spine = code_spine(spark.createDataFrame(CATEGORIES, "ord int, code string, description string"))
    rows = spine.collect()
    assert len(rows) == 2601 and len({r.code_3 for r in rows}) == 2600
    assert {r.level_2 for r in rows if r.code_3 == "A00"} == {"A00-A09", "A00-A03"}
    (row,) = [r for r in rows if r.code_3 == "B55"]
    assert (row.C1, row.N1, row.N2) == ("B", "5", "5")
    assert (row.level_1, row.label_1) == ("I", "I. Infections & parasites")
    assert (row.level_2, row.label_2, row.C3_text) == ("A00-A03", "Early gut", "Fever & chills")
    assert {r.level_1 for r in rows if r.code_3 == "Z99"} == {"II"}


def test_phrase_table(spark):
    listing = spark.createDataFrame(
        [("A0111", "Fever of the left arm"), ("A0112", "Fever, right arm"), ("A33", "the of"), ("E55", "Thin bone")],
        "original string, description string",
    )
    categories = spark.createDataFrame(CATEGORIES, "ord int, code string, description string")
    rows = {r.ICD10_RAW: r for r in phrase_table(listing, categories).collect()}
    assert list(rows["A0111"].asDict()) == list(OUTPUT)
    assert set(rows) == {"A0111", "A0112", "E55"}
    assert (rows["A0111"].ICD10_CD, rows["E55"].ICD10_CD) == ("A01.11", "E55.")
    assert rows["A0111"].RIGHTHAND_TEXT == "fever left arm"
    assert (rows["A0111"].CHAR_5_TEXT, rows["A0111"].CHAR_6_TEXT) == ("arm fever", "left")
    assert rows["A0111"].LEFTHAND_TEXT == "Fever & chills"


def test_neighbour_diff_removes_longest_first(spark):
    df = spark.createDataFrame([("painful ear left", "pain painful ear"), ("a b", None)], "t string, near string")
    rows = neighbour_diff(df, "t", "near", "x").collect()
    assert [(r.different_x, r.same_x) for r in rows] == [("  left", "painful ear left"), (None, None)]


def test_neighbour_diff_takes_words_as_they_are(spark):
    rows = [
        ("a (b c", "x (b", "a  c", "a (b c"), ("abc a.c", "a.c", "abc ", "a.c"), ("1+1 * [x] {y} ^$|?", "1+1 [x] ?", " *  {y} ^$|", "1+1 * [x] {y} ^$|?"),
        (r"a\\b c", r"a\\b", " c", r"a\\b"), ("x  y", "", "x  y", ""), ("x y", "  y ", "x ", "y"), ("abab ab", "ab abab", " ", "ababab"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "t string, near string").coalesce(1)
    found = neighbour_diff(df, "t", "near", "x").collect()
    assert [(r.t, r.near, r.different_x, r.same_x) for r in found] == rows


def test_words_are_exchanged_once_for_all_levels(spark):
    words = spark.createDataFrame([("A01.11", "arm"), ("A01.12", "arm"), ("A01.12", "leg")], "code string, word string")
    counts = phrases._level_counts(words)
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    found = {(r.code, r.word): (r.n, r.n_5, r.n_6, r.n_7, r.n_8) for r in counts.collect()}
    assert found == {("A01.11", "arm"): (1, 2, 1, 1, 2), ("A01.12", "arm"): (1, 2, 1, 1, 2), ("A01.12", "leg"): (1, 1, 1, 1, 1)}


def test_words_of_equal_hash_are_counted_anew(spark, monkeypatch):
    rng = random.Random(7)
    texts = [(f"A1{rng.choice('12')}.{rng.choice('12')}{rng.choice('12')}{rng.choice('12')}{rng.choice('AD')}", " ".join(rng.choices("arm leg eye ear toe lip".split(), k=5))) for _ in range(60)]
    monkeypatch.setattr(phrases.F, "xxhash64", lambda *c: phrases.F.lit(0).cast("long"))
    got = {r[0]: tuple(r[1:]) for r in phrase_mine(spark.createDataFrame(texts, "code string, description string")).collect()}
    assert got == mined(texts)
