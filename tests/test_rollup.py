import random
from collections import Counter

import pytest

from codetree.operators.rollup import prefix_rollup, rollup_enrich, rollup_map


def loop(fields, threshold):
    """The definition: shorten all unresolved codes by one character at a time."""
    resolved, length = {}, max(map(len, fields))
    while length >= 3:
        rest = [f for f in fields if f not in resolved]
        sizes = Counter(f[:length] for f in rest)
        for f in rest:
            if sizes[f[:length]] >= threshold or length == 3:
                resolved[f] = (f[:length], sizes[f[:length]])
        length -= 1
    return resolved


def frame(spark, fields):
    return spark.createDataFrame([(f,) for f in fields], "field string")


def test_small_example(spark):
    fields = ["S42.01"] * 3 + ["S42.1", "S42.2", "S42.3", "Y01.1"]
    rows = [tuple(r) for r in prefix_rollup(frame(spark, [*fields, None]), threshold=3).collect()]
    assert sorted(rows) == [("S42.01", "S42.01", 3)] * 3 + [
        ("S42.1", "S42.", 3), ("S42.2", "S42.", 3), ("S42.3", "S42.", 3), ("Y01.1", "Y01", 1),
    ]


def test_strip_dot(spark):
    fields = ["S42.1", "S42.2", "S42.3"]
    assert {r.shorten for r in rollup_map(frame(spark, fields), threshold=3, strip_dot=True).collect()} == {"S42"}


def test_nothing_long_enough(spark):
    assert rollup_map(frame(spark, ["A1", "B2"]), threshold=1).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    # One category holds a third of all rows; codes may be shorter than three characters.
    fields = ["H01." + rng.choice("12") + rng.choice(["", "7"])] * 150
    for _ in range(300):
        code = rng.choice("AB") + rng.choice("01") + rng.choice("12") + "." + "".join(rng.choices("123", k=rng.randrange(5)))
        fields.append(code[: rng.choice([2, 3, 9, 9, 9])].rstrip(".") if rng.random() < 0.3 else code)
    threshold = (5, 20)[seed % 2]
    got = {r.field: (r.shorten, r.n) for r in rollup_map(frame(spark, fields), threshold=threshold).collect()}
    assert got == loop(fields, threshold)
    assert len(got) == len(set(fields))


def fast_loop_sizes(fields, threshold):
    return {f: s for f, (s, _) in loop(fields, threshold).items()}


def test_long_codes(spark):
    fields = ["A" * 200, "A" * 199 + "B", "A" * 60 + "C", "B" * 18]
    got = {r.field: r.shorten for r in rollup_map(frame(spark, fields), threshold=2).collect()}
    assert got == fast_loop_sizes(fields, 2)


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None, "A10.1", 7, 1), (None, "A10.1", 8, 2), (1, "A10.1", 7, 3)], "year int, field string, custkey int, day int")
    assert prefix_rollup(df, threshold=2, by=["year"]).count() == 3
    got = {tuple(r) for r in rollup_enrich(df, threshold=2, by=["year"]).collect()}
    assert got == {(None, "A10.1", 2, 2, 1, 2), (1, "A10", 1, 1, 3, 3)}


def test_groups_by_key(spark):
    rows = [(1, "A10.1")] * 2 + [(2, "A10.1"), (2, "A10.2")]
    df = spark.createDataFrame(rows, "year int, field string")
    got = {(r.year, r.field): (r.shorten, r.n) for r in rollup_map(df, threshold=2, by=["year"]).collect()}
    assert got == {(1, "A10.1"): ("A10.1", 2), (2, "A10.1"): ("A10.", 2), (2, "A10.2"): ("A10.", 2)}


def test_enrich_counts_subjects_once_per_group(spark):
    rows = [("A10.1", 7, 1), ("A10.2", 7, 3), ("A10.2", 8, 2), ("B10.1", 7, 9)]
    df = spark.createDataFrame(rows, "field string, custkey int, day int")
    got = {tuple(r) for r in rollup_enrich(df, threshold=3).collect()}
    assert got == {("A10.", 3, 2, 1, 3), ("B10", 1, 1, 9, 9)}
