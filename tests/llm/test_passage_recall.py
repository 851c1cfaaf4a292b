"""How much of what repeats the compact windows find, against exact 50-word repeats and planted near copies."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from codetree.llm import compact_windows, queries
from codetree.llm.words import cut_words
from tests.llm.test_operators import prose

WORDS = compact_windows.PASSAGE_WORDS


def test_exact_repeats_are_covered(spark):
    """Of all places of sf0.01 where 50 words repeat an earlier document, how many lie in passages found, but for seven words."""
    docs = queries.ready(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    spans = {}
    for r in compact_windows.repeats(docs).collect():
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    seen, places, covered, hit, hurt = set(), 0, 0, set(), set()
    for name, text in rows:
        hashes = cut_words(pa.array([text])).hash.tolist()
        own = [tuple(hashes[i : i + WORDS]) for i in range(len(hashes) - WORDS + 1)]
        inside = np.zeros(len(hashes), bool)
        for low, high in spans.get(name, []):
            inside[low:high] = True
        for i, run in enumerate(own):
            if run in seen:
                places += 1
                hurt.add(name)
                if np.count_nonzero(~inside[i : i + WORDS]) <= 7:
                    covered += 1
                    hit.add(name)
        seen.update(own)
    assert places > 5_000 and covered >= 0.995 * places
    assert len(hit) >= 0.99 * len(hurt)


def test_planted_near_copies_are_covered(spark):
    """Passages of 120 words with a word in each sixty changed, each in two documents among many that share a line."""
    rng = random.Random(8)
    line = prose(999, 30)
    texts, where = {}, {}
    for k in range(150):
        passage = prose(2_000 + k, 120).split()
        other = list(passage)
        for low in (0, 60):
            other[low + rng.randrange(60)] = f"n{rng.random()}"
        before = f"{prose(5_000 + k, rng.randrange(10, 80))} {line}"
        texts[2 * k] = f"{prose(7_000 + k, 40)} {line} {' '.join(passage)} {prose(8_000 + k, 40)}"
        texts[2 * k + 1] = f"{before} {' '.join(other)} {prose(9_000 + k, 40)}"
        where[2 * k + 1] = len(before.split())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = compact_windows.repeats(docs).filter(F.col("other_doc_id") == F.col("doc_id") - 1).collect()
    inside = {d: 0 for d in where}
    for r in found:
        if r["doc_id"] in where:
            low = where[r["doc_id"]]
            inside[r["doc_id"]] += max(0, min(r["end_word"], low + 120) - max(r["start_word"], low))
    assert sum(n >= 70 for n in inside.values()) >= 0.98 * len(where)


def test_parts_of_a_passage_do_not_hide_its_exact_repeat(spark):
    """Before and between two copies of 50 words stand documents with 49 of them, which share most of every window."""
    texts, where = {}, {}
    for k in range(30):
        passage = prose(20_000 + k, WORDS).split()
        shared = [passage[:-1], passage[1:], passage, passage[:-1], passage[1:], passage]
        for i, words in enumerate(shared):
            before = prose(21_000 + 10 * k + i, 60).split()
            texts[10 * k + i] = " ".join([*before, *words, prose(30_000 + 10 * k + i, 60)])
            where[10 * k + i] = len(before)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    spans = {}
    for r in compact_windows.repeats(docs).collect():
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"], r["other_doc_id"]))
    for k in range(30):
        low = where[10 * k + 5]
        assert any(start <= low and low + WORDS <= end and other == 10 * k + 2 for start, end, other in spans.get(10 * k + 5, []))


def test_a_covered_seed_does_not_hide_the_rest_of_its_diagonal():
    """The second line repeats on a diagonal whose first seed lies in the first line, which is found on another one."""
    first, second, noise = (np.arange(n * 1_000, n * 1_000 + 60, dtype=np.uint64) for n in (1, 2, 3))
    a, b = np.concatenate([first, second]), np.concatenate([first, noise, first[30:], second])
    seeds = [(c, c, f) for c in (10, 20) for f in (0, 1)] + [(35, 125, 0), (35, 125, 1)]
    found = compact_windows.passages(a, b, seeds, 46, 2, 0.8)
    inside = np.zeros(len(a), bool)
    for low, high, *_ in found:
        inside[low : high + 1] = True
    assert inside.all()
