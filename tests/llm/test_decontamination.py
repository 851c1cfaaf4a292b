"""The latent search against a search that verifies every passage with every item."""

import random

import numpy as np
import pyarrow as pa
import pytest

from codetree.llm import latent, queries
from codetree.llm.words import cut_words
from tests.llm.test_operators import SF, prose


def brute_leaks(texts, items):
    """(document, item) by the common subsequence of every passage, without any candidate step."""
    parts = latent.cut_items([(i, t.lower()) for i, t in items.items() if t])
    out = set()
    for d, text in texts.items():
        words = cut_words(pa.array([(text or "").lower()])).hash.tolist()
        for start in range(0, len(words), latent.BLOCK):
            for item in parts:
                window = words[start : start + (-(-len(item.words) // latent.BLOCK) + 1) * latent.BLOCK]
                lcs = latent.common_subsequence(item.words, window) / len(item.words)
                if lcs >= latent.LCS_WITH_ANSWER:
                    answer = latent.common_subsequence(item.answer, window) / len(item.answer)
                    if lcs >= latent.LCS_SURE or answer >= latent.ANSWER:
                        out.add((d, item.item_id))
    return out


def pairs(found):
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


@pytest.fixture(scope="module")
def planted(spark):
    """All documents of the smallest table, and every item whole, with words changed, with words put in, and in upper case."""
    rng = random.Random(3)
    spark = queries.ready(spark)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    for i, item in items.items():
        words = item.split()
        around = [prose(1_000 + 10 * i + k, rng.randrange(5, 200)) for k in range(5)]
        fewer = [w if rng.random() > 0.15 else f"new{rng.random()}" for w in words]
        last = max(k for k, w in enumerate(words[:-1]) if w[-1] in ".?!" or k == 0)
        answer = [w if k > last or rng.random() > 0.3 else f"new{rng.random()}" for k, w in enumerate(words)]
        more = [x for w in words for x in ([w, f"put{rng.random()}"] if rng.random() < 0.1 else [w])]
        versions = [item, " ".join(fewer), " ".join(answer), " ".join(more), item.upper()]
        texts |= {100_000 + 10 * i + k: f"{around[k]} {v} {around[-1 - k]}" for k, v in enumerate(versions)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    return docs, spark.createDataFrame(list(items.items()), "item_id long, text string"), brute_leaks(texts, items)


def test_recall_of_the_latent_search(planted):
    docs, benchmark, want = planted
    found = pairs(latent.leaks(docs, benchmark))
    assert found <= want
    whole = {p for p in want if p[0] >= 100_000 and p[0] % 10 in (0, 4)}
    reworded = {p for p in want if p[0] >= 100_000 and p[0] % 10 in (1, 2, 3)}
    assert len(whole) >= 2 * benchmark.count() and len(reworded) > benchmark.count()
    assert whole <= found
    assert len(reworded & found) >= 0.95 * len(reworded)
    assert len(want & found) >= 0.95 * len(want)


def test_without_the_space_nothing_is_found(planted):
    docs, benchmark, want = planted
    assert pairs(latent.leaks(docs, benchmark, coverage=float("inf"), share=float("inf"))) == set()
    assert pairs(latent.leaks(docs, benchmark, rank=1)) != want


def test_stretches_and_blocks_of_items_change_nothing(planted, monkeypatch):
    docs, benchmark, _ = planted
    whole = pairs(latent.leaks(docs, benchmark))
    terms = latent.Terms.of(np.unique(cut_words(pa.array([prose(5, 1_000)])).hash))
    rows = docs.sparkSession.createDataFrame([(1, prose(5, 1_000)), (2, prose(5, 40))], "id long, text string")
    batch = latent._term_places(rows.coalesce(1), terms).toArrow().combine_chunks().to_batches()[0]
    (one,) = latent._stretches(batch, 4)
    monkeypatch.setattr(latent, "_HELD", 3)
    several = list(latent._stretches(batch, 4))
    assert len(several) > 8 and sum(int(s.starts.sum()) for s in several) == int(one.starts.sum()) == 34
    assert one.n == 40 and len(set(zip(one.block, one.term))) == len(one.block) == len(set(zip(one.word // latent.BLOCK, one.which)))
    # Every passage of four blocks has the same terms at the same words, wherever texts are cut.
    seen = []
    for held in ([one], several):
        passages = {}
        for s in held:
            for row, first, skipped, starts in zip(s.row, s.first, s.skipped, s.starts):
                for p in range(starts):
                    low, high = np.searchsorted(s.word, [(first + p) * latent.BLOCK, (first + p + 4) * latent.BLOCK])
                    passages[row, skipped + p] = [(w - (first + p) * latent.BLOCK, t) for w, t in zip(s.word[low:high], s.which[low:high])]
        seen.append(passages)
    assert seen[0] == seen[1] and len(seen[0]) == 34
    monkeypatch.undo()
    monkeypatch.setattr(latent, "BLOCK_ITEMS", 7)
    parted = pairs(latent.leaks(docs, benchmark))
    assert len(parted ^ whole) <= 0.03 * len(whole)


def test_long_items_are_searched_in_parts(spark):
    book = prose(77, 1_000)
    docs = spark.createDataFrame([(1, f"{prose(1, 50)} {' '.join(book.split()[400:700])} {prose(2, 50)}"), (2, prose(3, 300))], "doc_id long, text string")
    benchmark = queries.ready(spark).createDataFrame([(5, book)], "item_id long, text string")
    assert latent._parts(benchmark).count() == 5
    assert pairs(latent.leaks(docs, benchmark)) == {(1, 5)}
