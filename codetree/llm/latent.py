"""Benchmark decontamination by latent semantic retrieval.

Words of the benchmark are the terms. One pass over the corpus cuts every text into words
and keeps where terms stand; all else reads that table. Passages, runs of
32-word blocks as long as an item can reach over, are TF-IDF vectors that count a term once per block. A
randomised SVD of all passages and items gives the latent space: tasks sum up
``A' (A random)`` over their passages, Spark adds the sums, and the factors follow from
the small result (a one-pass Nystrom scheme).

The search compares every passage with every item in that space, blocks of passages
against all items as matrix products. A passage is a candidate where its part
along an item is at least ``COVERAGE`` of the item itself, or where the share of the item's words in it,
as the space gives them back, is at least ``SHARE``; the latter is for items whose weight lies in few words. Nothing else makes it
one. Candidates are verified by longest common subsequence, and near hits by
the item's answer, its last sentence. A passage that holds an item whole has a part of about
1 along it, whatever else it holds, and one that says an item in words that the corpus uses beside its own
comes close to it as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetree.llm.tables import free_name, rows_by_key
from codetree.llm.words import cut_words, slices
from codetree.staging import stage

BLOCK = 32  # words
RANK = 96
# Items, or parts of ITEM_WORDS of longer ones, compared with the corpus at a time.
BLOCK_ITEMS = 1_000
ITEM_WORDS = 224
COVERAGE, SHARE = 0.45, 0.5
LCS_SURE, LCS_WITH_ANSWER, ANSWER = 0.75, 0.55, 0.8
_MASK = (1 << 20) - 1
_TERM_ROWS = 16  # terms per row of a partial sum
_CHUNK = 1 << 15  # words whose vectors are held at a time
_HELD = 1 << 13  # blocks of passages held at a time


@dataclass
class Item:
    """An item or a part of one: its words, and those of its answer."""

    item_id: int
    words: list[int]
    answer: list[int]


@dataclass
class Terms:
    """Terms in order of their hashes, and a quick test for words that are none."""

    hashes: np.ndarray
    quick: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray) -> Terms:
        quick = np.zeros(_MASK + 1, bool)
        quick[(hashes & np.uint64(_MASK)).astype(np.int64)] = True
        return Terms(hashes, quick)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that are terms, and which terms."""
        at = np.flatnonzero(self.quick[(words & np.uint64(_MASK)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, words[at]), len(self.hashes) - 1)
        right = self.hashes[place] == words[at]
        return at[right], place[right]


def cut_items(texts: list[tuple[int, str]]) -> list[Item]:
    """Items with words, cut where they are long. The answer is the last sentence, or the last quarter."""
    out = []
    for name, text in texts:
        words = cut_words(pa.array([text]))
        hashes = words.hash.tolist()
        last = [words.data[e - 1] in b".?!" for e in words.end]
        for low in range(0, len(hashes), ITEM_WORDS):
            own = hashes[low : low + ITEM_WORDS]
            ends = [i + 1 for i, is_end in enumerate(last[low : low + ITEM_WORDS - 1]) if is_end and 0 < i + 1 < len(own)]
            start = ends[-1] if ends else len(own) - max(1, len(own) // 4)
            out.append(Item(name, own, own[start:]))
    return out


def _parts(wanted: DataFrame) -> DataFrame:
    """(item_id, words, answer) of all items or parts of them, words as signed hashes; staged."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = cut_items(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
            lists = [pa.array([np.array(x, np.uint64).view(np.int64) for x in c], pa.list_(pa.int64())) for c in ([i.words for i in items], [i.answer for i in items])]
            yield pa.RecordBatch.from_arrays([pa.array([i.item_id for i in items], pa.int64()), *lists], ["item_id", "words", "answer"])

    return stage(wanted.mapInArrow(work, "item_id long, words array<long>, answer array<long>"), "items")


def places_of(item: list[int]) -> dict[int, int]:
    """A bit for each place of every word of an item."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


def _common(masks: dict[int, int], size: int, window: list[int], least: float = 0) -> int:
    """Length of the longest common subsequence, or 0 where too few of the item's words stand in the window for ``least``."""
    hits = [masks[w] for w in window if w in masks]
    held = 0
    for hit in hits:
        held |= hit
    if held.bit_count() < least:
        return 0
    full = state = (1 << size) - 1
    for mask in hits:
        hit = state & mask
        if hit:
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def common_subsequence(item: list[int], window: list[int]) -> int:
    """Length of the longest common subsequence, one bit per word of the item."""
    return _common(places_of(item), len(item), window)


def _term_places(rows: DataFrame, terms: Terms) -> DataFrame:
    """(id, n_words, gaps, terms) of the rows with any term: which stand there, and how many words after the one before; staged.

    A term that its block has had already is stored as -1 minus its number.
    """
    held = rows.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_terms = len(held.value.hashes)
        for batch in batches:
            for low, high in slices(batch.column(1)):
                words = cut_words(batch.column(1).slice(low, high - low))
                at, term = held.value.find(words.hash)
                bounds = np.searchsorted(at, words.first)
                sizes = np.diff(words.first)
                text = np.repeat(np.arange(high - low), np.diff(bounds))
                place = at - words.first[text]
                gaps = np.diff(place, prepend=0)
                has = np.diff(bounds) > 0
                gaps[bounds[:-1][has]] = place[bounds[:-1][has]]
                first_block = np.cumsum(sizes // BLOCK + 1) - (sizes // BLOCK + 1)
                _, new = np.unique((first_block[text] + place // BLOCK) * n_terms + term, return_index=True)
                marked = -1 - term
                marked[new] = term[new]
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x.astype(np.int32))) for x in (gaps, marked)]
                columns = [batch.column(0).slice(low, high - low), pa.array(sizes.astype(np.int32)), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "gaps", "terms"]).filter(pa.array(has))

    return stage(rows.mapInArrow(work, "id long, n_words int, gaps array<int>, terms array<int>"), "term-places")


@dataclass
class Stretch:
    """Blocks of several texts or parts of them, in a row, with empty blocks between texts.

    ``block`` and ``term`` are the pairs of them, once; ``word`` and ``which`` all terms and their places in
    words of the row of blocks. Stretch ``s`` holds blocks from ``first[s]`` on of row ``row[s]``, whose block
    ``skipped[s]`` is the first, and its passages begin at the first ``starts[s]`` of them.
    """

    block: np.ndarray
    term: np.ndarray
    word: np.ndarray
    which: np.ndarray
    n: int
    row: np.ndarray
    first: np.ndarray
    skipped: np.ndarray
    starts: np.ndarray


def _stretches(batch: pa.RecordBatch, longest: int) -> Iterator[Stretch]:
    """The blocks of all rows, about ``_HELD`` at a time; passages of up to ``longest`` blocks lie in one stretch."""
    sizes = batch.column(1).to_numpy(zero_copy_only=False)
    gaps, terms = (batch.column(c) for c in (2, 3))
    flat = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    steps = gaps.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))])
    held: list[tuple] = []
    at = 0

    def put() -> Stretch:
        word = np.concatenate([p[0] for p in held])
        which = np.concatenate([p[1] for p in held])
        once = which >= 0
        columns = (np.array([p[i] for p in held], np.int64) for i in range(2, 6))
        return Stretch(word[once] // BLOCK, which[once], word, np.where(once, which, -1 - which), at, *columns)

    for row, size in enumerate(sizes.tolist()):
        own = slice(bounds[row], bounds[row + 1])
        word, which = np.cumsum(steps[own]), flat[own]
        blocks = -(-size // BLOCK)
        for low in range(0, blocks, _HELD):
            starts = min(_HELD, blocks - low)
            a, b = np.searchsorted(word, [low * BLOCK, (low + starts + longest - 1) * BLOCK])
            held.append((word[a:b] - low * BLOCK + at * BLOCK, which[a:b], row, at, low, starts))
            at += starts + longest - 1
            if at >= _HELD:
                yield put()
                held, at = [], 0
    if held:
        yield put()


def _sums(table: np.ndarray, term: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of ``table`` of each block's terms; ``block`` does not fall."""
    out = np.zeros((n, table.shape[1]), np.float32)
    for low in range(0, len(block), _CHUNK):
        own = block[low : low + _CHUNK]
        start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        out[own[start]] += np.add.reduceat(table[term[low : low + _CHUNK]], start, axis=0, dtype=np.float32)
    return out


def _runs(blocks: np.ndarray, length: int) -> np.ndarray:
    """Sums over ``length`` blocks from each on."""
    out = blocks.copy()
    for k in range(1, length):
        out[:-k] += blocks[k:]
    return out


def _block_counts(places: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """In how many blocks of the whole corpus each term occurs, and the number of blocks of texts with any term."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            for held in _stretches(batch, 1):
                counts += np.bincount(held.term, minlength=n_terms)
                total += held.n
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1)), pa.array(np.append(counts[found], total))], ["term", "n"])

    sums = places.mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    counts = np.zeros(n_terms, np.int64)
    own = sums[sums["term"] >= 0]
    counts[own["term"].to_numpy()] = own["n"].to_numpy()
    return counts, int(sums.loc[sums["term"] < 0, "n"].sum())


def _gram_times(places: DataFrame, weight: np.ndarray, random: np.ndarray) -> np.ndarray:
    """``A' A random`` over all passages (two blocks each), added up by Spark.

    A task sends its sums in rows of ``_TERM_ROWS`` terms, so one key's rows are small however many tasks there are.
    """
    held = places.sparkSession.sparkContext.broadcast((weight, random.astype(np.float32)))
    rank = random.shape[1]

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, random = held.value
        weighted = (random * weight[:, None]).astype(np.float32)
        total = np.zeros((len(weight), rank))
        for batch in batches:
            for s in _stretches(batch, 2):
                y = _runs(_sums(weighted, s.term, s.block, s.n), 2)
                y[1:] += y[:-1].copy()  # a block is in the passage that starts there and in the one before
                for at in range(0, len(s.term), _CHUNK):
                    some, block = s.term[at : at + _CHUNK], s.block[at : at + _CHUNK]
                    order = np.argsort(some, kind="stable")
                    start = np.flatnonzero(np.append(True, np.diff(some[order]) != 0))
                    total[some[order][start]] += np.add.reduceat(y[block[order]], start, axis=0)
        total = (total * weight[:, None]).astype(np.float32)
        lows = list(range(0, len(total), _TERM_ROWS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(lows, pa.int64()), pa.array([total[low : low + _TERM_ROWS].tobytes() for low in lows], pa.binary())], ["low", "sums"]
        )

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (low,), found in rows_by_key(batches, ["low"]):
            total = sum(np.frombuffer(x.as_py(), np.float32).astype(float) for x in found["sums"])
            yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([total.tobytes()])], ["low", "sums"])

    parts = places.mapInArrow(partial, "low long, sums binary").repartition("low").sortWithinPartitions("low")
    out = np.zeros((len(weight), rank))
    found = parts.mapInArrow(add, "low long, sums binary").toArrow()
    for low, sums in zip(found["low"].to_pylist(), found["sums"].to_pylist()):
        own = np.frombuffer(sums).reshape(-1, rank)
        out[low : low + len(own)] = own
    return out


def latent_space(places: DataFrame, weight: np.ndarray, items: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors (terms x rank) of all passages and the items, the largest first.

    Items, given as rows of weights, count together as much as all passages.
    """
    random = np.random.default_rng(seed).standard_normal((len(weight), min(len(weight), rank + 8)))
    gram = _gram_times(places, weight, random)
    own = items.T @ (items @ random)
    gram += own * (np.linalg.norm(gram) / max(np.linalg.norm(own), 1e-12) or 1.0)
    if not np.any(gram):
        gram = own
    # Nystrom: A'A is about gram (random' gram)^-1 gram'; a small shift keeps it positive.
    shift = 1e-6 * np.linalg.norm(gram)
    shifted = gram + shift * random
    core = random.T @ shifted
    lower = np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(core.shape[0]))
    left, _, _ = np.linalg.svd(np.linalg.solve(lower, shifted.T).T, full_matrices=False)
    return left[:, :rank]


FOUND = "id long, item_id long, start_word int, end_word int, cosine double, lcs double, answer double"


def _shares(items: list[Item], weight: np.ndarray, often: np.ndarray, space: np.ndarray, length: int) -> np.ndarray:
    """(items x rank) such that a passage's product with a row is about the share of the item's words in it.

    A term that stands in the part ``often`` of all blocks is in so many of a passage's ``length`` blocks, if in one.
    """
    out = np.zeros((len(items), len(weight)))
    for i, item in enumerate(items):
        np.add.at(out[i], item.words, 1 / len(item.words))
    return (out / (weight * (1 + (length - 1) * often))) @ space


def _search(
    places: DataFrame, weight: np.ndarray, often: np.ndarray, space: np.ndarray, items: list[Item], weights: np.ndarray, coverage: float, share: float
) -> DataFrame:
    """(id, item_id, start_word, end_word, cosine, lcs, answer) of verified passages. Words of ``items`` are terms."""
    latent = (weights @ space).astype(np.float32)
    norms = np.linalg.norm(latent, axis=1)
    by_length: dict[int, list[int]] = {}
    for i in range(len(items)):
        if norms[i] > 0:
            by_length.setdefault(-(-len(items[i].words) // BLOCK) + 1, []).append(i)
    groups = [
        (length, own, latent[own] / norms[own][:, None], norms[own], _shares([items[i] for i in own], weight, often, space, length).astype(np.float32))
        for length, own in sorted(by_length.items())
    ]
    vectors = (space * weight[:, None]).astype(np.float32)
    held = places.sparkSession.sparkContext.broadcast((vectors, groups, items))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, groups, items = held.value
        longest = max((length for length, *_ in groups), default=1)
        masks = [(places_of(item.words), places_of(item.answer)) for item in items]
        for batch in batches:
            out: list[tuple] = []
            sizes = batch.column(1).to_pylist()
            for s in _stretches(batch, longest):
                sums = _sums(vectors, s.term, s.block, s.n)
                for length, own, unit, norm, words in groups:
                    passages = _runs(sums, length)
                    likely = (passages @ unit.T >= coverage * norm) | (passages @ words.T >= share)
                    for p, i in zip(*(x.tolist() for x in np.nonzero(likely))):
                        part = int(np.searchsorted(s.first, p, "right")) - 1
                        if p - s.first[part] >= s.starts[part]:
                            continue  # belongs to the next stretch of the text, or to none
                        row, item = int(s.row[part]), items[own[i]]
                        start = int(p - s.first[part] + s.skipped[part]) * BLOCK
                        end = min(start + length * BLOCK, sizes[row])
                        low, high = np.searchsorted(s.word, [p * BLOCK, p * BLOCK + end - start])
                        window = s.which[low:high].tolist()
                        n = len(item.words)
                        lcs = _common(masks[own[i]][0], n, window, LCS_WITH_ANSWER * n) / n
                        if lcs < LCS_WITH_ANSWER:
                            continue
                        answer = _common(masks[own[i]][1], len(item.answer), window) / len(item.answer)
                        if lcs >= LCS_SURE or answer >= ANSWER:
                            cosine = float((passages[p] @ unit[i]) / max(np.linalg.norm(passages[p]), 1e-12))
                            out.append((row, item.item_id, start, end, cosine, lcs, answer))
            if out:
                found, *columns = zip(*out)
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(found)), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["id", "item_id", "start_word", "end_word", "cosine", "lcs", "answer"],
                )

    return places.mapInArrow(work, FOUND)


def _weights(items: list[Item], weight: np.ndarray) -> np.ndarray:
    out = np.zeros((len(items), len(weight)))
    for i, item in enumerate(items):
        out[i, item.words] = weight[item.words]
    return out


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    rank: int = RANK,
    coverage: float = COVERAGE,
    share: float = SHARE,
) -> DataFrame:
    """Documents that hold an item of ``benchmark`` (item_id, text), also with words changed.

    Letter case makes no difference.
    Returns ``(id_column, item_id, start_word, end_word, cosine, lcs, answer)``: per document and item
    the passage with the largest common subsequence (the first of equal ones), its
    cosine in the latent space, and the shares of the item's and of its answer's words in the common subsequence.
    A leak has ``LCS_SURE`` of the item's words in order, or
    ``LCS_WITH_ANSWER`` of them and ``ANSWER`` of the answer's. Null and empty texts and items leak nothing;
    rows with the same id count as one document; ids are numbers. Longer items are cut into parts of ``ITEM_WORDS`` words, each
    searched for itself. The driver holds ``BLOCK_ITEMS`` parts at a time, on average, and their terms; each
    such block of parts is one round over the corpus, so the plan and the scans grow with the benchmark, by a thousandth.
    """
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.lower(text).alias("text")).filter("text IS NOT NULL")
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).filter("text is not null").distinct()
    parts = _parts(wanted)
    found: DataFrame | None = None
    blocks = max(1, -(-parts.count() // BLOCK_ITEMS))
    for k in range(blocks):
        own = parts.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == k).orderBy("item_id", "words").collect()
        if not own:
            continue
        hashes = np.unique(np.concatenate([np.array(r["words"], np.int64) for r in own]).view(np.uint64))

        def numbered(words: list[int]) -> list[int]:
            return np.searchsorted(hashes, np.array(words, np.int64).view(np.uint64)).tolist()

        items = [Item(r["item_id"], numbered(r["words"]), numbered(r["answer"])) for r in own]
        places = _term_places(rows, Terms.of(hashes))
        counts, total = _block_counts(places, len(hashes))
        weight = np.log((total + 1) / (counts + 1)) + 1
        weights = _weights(items, weight)
        space = latent_space(places, weight, weights, rank)
        own_found = stage(_search(places, weight, counts / max(total, 1), space, items, weights, coverage, share), "leaks")
        found = own_found if found is None else found.unionByName(own_found)
    if found is None:
        found = df.sparkSession.createDataFrame([], FOUND)
    best = found.groupBy("id", "item_id").agg(F.max(F.struct("lcs", "answer", (-F.col("start_word")).alias("early"), "end_word", "cosine")).alias("best"))
    return best.select(
        F.col("id").alias(id_column), "item_id", (-F.col("best.early")).alias("start_word"), "best.end_word", "best.cosine", "best.lcs", "best.answer"
    )


def without_leaks(df: DataFrame, found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is not in ``found``. Rows without an id stay."""
    own = free_name(df, "own_id")
    ids = found.select(F.col(id_column).alias(own)).filter(F.col(own).isNotNull()).distinct()
    return df.join(ids, df[id_column] == ids[own], "left_anti")
