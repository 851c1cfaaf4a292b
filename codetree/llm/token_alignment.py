"""Alignment of two tokenizers over a corpus: groups of tokens that span the same bytes, and which ids go together.

A text with a space before it is encoded by a byte-level BPE (A, a ``tokenizers``
file) and by a sentencepiece model (B). Where a token of A and one of B end at the same byte,
both sequences are cut; the tokens between two cuts are a group. A token of A
and one of B whose bytes overlap are a link; how often two ids are linked in
all documents is the pair's count.

Exact-text deduplication: documents are grouped by their full text, so each
distinct text is tokenised and aligned once, whatever its copies. Its links
count as often as it has copies, and its measures are joined back by the SHA-256
of the text. The aligned texts are staged with their distinct id pairs; then

1. pair counts are sums over them, added up in every task before the exchange,
2. the most frequent pairs, at most ``HEAVY_PAIRS`` of them, are sent to all
   tasks, which add up their part of each text's measures; every other pair
   stands in few texts and meets its count in a join by pair, so that no pair is
   a hot key and none is left out,
3. texts with many copies (a thousandth of all documents or more, so at most a
   thousand texts) reach their documents by a broadcast, the others by a join.

Null and empty texts, and those whose joined token bytes are not the text's with a
space before (B may not spell every character), have no tokens: their measures
are zero and ``groups`` is empty. Rows that repeat each get their measures. Other
columns are not used and not returned. Empty tables give empty ones.

A's ids come from tiktoken over the same vocabulary, which is four times as fast, where the
file's merges stand in order of their ids; else, and for texts with very long runs, from the
file's own library. Texts are encoded whole; remembering ids of words was tried and is no faster, since
one word in six is new. Tokens of a slice of texts are aligned at once, as arrays over the bytes of the slice.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetree.llm.words import slices
from codetree.staging import stage

#: Pairs sent to all tasks: at most so many, 16 bytes each.
HEAVY_PAIRS = 1 << 18

#: A text with more copies than this part of all documents is sent to all tasks.
HEAVY_SHARE = 1000

# Texts aligned at once hold about this many bytes.
SLICE_BYTES = 1 << 18

# Rows of pairs a worker holds before it adds them up.
HELD_PAIRS = 1 << 20

# How a byte-level pre-tokenizer without options of its own is stated, and the pattern it stands for.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Runs of this length can hold up tiktoken, whose merging is quadratic in them.
LONG_RUN = 1_000


def may_have_long_run(text: str) -> bool:
    """False only where no ``LONG_RUN`` characters in a row are all white space or all not."""
    half = LONG_RUN // 2
    parts = (text[i : i + half] for i in range(0, len(text) - half + 1, half))
    return any(" " not in part or part.isspace() for part in parts)


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for U+0100 and up, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Strings:
    """Many byte strings in one array, to put together by their numbers."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def joined(self, which: np.ndarray) -> np.ndarray:
        size = self.size[which]
        first = np.cumsum(size) - size
        return self.flat[np.repeat(self.start[which] - first, size) + np.arange(int(size.sum()))]


@dataclass
class Aligned:
    """The texts of a slice that have tokens: which they are, their measures, and their distinct id pairs.

    The pairs of text ``t`` stand from ``first[t]`` to ``first[t + 1]``.
    """

    text: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    first: np.ndarray
    a: np.ndarray
    b: np.ndarray
    times: np.ndarray


class Aligner:
    """Two tokenizers, the bytes of their tokens, and the spelling of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(a_path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_of_letter()
        a_bytes = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_strings, self.b_strings = _Strings(a_bytes), _Strings(b_bytes)
        self.most = max(len(a_bytes), len(b_bytes))
        # Ids followed by a comma, by a bar, and by a semicolon.
        self.spelled = _Strings([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.most)])
        self.fast = self._same_vocabulary(a_path, a_bytes)

    def _same_vocabulary(self, a_path: str, a_bytes: list[bytes]):
        """An encoder of tiktoken, if A merges pairs in the order of the ids they become; else None."""
        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if spec.get("normalizer") or spec.get("pre_tokenizer") != _BYTE_LEVEL or model["type"] != "BPE" or model.get("dropout"):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"].get(left + right) != 256 + i for i, (left, right) in enumerate(merges)):
            return None
        try:
            import tiktoken
        except ImportError:
            return None
        ranks = {a_bytes[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, spaced: str) -> np.ndarray:
        """A's ids of a text that begins with its space."""
        if self.fast is None or may_have_long_run(spaced):
            return np.array(self.library.encode(spaced, add_special_tokens=False).ids, np.int32)
        return np.array(self.fast.encode_ordinary(spaced), np.int32)

    def align(self, texts: list[str]) -> Aligned:
        """Aligns texts, none of them empty."""
        a_ids = [self.a_ids(f" {t}") for t in texts]
        b_ids = [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)] if texts else []
        spaced = [f" {t}".encode() for t in texts]
        kept = [
            t
            for t, whole in enumerate(spaced)
            if self.a_strings.joined(a_ids[t]).tobytes() == whole and self.b_strings.joined(b_ids[t]).tobytes() == whole
        ]
        n_a, n_b, size = (np.array([len(x[t]) for t in kept], np.int64) for x in (a_ids, b_ids, spaced))
        a, b = (np.concatenate([x[t] for t in kept]).astype(np.int64) if kept else np.zeros(0, np.int64) for x in (a_ids, b_ids))
        bounds = np.concatenate([[0], np.cumsum(size)])
        a_end, b_end = np.cumsum(self.a_strings.size[a]) - 1, np.cumsum(self.b_strings.size[b]) - 1
        ends_a, ends_b = np.zeros(bounds[-1], bool), np.zeros(bounds[-1], bool)
        ends_a[a_end], ends_b[b_end] = True, True
        cuts = np.flatnonzero(ends_a & ends_b)
        n_groups = np.diff(np.searchsorted(cuts, bounds))
        # Each piece between two ends, of whichever side, lies in one token of A and one of B: a link.
        pieces = np.flatnonzero(ends_a | ends_b)
        of_a, of_b = (np.cumsum(e)[pieces] - e[pieces] for e in (ends_a, ends_b))
        text = np.searchsorted(bounds, pieces, "right") - 1
        pair = (text * self.most + a[of_a]) * self.most + b[of_b]
        pair, times = np.unique(pair, return_counts=True)
        first = np.searchsorted(pair, np.arange(len(kept) + 1) * self.most**2)
        return Aligned(
            np.array(kept, np.int64), n_a, n_b, n_groups, np.bincount(text, minlength=len(kept)),
            self._spell(a, b, np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end), n_a + n_b),
            first, pair // self.most % self.most, pair % self.most, times,
        )

    def _spell(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, tokens: np.ndarray) -> list[bytes]:
        """The groups of each text: ids of A, a bar, ids of B, a semicolon and so on."""
        if not len(a):
            return []
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        mark = np.concatenate([np.where(last_a, 1, 0), np.where(last_b, 2, 0)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        which = (np.concatenate([a, b]) + mark * self.most)[order]
        ends = np.cumsum(self.spelled.size[which])[np.cumsum(tokens) - 1].tolist()
        whole = self.spelled.joined(which).tobytes()
        return [whole[low : high - 1] for low, high in zip([0, *ends], ends)]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner of these files."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Every text but null and empty ones once, with its ``copies``."""
    return docs.filter(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("copies"))


def aligned(texts: DataFrame, a_path: str, b_path: str, spell: bool = True) -> DataFrame:
    """Every distinct text aligned, staged: ``place``, ``key``, ``copies``, numbers of tokens, groups and links, ``groups`` and id pairs.

    ``groups`` spells the groups out, or is the SHA-256 of that with ``spell=False``. ``a``, ``b`` and ``times`` are
    the distinct pairs of linked ids. Texts without tokens are left out.
    """
    schema = "key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups string, a array<int>, b array<int>, times array<int>"

    names = ["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "times"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            for low, high in slices(batch.column("text"), SLICE_BYTES):
                part = batch.slice(low, high - low)
                found = own.align(part.column("text").to_pylist())
                rows = part.take(pa.array(found.text))
                bounds = pa.array(found.first, pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (found.a, found.b, found.times)]
                groups = [g.decode() if spell else hashlib.sha256(g).hexdigest() for g in found.groups]
                measures = [pa.array(x.astype(np.int64)) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                columns = [rows.column("key"), rows.column("copies"), *measures, pa.array(groups, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    done = texts.select(F.sha2("text", 256).alias("key"), "copies", "text").mapInArrow(work, schema)
    return stage(done.withColumn("place", F.monotonically_increasing_id()), "aligned-texts")


def _pairs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id pairs of a batch, how often each is linked in its text, and where each text's pairs start."""
    a, b, times = (batch.column(c) for c in ("a", "b", "times"))
    flat = [c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (a, b, times)]
    sizes = a.value_lengths().to_numpy(zero_copy_only=False)
    return flat[0] << 32 | flat[1], flat[2], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def pair_counts(texts: DataFrame) -> DataFrame:
    """``pair``, its ``n`` links in all documents, and whether that is the ``best`` of its B id; staged.

    A B id has at most as many pairs as A's vocabulary has ids.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def added_up() -> tuple[np.ndarray, np.ndarray]:
            pairs, where = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, where, np.concatenate([n for _, n in held]))
            return pairs, sums

        for batch in batches:
            pairs, times, first = _pairs_of(batch)
            copies = batch.column("copies").to_numpy(zero_copy_only=False)
            held.append((pairs, times * np.repeat(copies, np.diff(first))))
            size += len(pairs)
            if size > HELD_PAIRS:
                held = [added_up()]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], names=["pair", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in added_up()], names=["pair", "n"])

    counts = texts.select("copies", "a", "b", "times").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stage(counts, "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    return stage(counts.withColumn("b", b_id).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def heavy_limit(pairs: DataFrame, most: int) -> int:
    """The least count, a power of two, that at most ``most`` pairs reach. At most 64 numbers come to the driver."""
    level = F.floor(F.log2("n") + 1e-9).cast("int").alias("level")
    found = sorted(((r["level"], r["count"]) for r in pairs.groupBy(level).count().collect()), reverse=True)
    limit, held = 1 << 62, 0
    for at, n in found:
        held += n
        if held > most:
            break
        limit = 1 << at
    return limit


def _sums(texts: DataFrame, pairs: DataFrame, most: int) -> DataFrame:
    """``texts`` without pairs, with ``n_best`` and ``count_sum`` of each."""
    limit = heavy_limit(pairs, most)
    table = pairs.filter(F.col("n") >= limit).toArrow()
    codes = table.column("pair").to_numpy()
    order = np.argsort(codes)
    codes, counts = codes[order], table.column("n").to_numpy()[order]
    best = table.column("best").to_numpy()[order]
    shared = texts.sparkSession.sparkContext.broadcast((codes, counts, best))
    kept = ["place", "key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups"]
    types = {f.name: f.dataType.simpleString() for f in texts.schema}

    def find(pairs_here: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, _, _ = shared.value
        if not len(codes):
            return np.zeros(len(pairs_here), np.int64), np.zeros(len(pairs_here), bool)
        at = np.minimum(np.searchsorted(codes, pairs_here), len(codes) - 1)
        return at, codes[at] == pairs_here

    def heavy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, counts, best = shared.value
        for batch in batches:
            pairs_here, times, first = _pairs_of(batch)
            at, hit = find(pairs_here)
            sums = []
            for value in (best, counts) if len(counts) else ():
                running = np.concatenate([[0], np.cumsum(np.where(hit, times * value[at], 0))])
                sums.append(running[first[1:]] - running[first[:-1]])
            sums = sums or [np.zeros(batch.num_rows, np.int64)] * 2
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, sums)], names=[*kept, "heavy_best", "heavy_sum"])

    def light(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs_here, times, first = _pairs_of(batch)
            _, hit = find(pairs_here)
            place = np.repeat(batch.column("place").to_numpy(), np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(x[~hit]) for x in (place, pairs_here, times)], names=["place", "pair", "times"])

    schema = ", ".join(f"{c} {types[c]}" for c in kept)
    main = texts.mapInArrow(heavy, f"{schema}, heavy_best long, heavy_sum long")
    rest = texts.select("place", "a", "b", "times").mapInArrow(light, "place long, pair long, times long")
    rest = (
        rest.join(pairs.filter(F.col("n") < limit), "pair")
        .groupBy("place")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("light_best"), F.sum(F.col("times") * F.col("n")).alias("light_sum"))
    )
    total = [(F.col(f"heavy_{c}") + F.coalesce(f"light_{c}", F.lit(0))).alias(name) for c, name in (("best", "n_best"), ("sum", "count_sum"))]
    return main.join(rest, "place", "left").select(*[c for c in kept if c != "place"], *total)


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def measures(docs: DataFrame, a_path: str, b_path: str, spell: bool = True) -> DataFrame:
    """``doc_id``, the measures and ``groups`` of every document (their SHA-256 with ``spell=False``)."""
    texts = aligned(distinct_texts(docs), a_path, b_path, spell)
    pairs = pair_counts(texts)
    found = stage(_sums(texts, pairs, HEAVY_PAIRS), "text-measures")
    least = docs.count() // HEAVY_SHARE + 1
    columns = [*MEASURES, "groups"]
    many = found.filter(F.col("copies") >= least).select(F.col("key").alias("many_key"), *(F.col(c).alias(f"many_{c}") for c in columns))
    few = found.filter(F.col("copies") < least).select(F.col("key").alias("few_key"), *(F.col(c).alias(f"few_{c}") for c in columns))
    keyed = docs.select("doc_id", F.when(F.length("text") > 0, F.sha2("text", 256)).alias("key"))
    met = keyed.join(F.broadcast(many), F.col("key") == F.col("many_key"), "left")
    # Documents that are done, or have no text, are dealt out evenly instead of meeting at one key.
    open_key = F.when(F.col("many_key").isNull() & F.col("key").isNotNull(), F.col("key")).otherwise(
        F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    )
    met = met.withColumn("open_key", open_key).join(few, F.col("open_key") == F.col("few_key"), "left")
    either = [F.coalesce(f"many_{c}", f"few_{c}", F.lit(0)).alias(c) for c in MEASURES]
    return met.select("doc_id", *either, F.coalesce("many_groups", "few_groups", F.lit("")).alias("groups"))
