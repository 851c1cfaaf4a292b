"""Words and shingles of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of characters other than space and U+0009..U+000D; A-Z
count as a-z. Words and shingles are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values() -> np.ndarray:
    value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    value[ord("A") : ord("Z") + 1] = value[ord("a") : ord("z") + 1]
    return value


_VALUE = _byte_values()
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** 0, base ** 1, ... modulo 2 ** 64, at least ``n`` of them."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, SLICE_BYTES + (SLICE_BYTES >> 2)), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base]


@dataclass
class Words:
    """Words of a run of texts. ``first[d]`` to ``first[d + 1]`` are those of text ``d``.

    ``start`` and ``end`` are byte offsets in ``data``; ``text[d]`` is where text ``d`` starts.
    """

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    text: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts (and the last ends). Null counts as empty."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = filled.buffers()
    bounds = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [low, high) of texts that hold ``limit`` bytes at most, or one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    low, held = 0, 0
    for i, size in enumerate(sizes):
        if i > low and held + size > limit:
            yield low, i
            low, held = i, 0
        held += int(size)
    if low < len(sizes):
        yield low, len(sizes)


def cut_words(texts: pa.Array) -> Words:
    """Find and hash the words of ``texts``."""
    data, text = text_bytes(texts)
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(text), np.int64), none, none, data, text)
    space = _IS_SPACE[data]
    edge = np.zeros(n + 1, bool)  # a text starts here, or the last one ended
    edge[text] = True
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1] | edge[1:n]
    ends[:-1] &= space[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power_table(_BASE, n)[:n], out=total[1:])
    value = (total[end] - total[start]) * _power_table(_INVERSE, n)[start]
    first = np.searchsorted(start, text)
    return Words(mix(value + (end - start).astype(np.uint64)), first, start, end, data, text)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, the first of each text, and the word each starts at.

    A text with fewer words, but at least one, has its whole sequence as its only run.
    """
    n = len(words.hash)
    counts = np.diff(words.first)
    left = np.repeat(words.first[1:], counts) - np.arange(n)  # words from here to the text's end
    combined = np.zeros(n, np.uint64)
    for j in range(k):
        part = mix(words.hash[j:] + np.uint64((j + 1) * _INVERSE % (1 << 64)))
        part[left[: n - j] <= j] = 0
        combined[: n - j] += part
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = np.arange(n) - np.repeat(words.first[:-1], counts)
    keep = np.flatnonzero(at < np.repeat(runs, counts))
    return mix(combined[keep]), np.concatenate([[0], np.cumsum(runs)]), keep


def sums_of(values: np.ndarray) -> np.ndarray:
    """Running sums of ``values``, from which ``span_hashes`` takes the hashes of their runs."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power_table(_BASE, len(values))[: len(values)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs of values from ``start`` to before ``end``, whatever stands around them."""
    return mix((sums[end] - sums[start]) * _power_table(_INVERSE, len(sums))[start])


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as signed integers, which Spark has."""
    return x.view(np.int64)
