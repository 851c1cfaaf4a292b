"""Fill-in-the-middle: documents cut in three and put in another order by rotating blocks in place.

A text is cut into units, a run of A-Z and a-z or one other code point, counted
from left to right. Two cuts give prefix, middle and suffix. In one bytearray
the sentinels are inserted before their segments,

    <P>prefix<M>middle<S>suffix

and neighbouring blocks are exchanged by three reversals: middle and suffix for
the order prefix, suffix, middle (psm), everything before the suffix and the
suffix for suffix, prefix, middle (spm). ``restore`` finds the sentinels,
rotates back and takes them out. A text that holds a sentinel stays plain, so
the way back is exact.

Every row is worked on by itself: nothing is shuffled, and besides its own text
a row needs blocks of 1 MB, however long it is. Null texts count as empty,
empty ones are plain. A null id draws as an empty string does. Rows that repeat
give rows that repeat. Columns other than ``doc_id`` and ``text`` are not used
and not returned, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Of 100 documents, so many are rearranged, and of 100 of those so many have the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

# Bytes looked at or moved at once.
BLOCK = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def reverse(view: np.ndarray, low: int, high: int) -> None:
    """Reverses ``view[low:high]`` in place, a block from either end at a time."""
    while high - low > 1:
        step = min(BLOCK, (high - low) // 2)
        held = view[low : low + step].copy()
        view[low : low + step] = view[high - step : high][::-1]
        view[high - step : high] = held[::-1]
        low, high = low + step, high - step


def exchange(buffer: bytearray, low: int, cut: int, high: int) -> None:
    """Exchanges the neighbours ``buffer[low:cut]`` and ``buffer[cut:high]`` by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, low, cut)
    reverse(view, cut, high)
    reverse(view, low, high)


def _starts(data: np.ndarray, low: int) -> np.ndarray:
    """Which bytes of the block from ``low`` on start a unit."""
    block = data[low : low + BLOCK]
    letter = _LETTER[block]
    starts = (block & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    if low and letter[0] and _LETTER[data[low - 1]]:
        starts[0] = False
    return starts


class Units:
    """The units of one text: how many there are, and at which byte one starts."""

    def __init__(self, text: bytes):
        self.data = np.frombuffer(text, np.uint8)
        self.lows = range(0, len(text), BLOCK)
        self.held = _starts(self.data, 0) if len(self.lows) == 1 else None
        self.before = np.cumsum([0, *(int(np.count_nonzero(self._block(low))) for low in self.lows)])

    def _block(self, low: int) -> np.ndarray:
        return _starts(self.data, low) if self.held is None else self.held

    def __len__(self) -> int:
        return int(self.before[-1])

    def byte(self, unit: int) -> int:
        """Where ``unit`` starts; the text's end for the one after the last."""
        if unit >= len(self):
            return len(self.data)
        block = int(np.searchsorted(self.before, unit, "right")) - 1
        return self.lows[block] + int(np.flatnonzero(self._block(self.lows[block]))[unit - self.before[block]])

    def code_points(self, low: int, high: int) -> int:
        parts = (self.data[at : min(at + BLOCK, high)] for at in range(low, high, BLOCK))
        return sum(int(np.count_nonzero((part & 0xC0) != 0x80)) for part in parts)


@dataclass
class Rearranged:
    """What became of one text."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def rearrange_text(text: bytes, draws: tuple[int, int, int, int]) -> Rearranged:
    """One UTF-8 text, cut where the first two draws say, in the form the other two say."""
    units = Units(text)
    n = len(units)
    if not text or draws[2] % 100 >= REARRANGED or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return Rearranged(n, PLAIN, None, None, text)
    first, second = (units.byte(k) for k in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    buffer = bytearray(text)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle_at, suffix_at = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    form = SPM if draws[3] % 100 < SUFFIX_FIRST else PSM
    exchange(buffer, 0 if form == SPM else middle_at, suffix_at, len(buffer))
    return Rearranged(n, form, units.code_points(0, first), units.code_points(first, second), bytes(buffer))


def restore_text(output: bytes, form: str) -> bytes:
    """The text that ``rearrange_text`` turned into ``output``."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    suffix_at, end = buffer.index(SUFFIX), len(buffer)
    if form == SPM:
        suffix_size = buffer.index(PREFIX)
        exchange(buffer, 0, suffix_size, end)
        middle_at = buffer.index(MIDDLE)
    else:
        middle_at = suffix_at
        suffix_size = buffer.index(MIDDLE) - suffix_at
        exchange(buffer, middle_at, middle_at + suffix_size, end)
    cut = end - suffix_size
    del buffer[cut : cut + len(SUFFIX)]
    del buffer[middle_at : middle_at + len(MIDDLE)]
    del buffer[: len(PREFIX)]
    return bytes(buffer)


def draws(key: Column, seed: str = "1") -> list[Column]:
    """Four numbers below 2 ** 32 that depend on the seed and the key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts hold a block together, or one longer text."""
    low, held = 0, 0
    for i, text in enumerate(texts.cast(pa.large_binary())):
        size = len(text.as_buffer()) if text.is_valid else 0
        if i > low and held + size > BLOCK:
            yield low, i
            low, held = i, 0
        held += size
    if low < len(texts):
        yield low, len(texts)


def rearrange(docs: DataFrame, seed: str = "1") -> DataFrame:
    """``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text of every document."""
    columns = [F.coalesce(F.col("text"), F.lit("")).alias("text"), F.array(*draws(F.col("doc_id"), seed)).alias("draws")]
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, n long, form string, prefix_chars long, middle_chars long, output string"

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _runs(batch.column("text")):
                part = batch.slice(low, high - low)
                texts = part.column("text").cast(pa.large_binary())
                done = [rearrange_text(t, tuple(d)) for t, d in zip(texts.to_pylist(), part.column("draws").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([d.n for d in done], pa.int64()),
                        pa.array([d.form for d in done], pa.string()),
                        pa.array([d.prefix_chars for d in done], pa.int64()),
                        pa.array([d.middle_chars for d in done], pa.int64()),
                        pa.array([d.output for d in done], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return docs.select("doc_id", *columns).mapInArrow(work, schema)


def restore(rearranged: DataFrame) -> DataFrame:
    """The rows of ``rearrange`` with their ``restored`` text, found from ``output`` and ``form`` alone."""
    kept = rearranged.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in kept.schema)}, restored string"

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _runs(batch.column("output")):
                part = batch.slice(low, high - low)
                outputs = part.column("output").cast(pa.large_binary())
                back = [restore_text(o, f) for o, f in zip(outputs.to_pylist(), part.column("form").to_pylist())]
                restored = pa.array(back, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, restored], names=[*part.schema.names, "restored"])

    return kept.mapInArrow(work, schema)
