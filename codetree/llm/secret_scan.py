"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests takes for keys.

Patterns give the base spans (``assign``, ``access``, ``hex``). The battery adds
``random`` spans: every maximal run of 20 or more letters, digits and ``+/_-``
(with ``=`` at its end) that touches no base span is a candidate. Its encoding
is the smallest listed alphabet that holds its symbols, and its symbols, as
their numbers in that alphabet, go through three tests of randomness:

* chi-squared of the symbol counts against a uniform alphabet,
* runs above and below the middle of the alphabet (Wald and Wolfowitz),
* serial correlation of neighbouring symbols.

A candidate that the three, put together by Fisher's method, tell from a random
string at ``ALPHA`` is no key. But short strings look random to any test, so what
is left must also be unlikely for text, and that depends on the length: under
the null hypothesis that symbols and changes of kind (lower case, upper case,
digit, sign) come as often as in all runs of all documents, the p-value says
how seldom a string of that length has so even an alphabet and so many changes.
The capital that starts a word of three letters or more is no change, or names in
camel case would be keys. Random lower case alone is found from about 100 letters on.
The p-values of all candidates of all documents, split by powers of two of their
length so that many short ones do not decide on few long ones, are held to a
false discovery rate of ``RATE`` by the step-up rule of Benjamini and Hochberg.
What a document's spans are thus depends on the whole table.

Two passes read the texts: one adds up symbols and changes (a few hundred
numbers), one finds spans and candidates, which are staged; the counts of
p-values, by length class and by steps of a twentieth of a power of ten, give the limits.
Nothing but candidates is shuffled, and no group of documents matters to a task.

Null texts count as empty and have no spans. Rows that repeat each get their
spans. Other columns are not used and not returned. An empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetree.llm.words import slices, text_bytes
from codetree.staging import stage

# The patterns of the base kinds, in their order, and the least sizes of their matches.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: Shortest candidate, level of the randomness tests, false discovery rate.
LEAST, ALPHA, RATE = 20, 0.001, 0.01

#: p-values are rounded up to steps of this many powers of ten; all below the last step count as that.
STEP, STEPS = 0.05, 1200

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the smallest alphabet on. Digits alone are numbers, not keys.
ENCODINGS = {
    "digits": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "mixed": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_NAMES = list(ENCODINGS)
_SIZES = np.array([len(a) for a in ENCODINGS.values()])


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every byte: its kind (0 for none), the encodings that hold it as bits, its number in each."""
    kind, held, number = np.zeros(256, np.uint8), np.zeros(256, np.uint32), np.zeros((len(_NAMES), 256), np.int64)
    for i, symbols in enumerate((_LOWER, _UPPER, _DIGITS, "+/_-")):
        kind[[ord(c) for c in symbols]] = i + 1
    for e, alphabet in enumerate(ENCODINGS.values()):
        for i, c in enumerate(alphabet):
            held[ord(c)] |= 1 << e
            number[e, ord(c)] = i
    return kind, held, number


_KIND, _HELD, _NUMBER = _tables()


# Base spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base span in code points, by start and then kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def spelled(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# What text is like


@dataclass
class Background:
    """How often each symbol stands in runs, and how often neighbours in a run are of different kinds."""

    symbols: np.ndarray
    pairs: int
    changes: int

    def change_rate(self) -> float:
        """At least a change in a million pairs, so that a table without any still has a rate."""
        return min(0.999, (self.changes + 1) / (self.pairs + 1_000_000 / max(1, self.changes + 1)) if self.pairs else 0.5)

    def power_sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each encoding, the chance that two, and that three, symbols of text are the same."""
        two, three = np.zeros(len(_NAMES)), np.zeros(len(_NAMES))
        for e in range(len(_NAMES)):
            own = np.where(_HELD >> e & 1, self.symbols, 0).astype(float)
            share = own / own.sum() if own.sum() else np.where(_HELD >> e & 1, 1 / _SIZES[e], 0)
            two[e], three[e] = (share**2).sum(), (share**3).sum()
        return two, three


def _run_bounds(data: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all maximal runs of symbols; no run goes over the end of a text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = _KIND[data] > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[text] = True
    begins, ends = held.copy(), held.copy()
    begins[1:] &= ~held[:-1] | edge[1:-1]
    ends[:-1] &= ~held[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def background(docs: DataFrame) -> Background:
    """Adds up symbols and changes over the runs of all texts."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, pairs, changes = np.zeros(256, np.int64), 0, 0
        for batch in batches:
            texts = batch.column(0)
            for low, high in slices(texts):
                data, text = text_bytes(texts.slice(low, high - low))
                start, end = _run_bounds(data, text)
                own = data[_KIND[data] > 0]
                opens = np.zeros(len(own), bool)
                opens[np.cumsum(end - start)[:-1]] = True
                opens[:1] = True
                symbols += np.bincount(own, minlength=256)
                pairs += int((end - start - 1).sum())
                changes += int(np.count_nonzero(odd_changes(_KIND[own], opens)))
        what = [*np.flatnonzero(symbols).tolist(), 256, 257]
        yield pa.RecordBatch.from_pydict(
            {"what": pa.array(what, pa.int32()), "n": pa.array([*symbols[symbols > 0].tolist(), pairs, changes], pa.int64())}
        )

    rows = docs.select("text").mapInArrow(work, "what int, n long").groupBy("what").agg(F.sum("n").alias("n")).collect()
    found = {r["what"]: r["n"] for r in rows}
    return Background(np.array([found.get(i, 0) for i in range(256)], np.int64), found.get(256, 0), found.get(257, 0))


def odd_changes(kind: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Which symbols are of another kind than the one before them in their run.

    ``opens`` marks the first symbols of runs. A capital before two small letters is like them.
    """
    n = len(kind)
    change = np.zeros(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) & ~opens[1:]
    if n > 2:
        word = np.flatnonzero((kind[:-2] == 2) & (kind[1:-1] == 1) & (kind[2:] == 1) & ~opens[1:-1] & ~opens[2:])
        change[word + 1] = False
        inside = word[word > 0]
        change[inside[kind[inside - 1] == 1]] = False
    return change


# The battery


def _normal_tail(z: np.ndarray) -> np.ndarray:
    """P(Z > z) for a standard normal Z."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])


def _fisher(*p: np.ndarray) -> np.ndarray:
    """The chance that the product of as many uniform numbers is no greater than that of ``p``."""
    x = -sum(np.log(np.clip(q, 1e-300, 1)) for q in p)
    return np.exp(-x) * sum(x**i / math.factorial(i) for i in range(len(p)))


def uniformity(same: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Two-sided p-value of chi-squared against a uniform alphabet of ``k``; ``same`` is the sum of squared counts.

    The statistic's mean is k - 1 and its variance 2 (k - 1)(n - 1) / n, also for few symbols; a gamma
    distribution of that mean and variance is brought to a normal one by its cube root.
    """
    mean = k - 1.0
    degrees = mean * n / np.maximum(n - 1, 1)  # of the chi-squared distribution that has this shape
    x = np.maximum(k / n * same - n, 0) / mean
    z = (np.cbrt(x) - (1 - 2 / (9 * degrees))) / np.sqrt(2 / (9 * degrees))
    return 2 * _normal_tail(np.abs(z))


def runs_test(upper: np.ndarray, runs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two-sided p-value of the number of runs, given how many symbols are in the alphabet's upper half."""
    a, b = upper.astype(float), (n - upper).astype(float)
    mean = 1 + 2 * a * b / n
    variance = (mean - 1) * (mean - 2) / np.maximum(n - 1, 1)
    z = (np.abs(runs - mean) - 0.5).clip(0) / np.sqrt(np.maximum(variance, 1e-9))
    return np.where((a == 0) | (b == 0), 2.0 ** (1 - np.minimum(n, 1000)), 2 * _normal_tail(z))


def serial_test(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two-sided p-value of a lag-one correlation, whose mean is -1 / n; nan is a constant string."""
    return np.where(np.isnan(r), 0, 2 * _normal_tail(np.abs(np.nan_to_num(r) + 1 / n) * np.sqrt(n)))


def text_tail(same: np.ndarray, changes: np.ndarray, n: np.ndarray, encoding: np.ndarray, text: Background) -> np.ndarray:
    """How seldom text of length ``n`` has as few equal pairs of symbols and as many changes of kind."""
    two, three = (s[encoding] for s in text.power_sums())
    pairs = n * (n - 1.0)
    spread = 2 * pairs * (two - two**2) + 4 * pairs * (n - 2) * np.maximum(three - two**2, 0)
    even = _normal_tail(-((same - n) - pairs * two) / np.sqrt(np.maximum(spread, 1e-9)))
    rate, m = text.change_rate(), n - 1.0
    share = np.clip(changes / np.maximum(m, 1), 0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(share > 0, share * np.log(share / rate), 0) + np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - rate)), 0)
    many = np.where(share > rate, np.exp(-m * gain), 1.0)  # an upper bound (Chernoff)
    return _fisher(even, many)


def candidates(data: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes [start, end) of the runs of ``LEAST`` symbols or more."""
    start, end = _run_bounds(data, text)
    keep = end - start >= LEAST
    return start[keep], end[keep]


def battery(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: Background) -> tuple[np.ndarray, np.ndarray]:
    """The encoding and the p-value of each run; 1 where the tests tell it from a random string, or it is a number."""
    n = end - start
    if not len(n):
        return np.zeros(0, np.int64), np.zeros(0)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    run = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) + (start - first)[run]
    symbols = data[at]
    common = np.bitwise_and.reduceat(_HELD[symbols], first)
    encoding = np.argmax(common[:, None] >> np.arange(len(_NAMES), dtype=np.uint32)[None, :] & 1, axis=1)
    value = _NUMBER[encoding[run], symbols]
    k = _SIZES[encoding]
    which, times = np.unique(run * 256 + symbols, return_counts=True)
    same = np.bincount(which // 256, weights=times.astype(float) ** 2, minlength=len(n))

    inner = np.ones(len(run), bool)
    inner[first] = False  # symbols with a neighbour before them in their run
    here, before = np.flatnonzero(inner), np.flatnonzero(inner) - 1
    upper = value * 2 >= k[run]
    runs = 1 + np.bincount(run[here], weights=upper[here] != upper[before], minlength=len(n))
    changes = np.bincount(run, weights=odd_changes(_KIND[symbols], ~inner), minlength=len(n))
    off = value - (np.bincount(run, weights=value, minlength=len(n)) / n)[run]
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.bincount(run[here], weights=off[here] * off[before], minlength=len(n)) / np.bincount(run, weights=off**2, minlength=len(n))
    random = _fisher(uniformity(same, n, k), runs_test(np.bincount(run, weights=upper, minlength=len(n)), runs, n), serial_test(r, n))
    p = text_tail(same, changes, n, encoding, text)
    return encoding, np.where((random >= ALPHA) & (encoding > 0), p, 1.0)


# False discovery control


def step_of(p: np.ndarray) -> np.ndarray:
    """The step of a p-value, whose upper end is 10 ** (-STEP * step): never less than ``p`` but on the last."""
    return np.clip(np.floor(-np.log10(np.clip(p, 1e-300, 1)) / STEP), 0, STEPS).astype(np.int64)


def limits(counts: Iterable[tuple[int, int, int]], rate: float = RATE) -> dict[int, int]:
    """The least step that is a discovery, per length class, from (class, step, candidates)."""
    classes: dict[int, dict[int, int]] = {}
    for c, step, n in counts:
        classes.setdefault(c, {})[step] = n
    out = {}
    for c, steps in classes.items():
        tests, found = sum(steps.values()), 0
        for step in sorted(steps, reverse=True):
            found += steps[step]
            if step and 10 ** (-STEP * step) <= rate * found / tests:
                out[c] = step
    return out


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every document: base spans, and all with the random ones among them."""
    text = background(docs)
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, base array<struct<start:long,kind:int,end:long>>, runs array<struct<start:long,end:long,size:int,step:int>>"
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("size", pa.int32()), ("step", pa.int32())]))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column("text")):
                part = batch.slice(low, high - low)
                bases, runs = _scan_slice(part.column("text"), text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(bases, span), pa.array(runs, run)], names=["doc_id", "base", "runs"]
                )

    found = stage(docs.select("doc_id", "text").mapInArrow(work, schema), "secret-candidates")
    counts = found.select(F.explode("runs").alias("run")).groupBy("run.size", "run.step").count().collect()
    least = limits([(r["size"], r["step"], r["count"]) for r in counts], rate)
    kept = F.filter("runs", lambda r: r["step"] >= _limit(r["size"], least))
    added = F.transform(
        kept, lambda r: F.struct(r["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), r["end"].alias("end"))
    )
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _limit(size: Column, least: dict[int, int]) -> Column:
    """The least step of a length class that is kept; none is where the class has no discovery."""
    out = F.lit(STEPS + 1)
    for c, step in least.items():
        out = F.when(size == c, F.lit(step)).otherwise(out)
    return out


def _scan_slice(texts: pa.Array, text: Background) -> tuple[list, list]:
    """Base spans and candidates (with length class and step) of each text, in code points."""
    data, first = text_bytes(texts)
    start, end = candidates(data, first)
    bases = [[{"start": s, "kind": k, "end": e} for s, k, e in base_spans(t)] if t else [] for t in texts.to_pylist()]
    runs: list[list] = [[] for _ in bases]
    if not len(start):
        return bases, runs
    _, p = battery(data, start, end, text)
    # A pad of '=' belongs to the run before it.
    padded = end.copy()
    last = first[np.searchsorted(first, start, "right")]
    for _ in range(2):
        more = (padded < last) & (data[np.minimum(padded, len(data) - 1)] == ord("="))
        padded = padded + more
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    doc = np.searchsorted(first, start, "right") - 1
    low, high = points[start] - points[first[doc]], points[padded] - points[first[doc]]
    size = np.floor(np.log2(end - start)).astype(int)
    for d, s, e, c, step in zip(doc.tolist(), low.tolist(), high.tolist(), size.tolist(), step_of(p).tolist()):
        if not any(b["start"] < e and s < b["end"] for b in bases[d]):
            runs[d].append({"start": s, "end": e, "size": c, "step": step})
    return bases, runs


def spelled_spans(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
