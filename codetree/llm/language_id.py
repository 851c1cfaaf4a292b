"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters with single spaces between words; all
runs of one to three characters are hashed to ``2 ** bits`` features. Feature
counts per language are summed by Spark over all training rows; the matrix of
log-probabilities, whose size is languages x features, is broadcast. A batch of
texts is scored as a sparse matrix (row pointers and feature indices) times
that matrix, in numpy.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codetree.llm.tables import free_name
from codetree.llm.words import slices

UNKNOWN = "und"
BITS = 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
# The broadcast matrix may hold this many languages; a table with more is not a language column.
MAX_LANGUAGES = 1_000
_SPACE = 32


@cache
def _fold_table() -> np.ndarray:
    """Lower-case letter of every code point; a space for what is no letter."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for point in range(0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        char = chr(point)
        if unicodedata.category(char)[0] in "LM":
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def features(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: feature indices of all texts, and where each text's start (and the last's end)."""
    points = np.frombuffer("".join([f"\n{t}\n" for t in texts]).encode("utf-32-le"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts], dtype=np.int64)])
    folded = _fold_table()[points]
    keep = folded != _SPACE
    keep[1:] |= folded[:-1] != _SPACE  # the first space of a run
    keep[bounds[:-1]] = keep[bounds[1:] - 1] = True  # a space on either side of a text
    held = folded[keep]
    bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
    mask = np.uint32((1 << bits) - 1)
    value, out = np.zeros(len(held), np.uint32), []
    for n in ORDERS:
        value = value[: len(held) - n + 1] * np.uint32(0x01000193) + held[n - 1 :]
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        own = np.ones(len(held), bool)  # starts of n-grams that end in the same text
        for j in range(1, n):
            own[bounds[1:] - j] = False
        index = ((mixed >> np.uint32(12)) ^ mixed) & mask
        out.append((index[own[: len(index)]], bounds - (n - 1) * np.arange(len(bounds))))
    return out


def _count(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = np.array(batch.column(1).to_pylist(), object)
        for low, high in slices(batch.column(0)):
            texts = batch.column(0).slice(low, high - low).to_pylist()
            for language in set(languages[low:high]):
                blocks = features([t for t, own in zip(texts, languages[low:high]) if own == language], bits)
                counts = sum(np.bincount(index, minlength=1 << bits) for index, _ in blocks)
                totals[language] = totals[language] + counts if language in totals else counts
    for language, counts in totals.items():
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(found)), pa.array(found.astype(np.int32)), pa.array(counts[found])],
            ["lang", "feature", "n"],
        )


@dataclass
class LanguageModel:
    """Languages, the log of their shares, and a row of log-probabilities for each."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray
    bits: int


def train(rows: DataFrame, text: str = "text", lang: str = "lang", bits: int = BITS) -> LanguageModel:
    """Fit on all rows with a text and a language. Without such rows, the model knows no language.

    The driver gets one row per language and feature, at most ``MAX_LANGUAGES * 2 ** bits``.
    """
    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    sums = known.mapInArrow(lambda it: _count(it, bits), "lang string, feature int, n long")
    counted = sums.groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    shares = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy("lang").take(MAX_LANGUAGES + 1)}
    if len(shares) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(shares)
    found = counted.toArrow().to_pandas()
    counts = np.zeros((len(languages), 1 << bits))
    counts[found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), found["feature"].to_numpy(int)] = found["n"]
    counts += SMOOTHING
    weights = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    held = np.array([shares[x] for x in languages], float)
    return LanguageModel(languages, np.log(held / max(held.sum(), 1)), weights, bits)


def _score(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    has_letter = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
    if not model.languages or not has_letter.any():
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    blocks = features([t or "" for t in texts], model.bits)
    total = np.tile(model.prior, (len(texts), 1))
    for k in range(len(model.languages)):
        for index, bounds in blocks:  # row pointers and feature indices of a sparse matrix of ones
            taken = np.append(model.weights[k][index], np.float32(0))
            sums = np.add.reduceat(taken, bounds[:-1], dtype=np.float64)
            total[:, k] += np.where(np.diff(bounds) > 0, sums, 0.0)
    total -= total.max(axis=1, keepdims=True)
    share = np.exp(total)
    share /= share.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
    return names, np.where(has_letter, share[np.arange(len(best)), best], 0.0)


def identify(df: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Add the predicted language and its posterior probability (0 to 1) to every row.

    A null text, one without letters, or any text where the model knows no
    language: ``und`` with score 0. Columns of ``df`` that have one of ``names``
    are replaced. Ties go to the language first in the alphabet. Only the text is read.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    source = free_name(df, "text_in")
    rows = df.withColumn(source, F.col(text)).select(*kept, source)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, languages, scores = batch.column(batch.num_columns - 1), [], []
            for low, high in slices(texts):
                own, score = _score(texts.slice(low, high - low).to_pylist(), held.value)
                languages += own
                scores.append(score)
            columns = [*batch.columns[:-1], pa.array(languages, pa.string()), pa.array(np.concatenate(scores or [np.zeros(0)]))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *names])

    return rows.mapInArrow(work, schema)


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id as text is a multiple of five. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
