"""Packing of documents into sequences of fixed length by a grouping genetic algorithm on islands.

Documents are cut only where they are longer than a sequence. Pieces that fill a
sequence are done. The others are dealt by hash into blocks of
some thousand, each a bin-packing problem of its own. Several islands work on each
block as separate tasks; between epochs each island's elite moves to the next
island. A solution is a set of bins: crossover puts well-filled bins of
one parent into the other, removes bins that hold the same pieces, and places the displaced
pieces by best fit, longest first. At the end the best island of each block counts.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codetree.llm.tables import rows_by_key
from codetree.llm.token_ids import TokenIds
from codetree.llm.words import slices
from codetree.staging import stage

SEQUENCE_TOKENS = 2048
BLOCK_PIECES = 8_192
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6


def pieces(df: DataFrame, tokenizer: str, end: int, capacity: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: texts as ids, with ``end`` after each, cut at ``capacity``."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenIds(tokenizer)
        for batch in batches:
            for low, high in slices(batch.column(1)):
                rows: list[tuple] = []
                names = batch.column(0).slice(low, high - low).to_pylist()
                texts = batch.column(1).slice(low, high - low).to_pylist()
                for name, ids in zip(names, encoder.encode_all(texts, end)):
                    for at in range(0, len(ids), capacity):
                        part = ids[at : at + capacity]
                        rows.append((name, at // capacity, at, len(part), zlib.crc32(part.tobytes())))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """A solution that grows by best fit. Bins with the same room are kept together, found by a bit mask."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        self.mask = 0

    def _file(self, b: int) -> None:
        self.by_room.setdefault(self.room[b], []).append(b)
        self.mask |= 1 << self.room[b]

    def take(self, items: list[int], room: int) -> None:
        """Add a ready bin."""
        self.bins.append(items)
        self.room.append(room)
        self._file(len(self.bins) - 1)

    def place(self, items: Iterable[int]) -> None:
        """Put items, in the order given, where they leave the least room."""
        for i in items:
            length = self.lengths[i]
            fits = self.mask >> length
            if fits:
                room = length + (fits & -fits).bit_length() - 1
                held = self.by_room[room]
                b = held.pop()
                if not held:
                    self.mask &= ~(1 << room)
                self.bins[b].append(i)
                self.room[b] = room - length
                self._file(b)
            else:
                self.take([i], self.capacity - length)

    def fitness(self) -> tuple[int, int]:
        """Smaller is better: bins, then room in many bins rather than in few."""
        return len(self.bins), -sum(r * r for r in self.room)

    def numbers(self) -> np.ndarray:
        """The bin of every item."""
        out = np.empty(len(self.lengths), np.int32)
        for b, items in enumerate(self.bins):
            out[items] = b
        return out


def _from_numbers(numbers: np.ndarray, lengths: list[int], capacity: int) -> Bins:
    out = Bins(lengths, capacity)
    groups: list[list[int]] = [[] for _ in range(int(numbers.max()) + 1)]
    for i, b in enumerate(numbers.tolist()):
        groups[b].append(i)
    for items in groups:
        out.take(items, capacity - sum(lengths[i] for i in items))
    return out


def crossover(a: Bins, b: Bins, rng: random.Random) -> Bins:
    """Well-filled bins of ``a`` go into ``b``; displaced items are placed by best fit."""
    order = sorted(range(len(a.bins)), key=a.room.__getitem__)
    best = order[: max(1, len(order) * 2 // 3)]
    chosen = rng.sample(best, max(1, len(best) // 2))
    child = Bins(a.lengths, a.capacity)
    inside: set[int] = set()
    for k in chosen:
        child.take(list(a.bins[k]), a.room[k])
        inside.update(a.bins[k])
    displaced: list[int] = []
    poorest = max(b.room) if b.room else 0
    for items, room in zip(b.bins, b.room):
        if inside.isdisjoint(items) and (room < poorest or not room):
            child.take(list(items), room)
        else:  # it holds an injected item, or is among the poorest and starts anew
            displaced += [i for i in items if i not in inside]
    child.place(sorted(displaced, key=a.lengths.__getitem__, reverse=True))
    return child


def evolve(lengths: list[int], capacity: int, seed: int, immigrants: list[np.ndarray]) -> np.ndarray:
    """The bin of every item in the best solution after one epoch on one island."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    population = [_from_numbers(x, lengths, capacity) for x in immigrants]
    while len(population) < POPULATION:
        if any(len(p.bins) == least for p in population):
            break
        noise = 0.0 if not population else 0.15
        new = Bins(lengths, capacity)
        new.place(sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + noise * rng.random())))
        population.append(new)
    for _ in range(GENERATIONS):
        population.sort(key=Bins.fitness)
        if len(population[0].bins) == least:  # no packing has fewer
            break
        a, b = rng.sample(population[: max(2, POPULATION // 2 + 1)], 2) if len(population) > 1 else (population[0],) * 2
        child = crossover(a, b, rng)
        if child.fitness() < population[-1].fitness() or len(population) < POPULATION:
            population = [*population[: POPULATION - 1], child]
    return min(population, key=Bins.fitness).numbers()


def _epoch(tasks: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One epoch of all islands. ``tasks``: block, island, lengths and elites as binary."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").tolist()
                elites = [np.frombuffer(x, "<i4") for x in row["elites"]]
                seed = (row["block"] * 1_000_003 + row["island"]) * 31 + epoch
                best = evolve(lengths, capacity, seed, elites)
                yield pa.RecordBatch.from_pylist(
                    [{"block": row["block"], "island": row["island"], "bins": int(best.max()) + 1, "numbers": best.astype("<i4").tobytes()}],
                    pa.schema([("block", pa.int64()), ("island", pa.int32()), ("bins", pa.int32()), ("numbers", pa.binary())]),
                )

    columns = tasks.select("block", "island", "lengths", "elites").repartition("block", "island")
    return columns.mapInArrow(work, "block long, island int, bins int, numbers binary")


def pack(items: DataFrame, capacity: int = SEQUENCE_TOKENS, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows ``(doc_id, piece, start, length, ids_crc32)``.

    No sequence holds more than ``capacity`` tokens; its pieces follow each
    other without gaps from offset 0. Lengths are between 1 and ``capacity``. Repeated rows are packed each
    on its own. The number of sequences can exceed the least possible one by about one per block.
    """
    rows = stage(items.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = rows.filter(F.col("length") >= capacity).select(
        *items.columns, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_rows = rows.filter(F.col("length") < capacity)
    blocks = max(1, -(-open_rows.count() // block_pieces))
    open_rows = open_rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,), found in rows_by_key(batches, ["block"]):
            lengths = found["length"].to_numpy().astype("<i4").tobytes()
            yield pa.RecordBatch.from_pylist(
                [{"block": block, "rows": found["row"].to_numpy().astype("<i8").tobytes(), "lengths": lengths}],
                pa.schema([("block", pa.int64()), ("rows", pa.binary()), ("lengths", pa.binary())]),
            )

    dealt = open_rows.select("block", "row", "length").repartition("block").sortWithinPartitions("block", "row")
    problems = stage(dealt.mapInArrow(gather, "block long, rows binary, lengths binary"), "blocks")
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    tasks = problems.select("block", "lengths", islands).withColumn("elites", F.array().cast("array<binary>"))
    for epoch in range(EPOCHS):
        solved = stage(_epoch(tasks, capacity, epoch), "islands")
        own = solved.select("block", "island", F.col("numbers").alias("own"))
        moved = solved.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.col("numbers").alias("come"))
        tasks = own.join(moved, ["block", "island"]).join(problems.select("block", "lengths"), "block")
        tasks = tasks.select("block", "island", "lengths", F.array("own", "come").alias("elites"))
    best = solved.groupBy("block").agg(F.min_by("numbers", F.struct("bins", "island")).alias("numbers"))

    def unfold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = np.frombuffer(row["numbers"], "<i4").astype(np.int64)
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                order = np.argsort(numbers, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                new = np.append(True, numbers[order][1:] != numbers[order][:-1])
                offset = before - np.maximum.accumulate(np.where(new, before, 0))
                columns = [np.frombuffer(row["rows"], "<i8")[order], (np.int64(row["block"]) << 32) + numbers[order], offset]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "sequence_id", "offset"])

    places = problems.join(best, "block").mapInArrow(unfold, "row long, sequence_id long, offset long")
    packed = open_rows.join(places, "row").select(*items.columns, "sequence_id", "offset")
    return full.unionByName(packed)
