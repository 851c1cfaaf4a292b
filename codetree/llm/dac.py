"""Token ids in files of directly addressable codes.

An id is split into chunks of eight bits. Level 0 holds the low chunk of every
id of a segment, level 1 the next chunk of those ids that go on, and so on; a bitmap per
level says which ids go on. A rank directory over the bitmap, one count per 512 bits,
leads from a place in one level to its place in the next, so any id is read
without decoding its neighbours.

A table of files is a folder of Parquet files with one row per segment: its
part and place, the ids of its documents, their first tokens, and the encoded segment as one
binary value: ``DAC1``, number of ids (8 bytes), number of levels (4 bytes), then for each level its
number of chunks (8 bytes), the chunks, the bitmap and the directory, all
little-endian. Documents never go over a segment's end.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codetree.llm.token_ids import TokenIds
from codetree.llm.words import slices

MAGIC = b"DAC1"
SEGMENT_TOKENS = 1 << 18
_BLOCK = 512  # bits per entry of a rank directory
_SCHEMA = "part int, seq int, first_token long, doc_ids array<bigint>, doc_starts array<bigint>, n_tokens long, payload binary"


def encode(ids: np.ndarray) -> bytes:
    """Directly addressable codes of unsigned integers."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        chunks = (rest & np.uint64(0xFF)).astype(np.uint8)
        rest = rest >> np.uint64(8)
        goes_on = rest != 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (_BLOCK // 8)))
        counts = np.bitwise_count(bits).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<u4")
        levels.append(struct.pack("<Q", len(chunks)) + chunks.tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[goes_on]
        if not len(rest):
            return MAGIC + struct.pack("<QI", len(ids), len(levels)) + b"".join(levels)


class Segment:
    """Reads an encoded segment in place."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.size, count = struct.unpack_from("<QI", payload, 4)
        self.levels, at = [], 16
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", payload, at)
            blocks = -(-n // _BLOCK)
            at += 8
            chunks = np.frombuffer(payload, np.uint8, n, at)
            bits = np.frombuffer(payload, np.uint8, blocks * _BLOCK // 8, at + n)
            at += n + len(bits)
            ranks = np.frombuffer(payload, "<u4", blocks + 1, at)
            at += 4 * (blocks + 1)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return self.size

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, each found by rank alone."""
        place = np.asarray(places, np.int64)
        out = np.zeros(len(place), np.uint64)
        who = np.arange(len(place))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[who] |= chunks[place].astype(np.uint64) << np.uint64(8 * level)
            goes_on = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            who, place = who[goes_on], place[goes_on]
            if not len(who):
                break
            block, byte = place // _BLOCK, (place % _BLOCK) >> 3
            own = bits.reshape(-1, _BLOCK // 8)[block]
            own = np.where(np.arange(_BLOCK // 8) < byte[:, None], own, 0)
            last = bits[place >> 3] & ((1 << (place & 7)) - 1).astype(np.uint8)
            before = np.bitwise_count(own).sum(axis=1, dtype=np.int64) + np.bitwise_count(last)
            place = ranks[block].astype(np.int64) + before
        return out

    def all(self) -> np.ndarray:
        """All ids."""
        out = np.zeros(self.size, np.uint64)
        who = np.arange(self.size)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[who] |= chunks.astype(np.uint64) << np.uint64(8 * level)
            who = who[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def write_token_files(
    df: DataFrame, path: str, tokenizer: str, end: int, id_column: str = "doc_id", text: str = "text"
) -> None:
    """Encode every text, append the id ``end``, and write the segments in ascending id order.

    Rows are dealt out by ranges of the id, so a part's number follows the
    order; null ids come first, equal ids by text. A null text is empty.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenIds(tokenizer)
        held: list[np.ndarray] = []
        owners: list[int | None] = []
        part, seq, total = 0, 0, 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held)
            starts = np.concatenate([[0], np.cumsum([len(x) for x in held])[:-1]])
            row = {
                "part": part, "seq": seq, "first_token": total, "doc_ids": owners, "doc_starts": starts.tolist(),
                "n_tokens": len(ids), "payload": encode(ids),
            }
            fields = [("part", pa.int32()), ("seq", pa.int32()), ("first_token", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("doc_starts", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("payload", pa.binary())]
            return pa.RecordBatch.from_pylist([row], pa.schema(fields))

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            for low, high in slices(batch.column(1)):
                texts = batch.column(1).slice(low, high - low).to_pylist()
                names = batch.column(0).slice(low, high - low).to_pylist()
                for name, ids in zip(names, encoder.encode_all(texts, end)):
                    if held and size + len(ids) > SEGMENT_TOKENS:
                        yield segment()
                        seq, total, size = seq + 1, total + size, 0
                        held, owners = [], []
                    held.append(ids)
                    owners.append(name)
                    size += len(ids)
        if held:
            yield segment()

    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text").withColumn("part", F.spark_partition_id())
    rows.mapInArrow(work, _SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files alone.

    ``start`` is the number of ids of all documents before it. Only the sums of the
    parts, a row each, are put in one place to add them up.
    """
    files = spark.read.schema(_SCHEMA).parquet(path)
    before = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    bases = bases.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Segment(row["payload"]).all().astype("<u4")
                starts = np.array(row["doc_starts"], np.int64)
                ends = np.append(starts[1:], len(ids))
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(starts), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["first_token"]), pa.array(ends - starts), pa.array(sums, pa.int64()),
                    ],
                    ["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    read = files.mapInArrow(work, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(bases, "part").select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``(doc_id, place, token)`` for the rows ``(doc_id, place)`` of ``wanted``, read by random access.

    Places count from 0 within the document; those outside it come back with a null token.
    """
    files = spark.read.schema(_SCHEMA).parquet(path)
    index = files.select("part", "seq", F.size("doc_ids").alias("n"), F.posexplode("doc_ids").alias("nth", "doc_id"))
    asked = wanted.join(index, "doc_id").groupBy("part", "seq").agg(F.collect_list(F.struct("doc_id", "nth", "place")).alias("asked"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["payload"])
                bounds = [*row["doc_starts"], len(segment)]
                spans = [(bounds[x["nth"]], bounds[x["nth"] + 1], x["place"]) for x in row["asked"]]
                inside = [0 <= p < b - a for a, b, p in spans]
                tokens = segment.at(np.array([a + p if ok else 0 for (a, b, p), ok in zip(spans, inside)], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["doc_id"] for x in row["asked"]], pa.int64()),
                        pa.array([x["place"] for x in row["asked"]], pa.int64()),
                        pa.array(tokens.astype(np.int64), mask=~np.array(inside, bool)),
                    ],
                    ["doc_id", "place", "token"],
                )

    return files.join(asked, ["part", "seq"]).select("doc_starts", "payload", "asked").mapInArrow(
        work, "doc_id long, place long, token long"
    )
