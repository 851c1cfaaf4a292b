"""Small helpers for operators: free column names, groups that arrive sorted, membership filters."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetree.staging import scratch

# Bits of a membership filter: 8 MB, whatever the table holds.
FILTER_BITS = 1 << 26


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def rows_by_key(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows that come sorted by ``keys``, also where a group goes over several batches."""
    held: list[pa.RecordBatch] = []
    key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            own = tuple(c[low].item() if hasattr(c[low], "item") else c[low] for c in columns)
            if key is not None and own != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(low, high - low))
    if key is not None:
        yield key, pa.Table.from_batches(held)


def filter_bits(df: DataFrame, key: str) -> np.ndarray:
    """A bit for each hash value of a long column, in 8 MB: what is not set is not in the table.

    The bits are put together by an aggregate; the driver gets at most 2 ** 20 words.
    """
    place = F.pmod(F.col(key), F.lit(FILTER_BITS))
    words = (
        df.select((place / 64).cast("long").alias("word"), F.expr("shiftleft(1L, cast(pmod(`%s`, 64) as int))" % key).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow().to_pandas()
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the signed keys can be in the table that ``bits`` were made of."""
    place = (keys.view(np.uint64) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def free_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of finished jobs now.

    Its cleaner drops what nothing refers to any more, but only learns of it when the driver's heap is
    collected, which on a quiet driver is long after the executors' disks have filled.
    """
    gc.collect()
    spark._jvm.System.gc()


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a staged table, with the shuffle files of making it gone."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    free_shuffles(df.sparkSession)
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes settled tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(table._settled_at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
