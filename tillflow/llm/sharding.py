"""Shards by a keyed permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order of doc_id, checksum and size. A Feistel network with cycle
walking permutes these numbers; the permuted number p lies in shard p mod shards at slot
p div shards. Anyone who knows n, the key and the number of shards can compute where a row goes, and
which row a slot holds, without a table. Shards differ by one row at most (law `rows`).

Cases: a null text has no bytes; null ids come first in the order; rows that repeat get numbers of
their own in some order, which changes nothing but their mutual place; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.batches import mix
from tillflow.llm.storage import written

SHARDS = 24
KEY = 20240229
ROUNDS = 6
ROW_BYTES = 8  # what a row takes besides its text
_IN_PARTITION = (1 << 33) - 1  # the lower bits of monotonically_increasing_id
_U64 = np.uint64


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round_keys(key: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15) + _U64(key))


def _network(x: np.ndarray, half: int, keys) -> np.ndarray:
    mask = _U64((1 << half) - 1)
    left, right = x >> _U64(half), x & mask
    for key in keys:
        left, right = right, left ^ (mix(right + key) & mask)
    # The halves are swapped back, so that the same network with reversed keys is the inverse.
    return (right << _U64(half)) | left


def _walk(numbers: np.ndarray, n: int, keys) -> np.ndarray:
    half = _half_bits(n)
    x = _network(numbers.astype(np.uint64), half, keys)
    outside = np.flatnonzero(x >= _U64(n))
    while len(outside):
        x[outside] = _network(x[outside], half, keys)
        outside = outside[x[outside] >= _U64(n)]
    return x.astype(np.int64)


def permute(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Where row numbers 0 to n - 1 go in the shuffled order."""
    return _walk(np.asarray(numbers), n, _round_keys(key))


def restore(places: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The row numbers at places of the shuffled order."""
    return _walk(np.asarray(places), n, _round_keys(key)[::-1])


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, key: int = KEY) -> int:
    """The global row number that a slot of a shard holds."""
    return int(restore(np.array([slot * shards + shard]), n, key)[0])


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """Rows with a gapless `row_number` from 0 in the given order, and how many there are.

    A range sort deals the rows out, with a tie-breaker so that equal ones can be split. The driver
    adds up one count per partition.
    """
    sorted_rows = (
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "tie")
        .sortWithinPartitions(*order, "tie")
        .withColumn("place", F.monotonically_increasing_id())
        .drop("tie")
    )
    placed = (
        written(sorted_rows, "numbered")
        .withColumn("part", F.shiftright("place", 33))
        .withColumn("place", F.col("place").bitwiseAND(F.lit(_IN_PARTITION)))
    )
    counts = placed.groupBy("part").agg(F.count("*").alias("rows")).orderBy("part").collect()
    starts, total = [], 0
    for part, count in counts:
        starts.append((part, total))
        total += count
    offsets = rows.sparkSession.createDataFrame(starts, "part long, first long")
    joined = placed.join(F.broadcast(offsets), "part")  # as many rows as partitions
    return joined.withColumn("row_number", F.col("first") + F.col("place")).drop(
        "part", "place", "first"
    ), total


def shard_rows(docs: DataFrame, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """One row per document: shard, slot, size in bytes and checksum of its text."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    digests = docs.select(
        F.col("doc_id"),
        (F.octet_length(data).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    rows, total = numbered(digests, "doc_id", "text_crc32", "size")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = permute(batch.column("row_number").to_numpy(), total, key)
            columns = [batch.column(c) for c in ("doc_id", "size", "text_crc32")]
            columns += [pa.array((at % shards).astype(np.int32)), pa.array(at // shards)]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "size", "text_crc32", "shard", "slot"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        place, f"doc_id {kind}, size long, text_crc32 long, shard int, slot long"
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
