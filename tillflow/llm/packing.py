"""Training sequences packed along a space-filling curve.

Each text becomes a vector of hashed words, projected to a few dimensions; the cell it falls in has a
place on a Hilbert curve, and texts that are near one another in space are mostly near on the curve.
A range sort by that place puts neighbours into one partition, where they are encoded. The tokens of
all texts then form one stream along the curve, cut every 1024 tokens: only the last sequence has
padding, and a sequence holds texts that resemble one another.

Text is shuffled once and encoded once. The driver adds up one token count per partition.

Cases: a null text counts as empty and has the closing token alone; a text without words has the
middle of space; rows that repeat are all packed; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillflow.llm.batches import mix, slices, unit, word_hashes
from tillflow.llm.storage import written

LENGTH = 1024
END = 0  # the id that closes a document
DIMENSIONS, BITS = 4, 10
_U64 = np.uint64
# Fixed value: the pattern that splits text before merging, as for all vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# The curve -------------------------------------------------------------------


def directions(text: pa.Array) -> np.ndarray:
    """Per row, the hashed bag of words projected to a few dimensions, as a unit vector."""
    words, counts = word_hashes(text)
    rows = len(counts)
    sums = np.zeros((rows, DIMENSIONS))
    filled = np.flatnonzero(counts)
    if len(filled):
        heads = np.concatenate([[0], np.cumsum(counts)])[filled]
        for d in range(DIMENSIONS):
            # The projection of a word is a number in [-1, 1) that its hash gives.
            drawn = unit(mix(words + _U64(2 * d + 1))) * 2 - 1
            sums[filled, d] = np.add.reduceat(drawn, heads)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.divide(sums, length, out=np.zeros_like(sums), where=length > 0)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates of `bits` bits.

    Coordinates are turned, from the highest bit down, into those of a Gray code; its bits, one of
    each dimension in turn, make up the place.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for d in range(dims):
            set_here = (x[d] & q) > 0
            swapped = np.where(set_here, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(set_here, x[0] ^ low, x[0] ^ swapped)
            x[d] ^= swapped
        q >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> bit) & 1)
    return key


def curve_places(text: pa.Array) -> np.ndarray:
    """Per row, where its text lies on the curve."""
    cells = np.floor((directions(text) + 1) / 2 * (1 << BITS))
    return hilbert_key(np.clip(cells, 0, (1 << BITS) - 1))


def _with_places(batches):
    for batch in batches:
        text = batch.column("text")
        keys = [curve_places(text.slice(a, b - a)) for a, b in slices(text)]
        keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "curve"]
        )


# Tokens ------------------------------------------------------------------------


def _byte_signs() -> dict[str, int]:
    """Of each sign in the vocabulary file the byte it stands for.

    Printable bytes stand for themselves; the others, in order, have the signs from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Token ids of texts as bytes, two for each id.

    In this kind of vocabulary the id of a token is also its rank in merging, so the faster of the
    two installed encoders can be built from the same file; it gives the same ids. Where it gives up
    on a text, the other one takes over.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        signs = _byte_signs()
        ranks = {bytes(signs[c] for c in t): i for t, i in parts["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        if max([*ranks.values(), *special.values()]) >= 1 << 16:
            raise ValueError("ids must fit in two bytes")
        self.fast = tiktoken.Encoding(
            "packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special
        )
        self.codec = Tokenizer.from_file(path)
        self.codec.no_truncation()
        self.codec.no_padding()

    def _ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except Exception:  # a text that its pattern matcher can't take, of any kind
            return np.array(self.codec.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text, followed by the closing id."""
        close = np.array([END], dtype="<u2").tobytes()
        return [self._ids(text).astype("<u2").tobytes() + close for text in texts]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded_along_curve(docs: DataFrame, path: str) -> DataFrame:
    """Documents encoded in the order of the curve.

    `part` and `first` say where the tokens of a document begin: in which partition, after how many
    tokens there. `ids` holds two bytes for each id, the closing one included.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = docs.select("doc_id", "text").mapInArrow(
        _with_places, f"doc_id {kind}, text string, curve long"
    )
    # Copies share a place; their ids, and a tie-breaker for rows that repeat, deal them out.
    order = ("curve", "doc_id", "tie")
    ordered = (
        placed.withColumn("tie", F.xxhash64("text").bitwiseXOR(F.monotonically_increasing_id()))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", "curve")
    )

    def run(batches):
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                ids = encoder(path).encode([t or "" for t in text.slice(a, b - a).to_pylist()])
                sizes = np.array([len(row) // 2 for row in ids], dtype=np.int64)
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    batch.column("curve").slice(a, b - a),
                    pa.array(np.full(b - a, part, dtype=np.int32)),
                    pa.array(first + np.cumsum(sizes) - sizes),
                    pa.array(sizes),
                    pa.array(ids, pa.binary()),
                ]
                first += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "curve", "part", "first", "doc_tokens", "ids"]
    return ordered.mapInArrow(
        run, f"doc_id {kind}, curve long, part int, first long, doc_tokens long, ids binary"
    )


def packed(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """One row per piece of a document in a sequence.

    start: how many ids of its document come before it; sequence_id and offset: where it goes; ids:
    two bytes for each id.
    """
    rows = written(encoded_along_curve(docs, path), "packed")
    totals = rows.groupBy("part").agg(F.sum("doc_tokens")).orderBy("part").collect()
    starts, base = [], 0
    for part, tokens in totals:
        starts.append((part, base))
        base += tokens
    bases = docs.sparkSession.createDataFrame(starts, "part int, base long")
    # As many rows as partitions.
    placed = rows.join(F.broadcast(bases), "part").withColumn("first", F.col("base") + F.col("first"))

    def cut(batches):
        for batch in batches:
            at, start, size, sequence, offset, ids = [], [], [], [], [], []
            firsts = batch.column("first").to_pylist()
            for k, (first, data) in enumerate(zip(firsts, batch.column("ids"), strict=True)):
                data = memoryview(data.as_py())
                total, done = len(data) // 2, 0
                while done < total:
                    n = min(total - done, length - (first + done) % length)
                    at.append(k)
                    start.append(done)
                    size.append(n)
                    sequence.append((first + done) // length)
                    offset.append((first + done) % length)
                    ids.append(bytes(data[2 * done : 2 * (done + n)]))
                    done += n
            of = pa.array(at, pa.int64())
            columns = [
                batch.column("doc_id").take(of),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                batch.column("doc_tokens").take(of),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
                batch.column("curve").take(of),
                pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = "doc_id start length doc_tokens sequence_id offset curve ids".split()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.select("doc_id", "curve", "first", "doc_tokens", "ids").mapInArrow(
        cut,
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long,"
        " curve long, ids binary",
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids, each id taken as four bytes."""

    def run(batches):
        for batch in batches:
            sums = [
                zlib.crc32(np.frombuffer(ids.as_py(), dtype="<u2").astype("<u4").tobytes())
                for ids in batch.column("ids")
            ]
            columns = [*[batch.column(c) for c in kept], pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "ids_crc32"])

    kept = "doc_id start length doc_tokens sequence_id offset curve".split()
    fields = [f"{c} {pieces.schema[c].dataType.simpleString()}" for c in kept]
    return pieces.mapInArrow(run, ", ".join([*fields, "ids_crc32 long"]))


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """One row per piece, with the checksum of its ids."""
    return piece_digests(packed(docs, path, length))
