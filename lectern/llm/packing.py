"""Packing along a space-filling curve: neighbours in a sequence are alike.

A document's token counts are hashed into a vector and projected to a few
dimensions. The Hilbert key of that point orders the documents by ranges, and each
range is cut into sequences of a fixed length in that order."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lectern.llm.kernels import chunks, mix
from lectern.llm.tables import arrow_map, written

BUCKETS, DIMENSIONS, BITS = 256, 4, 12
FLUSH_BYTES = 1 << 20
RANGE_TOKENS = 4 << 20

PIECE = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def encoder(ranks_path: str, pattern: str):
    """Byte-level BPE of a file of ranks: the ids the same vocabulary gives in any library."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (n, d) with coordinates below 2**bits,
    by the transposed form of Skilling (2004). d * bits must stay under 64."""
    x = points.T.astype(np.int64).copy()
    d, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(d):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    q = top
    while q > 1:
        carry ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= carry
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(counts: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed token counts (n, BUCKETS): damped, centred on equal
    counts, unit length, projected on fixed signs and spread over the grid."""
    damped = np.sqrt(counts)
    damped -= damped.mean(axis=1, keepdims=True)
    length = np.linalg.norm(damped, axis=1, keepdims=True)
    unit = damped / np.where(length > 0, length, 1)
    cells = np.arange(BUCKETS * DIMENSIONS, dtype=np.uint64) + np.uint64(1)
    signs = ((mix(cells) & np.uint64(1)).astype(np.float64) * 2 - 1).reshape(BUCKETS, DIMENSIONS)
    grid = (np.tanh(unit @ signs) + 1) / 2 * (1 << BITS)
    return hilbert(np.clip(grid.astype(np.int64), 0, (1 << BITS) - 1), BITS)


def _tokenise(ranks_path: str, pattern: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks_path, pattern)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, part in chunks(texts):
                lists = encoding.encode_ordinary_batch([t or "" for t in part.to_pylist()], num_threads=1)
                counts = np.zeros((len(lists), BUCKETS))
                blobs = []
                for row, tokens in enumerate(lists):
                    tokens.append(end_id)
                    array = np.asarray(tokens, "<u4")
                    counts[row] = np.bincount(array[:-1] % BUCKETS, minlength=BUCKETS)
                    blobs.append(array.astype("<u2").tobytes() if array.max() < 1 << 16 else array.tobytes() + b"\0")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(part)),
                        pa.array(curve_keys(counts)),
                        pa.array(np.array([len(t) for t in lists], np.int64)),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["doc_id", "key", "n", "ids"],
                )

    return run


def _wide(blob: bytes) -> np.ndarray:
    """Ids from two bytes each, or four where an odd length marks a larger id."""
    return np.frombuffer(blob[:-1], "<u4") if len(blob) % 2 else np.frombuffer(blob, "<u2").astype("<u4")


def _cut(length: int):
    names = [f.split()[0] for f in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, fill = TaskContext.get().partitionId() << 40, 0
        rows, held = [], 0

        def table() -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.binary())], names=names
            )

        for batch in batches:
            for doc, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = _wide(blob.as_py())
                start = 0
                while start < len(ids):
                    take = min(length - fill, len(ids) - start)
                    piece = ids[start : start + take].tobytes()
                    rows.append((doc, start, take, len(ids), sequence, fill, piece))
                    start, fill, held = start + take, fill + take, held + len(piece)
                    if fill == length:
                        sequence, fill = sequence + 1, 0
                    if held >= FLUSH_BYTES:
                        yield table()
                        rows, held = [], 0
        if rows:
            yield table()

    return run


def pack(
    docs: DataFrame, ranks_path: str, pattern: str, length: int = 2048, end_id: int = 1, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) that put
    every token of every document in one place: ``ids`` are little-endian 32-bit.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone.
    Documents follow the curve, ties by id, count and content, and fill sequences
    one after the other, cut where a sequence is full. Only the last sequence of a
    range is short, so padding is at most one sequence per range, whatever the
    lengths. Equal documents have one key and still fall into several ranges, as the
    id is part of the range key. Repeated rows are packed as often as they occur; an
    empty table gives an empty result. There is a range for each ``RANGE_TOKENS`` tokens, so that none grows with
    the input. Memory: an Arrow batch and its pieces."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tokens = arrow_map(own, _tokenise(ranks_path, pattern, end_id), "doc_id long, key long, n long, ids binary")
    # finding the ranges reads all keys once more, which should not tokenise all texts again
    keyed = written(tokens, "tokens").withColumn("h", F.xxhash64("ids"))
    ranges = max(1, -(-(keyed.agg(F.sum("n")).first()[0] or 0) // RANGE_TOKENS))
    ordered = keyed.repartitionByRange(ranges, "key", "doc_id").sortWithinPartitions("key", "doc_id", "n", "h")
    return arrow_map(ordered.select("doc_id", "ids"), _cut(length), PIECE)
