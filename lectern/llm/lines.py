"""Line deduplication through sorted hashes.

Hashes of lines are range-partitioned with a secondary order by document, largest
first, and streamed: the first document of a run of one hash keeps its lines. What
comes back is a compressed bitmap of the lines to keep for each document; texts
stay where they are until the bitmaps are applied."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.kernels import chunks
from lectern.llm.tables import arrow_map, drop, settled, written
from lectern.operators.sizing import fits_broadcast

STRIPPED = " \t\n\x0b\x0c\r"

_LINE = "h1 long, h2 long, doc long, body long, n_lines int, places array<int>"
# kind: a document that loses lines; a row of a run that goes on outside its batch; what a batch knows of such a run
_LOSES, _OPEN, _SUMMARY = 0, 1, 2
_STREAMED = f"kind int, {_LINE}, holders long, largest long"


def _line_rows(min_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("body", pa.int64()),
                        ("n_lines", pa.int32()), ("places", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(1)):
                docs = np.asarray(batch.column(0).slice(first, len(texts)))
                bodies = np.asarray(batch.column(2).slice(first, len(texts)))
                lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
                sizes = np.asarray(pc.list_value_length(lists), np.int64)
                lines = lists.flatten()
                row = np.repeat(np.arange(len(texts)), sizes)
                place = np.arange(len(lines)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                keys = pc.ascii_lower(pc.ascii_trim(lines, characters=STRIPPED))
                long_enough = np.flatnonzero(np.asarray(pc.greater_equal(pc.utf8_length(keys), min_chars)))
                if not len(long_enough):
                    continue
                hashes = np.frombuffer(
                    b"".join(xxhash.xxh3_128_digest(k) for k in keys.take(pa.array(long_enough)).to_pylist()), "<i8"
                ).reshape(-1, 2)
                row, place = row[long_enough], place[long_enough]
                order = np.lexsort((place, hashes[:, 1], hashes[:, 0], row))
                row, place, hashes = row[order], place[order], hashes[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]).any(axis=1)
                at = np.flatnonzero(new)
                places = pa.ListArray.from_arrays(
                    pa.array(np.append(at, len(row)).astype(np.int32)), pa.array(place.astype(np.int32))
                )
                row = row[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at, 0]), pa.array(hashes[at, 1]), pa.array(docs[row]), pa.array(bodies[row]),
                     pa.array(sizes[row].astype(np.int32)), places],
                    schema=schema,
                )

    return run


def _stream_runs(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # hash and document of the row before the batch
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2, doc = (np.asarray(batch.column(i)) for i in range(3))
            new = np.ones(n, bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            run_of = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            fresh = new.copy()
            fresh[1:] |= doc[1:] != doc[:-1]
            if before == (h1[0], h2[0], doc[0]):
                fresh[0] = False
            holders = np.add.reduceat(fresh.astype(np.int64), starts)
            largest = doc[starts]
            before = (h1[-1], h2[-1], doc[-1])

            open_run = np.zeros(len(starts), bool)
            open_run[[0, -1]] = True  # these may go on in another batch or partition
            kind = np.full(n, -1, np.int32)
            kind[(holders >= min_docs)[run_of] & (doc != largest[run_of])] = _LOSES
            kind[open_run[run_of]] = _OPEN
            taken = np.flatnonzero(kind >= 0)
            rows = batch.take(pa.array(taken))
            ends = np.unique([0, len(starts) - 1])
            summary = batch.take(pa.array(starts[ends]))
            empty = pa.array([[]] * len(ends), pa.list_(pa.int32()))
            columns = [pa.concat_arrays([a.cast(b.type), b]) for a, b in zip(rows.columns[:5], summary.columns[:5])]
            columns.append(pa.concat_arrays([rows.column(5).cast(empty.type), empty]))
            nothing = np.zeros(len(taken), np.int64)
            kinds = np.concatenate([kind[taken], np.full(len(ends), _SUMMARY, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), *columns, pa.array(np.concatenate([nothing, holders[ends]])),
                 pa.array(np.concatenate([nothing, largest[ends]]))],
                names=["kind", "h1", "h2", "doc", "body", "n_lines", "places", "holders", "largest"],
            )

    return run


def pack_bits(keep: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack_bits(bitmap: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n).astype(bool)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, dropped, maps = batch.column("places"), [], []
        for n, out in zip(batch.column("n_lines").to_pylist(), places):
            keep = np.ones(n, bool)
            keep[out.values.to_numpy()] = False
            dropped.append(int(n - keep.sum()))
            maps.append(pack_bits(keep))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("body"), batch.column("n_lines"), pa.array(dropped, pa.int32()),
             pa.array(maps, pa.binary())],
            names=["doc", "body", "n_lines", "n_dropped", "keep"],
        )


def body_key(text: str) -> Column:
    """Tells apart rows that share an id but not a text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, body, n_lines, n_dropped, keep) of every document that loses lines;
    ``keep`` is a compressed bitmap with a bit for each line, for :func:`unpack_bits`.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys
    of at least ``min_chars`` code points in at least ``min_docs`` documents lose all
    their lines but those of the largest id. Shorter keys are never touched.
    Documents are told apart by id; rows with one id count as one document, and all
    rows of the largest id keep the line. Null ids, like any id, hold lines: null is
    the smallest. A null text is one empty line.

    A line in a third of all documents is spread over tasks, since the document is
    part of the range key. A run that reaches the edge of an Arrow batch is settled
    afterwards, from one summary row per batch."""
    own = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.col(text).alias("text"), body_key(text).alias("body")
    )
    rows = arrow_map(own, _line_rows(min_chars), _LINE)
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    # finding the ranges reads all hashes once more, which should not split all texts again
    hashed = written(rows, "line-hashes")
    ordered = hashed.repartitionByRange(*order).sortWithinPartitions(*order)
    streamed = written(arrow_map(ordered, _stream_runs(min_docs), _STREAMED), "line-runs")
    drop(hashed)
    line = ["doc", "body", "n_lines", "places"]
    known = (
        streamed.filter(F.col("kind") == _SUMMARY)
        .groupBy("h1", "h2")
        .agg(F.sum("holders").alias("holders"), F.max("largest").alias("largest"))
        .filter(F.col("holders") >= min_docs)
    )
    known = written(known, "open-lines")
    # two rows a batch at most: where they are few they go to the open rows, of which a frequent line has many
    known = F.broadcast(known) if fits_broadcast(known) else known
    closed = (
        streamed.filter(F.col("kind") == _OPEN)
        .drop("holders", "largest")
        .join(known, ["h1", "h2"])
        .filter(F.col("doc") != F.col("largest"))
    )
    lost = streamed.filter(F.col("kind") == _LOSES).select(*line).unionByName(closed.select(*line))
    by_doc = lost.groupBy("doc", "body").agg(
        F.max("n_lines").alias("n_lines"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")
    )
    return arrow_map(by_doc, _bitmaps, "doc long, body long, n_lines int, n_dropped int, keep binary")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("_text")
        texts, bits = batch.column(at), batch.column(batch.schema.get_field_index("_keep"))
        out, totals, dropped = [], [], []
        for text, keep in zip(texts, bits):
            text, keep = text.as_py(), keep.as_py()
            if keep is None:
                out.append(text)
                totals.append((text or "").count("\n") + 1)
                dropped.append(0)
                continue
            lines = text.split("\n")
            kept = unpack_bits(keep, len(lines))
            out.append("\n".join(line for line, k in zip(lines, kept) if k))
            totals.append(len(lines))
            dropped.append(int(len(lines) - kept.sum()))
        columns = dict(zip(batch.schema.names, batch.columns))
        del columns["_keep"]
        columns |= {
            "_text": pa.array(out, texts.type), "_total": pa.array(totals, pa.int64()), "_lost": pa.array(dropped, pa.int64()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, key: str = "doc_id", text: str = "text",
    totals: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` without the lines that :func:`keep_bitmaps` marks, all columns as they
    were. A text that loses no line stays as it is, null too; one that loses all
    becomes empty, and an empty table stays empty. A text is read whole, however long; a task holds
    an Arrow batch. ``totals`` names two columns to add: lines before, lines dropped."""
    maps = settled(lambda: keep_bitmaps(docs, min_docs, min_chars, key, text), "bitmaps").select(
        F.col("doc").alias("_doc"), F.col("body").alias("_body"), F.col("keep").alias("_keep")
    )
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row"), F.col(text).alias("_text"))
    keyed = plain.withColumns(
        {"_doc": F.coalesce(F.col("_row")[key].cast("long"), F.lit(-(1 << 63))), "_body": F.xxhash64(F.coalesce("_text", F.lit("")))}
    )
    joined = keyed.join(maps, ["_doc", "_body"], "left").select("_row", "_text", "_keep")
    schema = joined.drop("_keep").withColumns({"_total": F.lit(0).cast("long"), "_lost": F.lit(0).cast("long")}).schema
    applied = arrow_map(joined, _apply, schema)
    out = [F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns]
    if totals:
        out += [F.col("_total").alias(totals[0]), F.col("_lost").alias(totals[1])]
    return applied.select(*out)
