"""Terms counted where their passage lies.

A passage travels as one row with the terms it holds, and never as a row per term. The most frequent
terms of a corpus are found without moving all of them: terms are dealt by hash into ``1 << SLOT_BITS`` slots, and
the sum of a slot is no less than the count of any term in it. Only terms of heavy slots are counted by name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lectern.functions.text import Tokenizer, bigrams, unigrams_and_bigrams
from lectern.operators.blocks import BLOCK
from lectern.operators.sizing import arrow_rows

TERM_TEXTS = 256  # passages whose terms are counted at a time inside a task
SLOT_BITS = 24
PART_BITS = 16  # slots of a part of the sketch
_FLUSH = 1 << 21  # slots that a task holds before it hands them on
_ASKED = 1 << 19  # pairs of bucket and term that it does


def packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, dtype: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


def slot(term: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(term), 64 - SLOT_BITS).cast("int")


# -- terms of some texts --------------------------------------------------

def texts_terms(texts: pa.RecordBatch, with_bigrams: bool, wanted: np.ndarray | None = None) -> tuple[pa.Array, pa.Array]:
    """(row, term) of every token, and of every pair of neighbours, of some texts (tokens). With ``wanted``, a flag
    for each slot, only of those in wanted slots, which come with the texts (slots, pair_slots)."""
    rows, words = pc.list_parent_indices(texts["tokens"]), texts["tokens"].flatten()
    asked = [None, None] if wanted is None else [pa.array(wanted[texts[c].flatten().to_numpy()]) for c in ("slots", "pair_slots")[: 1 + with_bigrams]]
    kept_rows, kept = (rows, words) if wanted is None else (rows.filter(asked[0]), words.filter(asked[0]))
    if with_bigrams and len(words) > 1:
        inside = pc.equal(rows[1:], rows[:-1])
        sides = [rows[1:].filter(inside), words[:-1].filter(inside), words[1:].filter(inside)]
        if wanted is not None:
            sides = [x.filter(asked[1]) for x in sides]
        kept_rows = pa.concat_arrays([kept_rows, sides[0]])
        kept = pa.concat_arrays([kept, pc.binary_join_element_wise(sides[1], sides[2], " ")])
    if kept.null_count:
        kept_rows, kept = kept_rows.filter(kept.is_valid()), kept.drop_null()
    return kept_rows, kept


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, TERM_TEXTS):
            yield batch.slice(i, TERM_TEXTS)


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table[name].combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _tokens(passages: DataFrame, tokenizer: Tokenizer, with_bigrams: bool, slots: bool) -> DataFrame:
    """(pid, dl, tokens) and, if asked, the slots of the tokens and of the pairs of neighbours."""
    tokens = passages.select("pid", tokenizer(F.col("text")).alias("tokens"))
    extra = [F.transform("tokens", slot).alias("slots")] * slots
    extra += [F.transform(bigrams(F.col("tokens")), slot).alias("pair_slots")] * (slots and with_bigrams)
    return tokens.select("pid", F.size("tokens").cast("long").alias("dl"), "tokens", *extra)


# -- the most frequent terms ----------------------------------------------

class Sketch:
    """Counts of the terms of a corpus by slot, in parts, on the driver and packed: at most some
    30 MB, whatever the corpus."""

    def __init__(self, parts: dict[int, bytes]):
        self.parts = parts

    def sums(self, part: int) -> np.ndarray:
        return unpacked(self.parts[part], np.int64, 1 << PART_BITS)

    def floor(self, k: int) -> int:
        """The sum of the slot that is k-th by its sum; 0 where fewer have any."""
        best = np.zeros(0, np.int64)
        for part in self.parts:
            best = np.concatenate([best, self.sums(part)])
            best = np.partition(best, -k)[-k:] if len(best) > k else best
        return int(best.min()) if len(best) == k else 0

    def heavy(self, floor: int) -> np.ndarray | None:
        """A flag for each slot whose sum is ``floor`` at least, as bits; None for all slots."""
        if floor < 1:
            return None
        bits = np.zeros(1 << SLOT_BITS, bool)
        for part in self.parts:
            bits[part << PART_BITS : (part + 1) << PART_BITS] = self.sums(part) >= floor
        return np.packbits(bits)


def slot_sums(slots: np.ndarray) -> pa.RecordBatch:
    """(part, n, slots, sums): how often each of some slots occurs, a row for each part."""
    found, counts = np.unique(slots, return_counts=True)
    parts = found >> PART_BITS
    edges = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(found) else np.empty(0, int)
    ends = np.append(edges[1:], len(found))
    low = (found & ((1 << PART_BITS) - 1)).astype(np.int32)
    cut = [(packed(np.diff(low[a:b], prepend=0).astype(np.uint16)), packed(counts[a:b].astype(np.int64))) for a, b in zip(edges, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(parts[edges], pa.int32()), pa.array(ends - edges, pa.int32()), *(pa.array([c[i] for c in cut], pa.binary()) for i in (0, 1))],
        names=["part", "n", "slots", "sums"],
    )


def _merged_sums(rows: pa.Table) -> pa.Table:
    sums = np.zeros(1 << PART_BITS, np.int64)
    for n, slots, counts in zip(*(rows[c].to_pylist() for c in ("n", "slots", "sums"))):
        sums[np.cumsum(unpacked(slots, np.uint16, n), dtype=np.int64)] += unpacked(counts, np.int64, n)
    return pa.table({"part": rows["part"][:1], "sums": pa.array([packed(sums)], pa.binary())})


def term_sketch(passages: DataFrame, tokenizer: Tokenizer, with_bigrams: bool) -> Sketch:
    tokens = passages.select(tokenizer(F.col("text")).alias("tokens"))
    terms = unigrams_and_bigrams(F.col("tokens")) if with_bigrams else F.col("tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch["slots"].flatten().to_numpy())
            if sum(map(len, held)) >= _FLUSH:
                yield slot_sums(np.concatenate(held))
                held = []
        if held:
            yield slot_sums(np.concatenate(held))

    parts = arrow_rows(tokens.select(F.transform(terms, slot).alias("slots")), count, "part int, n int, slots binary, sums binary")
    sums = parts.groupBy("part").applyInArrow(_merged_sums, "part int, sums binary")
    return Sketch({r["part"]: r["sums"] for r in sums.toLocalIterator()})


def counts_of(passages: DataFrame, tokenizer: Tokenizer, with_bigrams: bool, heavy: np.ndarray | None) -> DataFrame:
    """(term, cf, df) of the terms in ``heavy`` slots (bits), or of all."""
    shared = passages.sparkSession.sparkContext.broadcast(heavy)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if shared.value is None else np.unpackbits(shared.value).view(bool)
        for texts in _slices(batches):
            rows, terms = texts_terms(texts, with_bigrams, wanted)
            found = pa.table({"row": rows, "term": terms}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
            sums = found.group_by("term", use_threads=False).aggregate([("count_all", "sum"), ([], "count_all")])
            names = ("term", "count_all_sum", "count_all")
            yield pa.RecordBatch.from_arrays([_column(sums, c) for c in names], names=["term", "cf", "df"])

    tokens = _tokens(passages, tokenizer, with_bigrams, heavy is not None).drop("pid", "dl")
    found = arrow_rows(tokens, count, "term string, cf long, df long")
    return found.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


# -- passages as rows of term codes ---------------------------------------

def _bits(slots: list[int]) -> np.ndarray:
    bits = np.zeros(1 << SLOT_BITS, bool)
    bits[slots] = True
    return np.packbits(bits)


class Codes:
    """A vocabulary (term, idf) that every executor holds: the code of a term is its place in the order of the terms."""

    def __init__(self, vocabulary: DataFrame):
        listed = vocabulary.select("term", "idf", slot(F.col("term")).alias("slot")).toArrow().combine_chunks().sort_by("term")
        self.terms, self.idf = _column(listed, "term"), _column(listed, "idf").to_numpy()
        self.shared = vocabulary.sparkSession.sparkContext.broadcast((self.terms, self.idf, _bits(_column(listed, "slot").to_numpy())))

    def counts(self, passages: DataFrame, tokenizer: Tokenizer, with_bigrams: bool) -> DataFrame:
        """(pid, codes, tfs): the known terms of each passage and their counts, in the order of the codes. Passages
        without one are left out."""
        shared = self.shared

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms, idf, bits = shared.value
            wanted = np.unpackbits(bits).view(bool)
            for texts in _slices(batches):
                rows, found = texts_terms(texts, with_bigrams, wanted)
                codes = pc.index_in(found, value_set=terms)
                rows, codes = rows.filter(codes.is_valid()).to_numpy(), codes.drop_null().to_numpy()
                pairs, tfs = np.unique(rows.astype(np.int64) * max(len(idf), 1) + codes, return_counts=True)
                rows, codes = np.divmod(pairs, max(len(idf), 1))
                held, sizes = np.unique(rows, return_counts=True)
                at = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (codes, tfs)]
                yield pa.RecordBatch.from_arrays([texts["pid"].take(pa.array(held)), *lists], names=["pid", "codes", "tfs"])

        pid = passages.schema["pid"].dataType.simpleString()
        tokens = _tokens(passages, tokenizer, with_bigrams, True).drop("dl")
        return arrow_rows(tokens, count, f"pid {pid}, codes array<int>, tfs array<int>")


def _unit(codes: np.ndarray, tfs: np.ndarray, rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf-idf weights, those of a row of unit length."""
    w = tfs * idf[codes]
    return w / np.sqrt(np.bincount(rows, w * w))[rows]


def _code_weights(texts: pa.RecordBatch, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, weight) of some passages (codes, tfs)."""
    rows = pc.list_parent_indices(texts["codes"]).to_numpy()
    codes, tfs = (texts[c].flatten().to_numpy() for c in ("codes", "tfs"))
    return rows, codes, _unit(codes, tfs, rows, idf)


def coded_weights(counted: DataFrame, codes: Codes) -> DataFrame:
    """(pid, terms, ws) from (pid, codes, tfs)."""
    shared = codes.shared

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf, _ = shared.value
        for texts in _slices(batches):
            _, code, w = _code_weights(texts, idf)
            at = pa.array(np.append(0, np.cumsum(pc.list_value_length(texts["codes"]).to_numpy())), pa.int32())
            lists = [pa.ListArray.from_arrays(at, x) for x in (terms.take(pa.array(code)), pa.array(w))]
            yield pa.RecordBatch.from_arrays([texts["pid"], *lists], names=["pid", "terms", "ws"])

    pid = counted.schema["pid"].dataType.simpleString()
    return arrow_rows(counted, weigh, f"pid {pid}, terms array<string>, ws array<double>")


def coded_blocks(counted: DataFrame, codes: Codes, shards: int) -> DataFrame:
    """Posting blocks as by ``blocks.posting_blocks``, of the unit weights of (pid, codes, tfs)."""
    shared = codes.shared
    placed = counted.withColumn("shard", F.pmod(F.xxhash64("pid"), F.lit(shards)).cast("int")).repartition(shards, "shard")

    def cut(shard: pa.Table) -> pa.Table:
        terms, idf, _ = shared.value
        shard = shard.combine_chunks()
        rows, code, w = _code_weights(shard.to_batches()[0], idf)
        pids = _column(shard, "pid").to_numpy()[rows]
        order = np.lexsort((pids, code))
        code, pids, w = code[order], pids[order], w[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, int)
        sizes = np.diff(np.append(first, len(code)))
        blocks = -(-sizes // BLOCK)  # of each term
        number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = np.repeat(first, blocks) + number * BLOCK
        at = pa.array(np.append(starts, len(code)), pa.int32())
        return pa.table({
            "shard": shard["shard"][:1].take(pa.array(np.zeros(len(starts), np.int64))),
            "term": terms.take(pa.array(code[starts])),
            "block": pa.array(number, pa.int32()),
            "bound": pa.array(np.maximum.reduceat(w, starts) if len(starts) else w),
            "pids": pa.ListArray.from_arrays(at, pa.array(pids, pa.int64())),
            "impacts": pa.ListArray.from_arrays(at, pa.array(w)),
        })

    return placed.groupBy("shard").applyInArrow(cut, "shard int, term string, block int, bound double, pids array<bigint>, impacts array<double>")


# -- passages as rows of terms --------------------------------------------

def posting_rows(passages: DataFrame, tokenizer: Tokenizer, with_bigrams: bool) -> DataFrame:
    """(pid, dl, terms, tfs): a row for each passage. ``dl`` counts single tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _slices(batches):
            rows, terms = texts_terms(texts, with_bigrams)
            found = pa.table({"row": rows, "term": terms}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")]).sort_by("row")
            sizes = np.bincount(found["row"].to_numpy(), minlength=texts.num_rows)
            at = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, _column(found, c)) for c in ("term", "count_all")]
            yield pa.RecordBatch.from_arrays([texts["pid"], texts["dl"], *lists], names=["pid", "dl", "terms", "tfs"])

    pid = passages.schema["pid"].dataType.simpleString()
    return arrow_rows(_tokens(passages, tokenizer, with_bigrams, False), count, f"pid {pid}, dl long, terms array<string>, tfs array<long>")


def exploded(rows: DataFrame, **lists: str) -> DataFrame:
    """A row for each place of some lists of equal length, under names of their own."""
    others = [c for c in rows.columns if c not in lists]
    zipped = rows.select(*others, F.explode(F.arrays_zip(*lists)).alias("_z"))
    return zipped.select(*others, *[F.col("_z")[c].alias(name) for c, name in lists.items()])


def _distinct(held: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(held).group_by(["bucket", "term"], use_threads=False).aggregate([])


def _ipc(texts: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(texts)
    return out.getvalue().to_pybytes()


def weights_by_bucket(rows: DataFrame, vocabulary: DataFrame, buckets: int) -> DataFrame:
    """(pid, terms, ws) from (pid, dl, terms, tfs) and a vocabulary of any size: unit weights of the known terms.

    Passages are dealt into buckets, as a table bucketed on pid is. A bucket asks for each of its terms
    once, and what it is told meets the passages of the bucket."""
    pid = rows.schema["pid"].dataType.simpleString()
    empty = pa.table({"pid": pa.array([], pa.int32() if pid == "int" else pa.int64()), "terms": pa.array([], pa.list_(pa.string())), "ws": pa.array([], pa.list_(pa.float64()))})
    placed = rows.select(F.pmod(F.hash("pid"), F.lit(buckets)).alias("bucket"), "pid", "terms", "tfs")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for texts in _slices(batches):
            own = pc.list_parent_indices(texts["terms"])
            held.append(_distinct([pa.table({"bucket": texts["bucket"].take(own), "term": texts["terms"].flatten()})]))
            if sum(t.num_rows for t in held) >= _ASKED:
                held = [_distinct(held)]
                if held[0].num_rows >= _ASKED // 2:
                    yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from _distinct(held).combine_chunks().to_batches()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _slices(batches):
            own = texts["bucket"].to_numpy()
            buckets = np.unique(own)
            tables = [_ipc(texts.select(["pid", "terms", "tfs"]).take(pa.array(np.flatnonzero(own == b)))) for b in buckets]
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(tables, pa.binary())], names=["bucket", "texts"])

    def weigh(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not (texts.num_rows and known.num_rows):
            return empty
        texts = pa.concat_tables(pa.ipc.open_stream(x.as_buffer()).read_all() for x in texts["texts"])
        lists = _column(texts, "terms")
        terms, rows = lists.flatten(), pc.list_parent_indices(lists)
        code = pc.index_in(terms, value_set=_column(known, "term"))
        held = code.is_valid()
        rows, terms, tfs = rows.filter(held).to_numpy(), terms.filter(held), _column(texts, "tfs").flatten().filter(held).to_numpy()
        w = _unit(code.drop_null().to_numpy(), tfs, rows, _column(known, "idf").to_numpy())
        kept, sizes = np.unique(rows, return_counts=True)
        at = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        lists = [pa.ListArray.from_arrays(at, x) for x in (terms, pa.array(w))]
        return pa.table({"pid": _column(texts, "pid").take(pa.array(kept)), "terms": lists[0], "ws": lists[1]})

    asked = arrow_rows(placed.select("bucket", "terms"), ask, "bucket int, term string")
    known = asked.join(vocabulary.select("term", "idf"), "term").select("bucket", "term", "idf")
    moved = arrow_rows(placed, pack, "bucket int, texts binary")
    return moved.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(weigh, f"pid {pid}, terms array<string>, ws array<double>")


@F.arrow_udf(ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())])))
def known_terms(terms: pa.Array, tfs: pa.Array, known: pa.Array) -> pa.Array:
    """The terms of each row, and their counts, that the row's third list holds."""
    rows, asked = (pc.list_parent_indices(x).to_numpy() for x in (terms, known))
    own = terms.flatten()
    codes = pa.concat_arrays([own, known.flatten()]).dictionary_encode()
    width = max(len(codes.dictionary), 1)
    pairs = np.concatenate([rows, asked]) * width + codes.indices.to_numpy()
    held = np.isin(pairs[: len(rows)], pairs[len(rows) :])
    at = pa.array(np.append(0, np.cumsum(np.bincount(rows[held], minlength=len(terms)))), pa.int32())
    kept = pa.array(held)
    return pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([own.filter(kept), tfs.flatten().filter(kept)], names=["term", "tf"]))
