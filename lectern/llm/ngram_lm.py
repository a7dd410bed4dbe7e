"""Interpolated modified Kneser-Ney bigram model as memory-mapped hash arrays.

Counting is Spark's: words first, then pairs of a context and a word, dealt out by
the hash of the context. Each part becomes files of sorted 64-bit hashes with counts
beside them, in the shared folder. Scoring tasks map the files and search them, so
what they hold does not grow with the model."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.kernels import WordHasher, chunks, mix
from lectern.llm.tables import fresh_folder, written

END = mix(np.array([0x656E64], np.uint64))[0]
BEGIN = mix(np.array([0x626567696E], np.uint64))[0]
FLUSH_WORDS = 1 << 20
FLUSH_PAIRS = 1 << 19
PART_TOKENS = 2 << 20
PART_TYPES = 1 << 19
SCORED_BYTES = 1 << 19
# Spark puts thousands of rows in an Arrow batch, so a row of pairs is about a kilobyte
ROW_PAIRS = 64
BATCH_ROWS = 4096

_WORD, _CONTEXT, _TIMES = 0, 1, 2  # kinds of figures a part reports
_FIGURES = "kind int, h long, a long, b long, c long, d long"


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    out = mix(word + np.uint64(0x3C6EF372FE94F82A))
    out ^= context * np.uint64(0x9FB21C651E98DF25)
    return mix(out)


def _sequences(hasher: WordHasher, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words with an end after each text, their contexts, first place of each text)."""
    hashes, at = hasher.chunk(texts)
    sizes = np.diff(at)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.empty(first[-1], np.uint64)
    ends = first[1:] - 1
    inner = np.ones(len(words), bool)
    inner[ends] = False
    words[inner], words[ends] = hashes, END
    contexts = np.empty_like(words)
    contexts[1:] = words[:-1]
    contexts[first[:-1]] = BEGIN
    return words, contexts, first


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, sums, a place where each is found)."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(np.append(at, len(keys)))
    else:
        sums = np.add.reduceat(counts[order], at, dtype=np.int64) if len(at) else np.empty(0, np.int64)
    del at
    keys = keys[new]
    return keys, sums, order[new]


def _held(pieces: Iterator[tuple[np.ndarray, ...]], limit: int) -> Iterator[list[np.ndarray]]:
    """Pieces of equally long arrays end to end, about ``limit`` values at a time; what
    is yielded is valid until the next is asked for."""
    held, n = None, 0
    for piece in pieces:
        if held is None:
            held = [np.empty(limit, x.dtype) for x in piece]
        size = len(piece[0])
        if n and n + size > limit:
            yield [x[:n] for x in held]
            n = 0
        if size > limit:
            yield list(piece)
            continue
        for own, x in zip(held, piece):
            own[n : n + size] = x
        n += size
    if n:
        yield [x[:n] for x in held]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()

    def words() -> Iterator[tuple[np.ndarray]]:
        for batch in batches:
            for _, part in chunks(batch.column(0)):
                hashes, at = hasher.chunk(part)
                yield (hashes,)
                yield (np.full(len(at) - 1, END),)

    for (held,) in _held(words(), FLUSH_WORDS):
        keys, counts = np.unique(held, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["h", "n"])


def _part(contexts: np.ndarray, pairs: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """All pairs of a context share a part, but those of hot contexts are dealt out singly."""
    return np.where(np.isin(contexts, hot), pairs, contexts) % np.uint64(parts)


def _blobs(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values that begin at ``at``; the last place is the end of the last one."""
    ends = ((at - at[0]) * values.itemsize).astype(np.int32)
    own = np.ascontiguousarray(values[at[0] : at[-1]])
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(ends), pa.py_buffer(own)])


def _values(blobs: pa.Array, kind: type) -> np.ndarray:
    """The values of all rows end to end, where they lie."""
    _, ends, data = blobs.buffers()
    at = np.frombuffer(ends, np.int32)[blobs.offset : blobs.offset + len(blobs) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind)


def _rows(part: np.ndarray, contexts: np.ndarray, words: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs in the order of part and context as rows of at most ``ROW_PAIRS``: a context
    stands once in a row, with the number of its words."""
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    place = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
    new = place % ROW_PAIRS == 0
    rows = np.append(np.flatnonzero(new), len(part))
    new[1:] |= contexts[1:] != contexts[:-1]
    heads = np.append(np.flatnonzero(new), len(part))
    lengths = np.diff(heads).astype(np.uint8)
    contexts = contexts[heads[:-1]]
    first = np.searchsorted(heads, rows)
    for start in range(0, len(rows) - 1, BATCH_ROWS):
        stop = start + BATCH_ROWS + 1
        at, head = rows[start:stop], first[start:stop]
        columns = [pa.array(part[at[:-1]].astype(np.int32)), _blobs(contexts, head), _blobs(lengths, head)]
        columns += [_blobs(words, at), _blobs(counts, at)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "contexts", "lengths", "words", "counts"])


def _dealt(words: np.ndarray, contexts: np.ndarray, hot: np.ndarray, parts: int) -> tuple[np.ndarray, ...]:
    """(part, context, word, count) of the distinct pairs, in the order of part and context."""
    pairs, counts, at = _summed(_pair(contexts, words))
    words, contexts = words[at], contexts[at]
    part = _part(contexts, pairs, hot, parts)
    order = np.lexsort((contexts, part))
    return part[order], contexts[order], words[order], counts[order].astype(np.uint32)


def _count_pairs(hot: np.ndarray, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        texts = (_sequences(hasher, part)[:2] for batch in batches for _, part in chunks(batch.column(0)))
        for words, contexts in _held(texts, FLUSH_PAIRS):
            yield from _rows(*_dealt(words, contexts, hot, parts))

    return run


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all: a task that is run again replaces the file by an equal one."""
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(draft, "wb") as out:
        np.save(out, array)
    os.replace(draft, f"{folder}/{name}.npy")


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _only(parts: pa.Array, known: int | None) -> int:
    """The part of a task's rows; two parts in one task would end in one file."""
    found = {*parts.unique().to_pylist(), *([] if known is None else [known])}
    if len(found) > 1:
        raise ValueError(f"one task got the parts {sorted(found)}")
    return found.pop()


def _joined(pieces: list[np.ndarray]) -> np.ndarray:
    """All pieces end to end; the list is emptied."""
    out = np.concatenate(pieces)
    pieces.clear()
    return out


def _store_pairs(folder: str, hot: np.ndarray):
    def figures(part: int, *held: list[np.ndarray]) -> pa.RecordBatch:
        contexts, words, counts = (_joined(x) for x in held)
        pairs, counts, at = _summed(_pair(contexts, words), counts)
        _save(folder, f"pair-{part}", pairs)
        _save(folder, f"pair-n-{part}", _narrow(counts))
        del pairs
        contexts, words = contexts[at], words[at]
        order = np.argsort(contexts, kind="stable")
        by_context, first = np.unique(contexts[order], return_index=True)
        by_size = counts[order]
        del contexts, at, order
        total = np.add.reduceat(by_size, first)
        once, twice, more = (np.add.reduceat(m, first, dtype=np.int64) for m in (by_size == 1, by_size == 2, by_size > 2))
        del by_size
        spread = np.isin(by_context, hot)
        _save(folder, f"context-{part}", by_context[~spread])
        _save(folder, f"context-n-{part}", _narrow(np.stack([total, once, twice, more], 1)[~spread]))
        known, kinds = np.unique(words, return_counts=True)
        times, n_times = np.unique(np.minimum(counts, 5), return_counts=True)
        n = spread.sum()
        kind = np.repeat([_WORD, _CONTEXT, _TIMES], [len(known), n, len(times)]).astype(np.int32)
        zeros = lambda k: np.zeros(k, np.int64)
        columns = [np.concatenate([known.view(np.int64), by_context[spread].view(np.int64), times])]
        columns.append(np.concatenate([kinds, total[spread], n_times]))
        columns += [np.concatenate([zeros(len(known)), x[spread], zeros(len(times))]) for x in (once, twice, more)]
        return pa.RecordBatch.from_arrays([pa.array(kind), *map(pa.array, columns)], names=["kind", "h", "a", "b", "c", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, contexts, words, counts = None, [], [], []
        for batch in batches:
            if batch.num_rows:
                part = _only(batch.column(0), part)
                contexts.append(np.repeat(_values(batch.column(1), np.uint64), _values(batch.column(2), np.uint8)))
                words.append(_values(batch.column(3), np.uint64).copy())
                counts.append(_values(batch.column(4), np.uint32).copy())
        batch = None
        if words:
            yield figures(part, contexts, words, counts)

    return run


def _store_words(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, ([], [], [])
        for batch in batches:
            if batch.num_rows:
                part = _only(batch.column(3), part)
                for i, own in enumerate(held):
                    own.append(batch.column(i).to_numpy())
        if held[0]:
            keys, *both = (_joined(x) for x in held)
            keys = keys.view(np.uint64)
            order = np.argsort(keys)
            _save(folder, f"word-{part}", keys[order])
            _save(folder, f"word-n-{part}", _narrow(np.stack(both, 1)[order]))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32())], names=["done"])

    return run


def discounts(times: dict[int, int]) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and more, from how many n-grams have a count of
    1 to 4 (Chen and Goodman). Where a class is empty its discount is that of plain
    absolute discounting, and none exceeds its count."""
    n = [times.get(i, 0) for i in range(5)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    d = [0.0]
    for i in (1, 2, 3):
        value = i - (i + 1) * y * n[i + 1] / n[i] if n[i] else y
        d.append(min(max(value, 0.0), float(i)))
    return np.array(d)


@dataclass
class Model:
    """Where the arrays lie and the figures that all of them share."""

    folder: str
    parts: int
    word_parts: int
    tokens: int
    types: int
    kinds: int  # distinct pairs
    word_times: dict[int, int]  # how many words follow 1, 2, 3, 4 and at least 3 (key 0) contexts
    pair_times: dict[int, int]
    hot: np.ndarray
    hot_counts: np.ndarray
    _open: dict = field(default_factory=dict, repr=False)

    def _array(self, name: str) -> np.ndarray | None:
        if name not in self._open:
            path = f"{self.folder}/{name}.npy"
            mapped = os.path.exists(path) and os.path.getsize(path) > 128
            self._open[name] = np.asarray(np.load(path, mmap_mode="r")) if mapped else None
        return self._open[name]

    def _find(self, kind: str, keys: np.ndarray, part: np.ndarray, width: int) -> np.ndarray:
        """Rows of counts of sorted ``keys``, zeros where a key is unknown."""
        out = np.zeros((len(keys), width), np.int64)
        order = np.argsort(part.astype(np.min_scalar_type(self.parts + self.word_parts)), kind="stable")
        found, first = np.unique(part[order], return_index=True)
        for p, asked in zip(found, np.split(order, first[1:])):
            stored = self._array(f"{kind}-{p}")
            if stored is None or not len(stored):
                continue
            at = np.minimum(np.searchsorted(stored, keys[asked]), len(stored) - 1)
            hit = stored[at] == keys[asked]
            counts = self._array(f"{kind}-n-{p}")
            out[asked[hit]] = counts[at[hit]].reshape(-1, width)
        return out

    def words(self, words: np.ndarray) -> np.ndarray:
        """(count, contexts before it) of each word."""
        keys, back = np.unique(words, return_inverse=True)
        return self._find("word", keys, keys.view(np.int64) % self.word_parts, 2)[back]

    def unigram(self, kinds: np.ndarray) -> np.ndarray:
        """Probability from the number of contexts, the rest shared by all words and the unknown one."""
        if not self.kinds:
            return np.full(len(kinds), 1 / (self.types + 1))
        d = discounts(self.word_times)
        left = d[1] * self.word_times.get(1, 0) + d[2] * self.word_times.get(2, 0) + d[3] * self.word_times.get(0, 0)
        return (np.maximum(kinds - d[np.minimum(kinds, 3)], 0) + left / (self.types + 1)) / self.kinds

    def log10(self, words: np.ndarray, contexts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """log10 probability of each word after its context; ``kinds`` from :meth:`words`."""
        lower = self.unigram(kinds)
        pairs = _pair(contexts, words)
        keys, at, back = np.unique(pairs, return_index=True, return_inverse=True)
        c = self._find("pair", keys, _part(contexts[at], keys, self.hot, self.parts), 1)[back, 0]
        before, place = np.unique(contexts, return_inverse=True)
        figures = self._find("context", before, before % np.uint64(self.parts), 4)
        if len(self.hot):
            spot = np.minimum(np.searchsorted(self.hot, before), len(self.hot) - 1)
            is_hot = self.hot[spot] == before
            figures[is_hot] = self.hot_counts[spot[is_hot]]
        total, once, twice, more = figures[place].T
        d = discounts(self.pair_times)
        seen = np.maximum(total, 1)
        higher = (np.maximum(c - d[np.minimum(c, 3)], 0) + (d[1] * once + d[2] * twice + d[3] * more) * lower) / seen
        return np.log10(np.where(total > 0, higher, lower))


def local_folder(path: str) -> str:
    """The folder as the operating system names it; only a mounted one can be mapped."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    elif "://" in path:
        raise ValueError("the model is memory-mapped: spark.checkpoint.dir has to be a folder mounted on all executors")
    return path


def fit(texts: DataFrame, text: str = "text") -> Model:
    """Model of a column of texts; a null text is empty, and an end follows every text.

    Words are runs without white space, A-Z lower-cased. A context with a large share of all
    tokens is dealt out over all parts; such contexts are at most four times the number
    of parts. A part is a task of its own, which holds the pairs of about ``PART_TOKENS`` tokens
    or ``PART_TYPES`` words.
    Only sums and the figures of hot contexts reach the driver."""
    spark = texts.sparkSession
    folder = local_folder(fresh_folder(spark, "bigrams"))
    column = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = written(column.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    tokens, types = (x or 0 for x in words.agg(F.sum("n"), F.count("*")).first())
    parts = max(8, -(-tokens // PART_TOKENS))
    often = words.filter(F.col("n") * (4 * parts) > tokens).select("h").collect()
    hot = np.unique(np.array([r["h"] for r in often] + [int(BEGIN.view(np.int64))], np.int64).view(np.uint64))
    pairs = column.mapInArrow(
        _count_pairs(hot, parts), "part int, contexts binary, lengths binary, words binary, counts binary"
    )
    figures = pairs.repartitionById(parts, "part").mapInArrow(_store_pairs(folder, hot), _FIGURES)
    summed = written(
        figures.groupBy("kind", "h").agg(*[F.sum(c).alias(c) for c in "abcd"]), "figures"
    )
    times = {int(r["h"]): int(r["a"]) for r in summed.filter(F.col("kind") == _TIMES).collect()}
    spread = summed.filter(F.col("kind") == _CONTEXT).collect()
    hot_counts = np.zeros((len(hot), 4), np.int64)
    for r in spread:
        hot_counts[np.searchsorted(hot, np.int64(r["h"]).view(np.uint64))] = [r[c] for c in "abcd"]
    before = summed.filter(F.col("kind") == _WORD).select("h", F.col("a").alias("kinds"))
    word_parts = max(1, -(-types // PART_TYPES))
    both = words.join(before, "h").withColumn("part", F.pmod("h", F.lit(word_parts)).cast("int"))
    stored = both.repartitionById(word_parts, "part").mapInArrow(_store_words(folder), "done int")
    stored.write.format("noop").mode("overwrite").save()
    k = F.col("kinds")
    count = lambda test: F.coalesce(F.sum(F.when(test, 1)), F.lit(0))
    n1, n2, n3, n4, more, kinds = before.agg(
        count(k == 1), count(k == 2), count(k == 3), count(k == 4), count(k > 2), F.coalesce(F.sum(k), F.lit(0))
    ).first()
    return Model(
        folder, parts, word_parts, tokens, types, kinds, {1: n1, 2: n2, 3: n3, 4: n4, 0: more}, times, hot, hot_counts
    )


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for first, part in chunks(batch.column(1), SCORED_BYTES):
                words, contexts, at = _sequences(hasher, part)
                counts = model.words(words)
                base = np.log10((counts[:, 0] + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
                logs = model.log10(words, contexts, counts[:, 1])
                sums = [np.add.reduceat(x, at[:-1]) for x in ((counts[:, 0] > 0).astype(np.int64), base, logs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(np.diff(at).astype(np.int64)), *map(pa.array, sums)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row: tokens with the
    end, those seen in training, and log10 probabilities by add-half unigrams and by the
    model. Perplexity is ``10 ** (-score / n_tokens)``. A null or empty text is its end alone."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.mapInArrow(_score(model), "doc_id long, n_tokens long, n_known long, base_score double, score double")


def fold(key: str | Column, n: int) -> Column:
    """Remainder of the checksum of an id; a null id is in fold 0."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n, F.lit(0))

