"""Quality by a byte-level convolutional network.

Bytes become short vectors, learned filters read every window of bytes, and a hidden layer
reads mean and maximum of the filters over chunks that overlap by half and cover the
whole text. The strongest response of each hidden unit over all chunks gives one probability."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.kernels import chunks, text_bytes
from lectern.llm.ngram_lm import fold
from lectern.llm.tables import written

PAD = 256  # the symbol after the end of a text
HALVES = 128  # half chunks that are filtered at a time
DECAY = 1e-3


@dataclass(frozen=True)
class Shape:
    """``half`` bytes are half a chunk; a filter reads ``width`` bytes at every ``stride``-th place."""

    embedding: int = 8
    width: int = 16
    stride: int = 4
    filters: int = 48
    half: int = 256
    hidden: int = 32

    @property
    def spots(self) -> int:
        return self.half // self.stride


Weights = dict[str, np.ndarray]


def start_weights(shape: Shape, seed: int) -> Weights:
    rng = np.random.default_rng(seed)
    taps = shape.width * shape.embedding

    def drawn(rows: int, columns: int) -> np.ndarray:
        return (rng.normal(size=(rows, columns)) * np.sqrt(2 / rows)).astype(np.float32)

    return {
        "bytes": (rng.normal(size=(PAD + 1, shape.embedding)) * 0.5).astype(np.float32),
        "filters": drawn(taps, shape.filters), "filters_0": np.zeros(shape.filters, np.float32),
        "hidden": drawn(2 * shape.filters, shape.hidden), "hidden_0": np.zeros(shape.hidden, np.float32),
        "out": drawn(shape.hidden, 1)[:, 0], "out_0": np.zeros(1, np.float32),
    }


@dataclass
class Layout:
    """Several texts cut into half chunks; an empty text is a half of padding."""

    raw: np.ndarray
    begins: np.ndarray  # first byte of each half
    ends: np.ndarray  # end of its text
    counts: np.ndarray  # windows that begin inside its text
    first: np.ndarray  # first half of each chunk; the second one is the same where a text is one half
    second: np.ndarray
    starts: np.ndarray  # first chunk of each text

    def symbols(self, halves: np.ndarray, shape: Shape) -> np.ndarray:
        """Bytes that the windows of some halves read."""
        at = self.begins[halves][:, None] + np.arange(shape.half + shape.width - shape.stride)
        if not len(self.raw):
            return np.full(at.shape, PAD)
        read = self.raw[np.minimum(at, len(self.raw) - 1)].astype(np.int16)
        return np.where(at < self.ends[halves][:, None], read, np.int16(PAD))


def lay_out(raw: np.ndarray, offsets: np.ndarray, shape: Shape) -> Layout:
    sizes = np.diff(offsets)
    halves = np.maximum(-(-sizes // shape.half), 1)
    stops = np.cumsum(halves)
    begins = stops - halves
    text = np.repeat(np.arange(len(sizes)), halves)
    inside = (np.arange(len(text)) - begins[text]) * shape.half
    counts = np.minimum(np.maximum(-(-(sizes[text] - inside) // shape.stride), 1), shape.spots)
    chunks_of = np.maximum(halves - 1, 1)
    starts = np.cumsum(chunks_of) - chunks_of
    first = np.repeat(begins - starts, chunks_of) + np.arange(int(chunks_of.sum()))
    second = first + np.repeat(halves > 1, chunks_of)
    return Layout(raw, offsets[:-1][text] + inside, offsets[1:][text], counts, first, second, starts)


def _filtered(w: Weights, shape: Shape, texts: Layout, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, windows, responses of the filters) of some halves; windows beyond the text respond with 0."""
    symbols = texts.symbols(halves, shape)
    vectors = w["bytes"][symbols]
    step = vectors.strides
    windows = np.lib.stride_tricks.as_strided(
        vectors, (len(halves), shape.spots, shape.width * shape.embedding), (step[0], step[1] * shape.stride, step[2])
    ).reshape(len(halves) * shape.spots, -1)
    z = (windows @ w["filters"] + w["filters_0"]).reshape(len(halves), shape.spots, -1)
    np.maximum(z, 0, out=z)
    z *= (np.arange(shape.spots) < texts.counts[halves][:, None])[:, :, None]
    return symbols, windows, z


def forward(w: Weights, shape: Shape, texts: Layout) -> tuple[np.ndarray, ...]:
    """(logits, hidden units at their strongest, all hidden units, pooled responses, windows of each chunk, maxima of halves)."""
    n_halves, k = len(texts.begins), shape.filters
    sums, tops = np.empty((n_halves, k), np.float32), np.empty((n_halves, k), np.float32)
    for start in range(0, n_halves, HALVES):
        halves = np.arange(start, min(start + HALVES, n_halves))
        z = _filtered(w, shape, texts, halves)[2]
        z.sum(axis=1, out=sums[halves[0] : halves[-1] + 1])
        z.max(axis=1, out=tops[halves[0] : halves[-1] + 1])
    one, two = texts.first, texts.second
    double = (one != two)[:, None]
    n = (texts.counts[one][:, None] + double * texts.counts[two][:, None]).astype(np.float32)
    pooled = np.concatenate([(sums[one] + double * sums[two]) / n, np.maximum(tops[one], tops[two])], axis=1).astype(np.float32)
    hidden = np.maximum(pooled @ w["hidden"] + w["hidden_0"], 0)
    strongest = np.maximum.reduceat(hidden, texts.starts, axis=0)
    return strongest @ w["out"] + w["out_0"][0], strongest, hidden, pooled, n, tops


def probabilities(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))


def gradient(w: Weights, shape: Shape, texts: Layout, targets: np.ndarray, low_weight: float = 1.0) -> tuple[float, Weights]:
    """Mean log loss of the texts and its gradient; texts of target 0 count ``low_weight`` times.

    A maximum passes its gradient to its first place. So only the chunks with the
    strongest response of some unit matter, and only their windows are held."""
    logits, strongest, hidden, pooled, n, tops = forward(w, shape, texts)
    p = probabilities(logits)
    m = len(targets)
    counted = np.where(targets > 0, 1.0, low_weight)
    loss = float(-(counted * (targets * np.log(p) + (1 - targets) * np.log(1 - p))).mean())
    d_logit = (counted * (p - targets) / m).astype(np.float32)
    g = {"out": strongest.T @ d_logit, "out_0": d_logit.sum(keepdims=True)}
    edges = np.append(texts.starts, len(hidden))
    best = np.stack([a + hidden[a:b].argmax(axis=0) for a, b in zip(edges, edges[1:])])
    taken, place = np.unique(best, return_inverse=True)
    d_hidden = np.zeros((len(taken), shape.hidden), np.float32)
    units = np.broadcast_to(np.arange(shape.hidden), best.shape)
    np.add.at(d_hidden, (place.reshape(best.shape), units), np.where(strongest > 0, d_logit[:, None] * w["out"], 0))
    g["hidden"], g["hidden_0"] = pooled[taken].T @ d_hidden, d_hidden.sum(axis=0)
    d_pooled = d_hidden @ w["hidden"].T
    k = shape.filters
    one, two = texts.first[taken], texts.second[taken]
    halves, spot = np.unique(np.concatenate([one, two]), return_inverse=True)
    at_one, at_two = spot[: len(one)], spot[len(one) :]
    double, in_one = (one != two)[:, None], tops[one] >= tops[two]
    d_sums, d_tops = np.zeros((2, len(halves), k), np.float32)
    d_means = d_pooled[:, :k] / n[taken]
    np.add.at(d_sums, at_one, d_means)
    np.add.at(d_sums, at_two, double * d_means)
    np.add.at(d_tops, at_one, in_one * d_pooled[:, k:])
    np.add.at(d_tops, at_two, ~in_one * d_pooled[:, k:])
    symbols, windows, z = _filtered(w, shape, texts, halves)
    d_z = np.repeat(d_sums[:, None, :], shape.spots, axis=1)
    top = z.argmax(axis=1)
    rows, columns = np.indices(top.shape)
    d_z[rows, top, columns] += d_tops
    d_z = np.where(z > 0, d_z, 0).reshape(-1, k)
    g["filters"], g["filters_0"] = windows.T @ d_z, d_z.sum(axis=0)
    d_windows = (d_z @ w["filters"].T).reshape(len(halves), shape.spots, shape.width, shape.embedding)
    d_vectors = np.zeros((*symbols.shape, shape.embedding), np.float32)
    for j in range(shape.width):
        d_vectors[:, j : j + shape.half : shape.stride] += d_windows[:, :, j]
    flat, d_flat = symbols.reshape(-1), d_vectors.reshape(-1, shape.embedding)
    g["bytes"] = np.stack([np.bincount(flat, d_flat[:, c], PAD + 1) for c in range(shape.embedding)], axis=1).astype(np.float32)
    return loss, g


class Adam:
    def __init__(self, weights: Weights, rate: float):
        self.rate, self.steps = rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, weights: Weights, g: Weights) -> None:
        self.steps += 1
        for k, d in g.items():
            self.first[k] += 0.1 * (d - self.first[k])
            self.second[k] += 0.001 * (d * d - self.second[k])
            mean = self.first[k] / (1 - 0.9**self.steps)
            size = np.sqrt(self.second[k] / (1 - 0.999**self.steps))
            weights[k] = (weights[k] - self.rate * mean / (size + 1e-8)).astype(np.float32)


# -- on Spark -------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    shape: Shape
    weights: Weights | None
    prior: float

    def score(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, score) of every row, from its whole text; a null text scores as an empty one."""
        own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        if self.weights is None:
            return own.select("doc_id", F.lit(self.prior).cast("double").alias("score"))
        shape, weights = self.shape, self.weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, texts in chunks(batch.column(1), 1 << 20):
                    logits = forward(weights, shape, lay_out(*text_bytes(texts), shape))[0]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(texts)), pa.array(probabilities(logits))], names=["doc_id", "score"]
                    )

        return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, score double")


def _sample(docs: DataFrame, labels: DataFrame, taught: Column, max_rows: int, seed: int, key: str, text: str, label: str) -> DataFrame:
    """(at, label, text): at most ``max_rows`` different labelled texts, drawn by a hash of the text."""
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(taught).filter("label in (0, 1)")
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(seed))
    named = docs.select(F.col(key).alias("doc_id"), body.alias("at"))
    # of equal texts one stays for each label
    each = named.join(known, "doc_id").groupBy("at", "label").agg(F.min("doc_id").alias("doc_id"))
    drawn = written(each.orderBy("at", "label").limit(max_rows), "drawn")
    texts = docs.select(F.col(key).alias("doc_id"), body.alias("at"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(drawn), ["doc_id", "at"]).dropDuplicates(["at", "label"]).select("at", "label", "text")


def _one_round(shape: Shape, weights: Weights, rate: float, batch: int, low_weight: float, seed: int):
    """A pass over a shard from shared weights; what comes back are the shard's weights."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("at", "ascending"), ("label", "ascending")])
        texts, targets = rows["text"].combine_chunks(), np.asarray(rows["label"], np.float64)
        own, steps = dict(weights), Adam(weights, rate)
        order = np.random.default_rng(seed).permutation(len(targets))
        for start in range(0, len(order), batch):
            at = order[start : start + batch]
            _, g = gradient(own, shape, lay_out(*text_bytes(texts.take(pa.array(at))), shape), targets[at], low_weight)
            steps.step(own, {k: d if k.endswith("_0") else d + DECAY * own[k] for k, d in g.items()})
        flat = np.concatenate([own[k].reshape(-1) for k in sorted(own)])
        return pa.table({"shard": rows["shard"][:1], "n": pa.array([len(targets)]), "weights": pa.array([flat], pa.list_(pa.float32()))})

    return run


def _unflattened(flat: np.ndarray, like: Weights) -> Weights:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def fit(
    docs: DataFrame, labels: DataFrame, taught: Column | None = None, max_rows: int = 4000, shards: int = 4, rounds: int = 8,
    rate: float = 0.01, batch: int = 8, low_weight: float = 3.0, shape: Shape = Shape(), seed: int = 5,
    key: str = "doc_id", text: str = "text", label: str = "quality",
) -> Model:
    """Learn ``label`` (0 or 1) from the rows of ``labels`` for which ``taught``, a column over ``doc_id``, holds.

    It is fitted on ``max_rows`` labelled texts at most, a documented bound, drawn by a hash; equal texts count once.
    ``shards`` tasks go through their rows from shared weights, whose mean starts the next round, so no task holds more
    than its share of the sample and the driver only weights. Texts of label 0 count ``low_weight`` times, as they are rare.
    Null ids, ids without a label of 0 or 1 and labels without a document teach nothing; where an id is
    repeated, each of its texts is taught. Without rows of both labels there is no network,
    and every text scores the share of label 1 (0.5 without any rows). Other columns are not read."""
    taught = F.lit(True) if taught is None else taught
    sample = _sample(docs, labels, taught, max_rows, seed, key, text, label).withColumn("shard", F.pmod(F.col("at"), F.lit(shards)).cast("int"))
    rows = written(sample, "labelled")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Model(shape, None, counts.get(1, 0) / total if total else 0.5)
    weights = start_weights(shape, seed)
    for r in range(rounds):
        step = _one_round(shape, weights, rate * (1 - r / rounds), batch, low_weight, seed * 1000 + r)
        found = rows.groupBy("shard").applyInArrow(step, "shard int, n long, weights array<float>").collect()
        found.sort(key=lambda row: row["shard"])
        mean = np.average([row["weights"] for row in found], axis=0, weights=[row["n"] for row in found])
        weights = _unflattened(mean, weights)
    return Model(shape, weights, counts[1] / total)


def production_rows(key: str = "doc_id") -> Column:
    """What the registered query learns from; remainder 0 is held out."""
    return fold(key, 5) != 0
