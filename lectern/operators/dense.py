"""Top-k over vectors, flat and clustered, and the coders around it.

A search multiplies blocks of vectors: inside a task numpy scores a block of
questions against a block of passages and keeps k per question, so neither a
score matrix nor all pairs of a cell ever exist as rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from lectern.functions.vectors import as_doubles, l2_normalize
from lectern.operators.sizing import top_k

SCORE_DIGITS = 6
QUERY_BLOCK = 4096
PASSAGE_BLOCK = 65_536
SCORE_CELLS = 1 << 21  # scores held at a time inside a task
QUERY_ROWS = 512  # questions scored at a time inside a task
HITS = "qid long, pid long, score double"
_MERGED = 64  # tasks whose sums are merged at a time
_HELD_CELLS = 1 << 22  # sums held by a task
_encoders: dict = {}


# -- block scoring (inside tasks) -----------------------------------------

def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(array), -1) if len(array) else np.zeros((0, 0))


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(), dtype=np.int64)


def _scores(queries: np.ndarray, passages: np.ndarray, metric: str) -> np.ndarray:
    """Larger is better: inner products, or negated squared distances."""
    products = queries @ passages.T
    if metric == "l2":
        norms = (queries * queries).sum(1)[:, None] + (passages * passages).sum(1)[None, :]
        products = -np.maximum(norms - 2.0 * products, 0.0)
    return np.round(products, SCORE_DIGITS) + 0.0


def _best(qids: np.ndarray, pids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k best (qid, pid, score) per row of ``scores``; equal scores by pid."""
    n = scores.shape[1]
    if n > k:
        floor = np.partition(scores, n - k, axis=1)[:, n - k]
        rows, cols = np.nonzero(scores >= floor[:, None])
    else:
        rows, cols = np.nonzero(np.ones_like(scores, dtype=bool))
    kept = scores[rows, cols]
    order = np.lexsort((pids[cols], -kept, rows))
    rows, cols, kept = rows[order], cols[order], kept[order]
    first = np.searchsorted(rows, rows, side="left")
    within = np.arange(len(rows)) - first < k
    return qids[rows[within]], pids[cols[within]], kept[within]


def _hits(qids, pids, scores) -> pa.Table:
    return pa.table(
        {"qid": pa.array(qids, pa.int64()), "pid": pa.array(pids, pa.int64()), "score": pa.array(scores, pa.float64())}
    )


def _search_block(qids, queries, pids, passages, k: int, metric: str) -> pa.Table:
    """The k best of a block of passages for every row of a block of questions. Scores are held for
    some questions and some passages at a time, and what is kept of them is cut to k a question again."""
    found = [_hits([], [], [])]
    for a in range(0, len(qids), QUERY_ROWS):
        rows = np.arange(a, min(a + QUERY_ROWS, len(qids)))
        step = max(1, SCORE_CELLS // len(rows))
        best = _hits([], [], [])
        for i in range(0, len(pids), step):
            part = _hits(*_best(rows, pids[i : i + step], _scores(queries[rows], passages[i : i + step], metric), k))
            best = _k_best(pa.concat_tables([best, part]), k) if best.num_rows else part
        found.append(best)
    rows, p, s = (np.asarray(c) for c in pa.concat_tables(found).columns)
    return _hits(qids[rows], p, s)


def _k_best(hits: pa.Table, k: int) -> pa.Table:
    """The k best hits of every question, by question."""
    q, p, s = (np.asarray(c) for c in hits.columns)
    order = np.lexsort((p, -s, q))
    q, p, s = q[order], p[order], s[order]
    within = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
    return _hits(q[within], p[within], s[within])


# -- search ---------------------------------------------------------------

def _final(hits: DataFrame, k: int, metric: str) -> DataFrame:
    ranked = top_k(hits, "qid", [F.col("score").desc(), F.col("pid").asc()], k)
    score = F.abs("score") if metric == "l2" else F.col("score")
    return ranked.select("qid", "rank", "pid", score.alias("score"))


def _broadcast_search(queries: DataFrame, passages: DataFrame, k: int, metric: str) -> DataFrame:
    spark = passages.sparkSession
    block = queries.toArrow()
    shared = spark.sparkContext.broadcast((_ids(block["qid"]), _matrix(block["vec"])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, matrix = shared.value
        if len(qids) == 0:
            return
        best = _hits([], [], [])
        for batch in batches:
            if batch.num_rows:
                found = _search_block(qids, matrix, _ids(batch["pid"]), _matrix(batch["vec"]), k, metric)
                best = _k_best(pa.concat_tables([best, found]), k)
        yield from best.to_batches()

    return passages.select("pid", "vec").mapInArrow(search, HITS)


def _grid_search(queries: DataFrame, passages: DataFrame, k: int, metric: str) -> DataFrame:
    """Meet blocks of questions and blocks of passages in a shuffle.

    ``passages`` has (pid, vec, cell), ``queries`` has (qid, vec, cell). A cell is
    cut into blocks by a hash of the id, so a cell of any size is many tasks. Blocks are
    counted per cell on both sides: passages of a cell nobody asks stay where they
    are, and others are copied once for each block of the questions of their cell."""
    per_cell = passages.groupBy("cell").agg(F.ceil(F.count("*") / PASSAGE_BLOCK).cast("int").alias("blocks"))
    asking = queries.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("qblocks"))
    sizes = per_cell.join(asking, "cell")
    placed = (
        passages.join(sizes, "cell")
        .withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")).cast("int"))
        .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("qblocks") - 1)))
        .select("cell", "block", "qblock", "pid", "vec")
    )
    asked = (
        queries.join(sizes, "cell")
        .withColumn("qblock", F.pmod(F.xxhash64("qid"), F.col("qblocks")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cell", "block", "qblock", "qid", "vec")
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return _hits([], [], [])
        return _search_block(
            _ids(left["qid"]), _matrix(left["vec"]), _ids(right["pid"]), _matrix(right["vec"]), k, metric
        )

    keys = ("cell", "block", "qblock")
    # both may come from one table of vectors, so their columns get names of their own
    asked, placed = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (asked, placed))
    return asked.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInArrow(search, HITS)


def vector_topk(queries: DataFrame, passages: DataFrame, k: int, metric: str = "ip") -> DataFrame:
    """(qid, rank, pid, score): the k best passages for every question vector.

    ``queries`` (qid, vec) and ``passages`` (pid, vec). ``metric`` "ip" ranks by
    inner product; "l2" by squared distance, smallest first. Questions that fit
    one block visit the passages in place; more meet them block by block."""
    n_queries = queries.select("qid").limit(QUERY_BLOCK + 1).count()
    if n_queries <= QUERY_BLOCK:
        hits = _broadcast_search(queries.select("qid", "vec"), passages, k, metric)
    else:
        one_cell = F.lit(0).alias("cell")
        hits = _grid_search(
            queries.select("qid", "vec", one_cell), passages.select("pid", "vec", one_cell), k, metric
        )
    return _final(hits, k, metric)


def cosine_topk(queries: DataFrame, passages: DataFrame, k: int, normalize_query: bool = False) -> DataFrame:
    """Inner product against unit passages. Without ``normalize_query`` the order
    is that of the cosine and the score grows with the question's length."""
    unit = passages.select("pid", l2_normalize(F.col("vec")).alias("vec"))
    asked = queries.select("qid", l2_normalize(F.col("vec")).alias("vec")) if normalize_query else queries
    return vector_topk(asked, unit, k)


# -- clusters -------------------------------------------------------------

def kmeans_cells(passages: DataFrame, cells: int = 64, seed: int = 2024, max_iter: int = 10) -> KMeansModel:
    vectors = passages.select(array_to_vector(as_doubles(F.col("vec"))).alias("features"))
    # every iteration reads the vectors again
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=cells, seed=seed, maxIter=max_iter).fit(vectors)
    finally:
        vectors.unpersist()


def centroid_table(model: KMeansModel, spark) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cell int, vec array<double>")


def label_centroids(passages: DataFrame, label: str = "label") -> DataFrame:
    """(cell, vec): mean vector per label, rounded; null vectors and entries are not counted. Tasks sum up
    their vectors by label, so a label with most of the rows is a row per task."""
    sums = _vector_sums(passages.select(F.col(label).alias("cell"), "vec"))
    mean = F.zip_with("sums", "n", lambda s, n: F.round(F.try_divide(s, n), SCORE_DIGITS))
    return sums.select("cell", mean.alias("vec"))


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with a vector, their values with 0 for a null entry, 1 where an entry is not null)."""
    rows = np.flatnonzero(np.asarray(column.is_valid()))
    flat = column.flatten()
    known = np.asarray(flat.is_valid()).reshape(len(rows), -1) if len(rows) else np.zeros((0, 0), bool)
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(known.shape)
    return rows, values, known


def _sum_by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict = {}

    def table(schema: pa.Schema) -> pa.RecordBatch:
        arrays = [pa.array(list(held), schema.field("cell").type)]
        arrays += [pa.array([x[i] for x in held.values()], pa.list_(t)) for i, t in ((0, pa.int64()), (1, pa.float64()))]
        slot = TaskContext.get().partitionId() // _MERGED
        return pa.RecordBatch.from_arrays([*arrays, pa.array([slot] * len(held), pa.int32())], names=["cell", "n", "sums", "slot"])

    schema, width = None, 0
    for batch in batches:
        schema = batch.schema
        rows, values, known = _rows_of(batch.column(1))
        if not len(rows):
            continue
        width = values.shape[1]
        cells = batch.column(0).take(pa.array(rows)).dictionary_encode(null_encoding="encode")
        codes = np.asarray(cells.indices)
        order = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(codes[order]) != 0]))
        n, sums = np.add.reduceat(known[order].astype(np.int64), starts), np.add.reduceat(values[order], starts)
        for code, own in zip(codes[order][starts], zip(n, sums)):
            cell = cells.dictionary[int(code)].as_py()
            before = held.get(cell)
            held[cell] = own if before is None else (before[0] + own[0], before[1] + own[1])
        if len(held) * width > _HELD_CELLS:
            yield table(schema)
            held.clear()
    if held:
        yield table(schema)


def _add_up(rows: pa.Table) -> pa.Table:
    """One row from those of a group."""
    n, sums = (np.sum([np.asarray(v.values) for v in rows[c]], axis=0) for c in ("n", "sums"))
    arrays = {"cell": rows["cell"][:1], "n": pa.array([n], pa.list_(pa.int64())), "sums": pa.array([sums], pa.list_(pa.float64()))}
    return pa.table(arrays | {"slot": rows["slot"][:1]})


def _vector_sums(vectors: DataFrame) -> DataFrame:
    """(cell, n, sums, slot) per cell of ``vectors`` (cell, vec): entries and their sums, by dimension. Tasks are
    merged some at a time, so that no task holds a row of every other one."""
    schema = f"cell {vectors.schema['cell'].dataType.simpleString()}, n array<bigint>, sums array<double>, slot int"
    some = vectors.mapInArrow(_sum_by_cell, schema).groupBy("cell", "slot").applyInArrow(_add_up, schema)
    return some.groupBy("cell").applyInArrow(_add_up, schema)


def _width(vectors: DataFrame) -> int:
    """Dimensions of a table of vectors; 0 for an empty one."""
    first = vectors.select(F.size("vec").alias("n")).first()
    return first["n"] if first else 0


def _cell_matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    block = centroids.select(F.col("cell").cast("long"), as_doubles(F.col("vec")).alias("vec")).toArrow()
    return _ids(block["cell"]), _matrix(block["vec"])


def nearest_cells(vectors: DataFrame, centroids: DataFrame, key: str, nprobe: int = 1) -> DataFrame:
    """``vectors`` with (cell, d2) of the ``nprobe`` nearest centroids. The
    centroids travel to the vectors, which they are few beside; they are scored in
    blocks, so a task holds ``SCORE_CELLS`` distances however many cells there are."""
    shared = vectors.sparkSession.sparkContext.broadcast(_cell_matrix(centroids))
    schema = f"{key} long, vec {vectors.schema['vec'].dataType.simpleString()}, cell long, d2 double"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, centers = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            found = _search_block(np.arange(batch.num_rows), _matrix(batch["vec"]), cells, centers, nprobe, "l2")
            row, cell, score = (c.to_numpy() for c in _k_best(found, nprobe).columns)
            yield pa.RecordBatch.from_arrays(
                [
                    batch[key].take(pa.array(row)),
                    batch["vec"].take(pa.array(row)),
                    pa.array(cell, pa.int64()),
                    pa.array(np.abs(score), pa.float64()),
                ],
                names=[key, "vec", "cell", "d2"],
            )

    return vectors.select(F.col(key).cast("long").alias(key), "vec").mapInArrow(assign, schema)


def clustered_topk(
    queries: DataFrame, assigned: DataFrame, centroids: DataFrame, k: int, nprobe: int = 1
) -> DataFrame:
    """k nearest passages by L2 among those of a question's nearest cells,
    ascending. ``assigned`` has (pid, vec, cell); of a table stored by cell only the
    cells that are asked are read."""
    asked = nearest_cells(queries, centroids, "qid", nprobe).select("qid", "vec", "cell")
    hits = _grid_search(asked, assigned.select("pid", "vec", F.col("cell").cast("long").alias("cell")), k, "l2")
    return _final(hits, k, "l2")


def moved_centroids(passages: DataFrame, start: DataFrame, rounds: int = 10, least_move: float = 0.0) -> DataFrame:
    """(cell, vec): rounds of k-means from given centres, each the rounded mean
    of the vectors nearest to it. A centre without vectors goes. It stops when no centre moves by more
    than ``least_move`` in a dimension, or after ``rounds``. The centres, which are few, are kept between the rounds."""
    spark = passages.sparkSession

    def kept(centroids: DataFrame) -> tuple[dict, DataFrame]:
        rows = {r["cell"]: [float(x) for x in r["vec"]] for r in centroids.collect()}
        return rows, spark.createDataFrame(sorted(rows.items()), "cell long, vec array<double>")

    before, centroids = kept(start)
    for _ in range(rounds):
        now, centroids = kept(label_centroids(nearest_cells(passages, centroids, "pid"), "cell"))
        still = now.keys() == before.keys() and all(abs(a - b) <= least_move for c in now for a, b in zip(now[c], before[c]))
        if still:
            break
        before = now
    return centroids


def seeded_centres(passages: DataFrame, cells: int, seed: int = 2024) -> DataFrame:
    """(cell, vec): the vectors of ``cells`` passages drawn by a hash of id and seed."""
    draw = F.md5(F.concat_ws(":", F.col("pid").cast("string"), F.lit(str(seed))))
    drawn = passages.withColumn("_draw", draw).orderBy("_draw", "pid").limit(cells)
    return drawn.select((F.row_number().over(Window.orderBy("_draw", "pid")) - 1).cast("long").alias("cell"), as_doubles(F.col("vec")).alias("vec"))


def seeded_kmeans(passages: DataFrame, cells: int = 64, seed: int = 2024, rounds: int = 10) -> DataFrame:
    """(cell, vec): k-means from a seeded start, equal on every run and cluster."""
    return moved_centroids(passages, seeded_centres(passages, cells, seed), rounds)


# -- quantisation ---------------------------------------------------------

def _task_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lo = hi = None
    for batch in batches:
        rows, values, known = _rows_of(batch.column(0))
        if len(rows):
            least = np.fmin.reduce(np.where(known, values, np.inf), axis=0)  # NaN is above all numbers
            most = np.maximum.reduce(np.where(known, values, -np.inf), axis=0)
            lo, hi = (least, most) if lo is None else (np.fmin(lo, least), np.maximum(hi, most))
    if lo is not None:
        slot = pa.array([TaskContext.get().partitionId() // _MERGED], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([lo], pa.list_(pa.float64())), pa.array([hi], pa.list_(pa.float64())), slot], names=["lo", "hi", "slot"])


def _widest(rows: pa.Table) -> pa.Table:
    lo = np.fmin.reduce([np.asarray(v.values) for v in rows["lo"]])
    hi = np.maximum.reduce([np.asarray(v.values) for v in rows["hi"]])
    return pa.table({"lo": pa.array([lo], pa.list_(pa.float64())), "hi": pa.array([hi], pa.list_(pa.float64())), "slot": pa.array([0], pa.int32())})


def scalar_ranges(passages: DataFrame) -> DataFrame:
    """(d, lo, hi) per dimension. Tasks keep the least and largest entries of their vectors; null entries do not count."""
    schema = "lo array<double>, hi array<double>, slot int"
    some = passages.select("vec").mapInArrow(_task_ranges, schema).groupBy("slot").applyInArrow(_widest, schema)
    whole = some.groupBy("slot").applyInArrow(_widest, schema)
    return whole.select(F.posexplode(F.arrays_zip("lo", "hi")).alias("d", "r")).select("d", "r.lo", "r.hi")


def _ranges_as_array(ranges: DataFrame) -> Column:
    """The ranges of all dimensions as one array of (lo, hi)."""
    ordered = F.array_sort(F.collect_list(F.struct("d", "lo", "hi")))
    pairs = F.transform(ordered, lambda r: F.struct(r["lo"].alias("lo"), r["hi"].alias("hi")))
    return ranges.agg(pairs.alias("r")).scalar()


def scalar_encode(passages: DataFrame, ranges: DataFrame, bits: int = 8) -> DataFrame:
    """Replace ``vec`` by ``code``: one small integer per dimension."""
    levels = 1 << bits
    share = F.zip_with(as_doubles(F.col("vec")), "_r", lambda x, r: F.try_divide(x - r["lo"], r["hi"] - r["lo"]))
    code = F.transform(share, lambda t: F.least(F.floor(F.coalesce(t, F.lit(0.0)) * levels), F.lit(levels - 1)).cast("int"))
    # the ranges are bound as a column first: a subquery cannot stand in a lambda
    return passages.withColumn("_r", _ranges_as_array(ranges)).withColumn("code", code).drop("vec", "_r")


def scalar_decode(encoded: DataFrame, ranges: DataFrame, bits: int = 8) -> DataFrame:
    """Replace ``code`` by ``vec``: the middle of each level."""
    levels = 1 << bits
    vec = F.zip_with("code", "_r", lambda c, r: r["lo"] + (c + 0.5) * (r["hi"] - r["lo"]) / levels)
    return encoded.withColumn("_r", _ranges_as_array(ranges)).withColumn("vec", vec).drop("code", "_r")


def product_codebooks(passages: DataFrame, parts: int = 8, codes: int = 256, seed: int = 2024) -> DataFrame:
    """(part, code, vec): k-means centres of each slice of the dimensions. Where they do
    not divide evenly, the first slices are one longer."""
    spark = passages.sparkSession
    books = None
    for part, dimensions in enumerate(np.array_split(np.arange(_width(passages)), parts)):
        piece = passages.select(F.slice("vec", int(dimensions[0]) + 1, len(dimensions)).alias("vec"))
        model = kmeans_cells(piece, codes, seed)
        book = centroid_table(model, spark).select(
            F.lit(part).alias("part"), F.col("cell").alias("code"), "vec"
        )
        books = book if books is None else books.unionByName(book)
    return books


def product_encode(passages: DataFrame, codebooks: DataFrame) -> DataFrame:
    """(pid, codes): nearest centre of every slice. The codebooks travel to the vectors: their
    size is the number of codes times that of dimensions, both parameters of their training."""
    spark = passages.sparkSession
    rows = codebooks.orderBy("part", "code").toArrow()
    parts = np.asarray(rows["part"].to_numpy())
    centers = [np.array(rows["vec"].filter(pa.array(parts == p)).to_pylist(), np.float64) for p in np.unique(parts)]
    shared = spark.sparkContext.broadcast(centers)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = _matrix(batch["vec"])
            slices = np.split(vectors, np.cumsum([b.shape[1] for b in books])[:-1], axis=1)
            codes = np.stack([_scores(s, b, "l2").argmax(1) for s, b in zip(slices, books)], axis=1).astype(np.int32)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * len(books)
            yield pa.RecordBatch.from_arrays(
                [batch["pid"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.reshape(-1)))],
                names=["pid", "codes"],
            )

    return passages.select(F.col("pid").cast("long").alias("pid"), "vec").mapInArrow(encode, "pid long, codes array<int>")


def product_decode(encoded: DataFrame, codebooks: DataFrame) -> DataFrame:
    """(pid, vec): the centres put back together, by a lookup of each code."""
    book = codebooks.select("part", "code", F.col("vec").alias("center"))
    pieces = encoded.select("pid", F.posexplode("codes").alias("part", "code")).join(F.broadcast(book), ["part", "code"])
    ordered = F.array_sort(F.collect_list(F.struct("part", "center")))
    return pieces.groupBy("pid").agg(F.flatten(F.transform(ordered, lambda e: e["center"])).alias("vec"))


# -- embedding ------------------------------------------------------------

def embed(passages: DataFrame, make_encoder, text: str = "text", batch_size: int = 256) -> DataFrame:
    """Add ``vec``: a user's model over every text. ``make_encoder`` is called
    once per Python worker and returns texts -> matrix. Texts become Python strings ``batch_size`` at a time."""
    name = uuid.uuid4().hex

    @F.arrow_udf(ArrayType(FloatType()))
    def encoder(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _encoders:
            _encoders.clear()  # a worker serves one model after the other
            _encoders[name] = make_encoder()
        for texts in batches:
            for i in range(0, len(texts), batch_size):
                some = np.array(texts[i : i + batch_size].to_pylist(), dtype=object)
                yield pa.array(list(np.asarray(_encoders[name](some), np.float32)), pa.list_(pa.float32()))

    return passages.withColumn("vec", encoder(text))
