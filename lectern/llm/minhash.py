"""Near duplicates by circulant MinHash.

Two permutations of the 64-bit values give all coordinates: one spreads the shingles
once, the other, shifted circularly by k, is coordinate k (Li and Li, C-MinHash).
Bands of coordinates name candidate buckets; links are confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.components import components, rough_classes
from lectern.llm.kernels import WordHasher, chunks, digest, mix, windows
from lectern.llm.lines import body_key
from lectern.llm.tables import arrow_map, drop, settled, written
from lectern.operators.sizing import fits_broadcast

_SIGNED = "doc_id long, d1 long, d2 long, n_shingles long, bands array<long>"
_SETS = "doc_id long, shingles array<long>"
# coordinates are computed over this many shingles at a time, so that they stay in cache
_BLOCK = 1 << 16
# sets go back to Spark as soon as they hold so many
_HELD_SHINGLES = 1 << 17
# pivots that the members of a bucket meet, of a band and of a prefix; then all that is left meets
_BAND_PIVOTS, _PREFIX_PIVOTS = 2, 8


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of k-word runs; a shorter text is one run; no words, no set."""
    if 0 < len(hashes) < k:
        return windows(hashes, len(hashes)) + np.uint64(len(hashes))
    return np.unique(windows(hashes, k))


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Circulant MinHash coordinates of non-empty sets, one row each.

    The first permutation places the shingles on a circle of 2**32 values; coordinate k is the
    least value of the second one, read k places further on."""
    out = np.full((len(sets), coordinates), np.iinfo(np.uint32).max, np.uint32)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    circle = (mix(np.concatenate(sets) ^ np.uint64(0x6A09E667F3BCC909)) >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(circle), _BLOCK):
        block = circle[start : start + _BLOCK]
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(ends, start + len(block), "left"))
        edges = np.maximum(ends[first : last + 1] - sizes[first : last + 1] - start, 0)
        value, shifted = np.empty_like(block), np.empty_like(block)
        for k in range(coordinates):
            np.add(block, np.uint32(k), out=value)
            np.multiply(value, np.uint32(0x85EBCA6B), out=value)
            np.right_shift(value, np.uint32(15), out=shifted)
            np.bitwise_xor(value, shifted, out=value)
            np.multiply(value, np.uint32(0xC2B2AE35), out=value)
            np.right_shift(value, np.uint32(13), out=shifted)
            np.bitwise_xor(value, shifted, out=value)
            np.minimum(out[first : last + 1, k], np.minimum.reduceat(value, edges), out=out[first : last + 1, k])
    return out


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per set and band of ``rows`` coordinates, different for each band."""
    grid = coordinates.reshape(len(coordinates), -1, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, grid.shape[1] + 1, dtype=np.uint64), grid.shape[:2])
    for j in range(rows):
        keys = mix(keys * np.uint64(0xA24BAED4963EE407) + grid[:, :, j])
    return keys


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for first, part in chunks(batch.column(1)):
                hashes, at = hasher.chunk(part)
                n = len(part)
                ones, twos, sizes = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                sets, filled = [], []
                for row in range(n):
                    own = hashes[at[row] : at[row + 1]]
                    if len(own):
                        sets.append(shingle_set(own, k))
                        filled.append(row)
                        ones[row], twos[row] = digest(own)
                        sizes[row] = len(sets[-1])
                keys: list = [None] * n
                if sets:
                    for row, own in zip(filled, band_keys(signatures(sets, bands * rows), rows).view(np.int64)):
                        keys[row] = own
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(ones), pa.array(twos), pa.array(sizes), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "d1", "d2", "n_shingles", "bands"],
                )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            ids, found, held = [], [], 0
            for row, hashes in hasher(batch.column(1)):
                shingles = shingle_set(hashes, k)
                ids.append(batch.column(0)[row].as_py())
                found.append(shingles.view(np.int64))
                held += len(shingles)
                if held > _HELD_SHINGLES:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "shingles"])
                    ids, found, held = [], [], 0
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "shingles"])

    return run


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (p, x) with ``linked`` and ``far`` from their full sets. A pivot that is in very
    many pairs is a skewed join key, which adaptive execution splits."""
    of_p = sets.join(pairs.select(F.col("p").alias("doc_id")).distinct(), "doc_id", "left_semi")
    with_x = pairs.join(sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("sx")), "x")
    both = with_x.join(of_p.select(F.col("doc_id").alias("p"), F.col("shingles").alias("sp")), "p")
    shared = F.size(F.array_intersect("sx", "sp"))
    sized = both.select("p", "x", shared.alias("shared"), (F.size("sx") + F.size("sp") - shared).alias("union"))
    return sized.groupBy("p", "x").agg(
        F.bool_or(F.col("shared") * 100 >= F.col("union") * percent).alias("linked"),
        F.bool_and(F.col("shared") * 100 < F.col("union") * (2 * percent - 100)).alias("far"),
    )


def _state(labels: DataFrame, met: DataFrame) -> DataFrame:
    """(doc_id, class, star, away) of the documents that have met others: the class, a
    pivot that it is linked to, and the pivots that it is so far from that, by the triangle
    inequality of the Jaccard distance, it cannot be linked to what is linked to them."""
    stars = met.filter("linked").select("p", F.explode(F.array("p", "x")).alias("doc_id"))
    star = stars.groupBy("doc_id").agg(F.min("p").alias("star"))
    away = met.filter("far").groupBy(F.col("x").alias("doc_id")).agg(F.collect_set("p").alias("away"))
    classes = labels.select(F.col("node").alias("doc_id"), F.col("label").alias("class"))
    return written(classes.join(star, "doc_id", "full").join(away, "doc_id", "full"), "state")


def _ends() -> tuple:
    return F.least("p", "x").alias("lo"), F.greatest("p", "x").alias("hi")


def _known(rows: DataFrame, state: DataFrame | None) -> DataFrame:
    """Rows (band, doc_id, n, place, degree) with what is known of their documents."""
    rows = rows.select("band", "doc_id", "n", "place", *(["degree"] if "degree" in rows.columns else []))
    if state is None:
        nowhere = F.array().cast("array<bigint>")
        return rows.withColumns({"class": F.col("doc_id"), "star": F.lit(None).cast("long"), "away": nowhere})
    named = rows.join(state, "doc_id", "left")
    return named.withColumns(
        {"class": F.coalesce("class", "doc_id"), "away": F.coalesce("away", F.array().cast("array<bigint>"))}
    )


def _undone(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of the buckets whose members are not all known to belong together, without those
    that nobody of the sizes there can be linked to from their place on."""
    spans = rows.groupBy("band").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    # shared * (100 + percent) >= (n + m) * percent, and no more is shared than what is left, or than the other has
    large = (F.col("n") - F.col("place") + 1) * (100 + percent) >= (F.col("n") + F.col("least")) * percent
    small = F.col("most") * 100 >= F.col("n") * percent
    return rows.join(spans.filter("lo < hi"), "band").filter(large & small).drop("lo", "hi", "least", "most")


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with ``degree``: how often a document meets others. Who meets most is most
    likely in the middle of its group."""
    if "size" not in rows.columns:
        rows = rows.join(rows.groupBy("band").agg(F.count("*").alias("size")), "band")
    degree = rows.groupBy("doc_id").agg(F.sum("size").alias("degree"))
    return rows.drop("size").join(degree, "doc_id")


def _meet(rows: DataFrame, salts: int | None, percent: int) -> DataFrame:
    """Pairs (p, x), each once: in every bucket, all members meet one pivot per salt, or without
    ``salts`` one another, unless they are of one class, too far apart by what is known, or cannot share
    enough: of the shingles up to the places where they meet, they share that one at most."""
    own = ("doc_id", "class", "n", "place", "star", "away")
    if salts:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(salts)), F.lit(salts)))
        pivots = salted.groupBy("band", "salt").agg(F.max_by(F.struct(*own), F.struct("degree", "doc_id")).alias("top"))
        pivots = pivots.select("band", *[F.col(f"top.{c}").alias(f"p_{c}") for c in own])
    else:
        pivots = rows.select("band", *[F.col(c).alias(f"p_{c}") for c in own])
    most = F.least(F.col("n") - F.col("place"), F.col("p_n") - F.col("p_place")) + 1
    apart = F.array_contains("away", F.col("p_star")) | F.array_contains("p_away", F.col("star"))
    met = rows.join(
        pivots,
        (rows["band"] == pivots["band"])
        & (F.col("class") != F.col("p_class"))
        & (F.lit(True) if salts else F.col("p_doc_id") < F.col("doc_id"))
        & (most * (100 + percent) >= (F.col("n") + F.col("p_n")) * percent)
        & ~F.coalesce(apart, F.lit(False)),
    )
    pairs = met.select(F.col("p_doc_id").alias("p"), F.col("doc_id").alias("x"), *_ends())
    return pairs.dropDuplicates(["lo", "hi"])


def _prefixes(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(band, doc_id, n, place) with a bucket for each shingle that two of ``docs`` may have
    to share: in one order of all shingles, rarest first, sets that overlap enough
    have a shingle in common among the first of each (Chaudhuri et al., prefix filter)."""
    own = sets.join(docs, "doc_id", "left_semi").withColumn("n", F.size("shingles"))
    each = own.select("doc_id", "n", F.explode("shingles").alias("s"))
    shared = each.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1")
    listed = each.join(shared, "s").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("list"))
    # shingles of one document come first and use up places
    alone = F.col("n") - F.size("list")
    places = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone
    first = F.slice("list", F.lit(1), F.greatest(places, F.lit(0)).cast("int"))
    return listed.select("doc_id", F.col("n").cast("long").alias("n"), alone.alias("alone"), F.posexplode(first).alias("i", "v")).select(
        F.col("v.s").alias("band"), "doc_id", "n", (F.col("alone") + F.col("i") + 1).cast("long").alias("place")
    )


def _links(buckets: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Links (a, b) that connect all that can be linked inside the buckets.

    Members of a bucket first meet few pivots. Where the others do not turn out to belong
    together, prefix-filter buckets replace the bands: they keep every pair that can be linked and part
    documents that only share a common passage. There the members meet more pivots, and at last all
    of other classes that may still be linked. No pair is compared twice."""
    sizes = buckets.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    rows = written(_known(_ranked(buckets.join(sizes, "band").withColumn("place", F.lit(1).cast("long"))), None), "buckets")
    if rows.isEmpty():
        return None
    asked = written(rows.select("doc_id").distinct(), "asked")
    # few ids go to the texts, which then do not move
    asked = F.broadcast(asked) if fits_broadcast(asked) else asked
    sets = written(arrow_map(docs.join(asked, "doc_id", "left_semi").select("doc_id", "text"), _sets(k), _SETS), "shingles")
    met: DataFrame | None = None
    for salts in (_BAND_PIVOTS, _PREFIX_PIVOTS, None):
        pairs = _meet(rows, salts, percent)
        if met is not None:
            pairs = pairs.join(met.select("lo", "hi"), ["lo", "hi"], "left_anti")
        found = written(_compared(pairs, sets, percent).select("*", *_ends()), "met")
        met = found if met is None else met.unionByName(found)
        links = met.filter("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))
        if salts is None:
            break
        if salts == _BAND_PIVOTS:  # these are few, so that a document is away from few
            away = found
        state = written(_state(rough_classes(links), away), "state")
        left = written(_undone(_known(rows, state), percent), "buckets")
        drop(rows)
        rows = left
        if salts == _BAND_PIVOTS and not rows.isEmpty():
            open_docs = written(rows.select("doc_id").distinct(), "open")
            prefixes = written(_prefixes(open_docs, sets, percent), "prefixes")
            left = written(_undone(_known(_ranked(prefixes), state), percent), "buckets")
            drop(rows, open_docs, prefixes)
            rows = left
        drop(state)
        if rows.isEmpty():
            break
    drop(sets)
    return links


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 75, bands: int = 24, rows: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: the classes of
    documents linked by ``100 * shared >= percent * union`` of their k-word shingles.

    Words are separated by white space, A-Z lower-cased. A text with fewer words is one
    shingle; one without words, or null, has none and stands alone. ``component_id`` is
    the smallest id reachable. With 24 bands of 3 coordinates a pair at 0.75 shares no
    band once in 500,000, and more alike pairs less often.

    Exact copies (of the word sequence) collapse to their smallest id before the
    buckets are formed. A document is its id: rows that repeat an id belong together,
    also with different texts. Null ids are left as they are, each alone, with a null
    ``component_id`` and kept. Extra columns are not carried; an empty table gives an
    empty result."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = written(arrow_map(own, _sign(k, bands, rows), _SIGNED), "signatures")
    classes = settled(lambda: _classes(signed.filter("n_shingles > 0 and doc_id is not null"), own, k, percent), "classes")
    out = signed.select("doc_id", "n_shingles").join(classes, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _classes(full: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, component_id) of the documents with words."""
    groups = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    copies = written(full.join(groups, ["d1", "d2"]), "copies")
    members = copies.select("doc_id", "rep").distinct()
    reps = copies.filter("doc_id = rep")
    buckets = reps.select(F.explode("bands").alias("band"), "doc_id", F.col("n_shingles").alias("n")).distinct()
    near = _links(buckets, docs, k, percent)
    # an id with several texts ties their groups together
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b")
    ties = several.select("a", "b").unionByName(
        members.join(several.select("doc_id", "a"), "doc_id").filter("rep > a").select("a", F.col("rep").alias("b"))
    )
    labels = components(ties if near is None else near.unionByName(ties))
    named = members.join(labels, F.col("rep") == F.col("node"), "left")
    return named.groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("component_id"))


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class of :func:`near_duplicates`, all columns as they were.

    Rows are told apart by id and text: those that share only an id are documents of their own, and so are
    rows without an id. The first of a class stays by id, null last, and then by a hash of the text;
    of rows equal in both, any one. Texts without words belong to no class and stay, repeated
    or not. Only the ids of what goes meet the texts."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("long").alias("id"), body_key(text).alias("body"),
        F.col(text).alias("text"),
    )
    shared = settled(lambda: _shared_ids(rows), "shared-ids")
    if shared.isEmpty():
        near = settled(lambda: near_duplicates(rows, key="id", **options).filter("not kept").select(F.col("doc_id").alias("id")), "lost")
        return rows.join(near, "id", "left_anti").select("row.*")
    near = settled(lambda: near_duplicates(_keyed(rows, shared).withColumn("key", F.coalesce("number", "id")), key="key", **options), "classes")
    named = near.join(shared, F.col("number") == F.col("doc_id"), "left")
    named = named.withColumn("id", F.when(F.col("number").isNull(), F.col("doc_id")).otherwise(F.col("id")))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "body", "doc_id")
    first = named.groupBy("component_id").agg(F.min(place).alias("first"))
    judged = settled(
        lambda: named.join(first, "component_id").select(
            "number", "id", "n_shingles", "n", (F.col("first.doc_id") == F.col("doc_id")).alias("stays")
        ), "judged",
    )
    of_one = judged.filter("number is null and not stays").select("id")
    alone = _keyed(rows, shared).filter("number is null").join(of_one, "id", "left_anti")
    stay = judged.filter("number is not null and stays").select("number", "n_shingles", "n").distinct()
    met = _keyed(rows, shared).filter("number is not null").join(stay, "number")
    once = met.filter("n = 1 or n_shingles = 0").select("row")
    repeated = met.filter("n > 1 and n_shingles > 0").dropDuplicates(["number"]).select("row")
    return alone.select("row").unionByName(once).unionByName(repeated).select("row.*")


def _shared_ids(rows: DataFrame) -> DataFrame:
    """(id, body, n, number) of the rows that their id does not name, with a number below all ids instead."""
    counted = rows.groupBy("id", "body").agg(F.count("*").alias("n"))
    several = counted.groupBy("id").agg(F.sum("n").alias("rows")).filter("rows > 1 or id is null").select(F.col("id").alias("of"))
    least = rows.agg(F.least(F.lit(0).cast("long"), F.min("id"))).scalar()
    shared = written(counted.join(several, F.col("id").eqNullSafe(F.col("of")), "left_semi"), "shared")
    return shared.withColumn("number", least - 1 - F.monotonically_increasing_id())


def _keyed(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Rows with the number of those that their id does not name."""
    own = shared.select(F.col("id").alias("of"), F.col("body").alias("digest"), "number")
    return rows.join(own, F.col("id").eqNullSafe(F.col("of")) & (F.col("body") == F.col("digest")), "left").drop("of", "digest")
