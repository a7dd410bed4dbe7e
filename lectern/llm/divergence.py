"""Source divergence audit: which terms set a source apart within its language.

A term's standing is better with a higher count in the group, a lower count in the
language and an earlier place in UTF-8. Partitions retain the terms that fewer than k others
beat in all three (the k-skyband); merged skybands hold the k best, whatever the
sizes of group and language, and are then ranked by the exact figure."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.kernels import ASCII_LOWER, chunks, text_bytes
from lectern.llm.tables import written
from lectern.operators.sizing import top_k

SCALE = 1_000_000_000
SMOOTHING = 5
# texts counted at a time; rows that one skyband task holds; sources of a tile and cells of a block of pairs
COUNTED_BYTES = 8 << 20
PART_ROWS = 1 << 16
TILE = 256
BLOCK_CELLS = 1 << 21

_LETTER = np.zeros(256, bool)  # A-Z, a-z and every byte of a character beyond ASCII
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CELLS = "lang string, source string, term string, n long, df long"


# -- counts ---------------------------------------------------------------

def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(terms of all texts in order, how many each text has)."""
    raw, offsets = text_bytes(texts)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _LETTER[raw]
    opens, closes = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # a term never crosses from one text into the next
    seams = offsets[1:-1]
    joined = seams[inside[seams] & inside[seams + 1]] if len(raw) else seams
    opens[joined] = closes[joined] = True
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    letters = ASCII_LOWER[raw[inside[1:-1]]] if len(raw) else raw
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters.tobytes()))
    return terms.dictionary_encode(), np.diff(np.searchsorted(starts, offsets))


def _grouped(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, summed weights, occurrences)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    times = np.diff(np.append(at, len(keys)))
    return keys[at], times if weights is None else np.add.reduceat(weights[order], at), times


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in chunks(batch.column(2), COUNTED_BYTES):
            terms, sizes = _split(texts)
            if not len(terms):
                continue
            langs, sources = (batch.column(i).slice(first, len(texts)).dictionary_encode() for i in (0, 1))
            group = np.asarray(langs.indices, np.int64) * len(sources.dictionary) + np.asarray(sources.indices, np.int64)
            kinds = len(terms.dictionary)
            held, n, _ = _grouped(np.repeat(np.arange(len(texts)), sizes) * kinds + np.asarray(terms.indices, np.int64))
            cells, n, df = _grouped(group[held // kinds] * kinds + held % kinds, n)
            of, term = np.divmod(cells, kinds)
            lang, source = np.divmod(of, len(sources.dictionary))
            named = [d.take(pa.array(i)) for d, i in ((langs.dictionary, lang), (sources.dictionary, source), (terms.dictionary, term))]
            yield pa.RecordBatch.from_arrays(
                [*(x.cast(pa.string()) for x in named), pa.array(n), pa.array(df.astype(np.int64))],
                names=["lang", "source", "term", "n", "df"],
            )


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, df): occurrences of every term and documents with it, by group. Terms are runs
    of letters A-Z and of characters beyond ASCII, A-Z lower-cased; every row is a document."""
    return (
        _named(docs, lang, source, text)
        .mapInArrow(_count, _CELLS)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    )


def _named(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in zip(columns, ("lang", "source", "text"))])


# -- shares ---------------------------------------------------------------

def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(scale * (count + 5) / (total + 5 * kinds)), in whole numbers of any size."""
    above = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total.cast("decimal(20,0)") + kinds.cast("decimal(18,0)") * F.lit(SMOOTHING).cast("decimal(1,0)")).cast("decimal(22,0)")
    return F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(22,0)"))) + 1


# -- skybands -------------------------------------------------------------

def skyband(n: np.ndarray, cl: np.ndarray, place: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """Indices of the rows that fewer than ``k`` others beat or equal in a higher ``n``, a lower
    ``cl`` and an earlier ``place`` (distinct).

    Rows are taken in that order, so who beats a row comes before it. What is out is
    beaten by k rows that are in, so comparing with those is enough."""
    order = np.lexsort((place, cl, -n))
    cl, place = cl[order], place[order]
    kept_cl, kept_place = np.empty(0, cl.dtype), np.empty(0, place.dtype)
    out = []
    for start in range(0, len(order), block):
        c, p = cl[start : start + block], place[start : start + block]
        beaten = np.zeros(len(c), np.int64)
        for at in range(0, len(kept_cl), 1 << 13):
            part = slice(at, at + (1 << 13))
            beaten += ((kept_cl[part] <= c[:, None]) & (kept_place[part] < p[:, None])).sum(axis=1)
        beaten += np.tril((c <= c[:, None]) & (p < p[:, None]), -1).sum(axis=1)
        stays = np.flatnonzero(beaten < k)
        kept_cl, kept_place = np.concatenate([kept_cl, c[stays]]), np.concatenate([kept_place, p[stays]])
        out.append(order[start + stays])
    return np.concatenate(out) if out else order


def _skybands(rows: DataFrame, k: int) -> DataFrame:
    """Skyband of every part of a group; parts are ``PART_ROWS`` rows by a hash of the term, so that
    no group is one task's."""
    sizes = rows.groupBy("lang", "source").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))
    dealt = rows.join(sizes, ["lang", "source"]).withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")))

    def retain(part: pa.Table) -> pa.Table:
        places = np.empty(part.num_rows, np.int64)
        places[np.asarray(pc.sort_indices(part["term"]))] = np.arange(part.num_rows)
        return part.take(pa.array(skyband(np.asarray(part["n"]), np.asarray(part["cl"]), places, k))).drop_columns(["part", "parts"])

    return dealt.groupBy("lang", "source", "part").applyInArrow(retain, rows.schema)


# -- pairs of sources -----------------------------------------------------

def _pair_sums(block: pa.Table) -> pa.Table:
    """Over the terms of a block, the sum of ``|p - p'| - |z - z'|`` of every two of its sources, where z
    is the share of a term that a source lacks. Rows without a term name the sources and their z."""
    term, idx, p = block["term"].combine_chunks(), np.asarray(block["idx"]), np.asarray(block["p"])
    names = np.asarray(pc.is_null(term))
    ids, z = idx[names], p[names]
    order = np.argsort(ids)
    ids, z = ids[order], z[order]
    codes = term.filter(pa.array(~names)).dictionary_encode()
    shares = np.repeat(z[None, :], len(codes.dictionary), axis=0)
    shares[np.asarray(codes.indices, np.int64), np.searchsorted(ids, idx[~names])] = p[~names]
    ta, tb = (block[c][0].as_py() for c in ("ta", "tb"))
    left, right = np.flatnonzero(ids // TILE == ta), np.flatnonzero(ids // TILE == tb)
    firsts, seconds, sums = [], [], []
    for i in left:
        others = right[right > i] if ta == tb else right
        sums.append(np.abs(shares[:, others] - shares[:, [i]]).sum(axis=0) - len(shares) * np.abs(z[others] - z[i]))
        firsts.append(np.full(len(others), ids[i]))
        seconds.append(ids[others])
    columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (firsts, seconds, sums)]
    lang = pa.array([block["lang"][0].as_py()] * len(columns[0]), pa.string())
    return pa.Table.from_arrays([lang, *(pa.array(c.astype(np.int64)) for c in columns)], names=["lang", "a", "b", "more"])


def _pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language. ``groups`` has (lang, source, kinds, z)."""
    numbered = groups.withColumns(
        {
            "idx": F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1,
            "sources": F.count("*").over(Window.partitionBy("lang")),
        }
    ).withColumn("slices", F.greatest(F.lit(1), F.ceil(F.col("kinds") * F.least(F.col("sources"), F.lit(2 * TILE)) / BLOCK_CELLS)).cast("int"))
    numbered = written(numbered, "groups")
    known = numbered.select("lang", "source", "idx", "sources", "slices")
    own = cells.select("lang", "source", "term", "p").join(known, ["lang", "source"])
    own = own.withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    marks = numbered.filter("kinds > 0").withColumns(
        {"term": F.lit(None).cast("string"), "p": F.col("z"), "slice": F.explode(F.sequence(F.lit(0), F.col("slices") - 1))}
    )
    columns = ["lang", "idx", "sources", "slice", "term", "p"]
    both = own.select(columns).unionByName(marks.select(columns))
    tile = F.expr(f"idx div {TILE}")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(sources - 1) div {TILE}")))
    tiled = both.withColumn("tile", tile).withColumn("other", other).select(
        "lang", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"), "slice", "idx", "term", "p"
    )
    more = (
        tiled.groupBy("lang", "ta", "tb", "slice").applyInArrow(_pair_sums, "lang string, a long, b long, more long")
        .groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))
    )
    one = numbered.select("lang", "source", "idx", "kinds", "z")
    two = numbered.select("lang", F.col("source").alias("item"), F.col("idx").alias("jdx"), F.col("z").alias("y"))
    met = one.join(two, "lang").filter("idx <> jdx").withColumns({"a": F.least("idx", "jdx"), "b": F.greatest("idx", "jdx")})
    apart = F.coalesce(F.col("kinds") * F.abs(F.col("z") - F.col("y")), F.lit(0)) + F.coalesce("more", F.lit(0))
    return met.join(more, ["lang", "a", "b"], "left").select("lang", "source", "item", apart.cast("long").alias("value"))


# -- audit ----------------------------------------------------------------

def audit(docs: DataFrame, least_documents: int = 30, k: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group of ``docs``.

    A language keeps the terms in at least ``least_documents`` of its documents (rows). Part ``pair`` ranks
    the other sources of the language by the summed distance of all kept terms' shares, part
    ``term`` the ``k`` terms whose share in the group exceeds that of the language most. Ties go to the item
    that is earlier in UTF-8. A null text, lang or source is empty, and an empty lang or source is a
    group as any other. A group without terms, as one of empty texts, is there with shares of zero counts, and a
    language that keeps no term gives values of 0. Repeated rows are documents of their own. Other
    columns are not read; an empty table gives an empty result.

    A task counts its texts before anything moves, so a term, source or language with most of the
    rows is a row per task and chunk. Pairs are summed in tiles of sources and slices of terms."""
    cells = written(term_counts(docs, lang, source, text), "cells")
    kept = cells.groupBy("lang", "term").agg(F.sum("n").alias("cl"), F.sum("df").alias("df")).filter(F.col("df") >= least_documents)
    counted = written(cells.select("lang", "source", "term", "n").join(kept.select("lang", "term", "cl"), ["lang", "term"]), "kept")
    of_group = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("kinds"), F.sum("n").alias("lang_total")
    )
    zero = F.lit(0).cast("long")
    groups = _named(docs, lang, source).distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.withColumns({c: F.coalesce(c, zero) for c in ("total", "kinds", "lang_total")})
    groups = written(groups.withColumn("z", share(zero, F.col("total"), F.col("kinds"))), "shares")
    figures = groups.select("lang", "source", "total", "kinds", "lang_total")
    shared = written(
        counted.join(figures, ["lang", "source"]).select(
            "lang", "source", "term", "n", "cl", share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
            share(F.col("cl"), F.col("lang_total"), F.col("kinds")).alias("q"),
        ),
        "cell-shares",
    )
    pairs = _pairs(groups.select("lang", "source", "kinds", "z"), shared)
    over = shared.filter("p > q").withColumn("value", F.col("p") - F.col("q")).select("lang", "source", "term", "n", "cl", "value")
    merged = _skybands(written(_skybands(over, k), "skybands"), k)
    terms = merged.select("lang", "source", F.col("term").alias("item"), "value")
    order = [F.col("value").desc(), F.col("item")]
    ranked_pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    out = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return (
        ranked_pairs.withColumn("part", F.lit("pair")).select(*out)
        .unionByName(top_k(terms, ["lang", "source"], order, k).withColumn("part", F.lit("term")).select(*out))
    )
