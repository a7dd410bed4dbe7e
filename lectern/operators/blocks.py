"""Top-k over posting blocks, each with a bound of what it can add.

Passages are dealt into shards. In a shard, a term's postings are cut into blocks that
carry their largest impact. A task goes through the lists of a question from the
one that can add most; when the lists that are left cannot lift a new passage among
the k best, only passages that are still in question are looked up in them, block by
block. What leaves a task are k passages a question."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK = 128
SCORE_DIGITS = 6
# scores are rounded before they are ranked, so one that is this much smaller may still tie
_TIE = 2 * 10.0**-SCORE_DIGITS
_QUESTION_ROWS = 200_000  # question terms of a block of questions


def posting_blocks(impacts: DataFrame, shards: int) -> DataFrame:
    """(shard, term, block, bound, pids, impacts) from (pid, term, impact): blocks of ``BLOCK`` postings
    in the order of the passages. A list is one shard's, so its size is bounded by that of a shard."""
    placed = impacts.withColumn("shard", F.pmod(F.xxhash64("pid"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    lists = placed.groupBy("shard", "term").agg(F.array_sort(F.collect_list(F.struct("pid", "impact"))).alias("all"))
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(BLOCK))
    cut = lists.select("shard", "term", F.posexplode(F.transform(starts, lambda i: F.slice("all", i, F.lit(BLOCK)))).alias("block", "part"))
    impact = F.col("part")["impact"]
    return cut.select("shard", "term", "block", F.array_max(impact).alias("bound"), F.col("part")["pid"].alias("pids"), impact.alias("impacts"))


@dataclass
class PostingList:
    """Postings of a term in a shard: places of the passages, rising, and impacts; where blocks start
    (and the end), the last place of each and its bound."""

    places: np.ndarray
    impacts: np.ndarray
    starts: np.ndarray
    lasts: np.ndarray
    bounds: np.ndarray

    def part(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, impacts) of some blocks."""
        if len(blocks) == len(self.bounds):
            return self.places, self.impacts
        sizes = self.starts[blocks + 1] - self.starts[blocks]
        at = np.repeat(self.starts[blocks] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return self.places[at], self.impacts[at]


def best_passages(lists: list[tuple[float, PostingList]], n: int, k: int, visited: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores): of ``n`` passages, all that can be among the ``k`` best by the sum of weight times
    impact. ``visited`` counts the postings that were read. Weights below zero bound nothing, so all lists are read then."""
    lists = sorted(lists, key=lambda x: -x[0] * x[1].bounds.max())
    most = np.array([w * x.bounds.max() for w, x in lists])
    rest = np.append(np.cumsum(most[::-1])[::-1], 0.0)
    prunes = all(w >= 0 and x.impacts.min() >= 0 for w, x in lists)
    scores, seen = np.zeros(n), np.zeros(n, bool)
    floor, least = -np.inf, -np.inf
    open_places = None
    for i, (weight, postings) in enumerate(lists):
        if prunes and rest[i] < floor:
            # nobody new can come in; of those seen, the ones that can still reach the floor are looked up
            alive = np.flatnonzero(seen) if open_places is None else open_places
            open_places = alive[scores[alive] + rest[i] >= floor]
            edges = np.searchsorted(postings.lasts, open_places)
            blocks = np.unique(edges[edges < len(postings.bounds)])
        else:
            adds = weight * postings.bounds + rest[i + 1] >= floor if prunes else np.ones(len(postings.bounds), bool)
            if not adds.all():
                # a block that lifts nobody new matters where it may hold a passage that was seen
                held = np.concatenate([[0], np.cumsum(seen)])
                first = postings.places[postings.starts[:-1]]
                adds |= held[postings.lasts + 1] > held[first]
            blocks = np.flatnonzero(adds)
        places, impacts = postings.part(blocks)
        if visited is not None:
            visited[0] += len(places)
        scores[places] += weight * impacts
        if open_places is None:
            seen[places] = True
            if prunes and seen.sum() >= k:
                floor = np.partition(scores[seen], -k)[-k] - _TIE
        elif len(open_places) > k:
            floor = max(floor, np.partition(scores[open_places], -k)[-k] - _TIE)
    found = np.flatnonzero(seen) if open_places is None else open_places
    return found, scores[found]


def _lists(shard: pa.Table) -> tuple[np.ndarray, dict[str, PostingList]]:
    """(passages of the shard, lists by term)."""
    shard = shard.sort_by([("term", "ascending"), ("block", "ascending")])
    sizes = np.diff(np.asarray(shard["pids"].combine_chunks().offsets))
    flat = shard["pids"].combine_chunks().flatten().to_numpy()
    impacts = shard["impacts"].combine_chunks().flatten().to_numpy()
    pids = np.unique(flat)
    places = np.searchsorted(pids, flat)
    ends = np.cumsum(sizes)
    starts = np.append(0, ends)
    bounds = np.asarray(shard["bound"])
    terms = shard["term"].combine_chunks().dictionary_encode()
    codes = np.asarray(terms.indices)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    out = {}
    for a, b in zip(first, np.append(first[1:], len(codes))):
        low, high = starts[a], starts[b]
        out[terms.dictionary[codes[a]].as_py()] = PostingList(
            places[low:high], impacts[low:high], starts[a : b + 1] - low, places[ends[a:b] - 1], bounds[a:b]
        )
    return pids, out


def _search(shard: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    asked = asked.sort_by("qid")
    qids, weights, terms = asked["qid"].combine_chunks(), np.asarray(asked["wq"]), asked["term"].to_pylist()
    codes = np.asarray(qids.dictionary_encode().indices)
    edges = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, int)
    pids, lists = _lists(shard) if shard.num_rows else (np.empty(0, np.int64), {})
    columns: tuple[list, list, list] = ([], [], [])
    for a, b in zip(edges, np.append(edges[1:], len(codes))):
        own = [(w, lists[t]) for t, w in zip(terms[a:b], weights[a:b]) if t in lists]
        if not own:
            continue
        places, scores = best_passages(own, len(pids), k)
        scores = np.round(scores, SCORE_DIGITS) + 0.0
        order = np.lexsort((pids[places], -scores))[:k]
        for column, values in zip(columns, (np.full(len(order), a), pids[places[order]], scores[order])):
            column.append(values)
    rows, found, scores = (np.concatenate(c) if c else np.empty(0) for c in columns)
    return pa.table({"qid": qids.take(pa.array(rows.astype(np.int64))), "pid": pa.array(found.astype(np.int64)), "score": pa.array(scores.astype(np.float64))})


def search_blocks(blocks: DataFrame, asked: DataFrame, k: int, fits: bool) -> DataFrame:
    """(qid, pid, score): the k best passages of each question in every shard, from ``asked`` (qid, term, wq).
    Passages that share no term with a question are no hits.

    ``fits`` says that the questions were measured to fit on every executor: they travel to the
    shards, which stay where they are. Otherwise questions are dealt into blocks by a hash, and blocks
    of questions meet the shards, a shard's part being what those questions ask."""
    hits = f"qid {asked.schema['qid'].dataType.simpleString()}, pid long, score double"
    if fits:
        table = asked.select("qid", "term", "wq").toArrow()
        shared = blocks.sparkSession.sparkContext.broadcast(table)
        terms = blocks.sparkSession.createDataFrame(pa.table({"term": table["term"].unique()})) if table.num_rows else asked.select("term").distinct()
        found = blocks.join(F.broadcast(terms), "term", "left_semi")
        return found.groupBy("shard").applyInArrow(lambda shard: _search(shard, shared.value, k), hits)
    many = F.ceil(asked.agg(F.count("*")).scalar() / _QUESTION_ROWS)
    dealt = asked.select("qid", "term", "wq", F.pmod(F.xxhash64("qid"), many).cast("int").alias("part"))
    parts = dealt.select(F.col("term").alias("term"), F.col("part").alias("part")).distinct()
    wanted = blocks.join(parts, "term")
    last = blocks.agg(F.max("shard")).scalar()
    everywhere = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), last)))
    # both come from one table of terms, so their columns get names of their own
    sides = (df.select(*[F.col(c).alias(c) for c in df.columns]).groupBy("shard", "part") for df in (everywhere, wanted))
    pairs = next(sides).cogroup(next(sides))
    return pairs.applyInArrow(lambda questions, shard: _search(shard, questions, k), hits)
