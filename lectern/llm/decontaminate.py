"""Benchmark decontamination by greedy string tiling.

Runs of tokens that a document shares with a benchmark item seed the pairs. In a
pair the longest common run of unmarked tokens is found by Karp-Rabin hashes and
marked, again and again until no run of the least length is left (Wise, 1993). The
share of the item that the tiles cover decides, so passages in another order count."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lectern.llm.kernels import BASE, BASE_INVERSE, ASCII_LOWER, WordHasher, powers, chunks, windows
from lectern.llm.tables import arrow_map, written

# a token is a run of ASCII letters and digits and of all that is not ASCII
SEPARATORS = np.ones(256, bool)
SEPARATORS[128:] = False
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    SEPARATORS[ord(_first) : ord(_last) + 1] = False

BLOCK_BYTES = 4 << 20
_SIEVE_BITS = 20

MATCH = "doc_id long, item_id long, item_tokens long, covered_tokens long, tiles long, coverage double"


class Rolled:
    """Karp-Rabin hashes of all runs of any length, from prefix sums."""

    def __init__(self, tokens: np.ndarray):
        n = len(tokens)
        self.down = powers(BASE_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tokens * powers(BASE, n + 1)[:n], out=self.sums[1:])

    def runs(self, length: int, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the runs without a marked token."""
        n = len(marked) - length + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        taken = np.concatenate([[0], np.cumsum(marked)])
        starts = np.flatnonzero(taken[length:] == taken[:n])
        return starts, (self.sums[starts + length] - self.sums[starts]) * self.down[starts]


def tile(text: np.ndarray, item: np.ndarray, least: int, blocked: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Tiles (start in text, start in item, length), longest first, and at one length in
    the order of the item, then of the text. ``blocked`` tokens of the text match nothing."""
    in_text = np.zeros(len(text), bool) if blocked is None else blocked.copy()
    in_item = np.zeros(len(item), bool)
    a, b = Rolled(text), Rolled(item)
    tiles, longest = [], min(len(text), len(item))
    while longest >= least:
        low, high = least - 1, longest  # a common run of a length has common runs of all smaller ones
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(b.runs(middle, in_item)[1], a.runs(middle, in_text)[1]).any():
                low = middle
            else:
                high = middle - 1
        if low < least:
            break
        longest = low
        starts, hashes = a.runs(longest, in_text)
        places = defaultdict(list)
        for start, value in zip(starts.tolist(), hashes.tolist()):
            places[value].append(start)
        used = dict.fromkeys(places, 0)
        for start, value in zip(*(v.tolist() for v in b.runs(longest, in_item))):
            if in_item[start : start + longest].any():
                continue
            found = places.get(value, [])
            while used.get(value, 0) < len(found):
                at = found[used[value]]
                if in_text[at : at + longest].any():
                    used[value] += 1
                    continue
                if np.array_equal(text[at : at + longest], item[start : start + longest]):
                    tiles.append((at, start, longest))
                    in_text[at : at + longest] = in_item[start : start + longest] = True
                used[value] += 1
                break
        longest -= 1
    return tiles


class Seeds:
    """Runs of the items of one block, sorted, with the items that hold them."""

    def __init__(self, items: list[tuple[int, np.ndarray]], least: int):
        self.items = items
        by_length = defaultdict(list)
        for n, (_, tokens) in enumerate(items):
            if len(tokens):
                by_length[min(least, len(tokens))].append(n)
        self.of_length = {}
        for length, owners in by_length.items():
            values = [windows(items[n][1], length) for n in owners]
            hashes = np.concatenate(values)
            holders = np.repeat(np.array(owners), [len(v) for v in values])
            order = np.argsort(hashes, kind="stable")
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[hashes >> np.uint64(64 - _SIEVE_BITS)] = True
            self.of_length[length] = hashes[order], holders[order], sieve

    def hits(self, tokens: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, hashes) of the seeds among the runs of many texts."""
        for length, (hashes, _, sieve) in self.of_length.items():
            runs = windows(tokens, length)
            at = np.flatnonzero(sieve[runs >> np.uint64(64 - _SIEVE_BITS)])
            at = at[at + length <= ends[at]]  # runs inside one text
            found = np.minimum(np.searchsorted(hashes, runs[at]), len(hashes) - 1)
            at = at[hashes[found] == runs[at]]
            if len(at):
                yield length, at, runs[at]

    def owners(self, length: int, values: np.ndarray) -> np.ndarray:
        hashes, holders, _ = self.of_length[length]
        low, high = np.searchsorted(hashes, values, "left"), np.searchsorted(hashes, values, "right")
        return np.unique(np.concatenate([holders[a:b] for a, b in zip(low, high)]))


def _spanned(places: np.ndarray, length: int, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _judge(tokens: np.ndarray, item: np.ndarray, places: np.ndarray, values: np.ndarray, length: int, least: int, share: float):
    """(covered, tiles) of a pair, or None where its seeds alone fall short: every
    tile is made of seeds, so what they span bounds what tiles can cover."""
    own = windows(item, length)
    known = np.isin(own, values)
    if _spanned(np.flatnonzero(known), length, len(item)).sum() < share * len(item):
        return None
    near = _spanned(places[np.isin(values, own)], length, len(tokens))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
    parts, walls = [], []
    for start, end in zip(edges[::2], edges[1::2]):
        parts += [tokens[start:end], tokens[:1]]
        walls += [np.zeros(end - start, bool), np.ones(1, bool)]
    tiles = tile(np.concatenate(parts), item, min(least, len(item)), np.concatenate(walls))
    return sum(t[2] for t in tiles), len(tiles)


def _search(seeds: Seeds, least: int, share: float):
    names = [f.split()[0] for f in MATCH.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SEPARATORS, ASCII_LOWER)
        for batch in batches:
            out = []
            for first, part in chunks(batch.column(1)):
                tokens, at = hasher.chunk(pc.utf8_lower(pc.fill_null(part, "")))
                ends = np.repeat(at[1:], np.diff(at))
                for length, places, values in seeds.hits(tokens, ends):
                    rows = np.searchsorted(at, places, "right") - 1
                    cuts = np.flatnonzero(np.diff(rows)) + 1
                    for p, v in zip(np.split(places, cuts), np.split(values, cuts)):
                        row = int(np.searchsorted(at, p[0], "right") - 1)
                        text = tokens[at[row] : at[row + 1]]
                        for n in seeds.owners(length, np.unique(v)):
                            item_id, item = seeds.items[n]
                            if min(least, len(item)) != length:
                                continue
                            found = _judge(text, item, p - at[row], v, length, least, share)
                            if found and found[0] >= share * len(item):
                                doc = batch.column(0)[first + row].as_py()
                                out.append((doc, item_id, len(item), *found, found[0] / len(item)))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.float64())], names=names
                )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = 5, share: float = 0.5, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered_tokens, tiles, coverage): a row for every
    document and item of which tiles of at least ``least`` tokens cover ``share``.

    Tokens are lower-cased runs of letters, digits and non-ASCII characters, so
    punctuation and line breaks do not hide a passage. An item shorter than ``least`` is its
    own seed and has to occur whole; one without a token, or null, matches nothing, and
    neither does a null text. Repeated rows give repeated results.

    Documents stay where they are: the benchmark is the query set. It is cut into blocks of
    about ``block_bytes`` by a hash, and each block visits all documents, so what a task and the
    driver hold is bounded however large the benchmark is. A text is read whole, however long; an empty table on either
    side gives an empty result, and other columns are not read, whatever their names."""
    items = benchmark.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hasher, result = WordHasher(SEPARATORS, ASCII_LOWER), None
    for block in range(n_blocks):
        rows = items.filter(block_of == block).collect()
        texts = pc.utf8_lower(pa.array([r["text"] or "" for r in rows], pa.string()))
        seeds = Seeds([(rows[i]["item_id"], tokens) for i, tokens in hasher(texts)], least)
        found = arrow_map(own, _search(seeds, least, share), MATCH)
        if n_blocks > 1:  # written before the next block is read, so that the driver holds one
            found = written(found, "matches")
        result = found if result is None else result.unionByName(found)
    return result
