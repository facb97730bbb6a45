"""Benchmark decontamination by greedy string tiling.

Seeds are the hashes of short word windows of the benchmark items, rolled over every document
(Karp-Rabin). For a document and an item that share a seed, the longest match that overlaps no earlier one
is marked as a tile, again and again, until no match of the least length is left. Its length is found by bisection: windows of
a length are hashed on both sides from running sums, and only unmarked ones meet. A round costs the words of both sides,
also where one word or phrase fills both. Tiles may lie in any order, so passages that were reordered
still count. A document is contaminated by an item if tiles cover enough of the item's words.

Words are letters and digits of any script, lower-cased, so punctuation and layout play no part; in scripts
without spaces each character is a word. An item
with fewer words than a seed is its own seed; an item without words matches nothing.

The benchmark is read in blocks of at most ``block_words`` words, and every block meets all documents, so that
what a task holds is bounded whatever the benchmark's size.

Defined cases: null and empty texts are never contaminated and contaminate nothing; null item
ids and null document ids are kept as they are; repeated rows are repeated in the result; empty tables give an empty result.
Of equally long matches the one first in the item, then first in the document, is marked.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from kinfold.llm.registry import query, table
from kinfold.llm.text import Texts, free_name, letter_words, schema_with, splitmix, texts_of, within


@dataclass
class TilingParams:
    seed_words: int = 5  # least length of a tile
    coverage: float = 0.5  # of an item's words
    block_words: int = 1 << 20


@dataclass
class Index:
    """One block of items: their words, and by seed length the sorted hashes of seeds, each with an item that holds it."""

    ids: list
    lengths: np.ndarray
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray]]


def rolled(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k words."""
    if len(words) < k:
        return words[:0]
    total = np.zeros(len(words) - k + 1, np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    for j in range(k):
        total = total * factor + words[j : len(words) - k + 1 + j]
    return splitmix(total)


def index_of(ids: list, texts: Texts, k: int) -> Index:
    words = letter_words(texts)
    hashes, lengths = words.hashes(), words.counts(texts.rows())
    first = np.cumsum(lengths) - lengths
    own = [hashes[a : a + n] for a, n in zip(first, lengths, strict=True)]
    found: dict[int, list] = {}
    for i, n in enumerate(lengths.tolist()):
        size = min(k, n)
        if size:
            seeds = np.unique(rolled(own[i], size))
            found.setdefault(size, []).append((seeds, np.full(len(seeds), i)))
    ready = {}
    for size, parts in found.items():
        seeds, item = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(seeds, kind="stable")
        ready[size] = (seeds[order], item[order])
    return Index(ids, lengths, own, ready)


class Side:
    """Words of a document or an item, the hash of any window of them, and which are still free."""

    def __init__(self, words: np.ndarray, free: np.ndarray):
        n = len(words)
        steps = np.full(n + 1, _BASE, np.uint64)
        steps[0] = 1
        back = np.full(n + 1, _INVERSE, np.uint64)
        back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)
        self.sums = np.append(np.uint64(0), np.cumsum(splitmix(words) * np.cumprod(steps, dtype=np.uint64)[:n], dtype=np.uint64))
        self.free = free
        self.count()

    def count(self) -> None:
        self.taken = np.append(0, np.cumsum(~self.free))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the windows of free words."""
        at = np.flatnonzero(self.taken[size:] == self.taken[:-size])
        return at, (self.sums[at + size] - self.sums[at]) * self.back[at]


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def tiles(doc: np.ndarray, free: np.ndarray, item: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(place in the document, place in the item, words) of the tiles; only ``free`` words of the document count."""
    d, j = Side(doc, free.copy()), Side(item, np.ones(len(item), bool))
    out = []
    most = min(len(doc), len(item))

    def shared(size: int) -> bool:
        return bool(np.isin(j.windows(size)[1], d.windows(size)[1]).any())

    while most >= k and shared(k):
        low, high = k, most  # a match of some length holds matches of all smaller ones
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if shared(mid) else (low, mid - 1)
        item_at, item_hash = j.windows(low)
        doc_at, doc_hash = d.windows(low)
        met = np.isin(doc_hash, item_hash)
        doc_at, doc_hash = doc_at[met], doc_hash[met]
        order = np.lexsort((doc_at, doc_hash))
        doc_at, doc_hash = doc_at[order], doc_hash[order]
        begin, end = np.searchsorted(doc_hash, item_hash, "left"), np.searchsorted(doc_hash, item_hash, "right")
        next_of: dict[int, int] = {}  # places of a window that were taken stay taken
        for b, lo, hi in zip(item_at.tolist(), begin.tolist(), end.tolist(), strict=True):
            if lo == hi or not j.free[b : b + low].all():
                continue
            at = next_of.get(lo, lo)
            while at < hi and not d.free[doc_at[at] : doc_at[at] + low].all():
                at += 1
            next_of[lo] = at
            if at < hi:
                a = int(doc_at[at])
                out.append((a, b, low))
                d.free[a : a + low] = False
                j.free[b : b + low] = False
        d.count()
        j.count()
        most = low - 1
    return out


def matches(texts: Texts, index: Index, p: TilingParams) -> list[tuple[int, int, int, int, int]]:
    """(row, item, item words covered, tiles, longest tile) of all pairs that share a seed."""
    out = []
    for lo, part in texts.steps():
        words = letter_words(part)
        hashes, rows = words.hashes(), words.row
        first = np.searchsorted(rows, np.arange(part.rows() + 1))
        for k, (seeds, item) in index.seeds.items():
            if len(hashes) < k:
                continue
            window = rolled(hashes, k)
            same = rows[: len(window)] == rows[k - 1 :]
            sieve = np.zeros(1 << 16, bool)
            sieve[(seeds & np.uint64(0xFFFF)).astype(np.int64)] = True
            maybe = np.flatnonzero(same & sieve[(window & np.uint64(0xFFFF)).astype(np.int64)])
            maybe = maybe[np.isin(window[maybe], seeds)]
            if not len(maybe):
                continue
            # Each seed of a document once, with every item that holds it.
            order = np.lexsort((window[maybe], rows[maybe]))
            row, seed = rows[maybe][order], window[maybe][order]
            fresh = np.concatenate([[True], (np.diff(row) != 0) | (seed[1:] != seed[:-1])])
            row, seed = row[fresh], seed[fresh]
            left, count = np.searchsorted(seeds, seed, "left"), np.searchsorted(seeds, seed, "right")
            count = count - left
            which = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            pairs = np.unique(np.stack([np.repeat(row, count), item[which]], axis=1), axis=0)
            for r, i in pairs.tolist():
                a, b = first[r], first[r + 1]
                held = np.isin(window[a : b - k + 1], rolled(index.words[i], k))
                cover = np.zeros(b - a + 1, np.int64)
                at = np.flatnonzero(held)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + k, -1)
                free = np.cumsum(cover)[:-1] > 0
                if free.sum() < p.coverage * index.lengths[i]:  # tiles cover no more than that
                    continue
                got = tiles(hashes[a:b], free, index.words[i], k)
                if got:
                    out.append((lo + r, i, sum(t[2] for t in got), len(got), max(t[2] for t in got)))
    return [m for m in out if m[2] >= p.coverage * index.lengths[m[1]]]


def benchmark_blocks(items: DataFrame, p: TilingParams) -> list[DataFrame]:
    """The items in blocks of about ``block_words`` words; an item is never split."""
    words = F.octet_length(F.coalesce("text", F.lit(""))) / 4 + 1
    total = items.agg(F.sum(words)).first()[0] or 0
    n = max(1, int(-(-total // p.block_words)))
    if n == 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def _indexes(items: DataFrame, p: TilingParams):
    for block in benchmark_blocks(items.select("item_id", "text"), p):
        rows = block.toArrow()
        ids, texts = (rows.column(c).to_pylist() for c in (0, 1))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        yield index_of([ids[i] for i in order], texts_of(pa.array([texts[i] for i in order], pa.string()), "unicode"), p.seed_words)


def contaminated(docs: DataFrame, items: DataFrame, p: TilingParams) -> DataFrame:
    """doc_id, item_id, covered_words, item_words, coverage, n_tiles, longest_tile of every contaminated pair."""
    schema = "doc_id long, item_id long, covered_words long, item_words long, coverage double, n_tiles long, longest_tile long"
    found = None
    for index in _indexes(items, p):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            ix = shared.value
            for b in batches:
                got = matches(texts_of(b.column(1), "unicode"), ix, p)
                if got:
                    ids = b.column(0).take(pa.array([m[0] for m in got]))
                    size = [int(ix.lengths[m[1]]) for m in got]
                    columns = [
                        ids, pa.array([ix.ids[m[1]] for m in got], pa.int64()), pa.array([m[2] for m in got], pa.int64()),
                        pa.array(size, pa.int64()), pa.array([m[2] / n for m, n in zip(got, size, strict=True)]),
                        pa.array([m[3] for m in got], pa.int64()), pa.array([m[4] for m in got], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

        part = within(docs.select("doc_id", "text"), run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, p: TilingParams) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    text, left = docs.columns.index("text"), docs
    for index in _indexes(items, p):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        name = free_name(docs, "contaminated")

        def run(batches, shared=shared, name=name):
            for b in batches:
                bad = np.zeros(b.num_rows, bool)
                bad[[m[0] for m in matches(texts_of(b.column(text), "unicode"), shared.value, p)]] = True
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bad)], names=[*b.schema.names, name])

        left = within(left, run, schema_with(docs, name, BooleanType())).filter(~F.col(name)).drop(name)
    return left


@query("op6_decontamination")
def op6_decontamination(spark, folder):
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), TilingParams())
