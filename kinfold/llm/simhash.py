"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint has 64 bits in segments of 23, 23 and 18. The perfect binary Golay code maps
every 23-bit word to the one codeword within three bits; a word gets as keys the indices
that it and its one-bit neighbours decode to (one or six). Two words at most two bits apart
have a common neighbour, and so a common key.

Fingerprints at most four bits apart share a key of one of these kinds (pigeonhole):
* a segment agrees, and of the other two one differs in two bits or less: the exact segment
  with a Golay index of the other;
* no segment agrees: then two of them differ in exactly one bit each, so that half of each
  agrees, and the third differs in two bits or less: two halves with a Golay index.

Equal keys are joined and every candidate is verified by counting the differing bits.

Only distinct fingerprints take part, so exact copies cost one row. Of a bucket, only one edge
per linked member is emitted, to the smallest member reachable inside the bucket; buckets
above ``block`` members are cut into pairs of blocks, each a group of its own.

Defined cases: null and empty texts have the fingerprint zero and are linked like any other;
a null doc_id has a fingerprint, but component ids are taken from known ids (null if a
component has none). Repeated rows are repeated in the result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from kinfold.llm.graph import components
from kinfold.llm.registry import query, table
from kinfold.llm.store import written
from kinfold.llm.text import free_name, schema_with, within

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: (first bit, bits) of the segments, and how a segment is halved.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Members of a bucket that are compared in one group.
BLOCK = 2048

# Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the generator of the binary Golay code.
GENERATOR = 0b110001110101


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in over half of the hashes of all word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 16):
        part = [digest(joined[a:b], seed) for a, b in zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist(), strict=True)]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(check bits of each 12-bit message, error of each syndrome)."""
    check = np.zeros(4096, np.int64)
    for message in range(4096):
        rest = message << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - 11)
        check[message] = rest
    errors = np.zeros(2048, np.int64)
    single = [1 << i for i in range(23)]
    for i in range(23):
        for j in range(i, 23):
            for k in range(j, 23):
                e = single[i] | single[j] | single[k]
                errors[check[e >> 11] ^ (e & 2047)] = e
    return check, errors


def golay_index(words: np.ndarray) -> np.ndarray:
    """Message of the codeword within three bits of each 23-bit word."""
    check, errors = _tables()
    return (words ^ errors[check[words >> 11] ^ (words & 2047)]) >> 11


def golay_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, index) for the words and their neighbours at one of the low ``bits``."""
    near = np.stack([golay_index(words ^ flip) for flip in [0, *(1 << i for i in range(bits))]], axis=1)
    near.sort(axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    place, column = np.nonzero(new)
    return place, near[place, column]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the fingerprint, key) for every key of every fingerprint (unsigned)."""
    cut = [((prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    near = [golay_keys(cut[s], SEGMENTS[s][1]) for s in range(3)]
    places, keys, kind = [], [], 0
    for y in range(3):
        place, index = near[y]
        others = [s for s in range(3) if s != y]
        for x in others:
            places.append(place)
            keys.append((np.int64(kind) << 48) | (index << 24) | cut[x][place])
            kind += 1
        halves = []
        for s in others:
            low = (SEGMENTS[s][1] + 1) // 2
            halves.append((cut[s] & ((1 << low) - 1), cut[s] >> low))
        for a in (0, 1):
            for b in (0, 1):
                places.append(place)
                keys.append((np.int64(kind) << 48) | (index << 24) | (halves[0][a][place] << 12) | halves[1][b][place])
                kind += 1
    return np.concatenate(places), np.concatenate(keys)


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MAX_BITS


def bucket_edges(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member reachable in the bucket), without the members that reach none smaller.

    prints is one bucket (n) or many of one size (r, n), each sorted upwards.
    """
    many = prints.reshape(-1, prints.shape[-1])
    n = many.shape[1]
    if n <= 64:
        linked = _close(many[:, :, None], many[:, None, :])
        label = np.broadcast_to(np.arange(n), many.shape)
        while True:
            new = np.where(linked, label[:, None, :], n).min(axis=2)
            if (new == label).all():
                break
            label = new
        r, c = np.nonzero(label != np.arange(n))
        return many[r, c], many[r, label[r, c]]
    out_u, out_v = [], []
    for one in many:
        left = np.arange(n)
        while len(left):
            root, front, left = left[0], left[:1], left[1:]
            while len(front) and len(left):
                reached = np.zeros(len(left), bool)
                for at in range(0, len(front), 256):
                    rest = np.flatnonzero(~reached)
                    reached[rest] = _close(one[left[rest]][:, None], one[front[at : at + 256]][None, :]).any(axis=1)
                front, left = left[reached], left[~reached]
                out_u.append(one[front])
                out_v.append(np.full(len(front), one[root]))
    if not out_u:
        return prints[:0].reshape(-1)[:0], prints[:0].reshape(-1)[:0]
    return np.concatenate(out_u), np.concatenate(out_v)


def _runs(keys: np.ndarray, prints: np.ndarray, block: int):
    """Edges and overflow of whole runs of equal keys."""
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(keys)))
    edges, over = [], []
    for n in np.unique(size):
        if n < 2:
            continue
        begin = start[size == n]
        if n > block:
            over += [(keys[b], prints[b : b + n]) for b in begin]
            continue
        step = max(1, (1 << 22) // int(n * n))
        for at in range(0, len(begin), step):
            edges.append(bucket_edges(prints[begin[at : at + step, None] + np.arange(n)]))
    return edges, over


def _link(block: int):
    """Rows (key, print) sorted by key: edges (key null, u, v), or members of large buckets (key, u, null)."""

    def batch(edges, over):
        u = [e[0] for e in edges] + [o[1] for o in over]
        v = [e[1] for e in edges]
        if not u or not sum(map(len, u)):
            return None
        known = np.concatenate([np.ones(sum(map(len, v)), bool), np.zeros(sum(len(o[1]) for o in over), bool)])
        blank = np.zeros((~known).sum(), np.int64)
        v = np.concatenate([np.concatenate([x.view(np.int64) for x in v]) if v else np.zeros(0, np.int64), blank])
        k = np.concatenate([np.zeros(known.sum(), np.int64), *(np.full(len(o[1]), o[0]) for o in over)])
        u = np.concatenate([x.view(np.int64) for x in u])
        return pa.RecordBatch.from_arrays([pa.array(k, mask=known), pa.array(u), pa.array(v, mask=~known)], names=["key", "u", "v"])

    def run(batches):
        held_k, held_p, spilling = np.zeros(0, np.int64), np.zeros(0, np.uint64), False
        for b in batches:
            k = np.concatenate([held_k, b.column(0).to_numpy()])
            p = np.concatenate([held_p, b.column(1).to_numpy().view(np.uint64)])
            if not len(k):
                continue
            whole = int(np.searchsorted(k, k[-1], "left"))
            edges, over = [], []
            if spilling:  # the bucket goes on: its members stream out until it ends
                same = int(np.searchsorted(k, k[0], "right"))
                over.append((k[0], p[:same]))
                if same < len(k):
                    spilling = False
                    e, o = _runs(k[same:whole], p[same:whole], block)
                    edges, over = edges + e, over + o
                    held_k, held_p = k[whole:], p[whole:]
                else:
                    held_k, held_p = k[:0], p[:0]
            else:
                edges, over = _runs(k[:whole], p[:whole], block)
                held_k, held_p = k[whole:], p[whole:]
            if not spilling and len(held_k) > block:
                over.append((held_k[0], held_p))
                spilling, held_k, held_p = True, held_k[:0], held_p[:0]
            out = batch(edges, over)
            if out is not None:
                yield out
        edges, over = _runs(held_k, held_p, block) if not spilling else ([], [(held_k[0], held_p)] if len(held_k) else [])
        out = batch(edges, over)
        if out is not None:
            yield out

    return run


def fingerprints(docs: DataFrame, name: str = "print") -> DataFrame:
    """The frame with the fingerprint of its text as a signed long."""
    text = docs.columns.index("text")

    def run(batches):
        for b in batches:
            prints = np.array([fingerprint(t) for t in b.column(text).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prints)], names=[*b.schema.names, name])

    return within(docs, run, schema_with(docs, name, LongType()))


def linked(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(print, root) of the distinct fingerprints ``print`` that are linked to another one."""

    def spread(batches):
        for b in batches:
            p = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(p), 1 << 13):
                place, key = keys_of(p[at : at + (1 << 13)])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(p[at : at + (1 << 13)][place].view(np.int64))], names=["key", "print"])

    # A fingerprint becomes about a hundred keys, so the few bytes of the input say little about a task's work.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = within(prints.select("print").repartition(tasks, "print"), spread, "key long, print long")
    found = written(
        within(keyed.repartition("key").sortWithinPartitions("key"), _link(block), "key long, u long, v long"), "links"
    )
    large = found.filter(F.col("key").isNotNull()).select("key", F.col("u").alias("print"))
    sizes = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / (block // 2)).cast("int").alias("n"))
    paired = (
        large.join(sizes, "key")
        .withColumn("own", F.pmod(F.xxhash64("print"), F.col("n")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("key", "print", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )

    def compare(group: pa.Table) -> pa.Table:
        p = np.sort(group.column("print").to_numpy().view(np.uint64))
        u, v = bucket_edges(p)
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    more = paired.groupBy("key", "i", "j").applyInArrow(compare, "u long, v long")
    edges = found.filter(F.col("key").isNull()).select("u", "v").unionByName(more)
    return components(edges).select(F.col("node").alias("print"), "root")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, print and component_id per row: the smallest doc_id that is reachable over links."""
    marked = written(fingerprints(docs.select("doc_id", "text")).select("doc_id", "print"), "prints")
    distinct = marked.groupBy("print").agg(F.min("doc_id").alias("first"))
    rooted = distinct.join(linked(distinct), "print", "left").withColumn("root", F.coalesce("root", "print"))
    # One row per fingerprint takes part in what follows, however many copies it has.
    # Written, so that the join that follows has two plain inputs and a large component can be split.
    smallest = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    named = rooted.select("print", "root").join(smallest, "root").select("print", "component_id")
    return marked.join(named, "print")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group: that with the smallest doc_id; among rows that repeat it, any one.

    A group without known ids keeps one row as well.
    """
    name, comp, rows = (free_name(docs, n) for n in ("kept_print", "kept_component", "kept_rows"))
    member = groups(docs)
    winners = (
        member.filter(F.col("component_id").isNotNull())
        .groupBy(F.col("component_id").alias(comp))
        .agg(F.count(F.when(F.col("doc_id") == F.col("component_id"), 1)).alias(rows))
    )
    known = docs.join(winners, F.col("doc_id") == F.col(comp)).drop(comp)
    once = known.filter(F.col(rows) == 1).drop(rows)
    again = known.filter(F.col(rows) > 1).dropDuplicates(["doc_id"]).drop(rows)
    nameless = fingerprints(docs.filter(F.col("doc_id").isNull()), name)
    alone = member.filter(F.col("component_id").isNull()).select(F.col("print").alias(name)).distinct()
    return once.unionByName(again).unionByName(nameless.join(alone, name, "left_semi").dropDuplicates([name]).drop(name))


@query("op8_simhash")
def op8_simhash(spark, folder):
    member = groups(table(spark, folder, "documents"))
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0")
    return member.select("doc_id", hexed.alias("fingerprint"), "component_id")
