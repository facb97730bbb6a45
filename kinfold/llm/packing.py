"""Best-fit packing of token sequences by bin completion.

Only the histogram of piece lengths matters for a packing, and it has at most ``capacity``
rows whatever the corpus, so the search runs on it. Around the largest length left, fillings are enumerated in the order of
their waste, by the sums that the other lengths can reach with their counts, and those that another one dominates are left out;
a filling is used as often as the counts allow, or once. A branch whose lower bound, from waste and from large pieces, rules out
fewer sequences than the incumbent is cut; the first incumbent is the best-fit solution. The search ends at the lower
bound of all pieces or after ``max_nodes`` branches, with the best packing so far. What comes out is a list of (filling, times); the pieces of a length are numbered across
the corpus, and a piece's number says in which repetition of which filling it stands.

Defined cases: a null text is empty and gives one piece with the end id alone; null ids are
kept; repeated rows are packed as often as they occur; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.registry import query, table
from kinfold.llm.store import written
from kinfold.llm.text import within
from kinfold.llm.tokens import ids_for


@dataclass
class PackingParams:
    tokenizer: str
    capacity: int = 1024
    end_id: int = 2
    max_nodes: int = 4000
    max_fillings: int = 6  # branches of a node, those of least waste


def default_params() -> PackingParams:
    import public_tokenizers

    return PackingParams(public_tokenizers.path("byte_bpe_50k.json"))


def _fillings(lengths: list[int], counts: dict[int, int], room: int, limit: int) -> list[tuple[int, ...]]:
    """Fillings of ``room`` by least waste, larger pieces first, undominated: at most ``limit`` of them."""
    usable = [n for n in lengths if n <= room and counts[n] > 0]
    full = (1 << (room + 1)) - 1
    reach = [1] * (len(usable) + 1)  # bit s of reach[i]: sum s can be made of usable[i:]
    for i in range(len(usable) - 1, -1, -1):
        n, mask = usable[i], reach[i + 1]
        left, step = min(counts[n], room // n), 1
        while left > 0:
            take = min(step, left)
            mask |= (mask << (n * take)) & full
            left, step = left - take, 2 * step
        reach[i] = mask

    def exact(i: int, rest: int):
        """Ways to make a sum of usable[i:]."""
        if rest == 0:
            yield ()
            return
        while i < len(usable):
            n = usable[i]
            for c in range(min(counts[n], rest // n), 0, -1):
                if reach[i + 1] >> (rest - n * c) & 1:
                    for more in exact(i + 1, rest - n * c):
                        yield (n,) * c + more
            if not reach[i + 1] >> rest & 1:
                return
            i += 1

    out: list[tuple[int, ...]] = []
    looked, sums = 0, reach[0]
    while sums and len(out) < limit and looked < 4 * limit:
        total = sums.bit_length() - 1
        sums ^= 1 << total
        for filling in exact(0, total):
            looked += 1
            if not _dominated(filling, room - total, counts, usable):
                out.append(filling)
            if len(out) >= limit or looked >= 4 * limit:
                break
    return out or [()]


def _dominated(filling: tuple[int, ...], waste: int, counts: dict[int, int], usable: list[int]) -> bool:
    """Whether one larger piece could stand in for one or two of its pieces, or one more piece still fits."""
    if waste and usable and usable[-1] <= waste and any(n <= waste and counts[n] > filling.count(n) for n in reversed(usable)):
        return True
    groups = {*filling, *(a + b for k, a in enumerate(filling) for b in filling[k + 1 :])}
    for total in groups:
        for size in range(total + 1 if total in filling else total, total + waste + 1):
            if counts.get(size, 0) > filling.count(size):
                return True
    return False


def _apply(counts: dict[int, int], bin_: tuple[int, ...]) -> int:
    times = min(counts[n] // bin_.count(n) for n in set(bin_))
    for n in set(bin_):
        counts[n] -= times * bin_.count(n)
    return times


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Around the largest length left, always the largest length that still fits."""
    counts, out = dict(counts), []
    while any(counts.values()):
        lengths = sorted((n for n, c in counts.items() if c), reverse=True)
        bin_, room = [lengths[0]], capacity - lengths[0]
        for n in lengths:
            while n <= room and counts[n] > bin_.count(n):
                bin_.append(n)
                room -= n
        out.append((tuple(bin_), _apply(counts, tuple(bin_))))
    return out


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: for each k, what pieces of at least k must waste beside the large ones."""
    n = np.zeros(capacity + 1, np.int64)
    n[list(counts)] = list(counts.values())
    many, size = np.append(n[::-1].cumsum()[::-1], 0), np.append((n * np.arange(capacity + 1))[::-1].cumsum()[::-1], 0)
    half = capacity // 2 + 1
    k = np.arange(1, half)
    alone = many[capacity - k + 1]
    large, large_size = many[half] - alone, size[half] - size[capacity - k + 1]
    over = size[k] - size[half] - (large * capacity - large_size)
    bounds = alone + large + np.maximum(0, -(-over // capacity))
    return max(-(-int(size[0]) // capacity), int(bounds.max(initial=0)))


def bin_completion(counts: dict[int, int], p: PackingParams) -> list[tuple[tuple[int, ...], int]]:
    """(filling, times) of a packing with as few sequences as the search finds."""
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return []
    least = lower_bound(counts, p.capacity)
    best = best_fit(counts, p.capacity)
    used = sum(t for _, t in best)
    stack: list[tuple[dict[int, int], list, int]] = [(counts, [], 0)]
    nodes = 0
    while stack and used > least and nodes < p.max_nodes:
        left, done, bins = stack.pop()
        if bins + lower_bound(left, p.capacity) >= used:
            continue
        lengths = sorted((n for n, c in left.items() if c), reverse=True)
        if not lengths:
            best, used = done, bins
            continue
        nodes += 1
        head = lengths[0]
        others = dict(left)
        others[head] -= 1
        branches = []
        for filling in _fillings(lengths, others, p.capacity - head, p.max_fillings):
            bin_, after = (head, *filling), dict(left)
            times = _apply(after, bin_)
            branches.append((after, [*done, (bin_, times)], bins + times))
            if times > 1:
                once = dict(left)
                for n in bin_:
                    once[n] -= 1
                branches.append((once, [*done, (bin_, 1)], bins + 1))
        stack += reversed(branches)
    return best


def pieces(docs: DataFrame, p: PackingParams) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, numbered within its task and length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        ids = ids_for(p.tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(p.capacity + 1, np.int64)
        end = np.array([p.end_id], "<u4").tobytes()
        for b in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                raw = ids.whole(text or "") + end
                n = len(raw) // 4
                at = 0
                size = n % p.capacity or p.capacity
                k = 0
                while at < n:
                    doc.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + size)]))
                    at, size, k = at + size, p.capacity, k + 1
            if not doc:
                continue
            lengths = np.array(length)
            order = np.argsort(lengths, kind="stable")
            run_of = lengths[order]
            begin = np.flatnonzero(np.concatenate([[True], run_of[1:] != run_of[:-1]]))
            size = np.diff(np.append(begin, len(order)))
            nth = np.empty(len(order), np.int64)
            nth[order] = np.arange(len(order)) - np.repeat(begin, size) + seen[run_of]
            seen[run_of[begin]] += size
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(lengths),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(order), part, np.int32)), pa.array(nth),
                ],
                names=names,
            )

    return within(docs.select("doc_id", "text"), run, schema)


def packed(docs: DataFrame, p: PackingParams) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = written(pieces(docs, p), "pieces")
    by_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = bin_completion(histogram, p)
    # For each length: pieces from number ``begin`` on stand at ``offset`` of sequences from ``sequence`` on.
    taken: dict[int, int] = {}
    slots: dict[int, list] = {}
    sequence = 0
    for bin_, times in plan:
        at = 0
        for n in bin_:
            slots.setdefault(n, []).append((taken.get(n, 0), sequence, at))
            taken[n] = taken.get(n, 0) + times
            at += n
        sequence += times
    # At most ``capacity`` lengths and a few fillings for each: bounded whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast({n: np.array(v, np.int64).T for n, v in slots.items()})
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(batches):
        for b in batches:
            length, number = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence_id, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                begin, first, at = shared.value[int(n)]
                k = np.searchsorted(begin, number[mine], "right") - 1
                sequence_id[mine] = first[k] + number[mine] - begin[k]
                offset[mine] = at[k]
            columns = [*b.columns[:5], pa.array(sequence_id), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:5], "sequence_id", "offset"])

    numbered = cut.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("number")
    )
    return within(numbered, run, schema)


@query("op9_packing")
def op9_packing(spark, folder):
    return packed(table(spark, folder, "documents"), default_params())
