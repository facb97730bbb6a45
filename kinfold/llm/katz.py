"""Language-model scoring: Katz backoff of any order, Good-Turing discounted, exactly normalised.

    P(w | h) = d(c) c(h w) / (c(h) + 1)      where h w was seen in training
             = a(h) P(w | h')                elsewhere; h' is h without its first word
    P(w)     = d(c) c(w) / N for known words, the mass left by discounting for the unknown word

d is Katz's Good-Turing discount of the order for counts up to 5; a(h) shares out exactly the mass that the seen
continuations of h leave, over the words not seen after h. The 1 in the denominator keeps that mass above zero when
all counts of a history are large. A text begins after one begin mark and ends with one end token; at its beginning histories
are as long as the text allows. Histories that training never saw leave the word to the shorter history.

How it runs. A vocabulary or a table of n-grams may be as large as the corpus, so nothing is broadcast:
1. Texts become token tables of bounded chunks (local word numbers, distinct word hashes).
2. Chunks send their distinct words to word shards, which count them and answer with count and number.
3. Order by order, chunks send their distinct n-grams (number of the history, number of the word, times in training, probability
   by the shorter history) to shards by history. A shard counts them and answers each chunk with the count and number of its n-grams
   and, where one was never seen, with the sums that a(h) needs. An n-gram is one entry per chunk, however often it occurs.
4. A history with more tokens than half a shard is split by its next word. Its sums are added up in a table and joined to
   the chunks that ask for them.
5. Chunks evaluate their own tokens, order by order, from the answers.
Packed arrays are shuffled instead of rows, so an entry costs a few bytes. Every step writes a table in the shared folder.
The driver sees one row of totals per order.

Defined cases: null texts are empty (one end token); null ids count as empty text in the fold;
repeated rows are learned and scored as often as they occur; an empty table gives an empty
result; extra columns are ignored. Without training rows all tokens are the unknown word.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.labels import crc_remainder
from kinfold.llm.registry import query, table
from kinfold.llm.ship import ship
from kinfold.llm.store import written
from kinfold.llm.text import Texts, doc_hash, splitmix, texts_of, within, words_of

#: Counts up to this one are discounted (Katz).
K = 5
#: Hash of the end token, and the number that stands for the begin mark.
END, BEGIN = np.uint64(0), np.int64((1 << 40) - 1)


@dataclass
class KatzParams:
    order: int = 2  # words of the longest n-gram
    mod: int = 7
    held_out: int = 2
    chunk_bytes: int = 6 << 20
    shard_words: int = 1 << 20  # distinct words of chunks that meet in a word shard
    shard_grams: int = 3 << 19  # tokens whose n-grams meet in a history shard


def pack(a: np.ndarray) -> bytes:
    """Planes of bytes, compressed: unused high bytes cost nothing."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(raw: bytes, kind) -> np.ndarray:
    planes = zstandard.ZstdDecompressor().decompress(raw)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def discounts(n: np.ndarray) -> np.ndarray:
    """d(0..K) from the numbers n[r] of types with count r = 1..K+1 (n[0] unused); d(0) is 1.

    Where the numbers are too few for Good-Turing (a d outside (0, 1]), (r - 1/2) / r stands in.
    """
    d = np.ones(K + 1)
    r = np.arange(1, K + 1)
    plain = (r - 0.5) / r
    with np.errstate(all="ignore"):
        cut = (K + 1) * n[K + 1] / n[1] if n[1] else np.inf
        turing = ((r + 1) * n[2 : K + 2] / (n[1 : K + 1] * r) - cut) / (1 - cut)
    good = np.isfinite(turing) & (turing > 0) & (turing <= 1)
    d[1:] = np.where(good, turing, plain)
    return d


@dataclass
class Words:
    """Counts of the training tokens, and P(w) by the count of the word."""

    total: int
    kinds: int
    discount: np.ndarray
    unknown: float
    scale: float

    @staticmethod
    def of(total: int, kinds: int, n: np.ndarray) -> Words:
        if not total:
            return Words(0, 0, np.ones(K + 1), 1.0, 1.0)
        d = discounts(n)
        lost = sum((1 - d[r]) * r * n[r] for r in range(1, K + 1)) / total
        unknown = max(float(lost), 1.0 / (total + 1))
        return Words(int(total), int(kinds), d, unknown, (1 - unknown) / (1 - float(lost)))

    def p(self, c: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.full(len(c), self.unknown)
        return np.where(c > 0, self.scale * self.discount[np.where(c <= K, c, 0)] * c / self.total, self.unknown)


# 1. Tokens ------------------------------------------------------------------------------

TOKENS = "chunk long, ids array<long>, train binary, lengths binary, words binary, counts binary, tokens binary, n_words long, n_tokens long, n_train long"


def _chunk(number: int, ids: list, train: np.ndarray, texts: Texts) -> pa.RecordBatch:
    hashes, lengths, row = [], np.zeros(texts.rows(), np.int64), []
    for lo, part in texts.steps():
        w = words_of(part)
        h = w.hashes()
        h[h == END] = 1
        hashes.append(h)
        row.append(w.row + lo)
        lengths[lo : lo + part.rows()] = w.counts(part.rows())
    hashes, row = np.concatenate(hashes), np.concatenate(row)
    lengths += 1
    tokens = np.full(int(lengths.sum()), END, np.uint64)
    tokens[np.arange(len(hashes)) + row] = hashes  # every earlier document put one end token before
    words, local = np.unique(tokens, return_inverse=True)
    learned = np.repeat(train, lengths)
    counts = np.bincount(local[learned], minlength=len(words))
    steps = np.diff(words, prepend=np.uint64(0))
    values = [
        [number], [ids], [pack(train.astype(np.uint8))], [pack(lengths.astype(np.uint32))], [pack(steps)],
        [pack(counts.astype(np.uint32))], [pack(local.astype(np.uint32))], [len(words)], [len(tokens)], [int(learned.sum())],
    ]
    names = [x.split()[0] for x in TOKENS.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5, pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)


def tokenised(docs: DataFrame, p: KatzParams) -> DataFrame:
    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def close():
            columns = [pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1)]
            train = doc_hash(columns[0]) % p.mod != p.held_out
            return _chunk((part << 20) + n, columns[0].to_pylist(), train, texts_of(columns[1], "ascii"))

        for b in batches:
            ends = texts_of(b.column(1)).offsets
            at = 0
            while at < b.num_rows:
                to = int(np.searchsorted(ends, ends[at] + p.chunk_bytes - size, "right")) - 1
                to = min(b.num_rows, max(to, at + (not held)))
                if to > at:
                    held.append(b.slice(at, to - at))
                    size += int(ends[to] - ends[at])
                if to < b.num_rows or size >= p.chunk_bytes:
                    yield close()
                    held, size, n = [], 0, n + 1
                at = to
        if held:
            yield close()

    return within(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, TOKENS)


# 2. Words -------------------------------------------------------------------------------


def _ask(shards: int):
    shift = np.uint64(64 - (shards - 1).bit_length()) if shards > 1 else None

    def run(batches):
        for b in batches:
            for chunk, words, counts in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                words, counts = np.cumsum(unpack(words, np.uint64), dtype=np.uint64), unpack(counts, np.uint32)
                shard = (words >> shift).astype(np.int64) if shift is not None else np.zeros(len(words), np.int64)
                edge = np.searchsorted(shard, np.arange(shards + 1))
                out = [
                    (s, chunk, pack(np.diff(words[a:z], prepend=np.uint64(0))), pack(counts[a:z]))
                    for s, (a, z) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))
                    if z > a
                ]
                s, c, w, n = (list(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s, pa.int32()), pa.array(c, pa.int64()), pa.array(w, pa.binary()), pa.array(n, pa.binary())],
                    names=["shard", "chunk", "words", "counts"],
                )

    return run


#: ``counts`` and ``numbers`` are aligned with what the chunk sent. ``back_*`` hold the sums of a(h) for histories of unseen n-grams,
#: ``hot`` those histories whose sums lie in several shards, ``split`` this shard's part of such sums.
ANSWER = (
    "level int, shard int, chunk long, counts binary, numbers binary, back_at binary, back_n binary, back_p binary, hot array<long>, "
    "total long, kinds long, n array<long>, split array<struct<h:long,s:array<double>>>"
)
ANSWER_KINDS = pa.schema([
    ("level", pa.int32()), ("shard", pa.int32()), ("chunk", pa.int64()), ("counts", pa.binary()), ("numbers", pa.binary()),
    ("back_at", pa.binary()), ("back_n", pa.binary()), ("back_p", pa.binary()), ("hot", pa.list_(pa.int64())),
    ("total", pa.int64()), ("kinds", pa.int64()), ("n", pa.list_(pa.int64())),
    ("split", pa.list_(pa.struct([("h", pa.int64()), ("s", pa.list_(pa.float64()))]))),
])
#: What a chunk reads of its answers; rows with ``h`` carry the added-up sums of one split history.
REPLY = ["level", "shard", "chunk", "counts", "numbers", "back_at", "back_n", "back_p"]


def _count_words(shards: int):
    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        chunks = rows.column("chunk").to_pylist()
        words = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in rows.column("words").to_pylist()]
        counts = np.concatenate([unpack(x, np.uint32) for x in rows.column("counts").to_pylist()])
        kinds, where = np.unique(np.concatenate(words), return_inverse=True)
        count = np.bincount(where, counts, len(kinds)).astype(np.int64)
        out = [
            {"level": 1, "shard": shard, "chunk": chunk, "counts": pack(count[w]), "numbers": pack(w.astype(np.int64) * shards + shard)}
            for chunk, w in zip(chunks, np.split(where, np.cumsum([len(w) for w in words])[:-1]), strict=True)
        ]
        n = np.bincount(count[count <= K + 1], minlength=K + 2)
        out.append({"level": 1, "shard": shard, "total": int(count.sum()), "kinds": int((count > 0).sum()), "n": n.tolist()})
        return pa.Table.from_pylist(out, ANSWER_KINDS)

    return run


# 3. Chunks ------------------------------------------------------------------------------


@dataclass
class Model:
    """What all tasks know: totals of the words, texts in training, shards, and the discounts of the orders counted so far."""

    words: Words
    begins: int
    shards: int
    hot: int
    discounts: list[np.ndarray]  # of order 2 and up


class Chunk:
    """The tokens of one chunk with their histories of the current order and P by the order below."""

    def __init__(self, row: dict, answers: pa.Table, model: Model):
        self.model = model
        self.lengths = unpack(row["lengths"], np.uint32).astype(np.int64)
        self.tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        self.learned = np.repeat(unpack(row["train"], np.uint8), self.lengths)
        self.replies, self.sums = {}, {}
        for a in answers.to_pylist():
            if a["h"] is None:
                self.replies.setdefault(a["level"], []).append(a)
            else:
                self.sums[a["level"], a["h"]] = a["s"]
        count, number = self._joined(1, "counts"), self._joined(1, "numbers")
        self.kinds = len(count)
        self.count, self.number = count[self.tokens], number[self.tokens]
        self.p = model.words.p(self.count)
        self._histories(self.tokens, self.number, self.count, (self.kinds, BEGIN, model.begins))
        for level in range(2, 2 + len(model.discounts)):
            self._entries()
            self._evaluate(level)
        self._entries()

    def _joined(self, level: int, column: str) -> np.ndarray:
        rows = sorted(self.replies.get(level, []), key=lambda a: a["shard"])
        return np.concatenate([np.zeros(0, np.int64), *[unpack(a[column], np.int64) for a in rows if a[column] is not None]])

    def _histories(self, local: np.ndarray, number: np.ndarray, count: np.ndarray, at_begin: tuple):
        """The n-gram that ends before a token is its history: local and global number, count in training."""
        begin = np.cumsum(self.lengths) - self.lengths
        out = []
        for a, first in zip((local, number, count), at_begin, strict=True):
            b = np.empty_like(a)
            b[1:] = a[:-1]
            b[begin] = first
            out.append(b)
        self.h_local, self.h, self.hc = out

    def _entries(self):
        """Distinct n-grams with a known history, ordered by shard, history and word."""
        self.at = np.flatnonzero(self.hc > 0)
        _, first, self.where = np.unique(self.h_local[self.at] * self.kinds + self.tokens[self.at], return_index=True, return_inverse=True)
        self.times = np.bincount(self.where, self.learned[self.at], len(first)).astype(np.int64)
        e = self.at[first]
        shards = np.uint64(self.model.shards)
        parts = (-(-self.hc[e] // self.model.hot)).astype(np.uint64)
        h, w = (splitmix(x[e].astype(np.uint64) + np.uint64(1)) for x in (self.h, self.number))
        shard = ((h + (w % parts) * np.uint64(0x9E3779B97F4A7C15)) % shards).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        self.e, self.shard, self.times = e[by], shard[by], self.times[by]
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.where = rank[self.where]
        h = self.h[self.e]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (self.shard[1:] != self.shard[:-1])])[: len(h)]
        self.asked = np.cumsum(new) - 1  # number of the asked (shard, history)
        self.begins_history = np.flatnonzero(new)

    def sent(self, chunk: int, level: int):
        """One row of packed entries per shard."""
        e, n = self.e, self.times
        edge = np.flatnonzero(np.concatenate([[True], self.shard[1:] != self.shard[:-1]])[: len(e)])
        lower = np.where(n > 0, self.count[e], 0) if level == 2 else np.where(n > 0, self.p[e], 0.0)
        for a, z in zip(edge.tolist(), np.append(edge[1:], len(e)).tolist() if len(edge) else [], strict=True):
            lo, hi = np.searchsorted(self.begins_history, [a, z])
            new = self.begins_history[lo:hi]
            yield {
                "shard": int(self.shard[a]), "chunk": chunk, "h": pack(self.h[e[new]]), "hc": pack(self.hc[e[new]]),
                "hn": pack(np.diff(np.append(new, z)).astype(np.uint32)), "w": pack(self.number[e[a:z]]),
                "times": pack(n[a:z].astype(np.uint32)), "lower": pack(lower[a:z]),
            }

    def _evaluate(self, level: int):
        """P by this order from its answers; then the n-grams of this order are the histories of the next."""
        d = self.model.discounts[level - 2]
        c, hc = self._joined(level, "counts"), self.hc[self.e]
        kept = np.ones((len(self.begins_history), 2))  # discounted mass and lower-order mass of the seen continuations
        weights = np.append(d[1:] * np.arange(1, K + 1), 1.0)
        of_shard = self.shard[self.begins_history]
        for a in self.replies.get(level, []):
            at = unpack(a["back_at"], np.uint32) + np.searchsorted(of_shard, a["shard"])
            kept[at, 0] = weights @ unpack(a["back_n"], np.int64).reshape(K + 1, -1)
            kept[at, 1] = unpack(a["back_p"], np.float64)
        first = self.e[self.begins_history]
        for i in np.flatnonzero(self.hc[first] > self.model.hot).tolist():
            s = self.sums.get((level, int(self.h[first[i]])))  # absent if all its n-grams here were seen
            if s is not None:
                kept[i] = weights @ np.array(s[: K + 1]), s[K + 1]
        mass = kept[self.asked]
        with np.errstate(divide="ignore", invalid="ignore"):
            back = (1 - mass[:, 0] / (hc + 1.0)) / (1 - mass[:, 1])
        value = np.where(c > 0, d[np.where(c <= K, c, 0)] * c / (hc + 1.0), back * self.p[self.e])
        self.p[self.at] = value[self.where]
        number = self._joined(level, "numbers")
        local, numbers, counts = np.zeros((3, len(self.tokens)), np.int64)
        if len(number):
            local[self.at], numbers[self.at] = self.where, number[self.where]
        counts[self.at] = c[self.where]
        self._histories(local, numbers, counts, (0, 0, 0))


ASK = "shard int, chunk long, h binary, hc binary, hn binary, w binary, times binary, lower binary"
ASK_KINDS = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), *[(k, pa.binary()) for k in ("h", "hc", "hn", "w", "times", "lower")]])


def _ask_grams(level: int, model: Model):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        return pa.Table.from_pylist([x for r in rows for x in Chunk(r, right, model).sent(r["chunk"], level)], ASK_KINDS)

    return run


# 4. Histories ---------------------------------------------------------------------------


def _count_grams(level: int, model: Model, last: bool):
    def run(rows: pa.Table) -> pa.Table:
        parts = rows.to_pylist()
        shard = parts[0]["shard"]

        def joined(column, kind):
            return np.concatenate([unpack(r[column], kind) for r in parts])

        asked, hn, times = joined("h", np.int64), joined("hn", np.uint32), joined("times", np.uint32)
        lower = model.words.p(joined("lower", np.int64)) if level == 2 else joined("lower", np.float64)
        histories, first, of_asked = np.unique(asked, return_index=True, return_inverse=True)
        hc = joined("hc", np.int64)[first]
        asked_of = np.repeat(np.arange(len(asked)), hn)
        key = of_asked[asked_of].astype(np.int64) << 40 | joined("w", np.int64)
        kind, where = np.unique(key, return_inverse=True)
        c = np.bincount(where, times, len(kind)).astype(np.int64)
        low = np.zeros(len(kind))
        low[where[times > 0]] = lower[times > 0]
        h = kind >> 40
        n_h = len(histories)
        sums = np.stack([*[np.bincount(h[c == r], minlength=n_h) for r in range(1, K + 1)], np.bincount(h, np.where(c > K, c, 0), n_h)]).astype(np.int64)
        p_sum = np.bincount(h, low, n_h)
        split = hc > model.hot
        out, z, hz = [], 0, 0
        for r in parts:
            here = unpack(r["hn"], np.uint32)
            a, ha = z, hz
            z, hz = a + int(here.sum()), ha + len(here)
            missing = np.unique(asked_of[a:z][c[where[a:z]] == 0])
            of = of_asked[missing]
            own = ~split[of]
            out.append({
                "level": level, "shard": shard, "chunk": r["chunk"], "counts": pack(c[where[a:z]]),
                "numbers": None if last else pack(where[a:z].astype(np.int64) * model.shards + shard),
                "back_at": pack((missing[own] - ha).astype(np.uint32)), "back_n": pack(sums[:, of[own]].ravel()), "back_p": pack(p_sum[of[own]]),
                "hot": histories[of[~own]].tolist(),
            })
        n = np.bincount(c[(c > 0) & (c <= K + 1)], minlength=K + 2)
        parted = [{"h": int(histories[i]), "s": [*sums[:, i].astype(float).tolist(), float(p_sum[i])]} for i in np.flatnonzero(split).tolist()]
        out.append({"level": level, "shard": shard, "n": n.tolist(), "split": parted})
        return pa.Table.from_pylist(out, ANSWER_KINDS)

    return run


def replies(answers: DataFrame) -> DataFrame:
    """Answers by chunk, and for every chunk the sums of the split histories it asked for."""
    own = answers.filter(F.col("chunk").isNotNull())
    wanted = own.select("level", "chunk", F.explode("hot").alias("h")).distinct()
    parts = answers.filter(F.col("chunk").isNull()).select(F.explode("split").alias("x")).select("x.h", "x.s")
    sums = parts.groupBy("h").agg(F.array(*[F.sum(F.col("s")[i]) for i in range(K + 2)]).alias("s"))
    plain = own.select(*REPLY, F.lit(None).cast("long").alias("h"), F.lit(None).cast("array<double>").alias("s"))
    return plain.unionByName(wanted.join(sums, "h"), allowMissingColumns=True)


# 5. Documents ---------------------------------------------------------------------------

SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _add_up(model: Model):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            x = Chunk(row, right, model)
            doc = np.repeat(np.arange(len(x.lengths)), x.lengths)
            base = np.log10((x.count + 1) / (model.words.total + model.words.kinds + 1))
            out.append(pa.table({
                "doc_id": pa.array(row["ids"], pa.int64()),
                "n_tokens": pa.array(x.lengths),
                "n_known": pa.array(np.bincount(doc, x.count > 0, len(x.lengths)).astype(np.int64)),
                "base_score": pa.array(np.bincount(doc, base, len(x.lengths))),
                "score": pa.array(np.bincount(doc, np.log10(x.p), len(x.lengths))),
            }))
        return pa.concat_tables(out)

    return run


def _counts_of_counts(answers: DataFrame):
    sums = [F.sum(k).alias(k) for k in ("total", "kinds")] + [F.sum(F.col("n")[r]).alias(f"n{r}") for r in range(K + 2)]
    row = answers.filter(F.col("chunk").isNull()).agg(*sums).first()
    return row, np.array([row[f"n{r}"] or 0 for r in range(K + 2)], float)


def scored(docs: DataFrame, p: KatzParams) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    ship(spark)
    tokens = written(tokenised(docs, p), "tokens", "none")
    size = tokens.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    least = min(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    word_shards = 1 << (max(least, (size["words"] or 0) // p.shard_words) - 1).bit_length()
    asked = within(tokens.select("chunk", "words", "counts"), _ask(word_shards), "shard int, chunk long, words binary, counts binary")
    answers = written(asked.groupBy("shard").applyInArrow(_count_words(word_shards), ANSWER), "words", "none")
    row, n = _counts_of_counts(answers)
    ends = docs.select(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("crc"))
    begins = ends.filter(F.col("crc") % p.mod != p.held_out).count()
    shards = max(least, (size["tokens"] or 0) // p.shard_grams)
    hot = max(1, (size["tokens"] or 0) // (2 * shards))
    model = Model(Words.of(row["total"] or 0, row["kinds"] or 0, n), begins, shards, hot, [])
    own = tokens.select("chunk", "ids", "train", "lengths", "tokens")
    heard = replies(answers)
    for level in range(2, p.order + 1):
        sent = own.drop("ids").groupBy("chunk").cogroup(heard.groupBy("chunk")).applyInArrow(_ask_grams(level, model), ASK)
        answers = written(sent.groupBy("shard").applyInArrow(_count_grams(level, model, level == p.order), ANSWER), "grams", "none")
        model = replace(model, discounts=[*model.discounts, discounts(_counts_of_counts(answers)[1])])
        heard = heard.unionByName(replies(answers))
    out = own.groupBy("chunk").cogroup(heard.groupBy("chunk")).applyInArrow(_add_up(model), SCORES)
    return out.withColumn("train_tokens", F.lit(model.words.total).cast("long"))


@query("op4_katz")
def op4_katz(spark, folder):
    p = KatzParams()
    return scored(table(spark, folder, "documents"), p).select(
        "doc_id", (crc_remainder(F.col("doc_id"), p.mod) == p.held_out).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )
