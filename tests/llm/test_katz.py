"""The packed shuffles against one dictionary."""

import collections
import functools
import math
import zlib

import numpy as np
import pytest
from fixtures import FOLDER, awkward, awkward_rows, clashing, empty, needs_data

from kinfold.llm import katz
from kinfold.llm.katz import K, KatzParams, discounts, pack, scored, unpack


def brute(rows, p):
    docs = []
    for i, t in rows:
        learned = zlib.crc32(str(i).encode() if i is not None else b"") % p.mod != p.held_out
        docs.append((i, [*(t or "").encode().lower().split(), None], learned))

    def grams(words, k):
        words = ["begin", *words]
        return [tuple(words[i - k + 1 : i + 1]) for i in range(max(1, k - 1), len(words))]

    seen = {k: collections.Counter() for k in range(1, p.order + 1)}
    begins = 0
    for _, words, learned in docs:
        if learned:
            begins += 1
            for k, c in seen.items():
                c.update(grams(words, k))
    total = sum(seen[1].values())

    def by_count(c):
        return np.array([0] + [sum(v == r for v in c.values()) for r in range(1, K + 2)], float)

    d = {k: discounts(by_count(c)) for k, c in seen.items()}
    cut = {k: (lambda c, k=k: (d[k][c] if c <= K else 1) * c) for k in seen}
    lost = sum(c - cut[1](c) for c in seen[1].values()) / total if total else 0
    unknown = max(lost, 1 / (total + 1)) if total else 1.0
    after = collections.defaultdict(list)
    for k in range(2, p.order + 1):
        for g in seen[k]:
            after[g[:-1]].append(g[-1])

    def times(h):
        return begins if h == ("begin",) else seen[len(h)][h]

    @functools.cache
    def back(h):
        if h not in after:
            return 1.0
        kept = sum(cut[len(h) + 1](seen[len(h) + 1][(*h, w)]) for w in after[h]) / (times(h) + 1)
        return (1 - kept) / (1 - sum(prob((*h[1:], w)) for w in after[h]))

    @functools.cache
    def prob(g):
        k, c = len(g), seen[len(g)][g]
        if k == 1:
            return (1 - unknown) / (1 - lost) * cut[1](c) / total if c else unknown
        return cut[k](c) / (times(g[:-1]) + 1) if c else back(g[:-1]) * prob(g[1:])

    out = []
    for i, words, _ in docs:
        full = ["begin", *words]
        base = sum(math.log10((seen[1][w,] + 1) / (total + len(seen[1]) + 1)) for w in words)
        known = sum(seen[1][w,] > 0 for w in words)
        score = sum(math.log10(prob(tuple(full[max(0, j - p.order + 1) : j + 1]))) for j in range(1, len(full)))
        out.append((i, len(words), known, total, base, score))
    # Exactly normalised: over known words and the unknown one.
    for h in list(after)[:10] + list(after)[-10:]:
        assert sum(prob((*h, *g)) for g in seen[1]) + prob((*h, b"never seen")) == pytest.approx(1)
    return out


def same(df, rows, p):
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()]
    want = brute(rows, p)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


@needs_data
@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_brute_force_with_many_shards_and_split_histories(spark, order):
    p = KatzParams(order=order, chunk_bytes=20_000, shard_words=500, shard_grams=2_000)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    same(scored(docs, p), [(r.doc_id, r.text) for r in docs.collect()], p)


@pytest.mark.parametrize("order", [2, 3])
def test_a_frequent_pair_is_one_entry_per_chunk(spark, monkeypatch, order):
    hot_line = "la la la " * 30
    rows = [(i, f"{hot_line} word{i % 17} la word{i % 5} tail") for i in range(200)]
    rows += [(i, "held only la " * 40) for i in range(200, 2000) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    p = KatzParams(order=order, chunk_bytes=4_000, shard_words=500, shard_grams=1_000)
    folder = {}
    kept = katz.written
    monkeypatch.setattr(katz, "written", lambda df, name, *rest: folder.setdefault((name, len(folder)), kept(df, name, *rest)))
    same(scored(docs, p), rows, p)
    answers = [f.filter("chunk is not null").collect() for (name, _), f in folder.items() if name == "grams"]
    assert len(answers) == order - 1
    tokens = sum(r.n_tokens for r in folder["tokens", 0].collect())
    assert all(sum(len(unpack(r["counts"], np.int64)) for r in a) < tokens / 5 for a in answers)
    assert any(r["hot"] for r in answers[0])  # la is split by its next word, and some of its pairs are unseen


@pytest.mark.parametrize("order", [2, 3])
def test_awkward_rows(spark, order):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    same(scored(clashing(awkward(spark)), KatzParams(order=order, chunk_bytes=1000)), rows, KatzParams(order=order))


def test_empty_table_and_no_training_rows(spark):
    assert scored(empty(spark), KatzParams()).count() == 0
    only_held = spark.createDataFrame([(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    same(scored(only_held, KatzParams()), [(r.doc_id, r.text) for r in only_held.collect()], KatzParams())


def test_packed_arrays_come_back():
    for a in (np.array([], np.uint32), np.array([0, 2**32 - 1], np.uint32), np.array([1.5, -2.0])):
        assert (unpack(pack(a), a.dtype) == a).all()


def test_discounts_lie_between_zero_and_one():
    for n in ([0] * 7, [0, 100, 40, 20, 12, 8, 5], [0, 0, 5, 5, 5, 5, 5]):
        d = discounts(np.array(n, float))
        assert (d > 0).all() and (d <= 1).all() and d[0] == 1
    assert katz.K == 5
