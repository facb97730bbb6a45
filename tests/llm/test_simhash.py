"""Golay keys, fingerprints and classes against brute force."""

import numpy as np
import pytest
import xxhash
from fixtures import FOLDER, awkward, awkward_rows, clashing, empty, needs_data, plain
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm import simhash
from kinfold.llm.graph import components


def slow_print(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints):
    label = dict((p, p) for p in prints)

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    unique = sorted(label)
    for i, a in enumerate(unique):
        for b in unique[:i]:
            if (a ^ b).bit_count() <= 4:
                label[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in unique}


def test_golay_code_is_perfect():
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    check, _ = simhash._tables()
    index = simhash.golay_index(words)
    assert max(int(x).bit_count() for x in words ^ (index << 11 | check[index])) <= 3
    codewords = np.arange(4096) << 11 | check
    assert np.bitwise_count(codewords[1:]).min() == 7 and (simhash.golay_index(codewords) == np.arange(4096)).all()


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_fingerprints_up_to_four_bits_apart_share_a_key(print_, flips):
    other = print_
    for b in flips:
        other ^= 1 << b
    place, keys = simhash.keys_of(np.array([print_, other], np.uint64))
    assert set(keys[place == 0].tolist()) & set(keys[place == 1].tolist())


@pytest.mark.parametrize("text", [r[1] for r in awkward_rows() if r[0] != 8])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_print(text)


def check_groups(df, rows):
    roots = slow_classes([slow_print(t) for _, t in rows])
    smallest = {}
    for i, t in rows:
        root = roots[slow_print(t)]
        smallest[root] = min([x for x in (i, smallest.get(root)) if x is not None], default=None)
    want = [(i, slow_print(t), smallest[roots[slow_print(t)]]) for i, t in rows]
    got = [(r["doc_id"], r["print"] % 2**64, r["component_id"]) for r in df.collect()]
    assert plain(got) == plain(want)
    return want


def test_awkward_rows_and_empty_table(spark):
    rows = [(r[0], r[1]) for r in awkward_rows() if r[0] != 8]
    docs = clashing(awkward(spark).filter("doc_id is null or doc_id <> 8"))
    want = check_groups(simhash.groups(docs), rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert plain((r.doc_id,) for r in kept.collect()) == plain({(c,) for _, _, c in want})
    assert simhash.groups(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def test_a_group_without_ids_keeps_one_row(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (1, "f g h i j")], "doc_id long, text string")
    assert simhash.keep_one(docs).count() == 2


@needs_data
def test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check_groups(simhash.groups(docs), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("block", [16, 2048])
def test_large_buckets_are_cut_into_pairs_of_blocks(spark, block):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 6).astype(np.uint64)
    prints = set(base.tolist())
    for _ in range(500):
        p = int(base[rng.integers(6)])
        for b in rng.integers(0, 64, rng.integers(0, 9)):
            p ^= 1 << int(b)
        prints.add(p)
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print long")
    got = {r["print"] % 2**64: r["root"] for r in simhash.linked(frame, block).collect()}
    want = slow_classes(prints)
    classes = {}
    for p in prints:
        classes.setdefault(want[p], set()).add(got.get(p, p - 2**64 if p >= 2**63 else p))
    assert all(len(v) == 1 for v in classes.values())
    assert len({next(iter(v)) for v in classes.values()}) == len(classes)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)} | {201: 200}
