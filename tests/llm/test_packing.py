"""Packings are valid, ids are the tokenizer's, small cases are optimal."""

import itertools
import zlib

import numpy as np
import pytest
from fixtures import awkward, awkward_rows, clashing, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm.packing import PackingParams, best_fit, bin_completion, default_params, lower_bound, packed
from kinfold.llm.tokens import ids_for


def fewest(lengths, capacity):
    lengths = sorted(lengths, reverse=True)
    for n in itertools.count(-(-sum(lengths) // capacity)):
        def place(i, bins):
            if i == len(lengths):
                return True
            for room in set(b for b in bins if b >= lengths[i]):
                k = bins.index(room)
                if place(i + 1, bins[:k] + [room - lengths[i]] + bins[k + 1 :]):
                    return True
            return False

        if place(0, [capacity] * n):
            return n


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=11))
def test_bin_completion_is_valid_and_as_good_as_exhaustive_search(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    plan = bin_completion(counts, PackingParams("", capacity=20))
    used = [n for filling, times in plan for n in filling * times]
    assert sorted(used) == sorted(lengths) and all(sum(f) <= 20 for f, _ in plan)
    assert lower_bound(counts, 20) <= sum(t for _, t in plan) == fewest(lengths, 20)
    assert sum(t for _, t in plan) <= sum(t for _, t in best_fit(counts, 20))


def test_many_pieces_come_near_the_lower_bound():
    rng = np.random.default_rng(2)
    counts = {int(n): int(c) for n, c in zip(range(1, 1025), rng.integers(0, 500, 1024), strict=True)}
    plan = bin_completion(counts, PackingParams(""))
    assert lower_bound(counts, 1024) <= sum(t for _, t in plan) <= 1.002 * lower_bound(counts, 1024)


@pytest.mark.parametrize("seed", range(4))
def test_the_search_improves_on_best_fit_where_that_is_not_at_the_bound(seed):
    lengths = np.random.default_rng(seed).integers(200, 701, 600)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    plain, least = sum(t for _, t in best_fit(counts, 1024)), lower_bound(counts, 1024)
    plan = bin_completion(counts, PackingParams(""))
    used = sum(t for _, t in plan)
    assert sorted(n for f, t in plan for n in f * t) == sorted(lengths.tolist()) and all(sum(f) <= 1024 for f, _ in plan)
    assert used < plain or used == least
    print(seed, plain, used, least)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_params().tokenizer)
    t.encode_special_tokens = True
    return t


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 's1é漢\n\t .,  🙂<|endoftext|>"), max_size=40))
def test_ids_are_those_of_the_tokenizers_library(tokenizer, text):
    raw = ids_for(default_params().tokenizer).whole(text)
    assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def loaded():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_params().tokenizer)


PIECES = ["<|endoftext|>", "<|endoftext|", "a", " b", " ", "  ", "\n", "s's", "1é漢", "🙂."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_ids_are_those_of_the_tokenizer_as_loaded(loaded, text):
    raw = ids_for(default_params().tokenizer).whole(text)
    assert np.frombuffer(raw, "<u4").tolist() == loaded.encode(text, add_special_tokens=False).ids


def test_an_added_token_is_one_id():
    raw = ids_for(default_params().tokenizer).whole("a <|endoftext|> b")
    assert np.frombuffer(raw, "<u4").tolist() == [64, 220, 50256, 275]


def test_added_tokens_that_strip_or_normalise_are_left_to_the_library(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(default_params().tokenizer, encoding="utf-8") as f:
        model = json.load(f)
    model["added_tokens"][0] |= {"lstrip": True, "rstrip": True}
    path = str(tmp_path / "tokenizer.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(model, f)
    text = "a  <|endoftext|> b"
    assert np.frombuffer(ids_for(path).whole(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [16, 1024])
def test_awkward_rows(spark, tokenizer, capacity):
    p = PackingParams(default_params().tokenizer, capacity=capacity)
    rows = packed(clashing(awkward(spark)), p).collect()
    want = {}
    for r in awkward_rows():
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        cut = [*range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for k, (a, z) in enumerate(zip([0, *cut[:-1]], cut, strict=True)):
            key = (r[0], k, a, z - a, zlib.crc32(ids[a:z].tobytes()))
            want[key] = want.get(key, 0) + 1
    got = {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
    assert got == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= capacity


def test_empty_table(spark):
    assert packed(empty(spark), default_params()).count() == 0
