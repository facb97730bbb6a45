"""Tiles against a plain greedy search, and decisions on reordered passages."""

import pyarrow as pa
import pytest
from fixtures import SENTENCE, awkward, clashing, empty, plain
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm import tiling
from kinfold.llm.text import texts_of
from kinfold.llm.tiling import TilingParams, contaminated, drop_contaminated, index_of, matches

ITEMS = [(1, SENTENCE), (2, "q w e"), (3, None), (None, "aa bb cc dd ee ff gg hh ii jj"), (5, "..."), (6, "")]


def slow_tiles(doc, item, k):
    marked_d, marked_i, covered = set(), set(), 0
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in marked_d and j + n not in marked_i:
                    n += 1
                if n >= k and (best is None or n > best[0]):
                    best = (n, j, i)
        if best is None:
            return covered
        n, j, i = best
        covered += n
        marked_d.update(range(i, i + n))
        marked_i.update(range(j, j + n))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), min_size=1, max_size=16))
def test_covered_words_equal_plain_greedy_tiling(doc, item):
    index = index_of([1], texts_of(pa.array([" ".join(item)]), "unicode"), 3)
    got = matches(texts_of(pa.array([" ".join(doc)]), "unicode"), index, TilingParams(seed_words=3, coverage=0.0))
    assert (got[0][2] if got else 0) == slow_tiles(doc, item, min(3, len(item)))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_reordered_wrapped_and_recased_passages(spark, items):
    w = SENTENCE.split()
    docs = spark.createDataFrame(
        [
            (1, "lead in. " + " ".join(w[10:] + ["filler"] + w[:10]).upper() + "! tail"), (2, " ".join(w[:6])), (3, "x Q, w (E) y"),
            (4, "-".join(w)), (5, "nothing of it"), (6, "aa bb cc dd ee zz ff gg hh ii jj"),
        ],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id): (r.coverage, r.n_tiles) for r in contaminated(docs, items, TilingParams()).collect()}
    assert got == {(1, 1): (1.0, 2), (3, 2): (1.0, 1), (4, 1): (1.0, 1), (6, None): (1.0, 2)}
    assert plain((r.doc_id,) for r in drop_contaminated(docs, items, TilingParams()).collect()) == [(2,), (5,)]


def test_blocks_of_the_benchmark_change_nothing(spark, items):
    docs = awkward(spark)
    whole, blocks = TilingParams(), TilingParams(block_words=4)
    assert len(tiling.benchmark_blocks(items, blocks)) > 3
    assert plain(contaminated(docs, items, whole).collect()) == plain(contaminated(docs, items, blocks).collect())
    assert drop_contaminated(docs, items, blocks).count() == drop_contaminated(docs, items, whole).count()


def test_awkward_rows_and_empty_tables(spark, items):
    docs = clashing(awkward(spark))
    left = drop_contaminated(docs, items, TilingParams())
    assert left.columns == docs.columns and left.count() == docs.count() - 3  # 1, 2 and 3; 12 is in another order word by word
    assert plain((r.doc_id, r.item_id) for r in contaminated(docs, items, TilingParams()).collect()) == [(1, 1), (2, 1), (3, 1)]
    assert contaminated(empty(spark), items, TilingParams()).count() == 0
    assert contaminated(docs, items.limit(0), TilingParams()).count() == 0
    assert drop_contaminated(docs, items.limit(0), TilingParams()).count() == docs.count()


def test_repetitive_texts_cost_their_words():
    """A text of one word against an item of one word, and periods against periods."""
    index = index_of([1, 2], texts_of(pa.array(["na " * 1000, "a b c d e f g " * 100])), 5)
    got = matches(texts_of(pa.array(["na " * 200_000, "b c d e f g a " * 20_000])), index, TilingParams())
    assert [(m[0], m[1], m[2], m[3]) for m in got] == [(0, 0, 1000, 1), (1, 1, 700, 1)]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3), st.integers(0, 25), st.integers(1, 4), st.integers(1, 16))
def test_periods_equal_plain_greedy_tiling(p, n, q, m):
    doc, item = ["abc"[i % p] for i in range(n)], ["abcd"[i % q] for i in range(m)]
    index = index_of([1], texts_of(pa.array([" ".join(item)]), "unicode"), 3)
    got = matches(texts_of(pa.array([" ".join(doc)]), "unicode"), index, TilingParams(seed_words=3, coverage=0.0))
    assert (got[0][2] if got else 0) == slow_tiles(doc, item, min(3, len(item)))


@pytest.mark.parametrize(("text", "found"), [
    ("\u201cone two\u201d three\u2014four, five six \u00abseven\u00bb eight nine\u00a0ten", True), ("One Two Three Four Five SIX seven eight nine ten", True),
    ("one two three uno four five six siete eight nine", False), ("\u4ed6\u8bf4\u8fd9\u662f\u4e00\u4e2a\u5f88\u957f\u7684\u53e5\u5b50\u3002\u540e\u9762", True),
])
def test_typographic_and_unspaced_passages(text, found):
    items = ["one two three four five six seven eight nine ten", "\u8fd9\u662f\u4e00\u4e2a\u5f88\u957f\u7684\u53e5\u5b50"]
    index = index_of([1, 2], texts_of(pa.array(items), "unicode"), 5)
    got = matches(texts_of(pa.array([text]), "unicode"), index, TilingParams())
    assert bool(got) == found and all(m[2] == index.lengths[m[1]] for m in got)


def test_large_ids_beside_null_ones_stay_exact(spark):
    big = 9007199254740993
    items = spark.createDataFrame([(big, SENTENCE), (None, "q w e r t")], "item_id long, text string")
    docs = spark.createDataFrame([(big + 2, SENTENCE)], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in contaminated(docs, items, TilingParams()).collect()] == [(big + 2, big)]
