"""Words, hashes and stores against plain Python."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm.text import STEP_BYTES, letter_words, not_letters, texts_of, words_of

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\x1cé漢.", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_words_are_those_of_a_split_and_equal_words_have_equal_hashes(texts):
    t = texts_of(pa.array(texts, pa.string()))
    w = words_of(t)
    want = [(i, x) for i, text in enumerate(texts) for x in (text or "").encode().split()]
    got = [(int(r), t.data[a:b].tobytes()) for r, a, b in zip(w.row, w.start, w.end, strict=True)]
    assert got == want
    seen = {}
    for (_, word), h in zip(want, w.hashes().tolist(), strict=True):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    heads = {}
    for (_, word), h in zip(want, w.hashes(2).tolist(), strict=True):
        assert heads.setdefault(word[:2], h) == h


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_steps_give_all_rows_once(texts):
    t = texts_of(pa.array(texts, pa.string()))
    whole = words_of(t, not_letters).hashes().tolist()
    parts, rows = [], 0
    for lo, part in t.steps(16):
        assert lo == rows
        rows += part.rows()
        parts += words_of(part, not_letters).hashes().tolist()
    assert rows == len(texts) and parts == whole


def test_a_text_beyond_a_step_is_read_whole():
    t = texts_of(pa.array(["x " * STEP_BYTES, "y"]), "ascii")
    assert [words_of(p).counts(p.rows()).tolist() for _, p in t.steps()] == [[STEP_BYTES], [1]]


def test_hashes_do_not_depend_on_steps():
    long = "q" * (2 * STEP_BYTES + 3)
    words = ["a", "bc", long, "bc", "d" * (STEP_BYTES - 1), "a", long + "r", long]
    w = words_of(texts_of(pa.array([" ".join(words)])))
    alone = [int(words_of(texts_of(pa.array([x]))).hashes()[0]) for x in words]
    assert w.hashes().tolist() == alone and len(set(alone)) == len(set(words))
    mixed = letter_words(texts_of(pa.array([" ".join(["é", *words, "漢字"])])))
    assert mixed.hashes()[1:-2].tolist() == alone
    assert w.hashes(2).tolist() == [int(words_of(texts_of(pa.array([x[:2]]))).hashes()[0]) for x in words]


def test_slices_and_lower_case():
    column = pa.array(["A", "BÉ c", None, "D"]).slice(1, 3)
    assert texts_of(column, "ascii").data.tobytes().decode() == "bÉ cd"
    assert texts_of(column, "unicode").data.tobytes().decode() == "bé cd"
