"""Rule statistics against plain Python, and the guarantee of the cutoffs."""

import collections
import math
import random
import re

import pytest
from fixtures import FOLDER, awkward, awkward_rows, clashing, empty, needs_data, plain
from pyspark.sql import functions as F

from kinfold.llm import rules
from kinfold.llm.rules import RuleParams, binomial_upper, calibrate, judged, statistics

P = RuleParams()


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_of_awkward_rows(spark):
    got = judged(statistics(clashing(awkward(spark)), P), {r: {} for r in rules.RULES}, P).collect()
    assert plain((r.doc_id, *(r[c] for c in COLUMNS)) for r in got) == plain((r[0], *slow(r[1])) for r in awkward_rows())
    assert all(r.kept == (not r.base_failed) for r in got)
    assert judged(statistics(empty(spark), P), calibrate(statistics(empty(spark), P), spark.createDataFrame([], "doc_id long, quality int"), P), P).count() == 0


def test_repeats_in_random_texts(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(150)] + ["a b c d e", "x " * 5, "x " * 6, "x " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = {r.doc_id: r.n_repeat_words for r in statistics(docs, P).collect()}
    assert got == {i: slow(t)[4] for i, t in enumerate(texts)}


@needs_data
def test_registered_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = rules.op7_quality_rules(spark, FOLDER).collect()
    assert plain((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows) == plain((i, *slow(t)) for i, t in texts.items())
    assert not any(r.kept and r.base_failed for r in rows)


def test_tails_are_exact_and_take_no_time_on_many_labels():
    import time
    from fractions import Fraction

    for k, n, q in [(0, 10, 0.3), (3, 50, 0.01), (3, 50, 0.5), (49, 50, 0.9), (25, 60, 0.42), (7, 400, 0.002), (1, 2, 1e-9)]:
        exact = sum(math.comb(n, i) * Fraction(q) ** i * (1 - Fraction(q)) ** (n - i) for i in range(k + 1))
        assert rules.binomial_below(k, n, q) == pytest.approx(float(exact), rel=1e-9)
        for error in (0.2, 1e-3, 1e-6):
            assert rules.proven(k, n, q, error) == (k < q * n and binomial_upper(k, n, error) <= q)
    start = time.perf_counter()
    assert rules.proven(49_000, 10_000_000, 0.005, 1e-5) and not rules.proven(49_950, 10_000_000, 0.005, 1e-5)
    assert time.perf_counter() - start < 1


@pytest.mark.parametrize(("k", "n"), [(0, 10), (3, 50), (20, 20), (7, 4000)])
def test_binomial_bound_is_exact(k, n):
    q = binomial_upper(k, n, 0.01)
    if k == n:
        assert q == 1
        return
    tail = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
    assert tail == pytest.approx(0.01, rel=1e-6)


def test_cutoffs_reject_junk_within_the_proven_risk(spark):
    rows = [(i, "word " * 3 + " ".join(f"w{i}x{j}" for j in range(30)) + (" ###" * 200 if i % 10 == 0 else ""), "en") for i in range(3000)]
    docs = spark.createDataFrame([*rows, (9000, " ".join(f"z{j}" for j in range(20)), None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(3000)] + [(None, 1), (7, None)], "doc_id long, quality int")
    stats = statistics(docs, P)
    cutoffs = calibrate(stats, labels, P)
    assert cutoffs["symbols"]["en"] < 2 and not any("" in c for c in cutoffs.values())  # nothing proven for the null stratum
    out = {r.doc_id: r for r in judged(stats, cutoffs, P).collect()}
    assert not any(out[i].kept for i in range(0, 3000, 10))
    assert sum(not out[i].kept for i in range(3000) if i % 10) <= 0.02 * 2700 and out[9000].kept


def test_lower_and_two_sided_rules(spark):
    texts = {
        1: "Plain words make a good sentence here. " * 4, 2: "a b c d e f g h i j k l. " * 4, 3: "incomprehensibilities counterrevolutionaries " * 6,
        4: "12 34 56 78 90 12 34 56 78 91. " * 3, 5: "no end mark on this line\nand none on this one\nor here",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("lang", F.lit("en"))
    cut = {"long_mean": 12.0, "short_mean": 0.5, "other_characters": 0.5, "open_lines": 0.9, "repeats": 9.0}
    cutoffs = {r: {"en": cut[r]} if r in cut else {} for r in rules.RULES}
    got = {r.doc_id: set(r.rejected_by) for r in judged(statistics(df, P), cutoffs, P).collect()}
    assert got == {1: set(), 2: {"short_mean"}, 3: {"long_mean", "open_lines"}, 4: {"other_characters"}, 5: {"open_lines"}}
