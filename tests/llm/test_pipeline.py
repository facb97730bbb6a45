"""The stages one by one on their own input, and the whole run."""

import re

import numpy as np
import pytest
from fixtures import awkward, clashing, empty, plain

import corpus_pipeline
from kinfold.llm import simhash, tiling, toxicity

FOLDER = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").limit(400).cache()


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_and_empty_input(spark, name):
    stage = STAGES[name]
    rows = clashing(awkward(spark))
    out = stage(spark, rows, FOLDER)
    assert stage(spark, empty(spark), FOLDER).count() == 0
    if name != "packing":
        assert out.columns == rows.columns and 0 < out.count() <= rows.count()


def test_near_copies_stage(spark, docs):
    left = STAGES["near_copies"](spark, docs, FOLDER).collect()
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in docs.collect()}
    kept = np.array([prints[r.doc_id] for r in left], np.uint64)
    for i, p in enumerate(kept):
        assert (np.bitwise_count(kept[i + 1 :] ^ p) > 4).all()  # no two that stay are linked
    # Groups by links; the smallest id of each stays, and nothing else.
    ids = sorted(prints)
    group = {i: i for i in ids}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                low, high = sorted((top(i), top(j)))
                group[high] = low
    assert {r.doc_id for r in left} == {top(i) for i in ids}


def test_benchmark_stage(spark, docs):
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    has = {r.doc_id: any(f" {i} " in f" {' '.join(re.findall(r'\w+', r.text.lower()))} " for i in items) for r in docs.collect()}
    left = {r.doc_id for r in STAGES["benchmark"](spark, docs, FOLDER).collect()}
    assert left == {i for i, bad in has.items() if not bad}
    assert tiling.TilingParams().coverage <= 0.5


def test_toxicity_and_quality_stages_follow_the_labels(spark, docs):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    known = [r.doc_id for r in docs.collect() if r.doc_id in labels]
    left = {r.doc_id for r in STAGES["toxicity"](spark, docs, FOLDER).collect()}
    assert np.mean([(i in left) == (labels[i].toxic == 0) for i in known]) > 0.93
    left = {r.doc_id for r in STAGES["quality"](spark, docs, FOLDER).collect()}
    assert np.mean([(i in left) == (labels[i].quality == 1) for i in known]) > 0.97


def test_run_equals_the_stages_in_turn(spark):
    whole = corpus_pipeline.run(spark, FOLDER)
    by_hand = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        by_hand = stage(spark, by_hand, FOLDER)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert plain(whole.select(columns).collect()) == plain(by_hand.select(columns).collect())
    assert toxicity.ToxicityParams().cutoff == 0.3
