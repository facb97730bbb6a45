"""Quality: histogram gradient-boosted trees over statistics of the whole text.

The statistics are taken from the bytes of whole Arrow batches; the fitted trees are flat
arrays that are walked level by level for all rows of a batch.

Defined cases: null and empty texts get the statistics of a text without words; null labels
and ids take no part in fitting; without labelled rows every document scores 1, with labels
of one kind that kind's share. Rows are scored one by one, so repeated rows get equal scores.
Extra columns pass through ``keep_good`` untouched and are dropped by ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from kinfold.llm.boosting import TreeParams, Trees, fit_trees
from kinfold.llm.labels import crc_remainder, labelled_sample
from kinfold.llm.registry import query, table
from kinfold.llm.text import Texts, free_name, schema_with, splitmix, texts_of, within, words_of

STATISTICS = [
    "words", "mean_word", "spread_word", "long_words", "repeats", "distinct", "capitals", "small", "digits", "symbols",
    "pipes", "shouts", "stops", "commas", "white", "foreign", "lines", "words_a_line", "equal_lines", "stopped_lines",
]


@dataclass
class QualityParams:
    max_rows: int = 20000  # bound of the labelled sample; only its statistics reach the driver
    cutoff: float = 0.3
    mod: int = 5
    held_out: int = 0
    trees: TreeParams = field(default_factory=TreeParams)


def statistics(texts: Texts) -> np.ndarray:
    """One row of numbers per text."""
    out = np.zeros((texts.rows(), len(STATISTICS)))
    for lo, part in texts.steps():
        out[lo : lo + part.rows()] = _step(part)
    return out


def _step(texts: Texts) -> np.ndarray:
    data, offsets = texts
    n, rows = texts.rows(), texts.row_of()
    size = np.maximum(np.diff(offsets), 1)
    words = words_of(texts)
    count = words.counts(n)
    some = np.maximum(count, 1)
    length = (words.end - words.start).astype(float)
    mean = np.bincount(words.row, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(words.row, length**2, n) / some - mean**2, 0))
    hashes = words.hashes()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    _, first = np.unique(hashes ^ splitmix(words.row.astype(np.uint64) + np.uint64(1)), return_index=True)
    kinds = np.zeros(256, np.int64)  # 0: anything else
    for k, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&<>@^~_=+\\/", "|", "!", ".?;:", ",", " \t\r\v\f"), 1):
        kinds[[ord(c) for c in chars]] = k
    kinds[10], kinds[128:] = 10, 11
    share = np.bincount(rows * 12 + kinds[data], minlength=n * 12).reshape(n, 12) / size[:, None]
    lines = words_of(texts, lambda b: b == 10)
    n_lines = lines.counts(n)
    line_hash = lines.hashes()
    _, first_line = np.unique(line_hash ^ splitmix(lines.row.astype(np.uint64) + np.uint64(1)), return_index=True)
    stopped = np.isin(data[lines.end - 1], np.frombuffer(b".!?:;", np.uint8)) if len(lines.end) else np.zeros(0, bool)
    many = np.maximum(n_lines, 1)
    return np.stack([
        np.log1p(count), mean, spread, np.bincount(words.row, length > 15, n) / some,
        np.bincount(words.row, same, n) / some, np.bincount(words.row[first], minlength=n) / some,
        *(share[:, k] for k in range(1, 10)), share[:, 11], np.log1p(n_lines), count / many,
        1 - np.bincount(lines.row[first_line], minlength=n) / many, np.bincount(lines.row, stopped, n) / many,
    ], axis=1)


def train(docs: DataFrame, labels: DataFrame, p: QualityParams) -> Trees | None:
    """Fit on the statistics of the bounded sample."""
    sample = labelled_sample(docs, labels, "quality", p.max_rows, p.mod, p.held_out)

    def run(batches):
        for b in batches:
            values = statistics(texts_of(b.column(1)))
            rows = pa.array(values.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), rows, b.column(2)], names=["doc_id", "x", "y"])

    rows = within(sample, run, "doc_id long, x array<double>, y int").toPandas().sort_values("doc_id")
    if not len(rows):
        return None
    return fit_trees(np.array(rows["x"].tolist()), rows["y"].to_numpy(float), p.trees)


def _scored(df: DataFrame, model: Trees | None, name: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model and (model.feature, model.cut, model.leaf, model.base))
    text = df.columns.index("text")

    def run(batches):
        trees = shared.value and Trees(*shared.value)
        for b in batches:
            score = trees.score(statistics(texts_of(b.column(text)))) if trees else np.ones(b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*b.schema.names, name])

    return within(df, run, schema_with(df, name, DoubleType()))


def score(docs: DataFrame, model: Trees | None) -> DataFrame:
    """doc_id and score, the probability that label 1 would be given."""
    return _scored(docs.select("doc_id", "text"), model, "score").select("doc_id", "score")


def keep_good(docs: DataFrame, model: Trees | None, cutoff: float = 0.3) -> DataFrame:
    """The documents that score at least ``cutoff``, with all their columns."""
    name = free_name(docs, "quality_score")
    return _scored(docs, model, name).filter(F.col(name) >= cutoff).drop(name)


@query("op1_quality")
def op1_quality(spark, folder):
    p = QualityParams()
    docs = table(spark, folder, "documents")
    model = train(docs, table(spark, folder, "labels"), p)
    return score(docs, model).select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), p.mod) == p.held_out).alias("held_out"),
        "score",
        (F.col("score") >= p.cutoff).cast("int").alias("predicted"),
    )
