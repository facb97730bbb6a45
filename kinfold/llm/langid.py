"""Language ID with bit-sliced Bloom filters of character n-grams.

One filter holds all languages: every slot is a bit mask with one bit per language. Adding an
n-gram of a language sets its bit in ``hashes`` slots; the bitwise AND of an n-gram's slots
gives all languages that contain it at once. A text is decided by how many of its n-grams each
language contains, after the number that false positives would give is taken off.

Filters hold the n-grams whose share of a language's n-grams is at least ``min_share``. Rarer ones are mostly foreign words
and slips: on held-out texts of one to ten words, filters of every n-gram seen decide worse (see the tests). There are at most 1 / min_share of them per language and length, whatever the corpus, which bounds both
what reaches the driver and the filter. Shares come from all training documents; n-grams are
counted within tasks before they are shuffled.

Defined cases: a null text or one without letters is ``und`` with score 0; null languages and
ids: a null language is not learned from, a null id counts as empty text in the fold; without training rows
every text is ``und``. Repeated rows count and are answered as often as they occur. Extra columns are ignored.
Ties go to the language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.labels import crc_remainder
from kinfold.llm.registry import query, table
from kinfold.llm.store import written
from kinfold.llm.text import splitmix, within


@dataclass
class LanguageParams:
    orders: tuple[int, ...] = (2, 3, 4)
    min_share: float = 1e-4
    bits: int = 20  # slots of the filter: 2 ** bits
    hashes: int = 3
    mod: int = 4
    held_out: int = 2
    step_chars: int = 1 << 20


@dataclass
class LanguageModel:
    """masks[w] holds languages 64 w to 64 w + 63 as bits of every slot."""

    languages: list[str]
    masks: np.ndarray  # (words, slots) uint64
    false_rate: np.ndarray  # per language


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by one space, and the text of each."""
    joined = " ".join([t or "" for t in texts]) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    return points, np.repeat(np.arange(len(texts)), sizes)


def grams(texts: list[str | None], p: LanguageParams):
    """(order, hash, text) of all n-grams of lower-cased letters; a run of other characters is one blank."""
    lowered = [(t or "").lower() for t in texts]
    points, row = _code_points(lowered)
    ascii_ = (points >= 97) & (points <= 122)
    letter = ascii_.copy()
    wide = np.flatnonzero(points >= 128)
    if len(wide):
        kinds, where = np.unique(points[wide], return_inverse=True)
        letter[wide] = np.array([chr(c).isalpha() for c in kinds.tolist()])[where]
    blank = ~letter
    keep = letter | np.concatenate([[True], letter[:-1]])  # the first of a run of blanks stays
    points, row, blank = np.where(blank, 32, points)[keep], row[keep], blank[keep]
    codes = splitmix(points.astype(np.uint64))
    for n in p.orders:
        if len(codes) < n:
            continue
        size = len(codes) - n + 1
        total = np.zeros(size, np.uint64)
        for j in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + size]
        inner = np.zeros(size, bool)
        for j in range(1, n - 1):
            inner |= blank[j : j + size]
        ok = ~inner & (row[:size] == row[n - 1 :]) & ~(blank[:size] & blank[n - 1 :])
        yield n, splitmix(total[ok] + np.uint64(n)), row[:size][ok]


def _steps(texts: list[str | None], limit: int):
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= limit):
            size += len(texts[end] or "")
            end += 1
        yield at, texts[at:end]
        at = end


def _slots(hashes: np.ndarray, p: LanguageParams) -> list[np.ndarray]:
    mask = np.uint64((1 << p.bits) - 1)
    return [((hashes >> np.uint64(21 * k)) & mask).astype(np.int64) for k in range(p.hashes)]


def train(docs: DataFrame, p: LanguageParams) -> LanguageModel | None:
    """Count n-grams by language, keep the frequent ones, and set their bits."""

    def run(batches):
        # Counts of a task, folded whenever they grow: rows out are distinct n-grams per task.
        held: dict[tuple[str, int], list] = {}

        def fold(parts):
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return [(keys, np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64))]

        for b in batches:
            langs = np.array(b.column(1).to_pylist(), object)
            texts = b.column(0).to_pylist()
            for lang in sorted(set(langs)):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for _, part in _steps(own, p.step_chars):
                    for n, hashes, _ in grams(part, p):
                        keys, counts = np.unique(hashes, return_counts=True)
                        parts = held.setdefault((lang, n), [])
                        parts.append((keys, counts))
                        if len(parts) >= 8:
                            held[lang, n] = fold(parts)
        for (lang, n), parts in held.items():
            keys, counts = fold(parts)[0]
            for at in range(0, len(keys), 1 << 16):
                k = keys[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k)), pa.array(np.full(len(k), n, np.int32)), pa.array(k.view(np.int64)), pa.array(counts[at : at + (1 << 16)])],
                    names=["lang", "n", "gram", "c"],
                )

    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).filter(
        crc_remainder(F.col("doc_id"), p.mod) != p.held_out
    )
    counted = within(rows.select("text", "lang"), run, "lang string, n int, gram long, c long")
    summed = counted.groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    summed = written(summed, "grams")
    totals = summed.groupBy("lang", "n").agg(F.sum("c").alias("total"))
    frequent = summed.join(F.broadcast(totals), ["lang", "n"]).filter(F.col("c") >= F.col("total") * p.min_share)
    found = frequent.select("lang", "gram").distinct().toPandas()
    if not len(found):
        return None
    return build(found["lang"].to_numpy(), found["gram"].to_numpy().view(np.uint64), p)


def build(langs: np.ndarray, hashes: np.ndarray, p: LanguageParams) -> LanguageModel:
    """A filter of (language, n-gram hash) pairs."""
    languages = sorted(set(langs.tolist()))
    masks = np.zeros((-(-len(languages) // 64), 1 << p.bits), np.uint64)
    rate = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        bit = np.uint64(1 << (i % 64))
        for slots in _slots(hashes[langs == lang], p):
            masks[i // 64, slots] |= bit
        rate[i] = ((masks[i // 64] & bit) != 0).mean() ** p.hashes
    return LanguageModel(languages, masks, rate)


def predict(texts: list[str | None], m: LanguageModel, p: LanguageParams) -> tuple[list[str], np.ndarray]:
    langs: list[str] = []
    scores = np.zeros(len(texts))
    for at, part in _steps(texts, p.step_chars):
        n = len(part)
        held = np.zeros((n, len(m.languages)))
        total = np.zeros(n)
        for _, hashes, row in grams(part, p):
            slots = _slots(hashes, p)
            total += np.bincount(row, minlength=n)
            for w, masks in enumerate(m.masks):
                found = masks[slots[0]]
                for s in slots[1:]:
                    found &= masks[s]
                for i in range(64 * w, min(64 * w + 64, len(m.languages))):
                    held[:, i] += np.bincount(row, (found >> np.uint64(i % 64)) & np.uint64(1), n)
        share = np.maximum(held - total[:, None] * m.false_rate, 0) / (1 - m.false_rate) / np.maximum(total, 1)[:, None]
        best = share.argmax(axis=1)
        # A share of evidence per language as a confidence: close runners-up lower it.
        scores[at : at + n] = 1 / np.exp(16 * (share - share.max(axis=1, keepdims=True))).sum(axis=1)
        for i in range(n):
            letters = total[i] > 0 or any(c.isalpha() for c in part[i] or "")
            langs.append(m.languages[best[i]] if letters else "und")
            if not letters:
                scores[at + i] = 0.0
    return langs, scores


def identified(docs: DataFrame, m: LanguageModel | None, p: LanguageParams) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(m)

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            langs, scores = predict(texts, shared.value, p) if shared.value else (["und"] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return within(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")


@query("op5_language_id")
def op5_language_id(spark, folder):
    p = LanguageParams()
    docs = table(spark, folder, "documents")
    return identified(docs, train(docs, p), p).select(
        "doc_id", (crc_remainder(F.col("doc_id"), p.mod) == p.held_out).alias("held_out"), "lang_pred", "score"
    )
