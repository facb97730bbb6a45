"""Sequencing reads: quality trimming, adapter clipping, pairing and quality reports.

A read is (sample, read_id, mate, seq, qual) with quality characters at offset 33.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.order import computed_once

# Trimming settings and the quality offset.
WINDOW = 4
MIN_QUALITY = 20
MIN_LENGTH = 40
QUALITY_OFFSET = 33
SEED_LENGTH = 16
SEED_MISMATCHES = 2
CLIP_SCORE = 10.0
PIECE = 1 << 17  # places searched at a time


def qualities(qual: Column) -> Column:
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - QUALITY_OFFSET)


def _codes(texts: list[str]):
    """Code points of some texts in one array, and the length of each text."""
    import numpy as np

    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64), sizes


def _first_places(columns: list[pd.Series], beyond: int, found) -> pd.Series:
    """Place of the first hit in each text of the first column; texts without one keep their length.

    Texts are cut into pieces of at most ``PIECE`` places, each seen with the ``beyond`` characters after it, and a few pieces are
    searched at a time, so that memory follows neither the batch nor the longest text. ``found`` takes the pieces of each column
    and returns the places of the hits in them, written one after the other. Missing texts are empty.
    """
    import numpy as np

    texts = [column.fillna("").tolist() for column in columns]
    out = np.fromiter(map(len, texts[0]), np.int64, len(texts[0]))

    def search(pieces: list[tuple[int, int]]) -> None:
        if not pieces:
            return
        rows, starts = (np.array(x) for x in zip(*pieces))
        cut = [[column[row][start : start + PIECE + beyond] for row, start in pieces] for column in texts]
        ends = np.cumsum(np.fromiter(map(len, cut[0]), np.int64, len(pieces)))
        hits = found(*cut)
        piece = np.searchsorted(ends, hits, side="right")
        place = hits - np.concatenate(([0], ends))[piece]
        own = place < PIECE
        np.minimum.at(out, rows[piece[own]], starts[piece[own]] + place[own])

    waiting, held = [], 0
    for row, size in enumerate(out.tolist()):
        for start in range(0, size, PIECE):
            waiting.append((row, start))
            held += min(size - start, PIECE)
            if held >= PIECE:
                search(waiting)
                waiting, held = [], 0
    search(waiting)
    return pd.Series(out)


def _cut(reads: DataFrame, length: str) -> DataFrame:
    keep = F.col(length)
    return reads.withColumn("seq", F.substring("seq", F.lit(1), keep)).withColumn("qual", F.substring("qual", F.lit(1), keep))


def read_quality_trim(
    reads: DataFrame, window: int = WINDOW, quality: int = MIN_QUALITY, min_length: int = MIN_LENGTH
) -> DataFrame:
    """Cut before the first window whose mean quality is too low; drop reads left too short.

    Window sums are differences of one running sum over the qualities of some reads. A read without
    qualities is not cut.
    """
    lowest = quality * window
    offset = QUALITY_OFFSET

    def low_windows(quals: list[str]):
        import numpy as np

        codes, sizes = _codes(quals)
        if len(codes) < window:
            return np.zeros(0, np.int64)
        sums = np.concatenate(([0], np.cumsum(codes - offset)))
        ends = np.repeat(np.cumsum(sizes), sizes)[: len(codes) - window + 1]
        inside = np.arange(len(ends)) + window <= ends
        return np.flatnonzero(inside & (sums[window:] - sums[:-window] < lowest))

    @F.pandas_udf("int")
    def kept_length(quals: pd.Series) -> pd.Series:
        return _first_places([quals], window - 1, low_windows)

    keep = F.when(F.col("qual").isNull(), F.length("seq")).otherwise(kept_length("qual"))
    return _cut(computed_once(reads, _keep=keep).filter(F.col("_keep") >= min_length), "_keep").drop("_keep")


def adapter_clip(
    reads: DataFrame, adapters: Sequence[str], threshold: float = CLIP_SCORE, mismatches: int = SEED_MISMATCHES
) -> DataFrame:
    """Clip a read where an adapter begins, also where the adapter runs over the read's end.

    The whole adapter is laid against every place of the read: a matching base scores log10(4), a
    mismatch costs a tenth of its quality, and ``threshold`` must be reached (by a short adapter: its own full
    score). At most ``mismatches`` of the first 16 bases may differ. Adapters are a short settings list; some
    reads are compared at a time, base by base of the adapter. A missing sequence stays missing.
    """
    base = math.log10(4)
    offset = QUALITY_OFFSET
    settings = [(a, min(threshold, base * len(a)) - 1e-9) for a in adapters if a]

    def adapter_places(seqs: list[str], quals: list[str]):
        import numpy as np

        codes, sizes = _codes(seqs)
        scores, quality_sizes = _codes(quals)
        if (quality_sizes != sizes).any():  # missing or uneven qualities: mismatches cost as much as a match gives
            at = np.repeat(np.cumsum(quality_sizes) - quality_sizes, sizes) + np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            known = at < np.repeat(np.cumsum(quality_sizes), sizes)
            scores = np.where(known, np.append(scores, 0)[np.minimum(at, len(scores))], int(10 * base) + offset)
        cost = (scores - offset) / 10.0
        ends = np.repeat(np.cumsum(sizes), sizes)
        hit = np.zeros(len(codes), bool)
        for adapter, needed in settings:
            score, wrong = np.zeros(len(codes)), np.zeros(len(codes), np.int64)
            for j, letter in enumerate(adapter):
                place = np.arange(len(codes) - j)
                place = place[place + j < ends[: len(place)]]
                same = codes[place + j] == ord(letter)
                score[place] += np.where(same, base, -cost[place + j])
                if j < SEED_LENGTH:
                    wrong[place] += ~same
            hit |= (score >= needed) & (wrong <= mismatches)
        return np.flatnonzero(hit)

    longest = max((len(a) for a, _ in settings), default=1)

    @F.pandas_udf("int")
    def first_adapter(seqs: pd.Series, quals: pd.Series) -> pd.Series:
        return _first_places([seqs, quals], longest - 1, adapter_places)

    clipped = computed_once(reads, _cut=F.when(F.col("seq").isNotNull(), first_adapter("seq", "qual")))
    return _cut(clipped.withColumn("clipped", F.col("_cut") < F.length("seq")), "_cut").drop("_cut")


def pair_survival(trimmed: DataFrame) -> DataFrame:
    """Mark reads whose two mates both survived as paired, the rest as unpaired."""
    mates = Window.partitionBy("sample", "read_id")
    both = F.max((F.col("mate") == 1).cast("int")).over(mates) + F.max((F.col("mate") == 2).cast("int")).over(mates)
    return trimmed.withColumn("fate", F.when(both == 2, "paired").otherwise("unpaired"))


def position_quality(reads: DataFrame) -> DataFrame:
    """Mean and median quality and number of reads per position.

    The median comes from the histogram of the few quality values of a position.
    """
    by = ["sample", "position"]
    at = reads.select("sample", F.posexplode(qualities(F.col("qual"))).alias("position", "quality"))
    histogram = at.groupBy(*by, "quality").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*by)
    upto = F.sum("n").over(group.orderBy("quality"))
    total = F.sum("n").over(group)
    placed = histogram.withColumns({"upto": upto, "total": total})
    low = F.min(F.when(F.col("upto") >= F.floor((F.col("total") + 1) / 2), F.col("quality")))
    high = F.min(F.when(F.col("upto") >= F.floor((F.col("total") + 2) / 2), F.col("quality")))
    return placed.groupBy(*by).agg(
        F.sum("n").alias("n_reads"),
        (F.sum(F.col("n") * F.col("quality")) / F.sum("n")).alias("mean_quality"),
        ((low + high) / 2).alias("median_quality"),
    )


def base_share(seq: Column, bases: str) -> Column:
    """Percent of characters that are one of ``bases``."""
    upper = F.upper(seq)
    kept = F.length(upper) - F.length(F.translate(upper, bases, ""))
    return 100.0 * kept / F.nullif(F.length(seq), F.lit(0))


def read_qc(reads: DataFrame, stage: str = "raw") -> DataFrame:
    """All per-read reports of a stage as (sample, stage, module, metric, value), from one scan of the reads.

    length, gc: reads per length and rounded GC percentage; n_content: percent of unknown bases over all bases of a sample;
    duplication: how many distinct sequences occur once, twice, ... A read gives one small row per module, combined before the
    shuffle; a digest stands for its sequence, and only digests are shuffled in number.
    """
    upper = F.upper("seq")
    unknown = F.length(upper) - F.length(F.translate(upper, "N", ""))
    gc = F.floor(base_share(F.col("seq"), "GC") + 0.5).cast("int")

    def item(module: str, metric: Column, part: Column, whole: Column) -> Column:
        return F.struct(
            F.lit(module).alias("module"), metric.cast("string").alias("metric"),
            part.cast("double").alias("part"), whole.cast("double").alias("whole"),
        )

    one, none = F.lit(1), F.lit(None)
    items = reads.select("sample", F.inline(F.array(
        item("length", F.length("seq"), one, none),
        item("gc", gc, one, none),
        item("n_content", F.lit("percent"), 100.0 * unknown, F.length("seq")),
        item("duplication", F.sha2("seq", 256), one, none),
    )))
    sums = [F.sum("part").alias("part"), F.sum("whole").alias("whole")]
    counted = items.groupBy("sample", "module", "metric").agg(*sums)
    copies = F.col("module") == "duplication"
    levels = counted.select(
        "sample", "module",
        F.when(copies, F.col("part").cast("long").cast("string")).otherwise(F.col("metric")).alias("metric"),
        F.when(copies, 1.0).otherwise(F.col("part")).alias("part"), "whole",
    ).groupBy("sample", "module", "metric").agg(*sums)
    value = F.when(F.col("module") == "n_content", F.try_divide("part", "whole")).otherwise(F.col("part"))
    return levels.select("sample", F.lit(stage).alias("stage"), "module", "metric", value.alias("value"))


def qc_summary(reads_by_stage: dict[str, DataFrame]) -> DataFrame:
    """Reads, bases, mean length and GC per sample and stage, plus the share of reads kept."""
    frames = None
    for stage, reads in reads_by_stage.items():
        upper = F.upper("seq")
        gc = F.length(upper) - F.length(F.translate(upper, "GC", ""))
        summary = reads.groupBy("sample").agg(
            F.count(F.lit(1)).alias("n_reads"),
            F.sum(F.length("seq")).alias("n_bases"),
            (100.0 * F.sum(gc) / F.sum(F.length("seq"))).alias("gc_percent"),
        ).withColumn("stage", F.lit(stage))
        frames = summary if frames is None else frames.unionByName(summary)
    first = next(iter(reads_by_stage))
    whole = Window.partitionBy("sample")
    start = F.max(F.when(F.col("stage") == first, F.col("n_reads"))).over(whole)
    return frames.withColumn("kept_percent", 100.0 * F.col("n_reads") / start)
