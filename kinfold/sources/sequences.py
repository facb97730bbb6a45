"""FASTA and FASTQ readers that work on splits of any size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.functions.names import first_word


def read_fasta(spark: SparkSession, glob: str | Sequence[str]) -> DataFrame:
    """Records are cut by the reader at a line start of ">", so files stay splittable."""
    return parse_fasta(spark.read.text(glob, lineSep="\n>").select("value", "_metadata.file_path", "_metadata.file_block_start"))


def parse_fasta(chunks: DataFrame) -> DataFrame:
    """(file, ord, header, id, sequence): one row per record, wrapped lines joined.

    ``chunks`` has one record per row with the file and the start of its split; ``ord`` sorts the records of a file as they
    stand in it.
    """
    text = F.regexp_replace("value", r"^>", "")
    parts = F.split(text, "\n", 2)
    header = F.regexp_replace(F.get(parts, F.lit(0)), r"\s+$", "")
    return (
        chunks.filter(F.trim("value") != "")
        .withColumn("header", header)
        .select(
            F.col("file_path").alias("file"),
            F.struct(F.col("file_block_start"), F.monotonically_increasing_id().alias("row")).alias("ord"),
            "header",
            first_word(F.col("header")).alias("id"),
            F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "").alias("sequence"),
        )
    )


def read_fastq(spark: SparkSession, glob: str | Sequence[str]) -> DataFrame:
    lines = spark.read.text(glob).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return parse_fastq(lines)


def parse_fastq(lines: DataFrame) -> DataFrame:
    """(file, read_id, seq, qual) from 4-line records, plain or gz.

    ``lines`` has value, file and block, the start of the split; a split's lines stand together in their order. Records are cut inside their split: a line with "@" whose next but one has "+" is a record's first, because neither a sequence
    nor the line before one starts with "+". Only the lines of records that cross the edge of a split are shuffled, a few per
    split, and glued in the order of the file.
    """
    cut = lines.mapInArrow(_records_in_splits, "file string, head string, seq string, qual string, block long, place long")
    whole = F.col("place").isNull()
    place = Window.partitionBy("file").orderBy("block", "place")
    number = F.row_number().over(place) - 1
    edges = cut.filter(~whole).select("file", F.floor(number / 4).alias("record"), F.pmod(number, F.lit(4)).alias("part"), F.col("head").alias("value"))
    cells = [F.max(F.when(F.col("part") == i, F.col("value"))).alias(c) for i, c in enumerate(["head", "seq", "plus", "qual"])]
    glued = edges.groupBy("file", "record").agg(*cells).filter(F.col("seq").isNotNull())
    records = cut.filter(whole).select("file", "head", "seq", "qual").unionByName(glued.select("file", "head", "seq", "qual"))
    return records.select("file", F.regexp_extract("head", r"^@(\S+)", 1).alias("read_id"), "seq", "qual")


def _records_in_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split, and its other lines (in ``head``) with their place in it."""
    names = ["file", "head", "seq", "qual", "block", "place"]
    text, long = pa.string(), pa.int64()

    def edge(at: tuple[str, int], values: list[str], first: int) -> pa.RecordBatch:
        n = len(values)
        none = pa.nulls(n, text)
        places = pa.array(range(first, first + n), long)
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * n, text), pa.array(values, text), none, none, pa.array([at[1]] * n, long), places], names=names)

    at, held, seen, aligned = None, [], 0, False
    for batch in batches:
        value, file, block = (c.to_pylist() for c in batch.columns)
        begin = 0
        while begin < len(value):
            end, mine = begin, (file[begin], block[begin])
            while end < len(value) and block[end] == mine[1] and file[end] == mine[0]:
                end += 1
            if mine != at:
                if held:
                    yield edge(at, held, seen)
                at, held, seen, aligned = mine, [], 0, mine[1] == 0
            held += value[begin:end]
            begin = end
            if not aligned and len(held) >= 7:
                first = next((i for i in range(4) if held[i].startswith("@") and held[i + 2].startswith("+")), None)
                if first is None:
                    raise ValueError(f"{at[0]}: no record of four lines behind byte {at[1]}")
                if first:
                    yield edge(at, held[:first], 0)
                held, seen, aligned = held[first:], first, True
            n = len(held) // 4 * 4
            if aligned and n:
                rows = [pa.array([at[0]] * (n // 4), text)] + [pa.array(held[i:n:4], text) for i in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays([*rows, pa.nulls(n // 4, long), pa.nulls(n // 4, long)], names=names)
                held, seen = held[n:], seen + n
    if held:
        yield edge(at, held, seen)


def superset_sequences(frames: Sequence[DataFrame]) -> DataFrame:
    """Sequences of all species together."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def reads_of_sheet(reads: DataFrame, samples: DataFrame) -> DataFrame:
    """Give FASTQ reads their sample and mate by the file names of the sample sheet.

    The "/1" or "/2" that some files append to a read name is dropped, so mates share an id.
    """
    name = F.regexp_replace(F.col("file"), r"^.*/", "")
    sheet = samples.select(
        F.concat_ws("_", "sample", "unit").alias("sample"),
        F.inline(F.array(
            F.struct(F.col("fq1").alias("name"), F.lit(1).alias("mate")),
            F.struct(F.col("fq2").alias("name"), F.lit(2).alias("mate")),
        )),
    ).filter(F.col("name").isNotNull())
    bare = F.regexp_replace("read_id", r"/[12]$", "")
    return reads.withColumn("name", name).withColumn("read_id", bare).join(sheet, "name").drop("name")
