"""Gene names from FASTA headers, and identifier cleaning, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header tags, accession prefixes and isoform wording, and the characters
# that identifiers may not hold.
GENE_TAG = r"(gene|locus)[:=]"
REFSEQ_HEADER = r"^(NP|XP|YP|WP)_.*\]$"
ISOFORM_PLAIN = r"isoform [0-9, A-Z]+ "
ISOFORM_MODEL = r"isoform X[0-9, A-Z]+ "
UNSAFE_ID_CHARACTERS = ":,()"


def tagged_gene(header: Column) -> Column:
    """The value of the only gene or locus tag among the words; null when not exactly one."""
    words = F.filter(F.split(F.trim(header), r"\s+"), lambda w: w.rlike(GENE_TAG))
    word = F.get(words, F.lit(0))
    value = F.when(F.contains(word, F.lit("=")), F.get(F.split(word, "="), F.lit(1))).otherwise(
        F.get(F.split(word, ":"), F.lit(1))
    )
    return F.when(F.size(words) == 1, value)


def isoform_free_title(header: Column) -> Column:
    """Header without isoform wording; the accession goes too once such wording was found."""
    bare = F.regexp_replace(F.regexp_replace(header, ISOFORM_PLAIN, ""), ISOFORM_MODEL, "")
    return F.when(bare == header, header).otherwise(F.regexp_replace(bare, r"^\s*\S+\s+", ""))


def before_last_dot(header: Column) -> Column:
    return F.regexp_replace(F.rtrim(header), r"\.[^.]*$", "")


def first_word(header: Column) -> Column:
    return F.regexp_extract(header, r"^\s*(\S+)", 1)


GENE_NAME = {
    "tag": tagged_gene,
    "refseq": isoform_free_title,
    "last_dot": before_last_dot,
    "first_word": first_word,
}


def is_refseq_header(header: Column) -> Column:
    return F.rtrim(header).rlike(REFSEQ_HEADER)


def safe_id(name: Column) -> Column:
    """Replace the characters that tree and list formats reserve."""
    return F.translate(name, UNSAFE_ID_CHARACTERS, "_" * len(UNSAFE_ID_CHARACTERS))


def file_stem(path: Column, suffix: str = r"\.[^/]*") -> Column:
    """File name without its folders and without ``suffix`` (a pattern)."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), suffix + "$", "")
