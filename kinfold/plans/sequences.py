"""Queries on sequence records, headers and reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.names import GENE_NAME, safe_id
from kinfold.operators import isoforms, reads
from kinfold.plans.domain import Domain
from kinfold.plans.registry import big, fragment, query, r6

# Codes 10 and 32-126 count modulo 42, all other characters by their code minus 33.
SCORE = "CASE WHEN ascii(c) = 10 OR ascii(c) BETWEEN 32 AND 126 THEN ascii(c) % 42 ELSE ascii(c) - 33 END"
fragment("reads", f"""
SELECT lang AS sample, CAST(doc_id AS VARCHAR) AS read_id, text AS seq,
  list_transform(string_split(text, ''), lambda c: {SCORE}) AS q FROM documents""")
fragment("trimmed", """
SELECT sample, read_id, seq, q, coalesce(list_position(list_transform(range(1, len(q) - 2),
  lambda i: q[i] + q[i + 1] + q[i + 2] + q[i + 3] < 80), true) - 1, len(q)) AS keep FROM reads""", "reads")


@query("longest_isoform", """
SELECT file, ord, coalesce(gene, header) AS header, gene, sequence FROM (
  SELECT *, row_number() OVER (PARTITION BY file, gene ORDER BY length(sequence) DESC, ord) AS k FROM sequences)
WHERE gene IS NULL OR k = 1""", "sequences")
def _(d: Domain) -> DataFrame:
    return isoforms.longest_isoform(d.sequences).select("file", "ord", "header", "gene", "sequence")


@query("longest_isoform_per_file", """
SELECT file, ord, CASE WHEN refseq THEN 'NP_' || ord || ' ' || lang || ' isoform X' || ord % 3 || ' [y]' ELSE gene END AS header,
  gene, length(sequence) AS n FROM (SELECT *, row_number() OVER (PARTITION BY file, gene ORDER BY length(sequence) DESC, ord) AS k FROM (
    SELECT source AS file, doc_id AS ord, lang, text AS sequence, length(source) = 4 AS refseq,
      CASE WHEN length(source) = 4 THEN lang || ' [y]' ELSE source || '.' || lang END AS gene FROM documents)
  WHERE length(sequence) > 0) WHERE k = 1""")
def _(d: Domain) -> DataFrame:
    ord_ = F.col("doc_id").cast("string")
    model = F.concat(F.lit("NP_"), ord_, F.lit(" "), F.col("lang"), F.lit(" isoform X"), (F.col("doc_id") % 3).cast("string"), F.lit(" [y]"))
    tagged = F.concat(ord_, F.lit(" gene:"), F.col("source"), F.lit("."), F.col("lang"))
    seqs = d.table("documents").select(
        F.col("source").alias("file"), F.col("doc_id").alias("ord"), F.col("text").alias("sequence"),
        F.when(F.length("source") == 4, model).otherwise(tagged).alias("header"),
    )
    return isoforms.longest_isoform(seqs, "auto").select("file", "ord", "header", "gene", big("seq_length", "n"))


@query("gene_name_ensembl", "SELECT ord, gene FROM sequences", "sequences")
def _(d: Domain) -> DataFrame:
    return d.sequences.select("ord", GENE_NAME["tag"](F.col("header")).alias("gene"))


@query("gene_name_ncbi", r"""
SELECT doc_id AS ord, CASE lang WHEN 'en' THEN source || ' protein [' || lang || ']'
  ELSE doc_id || ' ' || source || ' protein [' || lang || ']' END AS gene FROM documents""")
def _(d: Domain) -> DataFrame:
    iso = F.when(F.col("lang") == "en", F.concat(F.lit("isoform X"), (F.col("doc_id") % 9).cast("string"), F.lit(" "))).otherwise("")
    header = F.concat(
        F.col("doc_id").cast("string"), F.lit(" "), F.col("source"), F.lit(" protein "), iso, F.lit("["), F.col("lang"), F.lit("]")
    )
    return d.table("documents").select(F.col("doc_id").alias("ord"), GENE_NAME["refseq"](header).alias("gene"))


@query("gene_name_last_dot", r"""
SELECT doc_id AS ord, source || '.' || lang AS gene FROM documents""")
def _(d: Domain) -> DataFrame:
    header = F.concat_ws(".", "source", "lang", F.col("doc_id").cast("string"))
    return d.table("documents").select(F.col("doc_id").alias("ord"), GENE_NAME["last_dot"](header).alias("gene"))


@query("gene_name_first_word", "SELECT ord, split_part(header, ' ', 1) AS gene FROM sequences", "sequences")
def _(d: Domain) -> DataFrame:
    return d.sequences.select("ord", GENE_NAME["first_word"](F.col("header")).alias("gene"))


@query("ncbi_detection", """
SELECT source AS file, min_by(lang, doc_id) = 'en' AS refseq FROM documents GROUP BY 1""")
def _(d: Domain) -> DataFrame:
    header = F.concat(
        F.when(F.col("lang") == "en", "NP_").otherwise("AT_"), F.col("doc_id").cast("string"), F.lit(" x [y]")
    )
    rows = d.table("documents").select(F.col("source").alias("file"), F.col("doc_id").alias("ord"), header.alias("header"))
    return isoforms.file_modes(rows).select("file", (F.col("mode") == "refseq").alias("refseq"))


@query("safe_id", "SELECT page_id, replace(replace(replace(replace(url, ':', '_'), ',', '_'), '(', '_'), ')', '_') AS id FROM pages")
def _(d: Domain) -> DataFrame:
    return d.table("pages").select("page_id", safe_id(F.col("url")).alias("id"))


@query("duplicate_headers", """
SELECT file, gene AS header, count(*) AS n FROM sequences WHERE gene IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""", "sequences")
def _(d: Domain) -> DataFrame:
    named = isoforms.with_gene(d.sequences, "tag").filter(F.col("gene").isNotNull())
    return isoforms.duplicate_headers(named.select("file", F.col("gene").alias("header")))


@query("header_tag_stats", """
SELECT tag, id, n FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY n DESC, id) AS k FROM (
  SELECT tag, id, count(*) AS n FROM (
    SELECT 'gene' AS tag, source || '.' || lang AS id FROM documents WHERE lang <> 'fr' UNION ALL
    SELECT 'locus', 'x' FROM documents WHERE lang = 'de') GROUP BY 1, 2)) WHERE k <= 5""")
def _(d: Domain) -> DataFrame:
    return isoforms.header_tag_stats(d.sequences).select("tag", "id", "n")


@query("gene_name_stats", """
SELECT file, count(*) AS n_sequences, count(DISTINCT coalesce(gene, '')) AS n_genes FROM sequences GROUP BY 1""", "sequences")
def _(d: Domain) -> DataFrame:
    return isoforms.gene_name_stats(d.sequences, "tag").select("file", big("n_sequences"), "n_genes")


@query("longest_protein_of_gene", """
SELECT gene, ord, n FROM (SELECT lang || (turn % 7) AS gene, conv_id * 1000 + turn AS ord, length(text) AS n,
  row_number() OVER (PARTITION BY lang || (turn % 7) ORDER BY length(text) DESC, conv_id * 1000 + turn) AS k
  FROM (SELECT *, role AS lang FROM conversations)) WHERE k = 1""")
def _(d: Domain) -> DataFrame:
    links = d.table("conversations").select(
        F.concat("role", (F.col("turn") % 7).cast("string")).alias("gene"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"),
        F.length("text").alias("seq_length"),
    )
    return isoforms.longest_protein_of_gene(links).select("gene", "ord", big("seq_length", "n"))


@query("sequences_per_species", """
SELECT species, n AS n_sequences, CASE species WHEN 'de' THEN 0 WHEN 'en' THEN (SELECT count(*) FROM documents WHERE lang = 'de')
  WHEN 'fr' THEN (SELECT count(*) FROM documents WHERE lang IN ('de', 'en')) END AS start
FROM (SELECT lang AS species, count(*) AS n FROM documents GROUP BY 1)""")
def _(d: Domain) -> DataFrame:
    seqs = d.table("documents").select(F.col("lang").alias("species"))
    return isoforms.sequences_per_species(seqs, ["de", "en", "fr"])


@query("read_quality_trim", """
SELECT sample, read_id, keep AS n, md5(substr(seq, 1, keep)) AS digest FROM trimmed WHERE keep >= 40""", "trimmed")
def _(d: Domain) -> DataFrame:
    kept = reads.read_quality_trim(d.reads)
    return kept.select("sample", "read_id", big(F.length("seq"), "n"), F.md5("seq").alias("digest"))


@query("adapter_clip", """
SELECT sample, read_id, n, md5(substr(seq, 1, n)) AS digest FROM (
  SELECT sample, read_id, seq, least(CASE WHEN instr(seq, 'The ') > 0 THEN instr(seq, 'The ') - 1 ELSE length(seq) END,
    CASE WHEN instr(seq, ' que') > 0 THEN instr(seq, ' que') - 1 ELSE length(seq) END) AS n FROM reads)""", "reads")
def _(d: Domain) -> DataFrame:
    clipped = reads.adapter_clip(d.reads, ["The ", " que"])
    return clipped.select("sample", "read_id", big(F.length("seq"), "n"), F.md5("seq").alias("digest"))


@query("pair_survival", f"""
WITH t AS (SELECT conv_id || '_' || (turn // 2) AS read_id, turn % 2 + 1 AS mate,
    list_transform(string_split(text, ''), lambda c: {SCORE}) AS q FROM conversations),
k AS (SELECT *, coalesce(list_position(list_transform(range(1, len(q) - 2),
  lambda i: q[i] + q[i + 1] + q[i + 2] + q[i + 3] < 40), true) - 1, len(q)) AS keep FROM t)
SELECT read_id, mate, CASE WHEN count(*) OVER (PARTITION BY read_id) = 2 THEN 'paired' ELSE 'unpaired' END AS fate
FROM k WHERE keep >= 10""".replace("WITH t AS", "SELECT * FROM (WITH t AS") + ")")
def _(d: Domain) -> DataFrame:
    kept = reads.read_quality_trim(d.paired_reads, quality=10, min_length=10)
    return reads.pair_survival(kept).select("read_id", big("mate"), "fate")


@query("read_qc_position", """
SELECT sample, i AS position, count(*) AS n_reads, round(avg(x), 6) AS mean_quality, median(x)::DOUBLE AS median_quality FROM (
  SELECT sample, unnest(q) AS x, unnest(range(0, len(q))) AS i FROM reads) GROUP BY 1, 2""", "reads")
def _(d: Domain) -> DataFrame:
    return reads.position_quality(d.reads).select(
        "sample", big("position"), big("n_reads"), r6("mean_quality"), "median_quality"
    )


@query("read_qc", r"""
SELECT sample, 'raw' AS stage, 'length' AS module, CAST(length(seq) AS VARCHAR) AS metric, count(*)::DOUBLE AS value
FROM reads GROUP BY ALL UNION ALL
SELECT sample, 'raw', 'gc', CAST(CAST(floor(100.0::DOUBLE * length(regexp_replace(upper(seq), '[^GC]', '', 'g')) / length(seq) + 0.5) AS INT) AS VARCHAR),
  count(*)::DOUBLE FROM reads GROUP BY ALL UNION ALL
SELECT sample, 'raw', 'n_content', 'percent',
  round(100.0::DOUBLE * sum(length(regexp_replace(upper(seq), '[^N]', '', 'g'))) / sum(length(seq)), 6) FROM reads GROUP BY ALL UNION ALL
SELECT sample, 'raw', 'duplication', CAST(n AS VARCHAR), count(*)::DOUBLE FROM (
  SELECT sample, seq, count(*) AS n FROM reads GROUP BY ALL) GROUP BY sample, n""", "reads")
def _(d: Domain) -> DataFrame:
    return reads.read_qc(d.reads).withColumn("value", r6("value"))


@query("qc_summary", r"""
SELECT sample, stage, count(*) AS n_reads, CAST(sum(length(s)) AS BIGINT) AS n_bases,
  round(100.0::DOUBLE * sum(length(regexp_replace(upper(s), '[^GC]', '', 'g'))) / sum(length(s)), 6) AS gc_percent,
  round(100.0::DOUBLE * count(*) / max(CASE WHEN stage = 'raw' THEN count(*) END) OVER (PARTITION BY sample), 6) AS kept_percent
FROM (SELECT sample, 'raw' AS stage, seq AS s FROM reads UNION ALL
  SELECT sample, 'trimmed', substr(seq, 1, keep) FROM trimmed WHERE keep >= 40) GROUP BY 1, 2""", ("reads", "trimmed"))
def _(d: Domain) -> DataFrame:
    summary = reads.qc_summary({"raw": d.reads, "trimmed": reads.read_quality_trim(d.reads)})
    return summary.select(
        "sample", "stage", "n_reads", big("n_bases"), r6("gc_percent"), r6("kept_percent")
    )
