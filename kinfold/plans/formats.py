"""Queries on the readers: lines of each format are written from the tables and parsed back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators import orthogroups
from kinfold.plans.domain import SAMPLES, SPECIES, Domain
from kinfold.plans.registry import big, query, r6
from kinfold.sources import config, features, sequences, tables

DOCS_PER_FILE = 100
LINES_PER_SPLIT = 80


def line(*columns: str | Column) -> Column:
    """Tab-separated text; a null is an empty cell."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]).alias("value")


def above(rows: DataFrame, *texts: str) -> DataFrame:
    """The lines under these ones; other columns are null there."""
    head = rows.sparkSession.createDataFrame([(t,) for t in texts], "value string")
    return head.unionByName(rows, allowMissingColumns=True)


@query("parse_hits", """
SELECT 'q' || l_orderkey AS qseqid, 'q' || l_partkey AS sseqid, l_quantity + 50 AS pident, CAST(l_linenumber AS DOUBLE) AS length,
  round(l_discount * 1e-2, 6) AS evalue, l_extendedprice AS bitscore FROM lineitem WHERE l_tax <> 0""")
def _(d: Domain) -> DataFrame:
    text = line(
        F.concat(F.lit("q"), "l_orderkey"), F.concat(F.lit("q"), "l_partkey"), F.col("l_quantity") + 50, "l_linenumber",
        *[F.lit(0)] * 6, F.col("l_discount") * 1e-2, "l_extendedprice",
    )
    lines = d.table("lineitem").select(F.when(F.col("l_tax") == 0, F.lit("")).otherwise(text).alias("value"))
    return tables.parse_hits(lines).select("qseqid", "sseqid", "pident", "length", r6("evalue"), "bitscore")


def id_lines(d: Domain) -> DataFrame:
    """Ids of a species and a sequence; pending ones are commented out."""
    key = F.concat_ws("_", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    mark = F.when(F.col("o_orderstatus") == "P", "#").otherwise("")
    name = F.concat(F.lit("g"), "o_orderkey", F.lit("("), "o_orderstatus", F.lit("):,"), "o_orderpriority", F.lit(" kind ("), "o_orderstatus", F.lit(") "))
    return d.table("orders").select(F.concat(mark, key, F.lit(": "), name).alias("value"))


ID = "o_custkey || '_' || o_orderkey AS seqid"


@query("parse_id_map", f"""SELECT {ID}, split_part('g' || o_orderkey || '(' || o_orderstatus || '):,' || o_orderpriority, ' ', 1) AS name FROM orders""")
def _(d: Domain) -> DataFrame:
    return tables.parse_id_map(id_lines(d))


@query("parse_id_map_full", f"""
SELECT {ID}, 'g' || o_orderkey || '_' || o_orderstatus || '___' || o_orderpriority || ' kind _' || o_orderstatus || '_' AS name FROM orders""")
def _(d: Domain) -> DataFrame:
    return tables.parse_id_map(id_lines(d), "full")


@query("parse_id_map_first_word", f"""
SELECT {ID}, split_part('g' || o_orderkey || '_' || o_orderstatus || '___' || o_orderpriority, ' ', 1) AS name FROM orders""")
def _(d: Domain) -> DataFrame:
    return tables.parse_id_map(id_lines(d), "first_word")


@query("parse_orthogroups", "SELECT hog, species, gene FROM hog_genes", "hog_genes")
def _(d: Domain) -> DataFrame:
    wide = orthogroups.orthogroup_wide(d.hog_genes, SPECIES)
    columns = wide.columns
    lines = above(wide.select(line(*[F.col(f"`{c}`") for c in columns])), "\t".join(columns))
    return orthogroups.hog_genes_long(tables.parse_table(lines, columns)).select("hog", "species", "gene")


@query("parse_annotation", """
SELECT gene, nullif(terms, 'NA') AS terms, species, CASE WHEN gene LIKE '%7' THEN NULL ELSE 'seen "twice" in ' || gene END AS "Description"
FROM annotation WHERE species = 'ASIA'""", "annotation")
def _(d: Domain) -> DataFrame:
    columns = [tables.ACCESSION, tables.QUALITY_CODE, "Description", tables.TERMS]
    seen = F.when(F.col("gene").endswith("7"), "").otherwise(F.concat(F.lit('seen "twice" in '), "gene"))
    rows = d.annotation.filter("species = 'ASIA'").select(line("gene", F.lit("***"), seen, F.nullif("terms", F.lit("NA"))))
    lines = above(rows, "# made by a tool", "", "\t".join(columns))
    return tables.parse_annotation(lines, "ASIA", True, columns).select("gene", "terms", "species", "Description")


@query("parse_count_files", """
SELECT sample, gene, p_brand AS chrom, CAST(p_size AS VARCHAR) AS "start", '+' AS strand, CAST(p_size + 10 AS BIGINT) AS length, count
FROM counts JOIN part ON gene = 'p' || p_partkey""", "counts")
def _(d: Domain) -> DataFrame:
    part = d.table("part").select(F.concat(F.lit("p"), "p_partkey").alias("gene"), "p_brand", "p_size")
    rows = d.counts.join(part, "gene").select(
        line("gene", "p_brand", "p_size", F.col("p_size") + 9, F.lit("+"), F.col("p_size") + 10, "count"),
        F.concat(F.lit("file:/some.where/run.1/"), "sample", F.lit("_counts.txt")).alias("file_path"),
    )
    lines = above(rows, "# Program: a counter", "\t".join([*tables.COUNT_KEYS, "/a/path/A_F.bam"]))
    return tables.parse_count_files(lines).select("sample", "gene", "chrom", "start", "strand", "length", "count")


@query("parse_quant", """
SELECT sample, gene AS transcript_id, count / 2 AS count, CAST(p_size AS DOUBLE) AS abundance, p_retailprice AS length
FROM counts JOIN part ON gene = 'p' || p_partkey""", "counts")
def _(d: Domain) -> DataFrame:
    part = d.table("part").select(F.concat(F.lit("p"), "p_partkey").alias("gene"), "p_size", "p_retailprice")
    rows = d.counts.join(part, "gene").select(
        line("gene", F.lit(1000), "p_retailprice", F.col("count") / 2, "p_size"),
        F.concat(F.lit("/quant/"), "sample", F.lit("/abundance.tsv")).alias("file_path"),
    )
    head = d.spark.createDataFrame([(s,) for s in SAMPLES], "sample string").select(
        F.lit("target_id\tlength\teff_length\test_counts\ttpm").alias("value"),
        F.concat(F.lit("/quant/"), "sample", F.lit("/abundance.tsv")).alias("file_path"),
    )
    return tables.parse_quant(head.unionByName(rows))


@query("parse_family_pvalues", """
SELECT hog, CASE WHEN pvalue > 0 THEN round(pvalue, 6) END AS pvalue FROM family""", "family")
def _(d: Domain) -> DataFrame:
    p = F.when(F.col("pvalue") > 0, F.col("pvalue").cast("string")).otherwise("N/A")
    columns = ["#FamilyID", "pvalue", "*.branches"]
    lines = above(d.family.select(line("hog", p, F.lit("y"))), "\t".join(columns))
    return tables.parse_family_pvalues(lines, columns).select("hog", r6("pvalue"))


@query("parse_features", """
SELECT p_type AS chrom, CASE WHEN p_size % 3 = 0 THEN 'gene' ELSE 'exon' END AS type, CAST(p_size AS BIGINT) AS "start",
  CAST(p_size + 99 AS BIGINT) AS "end", p_brand AS gene_id, 'p' || p_partkey AS transcript_id FROM part""")
def _(d: Domain) -> DataFrame:
    gtf = F.concat(F.lit('gene_id "'), "p_brand", F.lit('"; transcript_id "p'), "p_partkey", F.lit('"; gene_id "again";'))
    gff = F.concat(F.lit("ID=x;gene_id="), "p_brand", F.lit(";transcript_id=p"), "p_partkey")
    kind = F.when(F.col("p_size") % 3 == 0, "gene").otherwise("exon")
    rows = d.table("part").select(line(
        "p_type", F.lit("src"), kind, "p_size", F.col("p_size") + 99, F.lit("."), F.lit("+"), F.lit("."),
        F.when(F.col("p_partkey") % 2 == 0, gtf).otherwise(gff),
    ))
    parsed = features.parse_features(above(rows, "##gff-version 3", "#!build x", ""))
    return parsed.select("chrom", "type", "start", "end", *[F.col("attributes")[k].alias(k) for k in ("gene_id", "transcript_id")])


@query("parse_exons", """
SELECT p_type AS chrom, CAST(p_size AS BIGINT) AS "start", CAST(p_size + 99 AS BIGINT) AS "end", p_brand AS gene_id
FROM part WHERE p_size % 3 <> 0""")
def _(d: Domain) -> DataFrame:
    kind = F.when(F.col("p_size") % 3 == 0, "gene").otherwise("exon")
    rows = d.table("part").select(line(
        "p_type", F.lit("src"), kind, "p_size", F.col("p_size") + 99, F.lit("."), F.lit("+"), F.lit("."),
        F.concat(F.lit('gene_id "'), "p_brand", F.lit('";')),
    ))
    return features.exons(features.parse_features(rows)).select("chrom", "start", "end", "gene_id")


@query("parse_fasta", r"""
SELECT file, CAST(ord AS VARCHAR) AS id, header, CAST(length(s) AS BIGINT) AS n, md5(s) AS digest FROM (
  SELECT file, ord, header, regexp_replace(sequence, '\s', '', 'g') AS s FROM sequences)""", "sequences")
def _(d: Domain) -> DataFrame:
    wrapped = F.regexp_replace("sequence", "(.{60})", "$1\n")
    chunks = d.sequences.select(
        F.concat(F.when(F.col("ord") == 0, ">").otherwise(""), "header", F.lit(" \n"), wrapped, F.lit("\n")).alias("value"),
        F.col("file").alias("file_path"), F.lit(0).cast("long").alias("file_block_start"),
    )
    return sequences.parse_fasta(chunks).select("file", "id", "header", big(F.length("sequence"), "n"), F.md5("sequence").alias("digest"))


def fastq_lines(d: Domain) -> DataFrame:
    """Documents as records of files of a hundred, cut into splits that begin inside a record."""
    reads = d.reads.withColumn("key", F.col("read_id").cast("long"))
    number = F.pmod("key", F.lit(DOCS_PER_FILE)) * 4
    parts = F.array(F.concat(F.lit("@"), "read_id", F.lit("/1 more")), F.translate("seq", "\n", " "), F.lit("+"), F.col("qual"))
    lines = reads.select(
        F.concat(F.lit("/reads/lane"), F.floor(F.col("key") / DOCS_PER_FILE), F.lit(".fastq")).alias("file"),
        number.alias("first"), F.posexplode(parts).alias("part", "value"),
    ).select("file", (F.col("first") + F.col("part")).alias("number"), "value")
    block = F.floor((F.col("number") + 2) / LINES_PER_SPLIT)
    splits = lines.groupBy("file", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("number", "value"))).alias("lines"))
    return splits.select(F.explode("lines.value").alias("value"), "file", "block")


@query("parse_fastq", """
SELECT '/reads/lane' || (doc_id // 100) || '.fastq' AS file, doc_id || '/1' AS read_id, CAST(length(text) AS BIGINT) AS n,
  md5(replace(text, chr(10), ' ')) AS digest, CAST(length(text) AS BIGINT) AS n_qual FROM documents""")
def _(d: Domain) -> DataFrame:
    reads = sequences.parse_fastq(fastq_lines(d))
    return reads.select("file", "read_id", big(F.length("seq"), "n"), F.md5("seq").alias("digest"), big(F.length("qual"), "n_qual"))


@query("reads_of_sheet", """
SELECT 's' || (doc_id // 100) || '_u1' AS sample, CAST(doc_id AS VARCHAR) AS read_id, CAST(1 AS BIGINT) AS mate FROM documents""")
def _(d: Domain) -> DataFrame:
    lane = d.table("documents").select(F.floor(F.col("doc_id") / DOCS_PER_FILE).alias("lane")).distinct()
    sheet = lane.select(line(
        F.lit("A"), F.concat(F.lit("s"), "lane"), F.lit("u1"), F.lit("c"), F.concat(F.lit("lane"), "lane", F.lit(".fastq")), F.lit(""), F.lit(""), F.lit(""),
    ))
    samples = config.parse_samples(sheet)
    return sequences.reads_of_sheet(sequences.parse_fastq(fastq_lines(d)), samples).select("sample", "read_id", big("mate"))


SPECIES_LINES = """
SELECT n_name AS species, 2 + n_nationkey % 3 AS ploidy, n_regionkey <> 1 AS transcriptomic, n_nationkey % 2 = 0 AS genomic,
  n_regionkey = 2 AS annotation_generated FROM nation"""


def species(d: Domain) -> DataFrame:
    nation = d.table("nation").select(line(
        "n_name", 2 + F.col("n_nationkey") % 3, F.concat("n_name", F.lit(".fa")),
        F.when(F.col("n_regionkey") != 1, "c.fa"), F.when(F.col("n_nationkey") % 2 == 0, "g.fa"), F.lit("a.gtf"),
        F.when(F.col("n_regionkey") == 2, config.GENERATED_ANNOTATION).otherwise("own.tsv"),
    ))
    return config.parse_species(above(nation, "species\tploidy\tpep_fasta\tcDNA_fasta\tgen_fasta\tannotation\tfunction"))


def samples(d: Domain) -> DataFrame:
    """A sample per customer; the poor have single reads with a stated fragment length."""
    customers = d.table("customer").join(d.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    poor = F.col("c_acctbal") < 1000
    rows = customers.select(line(
        "n_name", "c_name", F.lit("u1"), "c_mktsegment", F.concat("c_name", F.lit("_1.fq")),
        F.when(~poor, F.concat("c_name", F.lit("_2.fq"))), F.when(poor, F.lit(180.5)), F.when(poor, F.lit(20)),
    ))
    return config.parse_samples(above(rows, "\t".join(f.split()[0] for f in config.SAMPLE_SCHEMA.split(", "))))


@query("species_routes", f"""
SELECT species, genomic, transcriptomic, genomic OR transcriptomic AS expressed, annotation_generated FROM ({SPECIES_LINES})""")
def _(d: Domain) -> DataFrame:
    return config.species_routes(species(d))


@query("parse_species", f"SELECT species, CAST(ploidy AS BIGINT) AS ploidy, species || '.fa' AS pep_fasta FROM ({SPECIES_LINES})")
def _(d: Domain) -> DataFrame:
    return species(d).select("species", big("ploidy"), "pep_fasta")


@query("parse_samples", """
SELECT n_name AS species, c_name || '_u1' AS sample_id, c_mktsegment AS condition, c_name || '_1.fq' AS fq1,
  CASE WHEN c_acctbal >= 1000 THEN c_name || '_2.fq' END AS fq2, CASE WHEN c_acctbal < 1000 THEN 180.5::DOUBLE END AS fragment_length_mean
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(d: Domain) -> DataFrame:
    return samples(d).select("species", config.sample_id().alias("sample_id"), "condition", "fq1", "fq2", "fragment_length_mean")


@query("sample_route", f"""
SELECT c_name || '_u1' AS sample_id, CASE WHEN c_acctbal < 1000 THEN 'single' ELSE 'paired' END AS layout, species, genomic, transcriptomic
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN ({SPECIES_LINES}) ON species = n_name""")
def _(d: Domain) -> DataFrame:
    return config.sample_route(species(d), samples(d)).select("sample_id", "layout", "species", "genomic", "transcriptomic")


@query("samples_of_species", """
SELECT n_name AS species, c_name AS sample FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 2 = 0""")
def _(d: Domain) -> DataFrame:
    genomic = species(d).filter(F.col("gen_fasta").isNotNull())
    return config.samples_of_species(samples(d), genomic).select("species", "sample")


@query("natural_sort", "SELECT c_name AS name, CAST(regexp_extract(c_name, '([0-9]+)', 1) AS BIGINT) AS number FROM customer ORDER BY 2, 1")
def _(d: Domain) -> DataFrame:
    names = d.table("customer").select(F.col("c_name").alias("name"))
    return config.natural_sort(names, "name").withColumn("number", config.number_in("name"))


@query("parse_hypotheses", """
SELECT CAST(a.r_regionkey + 1 AS BIGINT) AS hypothesis, a.r_name AS name, replace(a.r_name, ' ', '_') AS expanded_in,
  string_agg(replace(b.r_name, ' ', '_'), ';' ORDER BY b.r_regionkey) AS compared_to, CAST(2 AS BIGINT) AS "Nmin_compared_to",
  a.r_regionkey + 1.5::DOUBLE AS min_expansion_factor, a.r_regionkey % 2 = 0 AS ploidy_normalization, false AS compared_to_all_found
FROM region a JOIN region b ON a.r_regionkey <> b.r_regionkey GROUP BY a.r_regionkey, a.r_name""")
def _(d: Domain) -> DataFrame:
    key, name = F.col("r_regionkey"), F.translate("r_name", " ", "_")
    others = F.array_join(F.array_remove(F.array(*[F.lit(s) for s in SPECIES]), name), ";")
    properties = [F.concat(F.lit('"'), "r_name", F.lit('"')), name, others, F.lit("1"), F.lit("2"), (key + 1.5).cast("string"), F.lit("10"), F.lit("2"),
                  F.when(key % 2 == 0, "yes ").otherwise("NO"), F.lit("NO"), F.lit("")]
    rows = d.table("region").select(key.alias("k"), F.posexplode(F.array(*properties)).alias("i", "v"))
    names = F.array(*[F.lit(p) for p in config.HYPOTHESIS_PROPERTIES[1:]])
    lines = rows.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("values")).select(
        F.concat_ws("\t", F.get(names, F.col("i")), F.array_join("values.v", "\t")).alias("value")
    )
    columns = [config.HYPOTHESIS_PROPERTIES[0], *[str(i + 1) for i in range(len(SPECIES))]]
    parsed = config.parse_hypotheses(above(lines, "\t".join(columns)), columns)
    return parsed.select(
        big("hypothesis"), "name", F.array_join("expanded_in", ";").alias("expanded_in"), F.array_join("compared_to", ";").alias("compared_to"),
        big("Nmin_compared_to"), "min_expansion_factor", "ploidy_normalization", "compared_to_all_found",
    )
