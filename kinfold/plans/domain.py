"""Domain inputs as projections of the star-schema tables.

Each function reads only the columns it needs. An order is a gene, twenty consecutive orders
are a family, the customer's region is the species; parts give terms and transcripts, line
items give similarity hits and counts, documents and conversations give sequences and reads,
events give alignments. Everything grows with the tables.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.sources.config import Hypothesis

SPECIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE_EAST"]
EXPRESSED = SPECIES[:4]
PLOIDY = {"AFRICA": 2, "AMERICA": 2, "ASIA": 4, "EUROPE": 2, "MIDDLE_EAST": 6}
FDR = 0.1
ADDED_FAMILIES = 3
HYPOTHESES = [
    Hypothesis(1, "AFRICA against two", ("AFRICA",), ("AMERICA", "ASIA"), 1, 2, 2.0, 4.0, 2, True),
    Hypothesis(2, "AFRICA or EUROPE against AMERICA", ("AFRICA", "EUROPE"), ("AMERICA",), 1, 1, 2.0, 4.0, 1),
    Hypothesis(3, "AFRICA against three", ("AFRICA",), ("AMERICA", "ASIA", "MIDDLE_EAST"), 1, 1, 2.0, 100.0, 2),
    Hypothesis(4, "ASIA against the unmeasured", ("ASIA",), ("MIDDLE_EAST",), 1, 1, 2.0, 4.0, 2,
               expanded_in_all_found=True, compared_to_all_found=True),
]
SAMPLES = ["A_F", "A_O", "N_F", "N_O", "R_F", "R_O"]
CONDITION = {s: s[-1] for s in SAMPLES}
CHILDREN_PER_FAMILY = 20
# Quality of a character: its code modulo 42 for plain text, its own code for other letters.
QUALITY_FROM = "\n" + "".join(chr(c) for c in range(32, 127))
QUALITY_TO = "".join(chr(33 + ord(c) % 42) for c in QUALITY_FROM)


def _gene(key: str) -> Column:
    return F.concat(F.lit("g"), F.col(key).cast("string"))


def _hog(key: str) -> Column:
    return F.concat(F.lit("HOG"), F.floor(F.col(key) / CHILDREN_PER_FAMILY).cast("string"))


def _cents(key: str) -> Column:
    return F.round(F.col(key) * 100).cast("long")


@lru_cache(maxsize=8)
def _domain(application: str, spark: SparkSession, folder: str) -> Domain:
    return Domain(spark, folder)


def domain(spark: SparkSession, folder: str) -> Domain:
    """The domain of a folder; a session looks up files and schemas once."""
    return _domain(spark.sparkContext.applicationId, spark, folder.rstrip("/"))


class Domain:
    """Lazy domain tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def genes(self) -> DataFrame:
        """(key, gene, hog_of_block, species, status, priority, price)."""
        species = (
            self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.translate("r_name", " ", "_").alias("species"))
        )
        customers = self.table("customer").join(species, F.col("c_nationkey") == F.col("n_nationkey"))
        return self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("key"),
            _gene("o_orderkey").alias("gene"),
            _hog("o_orderkey").alias("hog"),
            "species",
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_totalprice").alias("price"),
        )

    @cached_property
    def hog_genes(self) -> DataFrame:
        """Genes without a stated priority belong to no family."""
        return self.genes.filter(F.col("priority") != "4-NOT SPECIFIED").select("hog", "species", "gene")

    @cached_property
    def de(self) -> DataFrame:
        """Results of the measured species; genes of pending orders have no adjusted p-value."""
        change = (F.round("price").cast("long") % 801 - 400) / 100
        return self.genes.filter(F.col("species").isin(EXPRESSED)).select(
            "species",
            "gene",
            F.col("price").alias("baseMean"),
            change.alias("log2FoldChange"),
            F.lit(0.5).alias("lfcSE"),
            (change / 0.5).alias("stat"),
            ((_cents("price") % 100000) / 100000).alias("pvalue"),
            F.when(F.col("status") != "P", (_cents("price") % 1000) / 1000).alias("padj"),
        )

    @cached_property
    def family(self) -> DataFrame:
        """Family p-values: share of finished urgent orders; families without urgent ones have none."""
        urgent = self.table("orders").filter(F.col("o_orderpriority") == "1-URGENT")
        return urgent.groupBy(_hog("o_orderkey").alias("hog")).agg(
            (F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("pvalue")
        )

    @cached_property
    def hits(self) -> DataFrame:
        """A line item is a hit of its order on a gene given by part and line; every gene hits itself."""
        found = self.table("lineitem").select(
            F.concat(F.lit("q"), F.col("l_orderkey").cast("string")).alias("qseqid"),
            F.concat(F.lit("q"), (F.col("l_partkey") * 7 + F.col("l_linenumber")).cast("string")).alias("sseqid"),
            (F.col("l_quantity") + 50).alias("pident"),
            (F.col("l_discount") * 1e-2).alias("evalue"),
            (F.col("l_extendedprice") / 100).alias("bitscore"),
        )
        itself = self.table("orders").select(
            F.concat(F.lit("q"), F.col("o_orderkey").cast("string")).alias("qseqid"),
            F.concat(F.lit("q"), F.col("o_orderkey").cast("string")).alias("sseqid"),
            F.lit(100.0).alias("pident"),
            F.lit(0.0).alias("evalue"),
            F.col("o_totalprice").alias("bitscore"),
        )
        return found.unionByName(itself)

    @cached_property
    def id_map(self) -> DataFrame:
        """Names of all sequences but those of pending low-priority orders."""
        named = (F.col("o_orderpriority") != "5-LOW") | (F.col("o_orderstatus") != "P")
        return self.table("orders").filter(named).select(
            F.concat(F.lit("q"), F.col("o_orderkey").cast("string")).alias("seqid"), _gene("o_orderkey").alias("name")
        )

    @cached_property
    def annotation(self) -> DataFrame:
        """Sorted distinct brands of an order's parts; undiscounted lines and empty orders give NA."""
        brand = self.table("part").select("p_partkey", "p_brand")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_discount").join(
            brand, F.col("l_partkey") == F.col("p_partkey")
        )
        term = F.when(F.col("l_discount") == 0, F.lit("NA")).otherwise(F.col("p_brand"))
        terms = lines.groupBy(F.col("l_orderkey").alias("key")).agg(
            F.array_join(F.sort_array(F.collect_set(term)), ", ").alias("terms")
        )
        return self.genes.join(terms, "key", "left").select(
            "species", "gene", F.coalesce("terms", F.lit("NA")).alias("terms")
        )

    @cached_property
    def counts(self) -> DataFrame:
        """Quantities per part, return flag and status; the status is the condition."""
        return self.table("lineitem").groupBy(
            F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("gene"),
            F.concat_ws("_", "l_returnflag", "l_linestatus").alias("sample"),
        ).agg(F.sum("l_quantity").cast("long").alias("count"))

    @cached_property
    def sequences(self) -> DataFrame:
        """Documents as records; French ones carry no gene tag and German ones two."""
        tag = F.concat(F.lit(" gene:"), F.col("source"), F.lit("."), F.col("lang"))
        tags = F.when(F.col("lang") == "fr", "").when(F.col("lang") == "de", F.concat(tag, F.lit(" locus:x"))).otherwise(tag)
        return self.table("documents").select(
            F.col("source").alias("file"),
            F.col("doc_id").alias("ord"),
            F.concat(F.col("doc_id").cast("string"), tags).alias("header"),
            F.col("text").alias("sequence"),
        )

    @cached_property
    def gene_sequences(self) -> DataFrame:
        """A sequence per gene, spelled by the hash of its order key."""
        return self.table("orders").select(
            _gene("o_orderkey").alias("gene"), F.md5(F.col("o_orderkey").cast("string")).alias("sequence")
        )

    def _reads(self, rows: DataFrame, text: str) -> DataFrame:
        quality = F.translate(text, QUALITY_FROM, QUALITY_TO)
        return rows.withColumn("qual", quality).withColumnRenamed(text, "seq")

    @cached_property
    def reads(self) -> DataFrame:
        """Single reads: whole documents per language, with qualities told by their characters."""
        rows = self.table("documents").select(
            F.col("lang").alias("sample"), F.col("doc_id").cast("string").alias("read_id"), F.lit(1).alias("mate"), "text"
        )
        return self._reads(rows, "text")

    @cached_property
    def paired_reads(self) -> DataFrame:
        """Turns of a conversation, two by two."""
        rows = self.table("conversations").select(
            F.lit("talk").alias("sample"),
            F.concat_ws("_", F.col("conv_id").cast("string"), F.floor(F.col("turn") / 2).cast("string")).alias("read_id"),
            (F.col("turn") % 2 + 1).cast("int").alias("mate"),
            "text",
        )
        return self._reads(rows, "text")

    @cached_property
    def alignments(self) -> DataFrame:
        """Two events are the mates of a read; every fifth event hits a second place an hour later, every seventh covers a long stretch."""
        start = F.unix_seconds(F.to_timestamp("ts"))
        pair = F.floor(F.col("event_id") / 2)
        length = F.when(F.col("event_id") % 7 == 0, 20_100).otherwise(100)
        second = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        rows = self.table("events").select(
            F.concat(F.lit("s"), (pair % 3).cast("string")).alias("sample"), F.col("event_type").alias("chrom"), pair.alias("read_id"),
            start.alias("first"), length.alias("length"), F.explode(second).alias("hit_index"),
        )
        begin = F.col("first") + (F.col("hit_index") - 1) * 3600
        return rows.select("sample", "chrom", "read_id", "hit_index", begin.alias("start"), (begin + F.col("length")).alias("end"))

    @cached_property
    def exons(self) -> DataFrame:
        """Half-hour features at the full hours in which a type was seen."""
        hour = F.floor(F.unix_seconds(F.to_timestamp("ts")) / 3600) * 3600
        seen = self.table("events").select("event_type", hour.alias("hour")).distinct()
        return seen.select(
            F.col("event_type").alias("chrom"),
            F.col("hour").alias("start"),
            (F.col("hour") + 1799).alias("end"),
            F.concat_ws("_", "event_type", F.floor(F.col("hour") / 7200).cast("string")).alias("gene_id"),
        )

    @cached_property
    def trees(self) -> DataFrame:
        return self.trees_by_status("F")

    def trees_by_status(self, status: str) -> DataFrame:
        """One Newick text per family: with this status or not, then species, then gene."""
        leaves = self.genes.filter(F.col("priority") != "4-NOT SPECIFIED").select(
            "hog", (F.col("status") == status).alias("side"), "species",
            _cents("price").alias("length"),
            F.concat("gene", F.lit(":"), _cents("price").cast("string")).alias("leaf"),
        )

        def clade(df: DataFrame, by: list[str], child: str, out: str) -> DataFrame:
            inside = F.array_join(F.sort_array(F.collect_list(child)), ",")
            stem = F.max("length").cast("string")
            return df.groupBy(*by).agg(
                F.max("length").alias("length"), F.concat(F.lit("("), inside, F.lit("):"), stem).alias(out)
            )

        species = clade(leaves, ["hog", "side", "species"], "leaf", "species_clade")
        sides = clade(species, ["hog", "side"], "species_clade", "side_clade")
        return sides.groupBy("hog").agg(
            F.concat(F.lit("("), F.array_join(F.sort_array(F.collect_list("side_clade")), ","), F.lit(");")).alias("newick"),
        ).select(F.col("hog").alias("tree_id"), "newick")

    @cached_property
    def edges(self) -> DataFrame:
        """Neighbouring genes of one species in a family, weighted by their prices."""
        after = Window.partitionBy("hog", "species").orderBy("key")
        rows = self.genes.filter(F.col("priority") != "4-NOT SPECIFIED")
        return rows.select(
            F.col("gene").alias("a"), F.lead("gene").over(after).alias("b"),
            (F.sqrt(F.col("price") * F.lead("price").over(after)) / 1000).alias("weight"),
        ).filter(F.col("b").isNotNull())
