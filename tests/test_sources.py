import gzip

import pytest

from kinfold.sources import config, features, newick, sequences, sinks, tables


def put(path, text):
    path.write_text(text)
    return str(path)


def test_hypotheses_are_transposed_and_typed(spark, tmp_path):
    path = put(tmp_path / "h.tsv", (
        "hypothesis\t1\t2\nname\t\"A vs B\"\t\"A vs C\"\nexpanded_in\tA\tA\ncompared_to\tB;C\tC\n"
        "Nmin_expanded_in\t1\t1\nNmin_compared_to\t2\t1\nmin_expansion_factor\t2\t2\nmin_expansion_difference\t10\t10\n"
        "Nmin_expanded_genes\t2\t2\nploidy_normalization\tYES\tNO\nexpanded_in_all_found\tYES\tNO\ncompared_to_all_found\tNO\tNO\n"))
    one, two = config.read_hypotheses(spark, path)
    assert (one.expanded_in, one.compared_to, one.min_compared_to, one.factor) == (("A",), ("B", "C"), 2, 2.0)
    assert one.ploidy_normalization and one.expanded_in_all_found and not one.compared_to_all_found
    assert two.name == "A vs C" and not two.ploidy_normalization
    assert config.all_hypothesis_species([one, two]) == ["A", "B", "C"]


def test_hypothesis_ids_without_gaps(spark, tmp_path):
    path = put(tmp_path / "h.tsv", "hypothesis\t2\nname\tx\nexpanded_in\tA\ncompared_to\tB\nNmin_expanded_in\t1\nNmin_compared_to\t1\n")
    with pytest.raises(ValueError):
        config.read_hypotheses(spark, path)


def test_species_samples_and_routes(spark, tmp_path):
    sp = config.read_species(spark, put(tmp_path / "s.tsv", (
        "species\tploidy\tpep_fasta\tcDNA_fasta\tgen_fasta\tannotation\tfunction\n"
        "A\t2\ta.fa\t\tg.fa\ta.gtf\tAHRD\nB\t4\tb.fa\tc.fa\t\tb.gtf\tb.tsv\nC\t2\tc.fa\t\t\tc.gtf\tc.tsv\n")))
    assert config.ploidy_map(sp) == {"A": 2, "B": 4, "C": 2}
    sheet = "species\tsample\tunit\tcondition\tfq1\tfq2\tfragment_length_mean\tfragment_length_sd\n"
    samples = config.read_samples(spark, put(tmp_path / "m.tsv", sheet + "A\tx\tu1\tc\t1.fq\t\t100\t15\nB\tx\tu2\tc\t1.fq\t2.fq\t\t\n"))
    rows = {r["sample_id"]: r for r in config.sample_route(sp, samples).collect()}
    assert rows["x_u1"]["layout"] == "single" and rows["x_u1"]["genomic"] and rows["x_u1"]["annotation_generated"]
    assert rows["x_u2"]["layout"] == "paired" and not rows["x_u2"]["genomic"] and rows["x_u2"]["transcriptomic"]
    with pytest.raises(ValueError):
        config.read_samples(spark, put(tmp_path / "d.tsv", sheet + "A\tx\tu1\tc\t1\t\t\t\nB\tx\tu1\tc\t2\t\t\t\n"))


def test_natural_sort(spark):
    df = spark.createDataFrame([("hypothesis_10",), ("hypothesis_2",), ("hypothesis_1",)], "n string")
    assert [r.n for r in config.natural_sort(df, "n").collect()] == ["hypothesis_1", "hypothesis_2", "hypothesis_10"]


def test_hits_and_id_maps(spark, tmp_path):
    put(tmp_path / "b1.txt", "0_0\t1_1\t99.5\t10\t0\t0\t1\t10\t1\t10\t1e-30\t200\n")
    put(tmp_path / "b2.txt", "1_1\t0_0\t99.5\t10\t0\t0\t1\t10\t1\t10\t0.0\t201\n")
    hits = tables.read_hits(spark, str(tmp_path / "b*.txt"))
    assert {(r.qseqid, r.evalue, r.bitscore) for r in hits.collect()} == {("0_0", 1e-30, 200.0), ("1_1", 0.0, 201.0)}
    path = put(tmp_path / "ids.txt", "0_0: gene(1):a,b extra\n0_1: g2\n")
    assert {(r.seqid, r.name) for r in tables.read_id_map(spark, path).collect()} == {("0_0", "gene(1):a,b"), ("0_1", "g2")}
    assert ("0_0", "gene_1__a_b extra") in {(r.seqid, r.name) for r in tables.read_id_map(spark, path, "full").collect()}
    assert ("0_0", "gene_1__a_b") in {(r.seqid, r.name) for r in tables.read_id_map(spark, path, "first_word").collect()}
    with pytest.raises(ValueError):
        tables.read_id_map(spark, put(tmp_path / "dup.txt", "0_0: a\n0_0: b\n"), "full")
    with pytest.raises(ValueError):
        tables.read_id_map(spark, put(tmp_path / "dup2.txt", "0_0: a x\n0_1: a y\n"), "first_word")
    assert tables.read_id_map(spark, put(tmp_path / "ok.txt", "0_0: a x\n1_1: a y\n"), "first_word").count() == 2


def test_wide_orthogroups(spark, tmp_path):
    from kinfold.operators import orthogroups

    path = put(tmp_path / "N0.tsv", "HOG\tOG\tGene Tree Parent Clade\tA\tB\nh1\to1\tn0\ta1, a2,a3\t\nh2\to2\tn0\t\tb1\n")
    wide = tables.read_orthogroups(spark, path)
    long = orthogroups.hog_genes_long(wide)
    assert {tuple(r) for r in long.collect()} == {("h1", "A", "a1"), ("h1", "A", "a2"), ("h1", "A", "a3"), ("h2", "B", "b1")}
    counted = {r["HOG"]: (r["A"], r["B"]) for r in orthogroups.wide_gene_count(wide).collect()}
    assert counted == {"h1": (3, 0), "h2": (0, 1)}
    counts = {r.hog: (r.A_total, r.B_total) for r in orthogroups.hog_counts(long, ["A", "B"]).collect()}
    assert counts == counted
    parts = orthogroups.orthogroup_wide(long, ["A", "B"])
    assert parts.count() == 2
    dotted = long.replace("A", "Z.mays", "species")
    again = orthogroups.hog_genes_long(orthogroups.orthogroup_wide(dotted, ["Z.mays", "B"]))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in dotted.collect()}
    assert {tuple(r) for r in orthogroups.hog_genes_long(parts).collect()} == {tuple(r) for r in long.collect()}
    plain = tables.read_orthogroups(spark, put(tmp_path / "og.tsv", "Orthogroup\tA\to1\n".replace("\to1", "") + "o1\ta1, a2\n"))
    assert orthogroups.wide_gene_count(plain).first()["A"] == 2


def test_annotation(spark, tmp_path):
    generated = put(tmp_path / "A.ahrd_output.tsv", "# made by x\n\nProtein-Accession\tAHRD-Quality-Code\tGene-Ontology-Term\na1\t***\tGO:1, GO:2\n")
    user = put(tmp_path / "B.func_annotation.tsv", "Protein-Accession\tGene-Ontology-Term\tMore\nb1\tGO:3\tx\n")
    both = tables.read_annotation(spark, {tables.species_of_path(generated): generated}, generated=True).unionByName(
        tables.read_annotation(spark, {tables.species_of_path(user): user}), allowMissingColumns=True)
    assert {(r.species, r.gene, r.terms, r.More) for r in both.collect()} == {("A", "a1", "GO:1, GO:2", None), ("B", "b1", "GO:3", "x")}
    with pytest.raises(ValueError):
        tables.read_annotation(spark, {"C": put(tmp_path / "C.tsv", "Protein-Accession\tX\nc\t1\n")})


def test_counts_quant_and_family_p(spark, tmp_path):
    put(tmp_path / "s_1_counts.txt", "# program\nGeneid\tChr\tStart\tEnd\tStrand\tLength\ts_1.bam\ng1\t1;1\t1;5\t3;9\t+;+\t8\t12\n")
    row = tables.read_count_files(spark, str(tmp_path / "*_counts.txt")).first()
    assert (row["sample"], row.gene, row["count"], row["length"]) == ("s_1", "g1", 12, 8)
    (tmp_path / "s_1").mkdir()
    put(tmp_path / "s_1" / "abundance.tsv", "target_id\tlength\teff_length\test_counts\ttpm\nt1\t100\t80\t5.5\t2\n")
    q = tables.read_quant(spark, str(tmp_path / "*" / "abundance.tsv")).first()
    assert (q["sample"], q.transcript_id, q["count"], q.abundance, q["length"]) == ("s_1", "t1", 5.5, 2.0, 80.0)
    p = tables.read_family_pvalues(spark, put(tmp_path / "fam.txt", "#FamilyID\tpvalue\tmore\nh1\t0.25\ty\n")).first()
    assert (p.hog, p.pvalue) == ("h1", 0.25)
    assert tables.read_fit_rate(spark, put(tmp_path / "fit.txt", "Model\nLambda: 0.0123\n")) == 0.0123
    assert tables.read_fit_rate(spark, put(tmp_path / "nofit.txt", "Model\n")) is None


def test_fasta_keeps_order_over_splits(spark, tmp_path):
    text = "".join(f">r{i} gene:g{i % 7}\n{'ACDE' * (i % 5)}\nAC\n" for i in range(400))
    put(tmp_path / "a.fa", text)
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = sequences.read_fasta(spark, str(tmp_path / "*.fa")).orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    assert [r.id for r in rows] == [f"r{i}" for i in range(400)]
    assert [r.sequence for r in rows] == ["ACDE" * (i % 5) + "AC" for i in range(400)]
    assert rows[0].header == "r0 gene:g0"


@pytest.mark.parametrize(("packed", "end", "split"), [(False, "\n", 1500), (True, "\n", 1500), (False, "\r\n", 900), (False, "\n", 45)])
def test_fastq(spark, tmp_path, packed, end, split):
    text = "".join(f"@r{i} x\nACGT{'A' * (i % 9)}\n+\n@+II{'!' * (i % 9)}\n" for i in range(300)).replace("\n", end) + end
    if packed:
        with gzip.open(tmp_path / "m.fq.gz", "wt") as f:
            f.write(text)
    else:
        (tmp_path / "m.fq").write_bytes(text.encode())
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows = {r.read_id: r for r in sequences.read_fastq(spark, str(tmp_path / "m.fq*")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    assert len(rows) == 300
    assert all(rows[f"r{i}"].seq == "ACGT" + "A" * (i % 9) and rows[f"r{i}"].qual == "@+II" + "!" * (i % 9) for i in range(300))


def test_reads_of_sheet(spark):
    reads = spark.createDataFrame([("/x/a.1.fq", "r1/1"), ("/x/a.2.fq", "r1/2")], "file string, read_id string")
    sheet = spark.createDataFrame([("s", "u", "a.1.fq", "a.2.fq")], "sample string, unit string, fq1 string, fq2 string")
    assert {(r["sample"], r.read_id, r.mate) for r in sequences.reads_of_sheet(reads, sheet).collect()} == {("s_u", "r1", 1), ("s_u", "r1", 2)}


def test_features_in_both_dialects(spark, tmp_path):
    gtf = put(tmp_path / "x.gtf", '#h\n1\ts\texon\t1\t9\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; tag "a"; tag "b";\n'
              '1\ts\texon\t20\t29\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\n')
    gff = put(tmp_path / "x.gff3", "##gff\n1\ts\tmRNA\t1\t9\t.\t+\t.\tID=t2;transcript_id=t2;gene_id=g2;Note=a b=c\n")
    one, two = features.read_features(spark, gtf), features.read_features(spark, gff)
    assert one.first()["attributes"]["tag"] == "a"
    assert two.first()["attributes"] == {"ID": "t2", "transcript_id": "t2", "gene_id": "g2", "Note": "a b=c"}
    assert [tuple(r) for r in features.tx2gene(one).collect()] == [("t1", "g1")]
    assert features.exons(one).count() == 2
    with pytest.raises(ValueError):
        features.read_features(spark, str(tmp_path / "x.bed"))


NEWICK = {
    0: "(A:1,(B:2,C:3)0.9:4);", 1: "(A:1,(B:2,C:3)E:4);", 2: "(A:1,(B:2,C:3)0.9:4);", 3: "(A:1,(B:2,C:3)E:4);",
    4: "(A:1,(B:2,C:3));", 5: "(A:1,(B:2,C:3):4);", 6: "(A,(B,C):4);", 7: "(A:1,(B:2,C:3)E);", 8: "(A,(B,C)E);",
    9: "(A,(B,C));", 100: "(,(,));",
}


@pytest.mark.parametrize("dialect", list(NEWICK))
def test_newick_dialects_round_trip(spark, dialect):
    trees = spark.createDataFrame([("t", NEWICK[dialect])], "tree_id string, newick string")
    nodes = newick.parse_newick(trees, dialect)
    rows = {r.node_id: r for r in nodes.collect()}
    assert [rows[i].parent_id for i in range(5)] == [None, 0, 0, 2, 2]
    assert [rows[i].is_leaf for i in range(5)] == [False, True, False, True, True]
    text = newick.write_newick(nodes, dialect).first()["newick"]
    assert text == NEWICK[dialect].replace("0.9", "0.900000")


def test_newick_errors_features_and_files(spark, tmp_path):
    for text in ("((A,B);", "(A,B)"):
        with pytest.raises(Exception, match="tree t"):
            newick.parse_newick(spark.createDataFrame([("t", text)], "tree_id string, newick string")).collect()
    with pytest.raises(Exception, match="dialect"):
        newick.parse_newick(spark.createDataFrame([("t", "(A,B);")], "tree_id string, newick string"), 5).collect()
    put(tmp_path / "fam1.tre", "(A:0.5[&&NHX:S=x:D=N],\nB);\n")
    rows = {r.name: r for r in newick.read_newick(spark, str(tmp_path / "*.tre")).collect()}
    assert rows["A"].tree_id == "fam1" and rows["A"].features == {"S": "x", "D": "N"} and rows["B"].dist == 1.0


def test_sinks(spark, tmp_path):
    sets = spark.createDataFrame([(1, "h", 1, "a"), (1, "h", 2, "b"), (1, "h", 2, "c")], "hypothesis int, hog string, set_num int, gene string")
    sinks.write_gene_sets(sets, str(tmp_path / "sets"))
    back = spark.read.text(str(tmp_path / "sets"))
    assert {(r.hog, r.set_num, r.value) for r in back.collect()} == {("h", 1, "a"), ("h", 2, "b"), ("h", 2, "c")}
    sinks.write_family_table(sets.select("hog", "gene"), str(tmp_path / "fam"))
    assert spark.read.csv(str(tmp_path / "fam"), sep="\t", header=True).columns == ["hog", "gene"]
    sinks.write_results({"sets": sets}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "sets")).count() == 3


def test_nodes_leave_the_parser_in_small_frames(spark, monkeypatch):
    texts = spark.createDataFrame([(f"t{i}", f"((a:1,b:2):1,c{i}:3);") for i in range(20)], "tree_id string, newick string").coalesce(1)
    want = sorted(map(str, newick.parse_newick(texts).collect()))
    monkeypatch.setattr(newick, "FRAME_NODES", 7)
    frames = newick.parse_newick(texts)
    assert sorted(map(str, frames.collect())) == want and len(want) == 100
