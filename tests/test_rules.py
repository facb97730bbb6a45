import random
from fractions import Fraction
from functools import partial
from math import comb, erfc, sqrt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinfold.functions import names, order, stats
from kinfold.operators import annotation, expansion, expression, hits, isoforms, orthogroups, reads, scoring
from kinfold.plans import catalog
from kinfold.sources.config import Hypothesis


def tail(x, n, w, b):
    return float(sum(Fraction(comb(w, k) * comb(b, n - k), comb(w + b, n)) for k in range(x, min(n, w) + 1)))


def test_hypergeometric_tail(spark):
    cases = [(14, 14, 11832, 1238), (3, 10, 50, 450), (300, 900, 1000, 2500), (0, 5, 10, 10), (5, 5, 4, 10), (6, 6, 6, 0),
             (500, 2000, 40000, 160000), (30, 2000, 40000, 160000), (1, 1, 277, 287)]
    df = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(cases)], "i int, x double, n double, w double, b double")
    got = {r.i: r.p for r in stats.with_hypergeom_upper(df, F.col("x"), F.col("n"), F.col("w"), F.col("b"), "p").collect()}
    for i, (x, n, w, b) in enumerate(cases):
        assert got[i] == pytest.approx(tail(x, n, w, b), rel=1e-6), cases[i]
    assert got[0] == pytest.approx(0.248107227483, abs=1e-9)
    assert got[3] == 1.0 and got[5] == 1.0 and got[4] == 0.0


def test_hypergeometric_tail_far_from_the_mean(spark):
    def exact(x, n, w, b):
        return Fraction(sum(comb(w, k) * comb(b, n - k) for k in range(x, min(n, w) + 1)), comb(w + b, n))

    cases = [(x, 60, w, 200 - w) for w in (20, 60, 100, 140, 180) for x in range(0, 61, 3)]
    sure = [(6000, 20000, 50000, 50000), (7000, 20000, 50000, 50000), (41000, 50000, 90000, 10000)]
    rows = [(i, *map(float, c)) for i, c in enumerate(cases + sure)]
    df = spark.createDataFrame(rows, "i int, x double, n double, w double, b double")
    got = {r.i: r.p for r in stats.with_hypergeom_upper(df, F.col("x"), F.col("n"), F.col("w"), F.col("b"), "p").collect()}
    for i, c in enumerate(cases):
        assert got[i] == pytest.approx(float(exact(*c)), rel=1e-8, abs=1e-300), c
    assert [got[len(cases) + i] for i in range(len(sure))] == [1.0] * len(sure)
    middle = spark.createDataFrame([(10000.0, 20000.0, 50000.0, 50000.0)], "x double, n double, w double, b double")
    p = stats.with_hypergeom_upper(middle, F.col("x"), F.col("n"), F.col("w"), F.col("b"), "p").first().p
    assert 0.5 < p < 0.51  # the half above a symmetric centre and half of the centre's own term


def test_half_integers_round_to_even_and_x_is_floored(spark):
    df = spark.createDataFrame([(1.5, 2.5, 31.0, 26.5), (0.5, 1.0, 31.0, 26.5)], "x double, n double, w double, b double")
    p = [r.p for r in stats.with_hypergeom_upper(df, F.col("x"), F.col("n"), F.col("w"), F.col("b"), "p").collect()]
    assert p[0] == pytest.approx(tail(1, 2, 31, 26)) and p[1] == 1.0


def test_fisher_and_normal(spark):
    df = spark.createDataFrame([(0.2, 0.05), (0.0, 0.5), (None, 0.5)], "a double, b double")
    got = [r[0] for r in df.select(stats.fisher_combine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(0.0560517, abs=1e-7) and got[1] == 0.0 and got[2] is None
    for z in (0.0, 0.5, -1.96, 5.0, 12.0):
        value = spark.range(1).select(stats.two_sided_normal(F.lit(z))).first()[0]
        assert value == pytest.approx(erfc(abs(z) / sqrt(2)), rel=1e-6)


def test_buckets_are_monotone(spark):
    values = sorted({s * m * 2.0**e for s in (-1, 1) for e in (-1030, -40, -3, 0, 1, 2, 3, 17, 60) for m in (1.0, 1 + 1e-15, 1.3, 1.999999999999999)} | {0.0})
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", order.value_bucket(F.col("v")).alias("b"))
    rows = sorted(df.collect(), key=lambda r: r.v)
    assert all(x.b <= y.b for x, y in zip(rows, rows[1:]))


HYP = Hypothesis(1, "x", ("A",), ("B", "C"), 1, 1, 2.0, 10.0, 0)
COUNTS = "hog string, A_total long, B_total long, C_total long"


def expanded(spark, hyp, row, mode="reference", ploidy=None):
    df = spark.createDataFrame([("h", *row)], COUNTS)
    ploidy = ploidy or {"A": 2, "B": 2, "C": 2}
    return expansion.expanded_hogs(df, [hyp], ploidy, mode).count() == 1


def test_counter_is_the_last_run_of_passes(spark):
    df = spark.createDataFrame([("pf", 4, 2, 3), ("fp", 4, 3, 2), ("pp", 4, 2, 2)], COUNTS)
    run = expansion.expansion_counter(HYP, "A", {}, "reference").alias("run")
    total = expansion.expansion_counter(HYP, "A", {}, "documented").alias("total")
    assert {r.hog: (r.run, r.total) for r in df.select("hog", run, total).collect()} == {"pf": (0, 1), "fp": (1, 1), "pp": (2, 2)}


def test_expansion_rule(spark):
    one = Hypothesis(1, "x", ("A",), ("B",), 1, 1, 2.0, 10.0, 0)
    assert not expanded(spark, one, (4, 0, 0))
    assert expanded(spark, Hypothesis(1, "x", ("A",), ("B",), 1, 1, 100.0, 10.0, 0), (12, 2, 0))
    four = {"A": 4, "B": 2, "C": 2}
    assert not expanded(spark, Hypothesis(1, "x", ("A",), ("B",), 1, 1, 2.0, 10.0, 0, True), (4, 2, 0), ploidy=four)
    assert expanded(spark, one, (4, 2, 0), ploidy=four)
    assert not expanded(spark, Hypothesis(1, "x", ("A",), ("B",), 1, 1, 2.0, 10.0, 5), (4, 2, 0))
    assert not expanded(spark, Hypothesis(1, "x", ("A",), ("C", "B"), 1, 1, 2.0, 10.0, 0, compared_to_all_found=True), (4, 2, 0))


def test_flags_singletons_and_families(spark):
    de = spark.createDataFrame([("A", "g1", None), ("A", "g2", 0.05), ("A", "g3", 0.1), ("A", "g4", 0.2)], "species string, gene string, padj double")
    hog_genes = spark.createDataFrame([("h", "A", "g2"), ("h", "B", "g9")], "hog string, species string, gene string")
    rows = {r.gene: r for r in expression.significance_flag(expression.de_with_hog(de, hog_genes), 0.1).collect()}
    assert [rows[g].significant for g in ("g1", "g2", "g3", "g4", "g9")] == ["no", "yes", "no", "no", "no"]
    assert rows["g1"].hog == "singleton" and rows["g9"].species is None and rows["g9"].hog == "h"


def test_family_p_and_sizes(spark):
    level = spark.createDataFrame([("a",), ("b",), ("c",)], "hog string")
    family = spark.createDataFrame([("a", 0.0), ("b", 0.3)], "hog string, pvalue double")
    assert {r.hog: r.cafe_pvalue for r in scoring.hog_with_family_p(level, family).collect()} == {"a": 0.001, "b": 0.3, "c": None}
    assert scoring.default_family_pvalues(level).first().pvalue == 0.999
    sizes = spark.createDataFrame([("k", 99, 1, 1), ("r", 100, 1, 1)], COUNTS)
    assert [r.hog for r in orthogroups.family_size_filter(sizes, HYP).collect()] == ["k"]


def test_first_seen_order(spark):
    q, s = "abcde", "bgccf"
    rows = [(1, "h", q[i], s[i], q[i], s[i], 1e-9 * (i + 1), 50.0, 90.0) for i in range(5)]
    touching = spark.createDataFrame(rows, "hypothesis int, hog string, qseqid string, sseqid string, qseqid_name string, sseqid_name string, evalue double, bitscore double, pident double")
    members = spark.createDataFrame([(1, "h", g) for g in "abc"], "hypothesis int, hog string, gene string")
    seen = hits.first_seen_genes(touching).orderBy("first_seen").collect()
    assert [r.gene for r in seen] == list("abgcdef")
    assert [r.gene for r in hits.extended_genes(touching, members, 9).orderBy("rank").collect()] == list("gdef")
    assert [r.gene for r in hits.extended_genes(touching, members, 2).orderBy("rank").collect()] == list("gd")


MEMBERS = "hypothesis int, hog string, gene string"


def test_hits_meet_families_once_per_end(spark):
    found = spark.range(97).selectExpr(
        "concat('q', id % 9) qseqid", "concat('q', id % 11) sseqid", "id * 1e-9 evalue", "50.0 bitscore", "90.0 pident")
    id_map = spark.createDataFrame([(f"q{i}", f"g{i}") for i in range(10)], "seqid string, name string")
    members = spark.createDataFrame([(h, "h", f"g{i}") for h in (1, 2) for i in range(3)], MEMBERS)
    plan = hits.hits_touching(found, id_map, members)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 97") == 1  # the hits are read and dealt once, not once per end
    assert plan.count("Exchange hashpartitioning(qseqid") == plan.count("Exchange hashpartitioning(sseqid") == 2
    assert "Broadcast" not in plan  # every sequence has a row there


def test_hits_touching_with_missing_and_repeated_names(spark):
    pairs = [("q1", "q2"), ("q2", "q1"), ("q1", "q1"), ("q3", "q2"), ("q5", "q6"), ("q9", "q1"), ("q4", None), (None, "q4"), ("q4", "q4"), ("q1", "q2")]
    found = [(q, s, i * 1e-9, 50.0, 90.0) for i, (q, s) in enumerate(pairs)]
    names = [("q1", "a"), ("q2", "b"), ("q2", "x"), ("q2", "b"), ("q3", None), ("q4", "d"), ("q5", "e"), ("q6", "a"), (None, "a")]
    members = [(1, "h", "a"), (1, "h", "b"), (2, "h", "a"), (1, "k", "b"), (1, "h", "a"), (1, None, "d"), (1, "h", None), (1, "m", "z")]
    want = []
    for q, s, *_ in found:
        for qn in [n for i, n in names if i == q and q is not None] or [None]:
            for sn in [n for i, n in names if i == s and s is not None] or [None]:
                mine = {m[:2] for m in members if qn is not None and m[2] == qn}
                other = {m[:2] for m in members if sn is not None and m[2] == sn}
                want += [(*f, q, s, qn, sn) for f in [*mine, *(f for f in other if f not in mine or f[1] is None)]]
    touching = hits.hits_touching(
        spark.createDataFrame(found, "qseqid string, sseqid string, evalue double, bitscore double, pident double"),
        spark.createDataFrame(names, "seqid string, name string"), spark.createDataFrame(members, MEMBERS))
    columns = ["hypothesis", "hog", "qseqid", "sseqid", "qseqid_name", "sseqid_name"]
    assert touching.columns == [*columns[:4], "evalue", "bitscore", "pident", *columns[4:]]
    assert sorted(map(str, touching.select(columns).collect())) == sorted(map(str, spark.createDataFrame(want, touching.select(columns).schema).collect()))


@pytest.mark.parametrize("heavy", [2, 1 << 20])
def test_first_seen_genes_ranks_each_value_once(spark, tmp_path, monkeypatch, heavy):
    tables = {
        "region": spark.sql("select 0 r_regionkey, 'ASIA' r_name union all select 1, 'MIDDLE EAST'"),
        "nation": spark.range(2).selectExpr("id n_nationkey", "id n_regionkey"),
        "customer": spark.range(2).selectExpr("id c_custkey", "id c_nationkey"),
        "orders": spark.range(40).selectExpr(
            "id o_orderkey", "if(id % 20 < 12, 0, 1) o_custkey", "'F' o_orderstatus", "'1-URGENT' o_orderpriority", "100.0 + id o_totalprice"),
        "lineitem": spark.range(60).selectExpr(
            "id % 20 l_orderkey", "2 + id % 3 l_partkey", "id % 7 l_linenumber", "1.0 l_quantity", "0.05 l_discount", "300.0 + id l_extendedprice"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    ranked = []
    monkeypatch.setattr(hits, "full_rank", partial(order.full_rank, heavy=heavy))
    monkeypatch.setattr(order, "cut_lineage", lambda df: ranked.append(df) or df)
    got = catalog.QUERIES["first_seen_genes"](spark, str(tmp_path)).collect()
    assert dict(ranked[0].dtypes).keys() == {"hypothesis", "hog", "gene", "evalue", "bitscore", "pident", "qseqid", "sseqid", "side"}
    assert not any(t.startswith("struct") for _, t in ranked[0].dtypes)  # the key of the minimum is not kept beside its parts
    places = {}
    for r in got:
        places.setdefault((r.hypothesis, r.hog), []).append((r.place, r.gene))
    # own hits come first, by falling score
    assert {k: [g for _, g in sorted(v)[:20]] for k, v in places.items()} == {
        (4, f"HOG{f}"): [f"g{i}" for i in range(20 * f + 19, 20 * f - 1, -1)] for f in (0, 1)}


def test_isoforms(spark):
    seqs = spark.createDataFrame(
        [("f", 1, "a gene:G", "AAAAA"), ("f", 2, "b gene:G", "CCCCC"), ("f", 3, "c gene:G", "AAA"), ("f", 4, "x gene:G1 locus:L1", "A"),
         ("f", 5, "e gene=H=2", ""), ("f", 6, "none", "AC")], "file string, ord int, header string, sequence string")
    rows = isoforms.longest_isoform(seqs).orderBy("ord").collect()
    assert [(r.ord, r.header) for r in rows] == [(1, "G"), (4, "x gene:G1 locus:L1"), (6, "none")]
    head = spark.createDataFrame([("XP_1.1 kinase 2-like isoform X1 [P p]",), ("XP_2.1 kinase [P p]",)], "h string")
    assert [r[0] for r in head.select(names.isoform_free_title(F.col("h"))).collect()] == ["kinase 2-like [P p]", "XP_2.1 kinase [P p]"]
    assert [r[0] for r in head.select(names.is_refseq_header(F.col("h"))).collect()] == [True, True]


def test_clean_terms(spark):
    df = spark.createDataFrame([(1, "NA, GO:1"), (2, "GO:1, NA"), (3, "NA"), (4, None)], "i int, terms string")
    assert [(r.i, r.terms) for r in annotation.clean_terms(df).orderBy("i").collect()] == [(1, "GO:1"), (2, "GO:1")]


def test_random_sample(spark):
    ids = spark.range(500).selectExpr("cast(id as string) gene")
    once, again = (sorted(r.gene for r in annotation.random_sample(ids, "gene", 40, 3).collect()) for _ in range(2))
    assert len(set(once)) == 40 and once == again
    assert once != sorted(r.gene for r in annotation.random_sample(ids, "gene", 40, 4).collect())
    for n in (0, 7, 500, 1000, 2000):
        df = spark.range(1000).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("gene"))
        want = [r.gene for r in df.orderBy(F.md5(F.concat_ws("|", "gene", F.lit("5"))), "gene").limit(n).collect()]
        for last in (1, 10_000):
            assert sorted(r.gene for r in annotation.random_sample(df, "gene", n, 5, last).collect()) == sorted(want)


def test_trimming_and_adapters(spark):
    good, bad = "I" * 45, "!" * 4
    rows = [("s", "a", 1, "A" * 49, good + bad), ("s", "b", 1, "A" * 49, bad + good), ("s", "c", 1, "A" * 45, good)]
    df = spark.createDataFrame(rows, "sample string, read_id string, mate int, seq string, qual string")
    kept = {r.read_id: (len(r.seq), len(r.qual)) for r in reads.read_quality_trim(df).collect()}
    # the first window with three zeros begins at base 45: mean 10 is below 20
    assert kept == {"a": (44, 44), "c": (45, 45)}
    adapter = "GATCGGAAGAGCACACGTCT"
    texts = {
        "hit": "ACGTAC" + adapter, "two_off": "ACGTAC" + "CATCGGAAGAGCACACGTCT", "three_off": "ACGTAC" + "CTACGGAAGAGCACACGTCT",
        "over_the_end": "ACGTAC" + adapter[:18], "too_short_at_the_end": "ACGTAC" + adapter[:12], "short": "ACG", "none": None, "no_quality": "AC" + adapter,
    }
    rows = [("s", k, 1, t, None if k == "no_quality" or t is None else "+" * len(t)) for k, t in texts.items()]
    df = spark.createDataFrame(rows, "sample string, read_id string, mate int, seq string, qual string")
    clipped = {r.read_id: (r.seq and len(r.seq), r.clipped) for r in reads.adapter_clip(df, [adapter, "TTTTT"]).collect()}
    assert clipped == {
        "hit": (6, True), "two_off": (6, True), "three_off": (26, False), "over_the_end": (6, True), "too_short_at_the_end": (18, False),
        "short": (3, False), "none": (None, None), "no_quality": (2, True),
    }
    short = spark.createDataFrame([("s", "r", 1, "ACTTTTTAC", "I" * 9), ("s", "q", 1, "ACTTTT", "I" * 6)], df.schema)
    assert {r.read_id: len(r.seq) for r in reads.adapter_clip(short, [adapter, "TTTTT"]).collect()} == {"r": 2, "q": 6}


def test_reads_are_searched_in_pieces_of_bounded_size(monkeypatch):
    """Hits on either side of an edge between pieces, and no array longer than a piece and what is seen beyond it."""
    monkeypatch.setattr(reads, "PIECE", 8)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, "", "a" * 500 + "bab"]
    longest = []

    def found(pieces):
        joined = "".join(pieces)
        longest.append(len(joined))
        ends = np.repeat(np.cumsum([len(p) for p in pieces]), [len(p) for p in pieces])
        return np.array([i for i in range(len(joined)) if joined[i : i + 3] == "bab" and i + 3 <= ends[i]], dtype=np.int64)

    got = reads._first_places([pd.Series(texts, dtype=object)], 2, found).tolist()
    assert got == [len(t or "") if "bab" not in (t or "") else t.index("bab") for t in texts]
    assert max(longest) <= 2 * (8 + 2 * 8)


def test_trimming_passes_reads_without_qualities(spark):
    rows = [("s", "a", 1, "A" * 50, None), ("s", "b", 1, None, None), ("s", "c", 1, "A" * 50, "I" * 45 + "!" * 5), ("s", "d", 1, "", ""), ("s", "e", 1, "A" * 60, "I" * 60)]
    df = spark.createDataFrame(rows, "sample string, read_id string, mate int, seq string, qual string")
    assert {r.read_id: len(r.seq) for r in reads.read_quality_trim(df).collect()} == {"a": 50, "c": 44, "e": 60}


@pytest.mark.parametrize("heavy", [2, 1 << 20])
def test_ranks_keep_missing_values_last(spark, heavy):
    rows = [(1, "h", 1e-9, 5.0), (1, "h", None, 9.0), (1, "h", 0.0, None), (1, "h", 0.0, 7.0), (1, "h", 1e-9, 6.0), (1, "h", None, None)]
    df = spark.createDataFrame(rows, "g int, h string, e double, s double")
    ranked = order.full_rank(df, ["g", "h"], "e", "s", [F.col("e").asc_nulls_last(), F.col("s").desc_nulls_last()], heavy=heavy)
    assert [(r.e, r.s) for r in ranked.orderBy("rank").collect()] == [(0.0, 7.0), (0.0, None), (1e-9, 6.0), (1e-9, 5.0), (None, 9.0), (None, None)]


def test_gene_sets_grow_and_singletons_are_numbered(spark):
    rows = [(1, "h", "q", s, "q", s, i * 1e-9, 50.0, 90.0) for i, s in enumerate(["m1", "x", "o1", "y", "p1"])]
    touching = spark.createDataFrame(rows, "hypothesis int, hog string, qseqid string, sseqid string, qseqid_name string, sseqid_name string, evalue double, bitscore double, pident double")
    hog_genes = spark.createDataFrame([("h", "A", "m1"), ("h", "B", "m2"), ("o", "A", "o1"), ("p", "A", "p1"), ("p", "B", "p2")], "hog string, species string, gene string")
    best = hits.best_hit_per_subject(hits.hits_to_hog(touching, hog_genes))
    closest = hits.closest_hogs(best, 3)
    assert [r.closest for r in closest.orderBy("rank").collect()] == ["h", "singleton-1", "o", "singleton-2"]
    sets = {}
    for r in hits.cumulative_gene_sets(closest, hog_genes).collect():
        sets.setdefault(r.set_num, set()).add(r.gene)
    assert sets == {1: {"m1", "m2"}, 2: {"m1", "m2", "x"}, 3: {"m1", "m2", "x", "o1"}, 4: {"m1", "m2", "x", "o1", "y"}}
    padded = hits.pad_sets(hits.cumulative_gene_sets(closest, hog_genes), spark.createDataFrame([(1, "h")], "hypothesis int, hog string"), 5)
    assert [r.n_genes for r in padded.orderBy("set_num").collect()] == [2, 3, 4, 5, 0, 0]


def test_hot_family_keeps_every_rank(spark):
    n = 3000
    rows = spark.range(n).selectExpr(
        "1 hypothesis", "'h' hog", "concat('q', id) qseqid", "concat('s', id % 17) sseqid",
        "case when id % 3 = 0 then 0.0 else (id % 50) * 1e-7 end evalue", "cast(id % 101 as double) bitscore", "cast(id % 7 as double) pident")
    got = {r.qseqid: r["rank"] for r in hits.rank_hits(rows).collect()}
    want = sorted(rows.collect(), key=lambda r: (r.evalue, -r.bitscore, -r.pident, r.qseqid, r.sseqid))
    assert got == {r.qseqid: i + 1 for i, r in enumerate(want)}


def test_orthology_from_counts_equals_orthology_from_pairs(spark):
    genes = [("h1", "A", "a1"), ("h1", "A", "a2"), ("h1", "B", "b1"), ("h2", "A", "a3"), ("h2", "B", "b2"), ("h3", "A", "a4"), ("h3", "B", "b3"), ("h3", "B", "b4")]
    df = spark.createDataFrame(genes, "hog string, species string, gene string")
    by_counts = orthogroups.species_pair_orthology(orthogroups.hog_counts(df, ["A", "B"]), ["A", "B"])
    a, b = df.selectExpr("hog", "species species_a", "gene gene_a"), df.selectExpr("hog", "species species_b", "gene gene_b")
    by_pairs = orthogroups.pair_orthology(a.join(b, "hog").filter("species_a <> species_b"))
    columns = ["species_a", "species_b", "n", "one_one", "one_many", "many_one", "many_many"]
    rows = sorted(tuple(r) for r in by_counts.select(*columns).collect())
    assert rows == sorted(tuple(r) for r in by_pairs.select(*columns).collect())
    assert rows[0] == ("A", "B", 4, 1, 1, 2, 0)
