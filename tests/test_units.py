"""Literal unit fixtures (FIXTURES.md §3): genotype edges, allele indices, letters, depth filter,
candidate-edge branches, sex call rows."""
from pyspark.sql import functions as F

from baflow.operators import call as K
from baflow.operators import phase as H
from baflow.operators import pileup as P
from baflow.operators import signals as S
from baflow.operators.fit import nearest_corner


def test_genotype_edges(spark):
    df = spark.createDataFrame([(0.1,), (0.9,), (0.5,), (0.0,), (0.1000001,)], "baf double")
    got = [r[0] for r in H.call_genotype(df).select("genotype").collect()]
    assert got == ["0/0", "1/1", "0/1", "0/0", "0/1"]


def test_allele_index_out_of_range_is_null(spark):
    counts = spark.createDataFrame(
        [("s", k, "1", 1, 10, 20, 30, 40, 100) for k in ("tumour", "normal")],
        "sample_id string, sample_kind string, chrom string, position int, count_a int, count_c int, "
        "count_g int, count_t int, good_depth int")
    loci = spark.createDataFrame([("1", 1, 0, 5), ], "chrom string, position int, a0 int, a1 int")
    r = S.allele_pair_counts(counts, loci).collect()[0]
    assert r["mut_count1"] is None and r["mut_count2"] is None
    more = loci.union(spark.createDataFrame([("1", 2, 1, 4), ("1", 3, None, 2), ("2", 1, 3, 1)], loci.schema))
    assert sorted(map(tuple, S.allele_quality(more).collect())) == [("1", 3, 2), ("2", 1, 0)]
    assert S.allele_quality(loci.where("false")).count() == 0
    loci2 = spark.createDataFrame([("1", 1, 2, 4)], "chrom string, position int, a0 int, a1 int")
    r = S.allele_pair_counts(counts, loci2).collect()[0]
    assert (r["mut_count1"], r["mut_count2"], r["total_normal"]) == (20, 40, 60)


def test_depth_filter_edges(spark):
    df = spark.createDataFrame([(10, 1), (9, 5), (10, 0), (0, 0)], "total_normal int, total_tumour int")
    assert S.min_depth(df, 10).count() == 1
    assert S.min_depth(df, 0).count() == 4


def test_letters_outside_acgt_count_zero(spark):
    counts = spark.createDataFrame([("s", "tumour", "1", 5, 1, 2, 3, 4)],
                                   "sample_id string, sample_kind string, chrom string, position int, count_a int, "
                                   "count_c int, count_g int, count_t int")
    haps = spark.createDataFrame([("1", 5, "N", "G", 0, 1)],
                                 "chrom string, position int, ref string, alt string, allele1 int, allele2 int")
    r = H.het_baf(counts, haps, 1).collect()[0]
    assert r["baf"] == 1.0   # ref N counts 0, alt G counts 3


def test_edge_branches(spark):
    # (l, logr, n_major, n_minor) chosen to hit each of the 3 BAF cases x 2 LogR cases, rho = 0.8
    rows = [(0.95, 2.2, 0.3), (0.95, 2.9, 0.9), (0.72, 2.3, 0.6), (0.72, 2.8, 0.9), (0.52, 1.3, 1.2), (0.52, 1.8, 1.9),
            (0.6, 0.4, 0.2)]
    df = spark.createDataFrame(rows, "l double, n_major double, n_minor double")
    e = K.edge_candidates(df, F.lit(0.8)).collect()
    for r in e:
        assert len(r["edges"]) == 6
        first = r["edges"][0]
        maj, mn = nearest_corner(F.lit(r["l"]), F.lit(r["ntot"]), F.lit(0.8), F.lit(r["n_major"]), F.lit(r["n_minor"]))
        want = spark.range(1).select(maj.alias("a"), mn.alias("b")).collect()[0]
        assert (first["major"], first["minor"]) == (want["a"], want["b"])
    # x = floor(0.2) = 0 -> candidates with minor - 1 are null
    last = e[-1]["edges"]
    assert any(c is None for c in last)


def test_sex_call_rows(spark):
    rows = [("chr1", 1000, 1000, 0), ("chr2", 1000, 1000, 0), ("chrX", 1000, 500, 0), ("chrM", 16569, 900, 0),
            ("chr1_alt", 500, 9, 0), ("*", 0, 0, 77)]
    df = spark.createDataFrame(rows, "chrom string, length long, mapped long, unmapped long")
    r = P.sex_call(df).collect()[0]
    # compat: the * row counts in the denominator (3 others -> (2.0 + 0.5 - 0.5) / 3)
    assert abs(r["others_mean"] - 2.0 / 3.0) < 1e-12
    r2 = P.sex_call(df, compat=False).collect()[0]
    assert abs(r2["others_mean"] - 1.0) < 1e-12 and r2["x_like_autosomes"] is False
    style = P.contig_style(df).collect()
    assert [r["chrom"] for r in style][-1] == "chrX" and len(style) == 23
