"""Readers and writers at the edges: fixed schemas, malformed rows, VCF text, per-chromosome files."""
import os
import tempfile

from pyspark.sql import functions as F

from baflow.sources import io


def _write_text(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_allele_counts_and_per_chrom(spark):
    d = tempfile.mkdtemp(prefix="baflow-io-")
    header = "#CHR\tPOS\tCount_A\tCount_C\tCount_G\tCount_T\tGood_depth"
    _write_text(f"{d}/t_chr1.txt", [header, "chr1\t100\t1\t2\t3\t4\t10", "chr1\tbad\t1\t2\t3\t4\t10"])
    _write_text(f"{d}/t_chr2.txt", [header, "chr2\t200\t5\t6\t7\t8\t26"])
    df = io.read_per_chrom(spark, [f"{d}/t_chr1.txt", f"{d}/t_chr2.txt", f"{d}/t_chrX.txt"], io.ALLELE_COUNTS)
    rows = sorted(df.collect(), key=lambda r: r["POS"])
    assert [r["POS"] for r in rows] == [100, 200]          # malformed row dropped, missing file skipped
    loci = io.read_per_chrom(spark, [f"{d}/t_chr2.txt"], io.ALLELE_COUNTS, chrom_from_name=True)
    assert loci.select("CHR").collect()[0][0] == "chr2"


def test_readers_feed_the_operators(spark):
    """Count, allele, legend, VCF and haplotype files through the operators that use them."""
    from baflow.operators.phase import het_baf, known_snps, phased_split, snp_baf
    from baflow.operators.signals import allele_pair_counts
    d = tempfile.mkdtemp(prefix="baflow-io-")
    header = "#CHR\tPOS\tCount_A\tCount_C\tCount_G\tCount_T\tGood_depth"
    for kind, g in (("tumour", 4), ("normal", 3)):
        _write_text(f"{d}/{kind}_chr1.txt", [header, f"chr1\t100\t1\t0\t{g}\t0\t{1 + g}", "chr1\t200\t0\t5\t0\t5\t10"])
    counts = io.read_allele_counts(spark, [f"{d}/tumour_chr1.txt"], "s", "tumour").union(
        io.read_allele_counts(spark, [f"{d}/normal_chr1.txt"], "s", "normal"))
    _write_text(f"{d}/loci_chr1.txt", ["position\ta0\ta1", "100\t1\t3", "200\t2\t4"])
    pairs = {r["position"]: r for r in allele_pair_counts(counts, io.read_allele_loci(spark, [f"{d}/loci_chr1.txt"])).collect()}
    assert pairs[100]["mut_count2"] == 4 and pairs[100]["norm_count2"] == 3 and pairs[200]["total_tumour"] == 10
    _write_text(f"{d}/chr1.legend", ["id position a0 a1", "rs1 100 A G", "rs2 200 C T"])
    info = spark.createDataFrame([("chr1", f"{d}/chr1.legend", "m", "h", 1, 9, 1)], io.IMPUTE_INFO)
    bad = spark.createDataFrame([("chr1", 200)], "chrom string, position int")
    snps = known_snps(io.read_legends(spark, info), bad)
    assert [(r["id"], round(r["baf"], 6)) for r in snp_baf(counts, snps).collect()] == [("rs1", 0.8)]
    _write_text(f"{d}/p.vcf", ["##x", "chr1\t100\t.\tA\tG\t.\tPASS\t.\tGT\t0|1"])
    split = phased_split(io.phased_genotypes(io.read_phased_vcf(spark, f"{d}/p.vcf"), "s"))
    assert [(r["allele1"], r["allele2"]) for r in split.collect()] == [(0, 1)]
    _write_text(f"{d}/hap.txt", ["snp1\trs1\t100\tA\tG\t0\t1", "snp2\trs2\t200\tC\tT\t1\t1"])
    haps = io.haplotype_variants(io.read_haplotype_info(spark, f"{d}/hap.txt"), "chr1")
    assert [(r["position"], round(r["baf"], 6)) for r in het_baf(counts, haps).collect()] == [(100, 0.8)]


def test_vcf_order_and_empty_inputs(spark):
    calls = spark.createDataFrame([(c, p, ".", "A", "G", ".", "PASS", ".", "GT", "0/1") for c, p in
                                   (("chrX", 5), ("chr10", 7), ("chr2", 9), ("chr2", 3))],
                                  "CHROM string, POS int, ID string, REF string, ALT string, QUAL string, "
                                  "FILTER string, INFO string, FORMAT string, SAMP0001 string")
    body = [r["line"].split("\t")[:2] for r in io.vcf_lines(calls).orderBy("chrom_ord", "ord").collect()][4:]
    assert body == [["2", "3"], ["2", "9"], ["10", "7"], ["X", "5"]]
    assert io.read_per_chrom(spark, ["/nowhere/a_chr1.txt"], io.LOCI_ALLELES, chrom_from_name=True).columns[-1] == "CHR"
    d = tempfile.mkdtemp(prefix="baflow-io-")
    _write_text(f"{d}/bp.txt", ["chromosome  position", "1\t100", "X   200"])
    assert [tuple(r) for r in io.read_breakpoints(spark, f"{d}/bp.txt").orderBy("position").collect()] == [("1", 100), ("X", 200)]
    _write_text(f"{d}/five.txt", ["chr1\t1\t2\t3\t4", "chr2\t10\t5\t0"])
    assert {r["chrom"] for r in io.read_contig_stats(spark, f"{d}/five.txt").collect()} == {"invalid", "chr2"}


def test_contig_stats_malformed(spark):
    d = tempfile.mkdtemp(prefix="baflow-io-")
    _write_text(f"{d}/idx.txt", ["chr1\t1000\t500\t0", "chrX\t800\t200\t3", "garbage line", "*\t0\t0\t77"])
    rows = {r["chrom"]: r for r in io.read_contig_stats(spark, f"{d}/idx.txt").collect()}
    assert rows["invalid"]["length"] == 0 and rows["chrX"]["mapped"] == 200 and rows["*"]["unmapped"] == 77


def test_phased_vcf_and_split(spark):
    from baflow.operators.phase import phased_split
    d = tempfile.mkdtemp(prefix="baflow-io-")
    _write_text(f"{d}/p.vcf", ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS",
                               "1\t300\t.\tA\tG\t.\tPASS\t.\tGT\t0|1", "1\t100\t.\tC\tT\t.\tPASS\t.\tGT\t1|1"])
    v = io.read_phased_vcf(spark, f"{d}/p.vcf")
    assert v.filter(F.col("QUAL").isNull()).count() == 2
    ph = v.select(F.col("CHROM").alias("chrom"), F.col("POS").alias("position"), F.col("REF").alias("ref"),
                  F.col("ALT").alias("alt"), F.col("SAMPLE").alias("gt"))
    out = {r["position"]: r for r in phased_split(ph).collect()}
    assert out[100]["snp_index"] == "snp_index1" and out[300]["allele2"] == 1 and out[100]["allele1"] == 1


def test_vcf_lines_and_export(spark):
    calls = spark.createDataFrame([("chr1", 5, ".", "A", "G", ".", "PASS", ".", "GT", "0/1")],
                                  "CHROM string, POS int, ID string, REF string, ALT string, QUAL string, "
                                  "FILTER string, INFO string, FORMAT string, SAMP0001 string")
    lines = [r["line"] for r in io.vcf_lines(calls).orderBy("ord").collect()]
    assert lines[0] == "##fileformat=VCFv4.2" and lines[3].startswith("#CHROM") and lines[4].startswith("1\t5\t")
    d = tempfile.mkdtemp(prefix="baflow-io-")
    io.export_tsv(calls, f"{d}/out", single_file=True)
    back = spark.read.option("header", True).option("sep", "\t").csv(f"{d}/out")
    assert back.count() == 1 and back.columns[0] == "CHROM"


def test_signal_reader_value_column(spark):
    d = tempfile.mkdtemp(prefix="baflow-io-")
    _write_text(f"{d}/baf.tsv", ["Chromosome\tPosition\tTUMOUR1", "1\t10\t0.25", "1\t20\tNA"])
    s = io.read_signal(spark, f"{d}/baf.tsv")
    rows = sorted(s.collect(), key=lambda r: r["position"])
    assert rows[0]["sample_id"] == "TUMOUR1" and rows[0]["value"] == 0.25 and rows[1]["value"] is None


def test_rho_psi_reader(spark):
    d = tempfile.mkdtemp(prefix="baflow-io-")
    _write_text(f"{d}/rho_and_psi.txt", ["rho\tpsi\tploidy\tdistance\tis.best", "ASCAT\t0.7\t2.4\t2.4\tNA\tNA",
                                         "FRAC_GENOME\t0.71\t2.38\t2.41\t0.93\tTRUE", "REF_SEG\t0.69\t2.5\t2.45\t0.9\tFALSE"])
    rows = {r["method"]: r for r in io.read_rho_psi(spark, f"{d}/rho_and_psi.txt").collect()}
    assert set(rows) == {"ASCAT", "FRAC_GENOME", "REF_SEG"}
    assert rows["FRAC_GENOME"]["rho"] == 0.71 and rows["FRAC_GENOME"]["is_best"] is True
    assert rows["ASCAT"]["distance"] is None


def test_every_line_is_a_row_or_a_reject(spark, caplog):
    d = tempfile.mkdtemp(prefix="baflow-io-")
    header = "#CHR\tPOS\tCount_A\tCount_C\tCount_G\tCount_T\tGood_depth"
    _write_text(f"{d}/t_chr1.txt", [header, "chr1\t100\t1\t2\t3\t4\t10", "chr1\tbad\t1\t2\t3\t4\t10", "chr1\t300\t1\t2", "chr1\t400\t1\t2\t3\t4\t10\t99"])
    _write_text(f"{d}/t_chr2.txt", [header, "chr2\t200\t5\t6\t7\t8\t26", "chr2\t201\t5\t6\t7\t8\tx"])
    _write_text(f"{d}/t_chr3.txt", [header, "chr3\t200\t5\t6\t7\t8\t26"])
    got = io.read_checked(spark, [f"{d}/t_chr{k}.txt" for k in (1, 2, 3)], io.ALLELE_COUNTS)
    assert sorted(r["POS"] for r in got.rows.collect()) == [100, 200, 200]
    assert got.rows.columns[:2] == ["#CHR", "POS"]
    assert {os.path.basename(r["file"]): r["rejected"] for r in got.counts().collect()} == {"t_chr1.txt": 3, "t_chr2.txt": 1}
    assert {r["line"].split("\t")[1] for r in got.rejects.collect()} == {"bad", "300", "400", "201"}
    assert "3 lines do not fit" in caplog.text
    # a reader of fewer columns sees the same rows
    assert got.rows.select("POS").count() == 3
    assert io.read_per_chrom(spark, [f"{d}/t_chr2.txt", f"{d}/nothing.txt"], io.ALLELE_COUNTS).select("#CHR").count() == 1
    assert "nothing.txt: missing" in caplog.text


def test_ordered_export_reads_back_in_order(spark):
    d = tempfile.mkdtemp(prefix="baflow-io-")
    rows = [(c, p, ".", "A", "G", ".", "PASS", ".", "GT", "0/1") for c in ("X", "10", "2") for p in range(500, 0, -1)]
    calls = spark.createDataFrame(rows, "CHROM string, POS int, ID string, REF string, ALT string, QUAL string, FILTER string, INFO string, FORMAT string, "
                                  "SAMP0001 string").repartition(7)
    io.export_vcf(calls, f"{d}/out")
    back = [r["line"].split("\t")[:2] for r in io.read_ordered(spark, f"{d}/out").orderBy("row").collect()]
    assert back == [[c, str(p)] for c in ("2", "10", "X") for p in range(1, 501)]
    assert [r["value"] for r in spark.read.text(f"{d}/out/header").collect()] == io.VCF_HEADER
    io.export_vcf(calls.limit(0), f"{d}/none")
    assert io.read_ordered(spark, f"{d}/none").count() == 0


def test_reference_tables_follow_the_contig_style(spark):
    import pytest
    from baflow.params import Catalogue, ReferencePaths, reference_tables
    d = tempfile.mkdtemp(prefix="baflow-io-")
    for style, c in (("plain", "1"), ("prefixed", "chr1")):
        _write_text(f"{d}/{style}/loci_{c}.txt", ["position\ta0\ta1", f"{len(c)}00\t1\t3"])
        _write_text(f"{d}/{style}/info.txt", [f"{c}\tl\tm\th\t1\t9\t1"])
        _write_text(f"{d}/{style}/bad.txt", ["Chr\tPos", f"{c}\t5"])
    cat = Catalogue(*[ReferencePaths(f"{d}/{s}/loci_{{chrom}}.txt", f"{d}/{s}/info.txt", f"{d}/{s}/bad.txt") for s in ("prefixed", "plain")])
    schema = "sample_id string, chrom string, length long, mapped long, unmapped long"
    stats = {k: spark.createDataFrame([("s", c, 9, 9, 0)], schema) for k, c in (("chr1", "chr1"), ("1", "1"))}
    for c in ("chr1", "1"):
        got = reference_tables(spark, cat, stats[c])
        assert [(r["chrom"], r["position"]) for r in got["loci"].collect()] == [(c, 100 * len(c))]
        assert got["impute_info"].first()["chrom"] == c and got["problem_loci"].first()["chrom"] == c
    with pytest.raises(ValueError, match="both contig naming styles"):
        reference_tables(spark, cat, stats["chr1"].union(spark.createDataFrame([("t", "1", 9, 9, 0)], schema)))
