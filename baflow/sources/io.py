"""Readers and writers at the edges (SRC-01..20, SNK-01..11).

Internally every table is Parquet, partitioned by ``sample_id`` (and ``chrom`` where useful) so
filters on them prune directories. TSV is only read or written at the boundary, with fixed schemas
(no inference pass), one multi-path scan instead of a loop of unions.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from baflow.functions.chrom import chrom_ord
from baflow.session import cut_lineage

ALLELE_COUNTS = StructType([StructField("#CHR", StringType()), StructField("POS", IntegerType())]
                           + [StructField(f"Count_{b}", IntegerType()) for b in "ACGT"]
                           + [StructField("Good_depth", IntegerType())])
LOCI_ALLELES = StructType([StructField("position", IntegerType()), StructField("a0", IntegerType()),
                           StructField("a1", IntegerType())])
IMPUTE_INFO = StructType([StructField(n, StringType()) for n in
                          ("chrom", "impute_legend", "genetic_map", "impute_hap")]
                         + [StructField(n, IntegerType()) for n in ("start", "end", "is_par")])
VCF10 = StructType([StructField("CHROM", StringType()), StructField("POS", StringType()),
                    StructField("ID", StringType()), StructField("REF", StringType()),
                    StructField("ALT", StringType()), StructField("QUAL", StringType()),
                    StructField("FILTER", StringType()), StructField("INFO", StringType()),
                    StructField("FORMAT", StringType()), StructField("SAMPLE", StringType())])
HAPLOTYPE_INFO = StructType([StructField("id1", StringType()), StructField("id2", StringType()),
                             StructField("POS_var", IntegerType()), StructField("REF", StringType()),
                             StructField("ALT", StringType()), StructField("allele1", IntegerType()),
                             StructField("allele2", IntegerType())])
CONTIG_STATS = StructType([StructField("chrom", StringType()), StructField("length", StringType()),
                           StructField("mapped", StringType()), StructField("unmapped", StringType())])
SIGNAL = StructType([StructField("Chromosome", StringType()), StructField("Position", IntegerType()),
                     StructField("value", DoubleType())])
BAF_SEGMENTED = StructType([StructField("Chromosome", StringType()), StructField("Position", IntegerType()),
                            StructField("BAF", DoubleType()), StructField("BAFphased", DoubleType()),
                            StructField("BAFseg", DoubleType())])


@dataclass(frozen=True)
class Checked:
    """Rows that fit the schema, and the lines that do not: ``rejects`` (file, line)."""
    rows: DataFrame
    rejects: DataFrame

    def counts(self) -> DataFrame:
        """(file, rejected) for every file with a rejected line."""
        return self.rejects.groupBy("file").agg(F.count("*").alias("rejected"))


def read_checked(spark: SparkSession, paths, schema: StructType, header: bool = True, sep: str = "\t") -> Checked:
    """SRC-01: TSV with a fixed schema, every line either a row or a reject; spaces in names become dots.

    A line with a wrong number of fields or a value of the wrong type is a reject. The files are scanned once (the parsed lines are stored as a
    stage); rejects are counted by file and a warning is logged for each file that has some.
    """
    full = StructType([*schema.fields, StructField("__line", StringType())])
    raw = (spark.read.schema(full).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "__line").csv(paths))
    # an alias for each column, since a name may hold a dot or a blank
    names = [f"c{k}" for k in range(len(schema.fields))]
    stored = cut_lineage(raw.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(schema.fields, names, strict=True)],
                                    F.col("__line").alias("line"), F.col("_metadata.file_path").alias("file")))
    rows = stored.where(F.col("line").isNull())
    rows = rows.select(*[F.col(n).alias(f.name.replace(" ", ".")) for f, n in zip(schema.fields, names, strict=True)], F.col("file").alias("__file"))
    checked = Checked(rows, stored.where(F.col("line").isNotNull()).select("file", "line"))
    worst = checked.counts().orderBy(F.desc("rejected"), "file").limit(20).collect()
    for r in worst:
        logging.getLogger(__name__).warning("%s: %d lines do not fit the schema", r["file"], r["rejected"])
    return checked


def read_table_generic(spark: SparkSession, paths, schema: StructType, header: bool = True,
                       sep: str = "\t") -> DataFrame:
    """The rows of ``read_checked``."""
    return read_checked(spark, paths, schema, header, sep).rows.drop("__file")


def existing_paths(spark: SparkSession, paths) -> list[str]:
    """Keep paths that exist and are not empty (file-system metadata only, one call per path)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    keep = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp) and (fs.getFileStatus(hp).isDirectory() or fs.getFileStatus(hp).getLen() > 0):
            keep.append(p)
        else:
            logging.getLogger(__name__).warning("%s: missing or empty, left out", p)
    return keep


def read_per_chrom(spark: SparkSession, paths: list[str], schema: StructType, header: bool = True,
                   sep: str = "\t", chrom_from_name: bool = False) -> DataFrame:
    """SRC-02/03/04: one scan over many per-chromosome files; missing files are skipped.

    With ``chrom_from_name`` the chromosome is taken from the file name suffix
    (``prefix<chrom>.txt``, also a folder of part files of that name) through the hidden ``_metadata`` column selected on the scan.
    """
    paths = existing_paths(spark, paths)
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("CHR", F.lit(None).cast("string")) if chrom_from_name else empty
    df = read_checked(spark, paths, schema, header, sep).rows
    if chrom_from_name:
        df = df.withColumn("CHR", F.regexp_extract(F.col("__file"), r"((?:chr)?(?:\d+|X|Y))\.[^/.]+(?:/part-[^/]*)?$", 1))
    return df.drop("__file")


def read_impute_info(spark: SparkSession, path: str, chrom: str | None = None, is_male: bool = False) -> DataFrame:
    """SRC-05: headerless impute-info table; males keep PAR rows only (FLT-01); optional chrom filter."""
    df = read_table_generic(spark, path, IMPUTE_INFO, header=False)
    if is_male:
        df = df.filter(F.col("is_par") == 1)
    if chrom is not None:
        df = df.filter(F.col("chrom") == chrom)
    return df


def read_allele_counts(spark: SparkSession, paths: list[str], sample_id: str, sample_kind: str) -> DataFrame:
    """Per-chromosome count files of one sample as the operators take them (PRJ-02)."""
    df = read_per_chrom(spark, paths, ALLELE_COUNTS)
    return df.select(F.lit(sample_id).alias("sample_id"), F.lit(sample_kind).alias("sample_kind"),
                     F.col("#CHR").alias("chrom"), F.col("POS").alias("position"),
                     *[F.col(f"Count_{x}").alias(f"count_{x.lower()}") for x in "ACGT"],
                     F.col("Good_depth").alias("good_depth"))


def read_allele_loci(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per-chromosome allele files as loci (chrom, position, a0, a1); the chromosome is in the file name."""
    df = read_per_chrom(spark, paths, LOCI_ALLELES, chrom_from_name=True)
    return df.select(F.col("CHR").alias("chrom"), "position", "a0", "a1")


def read_legends(spark: SparkSession, impute_info: DataFrame) -> DataFrame:
    """SRC-06: legends listed in ``impute_info`` as SNPs (chrom, position, id, a0, a1), one multi-path scan.

    The list of legend paths is a handful of reference-panel file names, so it is collected; a legend's
    chromosome is that of its row of ``impute_info``, found by the file name.
    """
    listed = impute_info.select("chrom", "impute_legend").distinct().collect()
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    chrom = F.create_map(*[F.lit(x) for r in listed for x in (r["impute_legend"].rsplit("/", 1)[-1], r["chrom"])])
    df = (spark.read.schema("id string, position string, a0 string, a1 string").option("header", True)
          .option("sep", " ").csv([r["impute_legend"] for r in listed]))
    return df.select(F.try_element_at(chrom, name).alias("chrom"), F.col("position").try_cast("int").alias("position"),
                     "id", "a0", "a1")


def read_problem_loci(spark: SparkSession, path: str) -> DataFrame:
    """SRC-07: gzip TSV ``Chr, Pos`` (gzip is decoded by the reader)."""
    df = spark.read.option("header", True).option("sep", "\t").csv(path)
    return df.select(F.col("Chr").alias("chrom"), F.col("Pos").try_cast("int").alias("position"))


def read_phased_vcf(spark: SparkSession, path: str) -> DataFrame:
    """SRC-09: VCF body (``#`` lines skipped), 10 columns, POS int, QUAL double ('.' -> null)."""
    df = spark.read.schema(VCF10).option("sep", "\t").option("comment", "#").csv(path)
    return df.withColumns({"POS": F.col("POS").try_cast("int"), "QUAL": F.col("QUAL").try_cast("double")})


def read_haplotype_info(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: headerless haplotype info, seven names."""
    return read_table_generic(spark, path, HAPLOTYPE_INFO, header=False)


def phased_genotypes(vcf: DataFrame, sample_id: str) -> DataFrame:
    """A phased VCF body as ``phased_split`` takes it (SRC-09)."""
    return vcf.select(F.lit(sample_id).alias("sample_id"), F.col("CHROM").alias("chrom"), F.col("POS").alias("position"),
                      F.col("REF").alias("ref"), F.col("ALT").alias("alt"), F.col("SAMPLE").alias("gt"))


def haplotype_variants(info: DataFrame, chrom: str) -> DataFrame:
    """A haplotype info table of one chromosome as ``het_baf`` takes it (SRC-10)."""
    return info.select(F.lit(chrom).alias("chrom"), F.col("POS_var").alias("position"), F.col("REF").alias("ref"),
                       F.col("ALT").alias("alt"), "allele1", "allele2")


def read_contig_stats(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: 4-column contig table; malformed rows become ("invalid", 0, 0, 0)."""
    raw = spark.read.text(path)
    parts = F.split("value", "\t", -1)
    names = [f.name for f in CONTIG_STATS.fields]
    df = raw.where(F.col("value") != "").select(F.size(parts).alias("__n"), *[
        F.get(parts, F.lit(k)).alias(c) for k, c in enumerate(names)])
    ok = ((F.col("__n") == len(names)) & F.col("length").try_cast("long").isNotNull() & F.col("mapped").try_cast("long").isNotNull()
          & F.col("unmapped").try_cast("long").isNotNull() & F.col("chrom").isNotNull())
    return df.select(
        F.when(ok, F.col("chrom")).otherwise(F.lit("invalid")).alias("chrom"),
        *[F.when(ok, F.col(c).try_cast("long")).otherwise(F.lit(0).cast("long")).alias(c)
          for c in ("length", "mapped", "unmapped")])


def read_signal(spark: SparkSession, path: str, sample_id: str | None = None) -> DataFrame:
    """SRC-12/17/20: (Chromosome, Position, <value>) TSV into tidy (sample_id, chrom, position, value).

    A leading row-name column (``X``/``chrX`` header) is dropped, as the reference does.
    """
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    cols = raw.columns
    if cols and cols[0] in ("X", "chrX") and len(cols) > 3:
        raw = raw.drop(cols[0])
        cols = raw.columns
    value = [c for c in cols if c not in ("Chromosome", "Position")][0]
    out = raw.select(F.col(cols[0]).alias("chrom"), F.col(cols[1]).try_cast("int").alias("position"),
                     F.col(value).try_cast("double").alias("value"))
    sid = sample_id if sample_id is not None else value
    return out.select(F.lit(sid).alias("sample_id"), "*")


def read_rho_psi(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13: ``rho_and_psi`` TSV written with row names (the header line has one field less).

    Columns are named explicitly; the header line drops out with the method filter.
    """
    schema = StructType([StructField(c, StringType()) for c in ("method", "rho", "psi", "ploidy", "distance", "is_best")])
    named = spark.read.schema(schema).option("header", False).option("sep", "\t").csv(path)
    return named.filter(F.col("method").isin("ASCAT", "FRAC_GENOME", "REF_SEG")).select(
        "method", *[F.col(c).try_cast("double").alias(c) for c in ("rho", "psi", "ploidy", "distance")],
        F.upper(F.col("is_best")).isin("TRUE", "T").alias("is_best"))


def read_breakpoints(spark: SparkSession, path: str | None) -> DataFrame:
    """SRC-14: optional prior breakpoints (whitespace, header ``chromosome position``)."""
    schema = "chrom string, position int"
    if path is None:
        return spark.createDataFrame([], schema)
    parts = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    df = spark.read.text(path).select(F.get(parts, F.lit(0)).alias("chrom"), F.get(parts, F.lit(1)).alias("position"))
    return df.where("chrom <> '' and chrom <> 'chromosome'").select(
        "chrom", F.col("position").try_cast("int").alias("position"))


def write_per_chrom(df: DataFrame, path: str, prefix: str, chrom: str = "chrom") -> None:
    """SNK-01: one folder ``file=<prefix><chrom>.txt`` of TSV parts with a header for each chromosome, in one job (read by ``read_per_chrom``)."""
    name = F.concat(F.lit(prefix), F.col(chrom), F.lit(".txt"))
    df.withColumn("file", name).drop(chrom).repartition("file").write.partitionBy("file").option("sep", "\t").option("header", True).csv(path)


def prefix_columns(df: DataFrame, prefix: str, keep=("sample_id", "chrom", "position")) -> DataFrame:
    """PRJ-01: prefix every column except the keys (``snp_``, ``normal_``), in one projection."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def genomic_sort(df: DataFrame, chrom: str = "chrom", pos: str = "position") -> DataFrame:
    """SRT-01/02/06: order by (chromosome rank with X = 100, name, position); range-partitioned sort."""
    return df.withColumn("chrom_rank", chrom_ord(chrom)).orderBy("chrom_rank", chrom, pos)


# ------------------------------------------------------------------ sinks

def write_table(df: DataFrame, path: str, partition_by=("sample_id",), mode: str = "overwrite") -> None:
    """SNK-11: Parquet, one directory per sample (and more keys if given)."""
    cols = [c for c in partition_by if c in df.columns]
    w = df.write.mode(mode)
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)


def export_tsv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> None:
    """SNK-01/04/05/06/08: tab-separated export at the edge.

    ``single_file`` mirrors the reference's one-file output; it funnels the final write through one
    task, so it is meant for small result tables (segments, copy number), not per-locus tables (``export_ordered``).
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


def export_ordered(lines: DataFrame, order, path: str, header: list[str] | None = None) -> None:
    """SRT-01/02/03, SNK-01/03: column ``line`` of ``lines`` as text files in the order of ``order``, without one task for all.

    Rows are dealt to range partitions and sorted inside them; part files follow each other by name under ``path/body``, and the header lines are a
    file of their own under ``path/header``, so that ``cat header/part-* body/part-*`` is the whole text.
    """
    sort = [F.asc(o) if isinstance(o, str) else o for o in order]
    body = lines.repartitionByRange(*sort).sortWithinPartitions(*sort).select("line")
    body.write.mode("overwrite").text(f"{path}/body")
    head = lines.sparkSession.createDataFrame([(h,) for h in header or []], "line string")
    head.coalesce(1).write.mode("overwrite").text(f"{path}/header")


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """(row, line) of an ordered export: the place of each body line in the files as they lie there."""
    raw = spark.read.text(f"{path}/body").select("value", F.col("_metadata.file_name").alias("file"),
                                                F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    raw = cut_lineage(raw)
    blocks = raw.groupBy("file", "start").agg(F.count("*").alias("n"))
    ahead = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)          # one row for each block of the files
    blocks = blocks.select("file", "start", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("file", "start").orderBy("at"))
    return raw.withColumn("inside", inside).join(blocks, ["file", "start"]).select(
        (F.col("before") + F.col("inside")).alias("row"), F.col("value").alias("line"))


VCF_HEADER = ["##fileformat=VCFv4.2",
              '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
              "##reference=hg38",
              "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSAMP0001"]


def export_vcf(calls: DataFrame, path: str) -> None:
    """SNK-03: the VCF columns of one sample (``vcf_projection``) as an ordered export."""
    lines = vcf_lines(calls).where("chrom_ord >= 0")
    export_ordered(lines, ["chrom_ord", "ord", "line"], path, VCF_HEADER)


def vcf_lines(df: DataFrame) -> DataFrame:
    """SNK-03: VCF text lines -- three ``##`` header lines, ``#CHROM`` header, body without ``chr``.

    Returns (chrom_ord, ord, line): a writer orders by these within a sample, so chromosomes follow each other
    (X last) and positions rise within each; the header lines come first.
    """
    header = VCF_HEADER
    keys = [c for c in ("sample_id",) if c in df.columns]
    body = df.select(*keys, F.coalesce(chrom_ord("CHROM"), F.lit(1000)).cast("int").alias("chrom_ord"),
                     F.col("POS").cast("long").alias("ord"), F.concat_ws(
        "\t", F.regexp_replace(F.col("CHROM"), "^chr", ""), F.col("POS").cast("string"), "ID", "REF", "ALT",
        "QUAL", "FILTER", "INFO", "FORMAT", "SAMP0001").alias("line"))
    heads = df.select(*keys).distinct() if keys else None
    hdr_arr = F.array(*[F.struct(F.lit(-1).alias("chrom_ord"), F.lit(i - len(header)).cast("long").alias("ord"), F.lit(h).alias("line"))
                        for i, h in enumerate(header)])
    if heads is None:
        hdr = df.sparkSession.range(1).select(F.inline(hdr_arr))
    else:
        hdr = heads.select(*keys, F.inline(hdr_arr))
    return hdr.unionByName(body)
