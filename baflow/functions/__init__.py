from baflow.functions.chrom import chrom_ord, strip_chr, genome_coord  # noqa: F401
from baflow.functions.rmath import r_round, t_pvalue_two_sided, dbinom_clamped  # noqa: F401
