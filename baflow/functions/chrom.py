"""Chromosome-name column functions (JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sort rank given to X, and the contig names kept for calling.
X_RANK = 100
AUTOSOMES = 22


def strip_chr(c: Column | str) -> Column:
    """Drop a leading ``chr`` (``chr7`` -> ``7``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "^chr", "")


def chrom_ord(c: Column | str) -> Column:
    """Genomic sort rank: 1..22 as numbers, X as 100, anything else null.

    Accepts names with or without the ``chr`` prefix (one shared rule for all sorts).
    """
    c = F.col(c) if isinstance(c, str) else c
    core = F.regexp_extract(c, r"^(?:chr)?(\d+|X)$", 1)
    return (F.when(core == "X", F.lit(X_RANK))
            .when(core == "", F.lit(None).cast("int"))
            .otherwise(core.try_cast("int")))


def genome_coord(ordinal: Column, pos: Column) -> Column:
    """Global coordinate ``ordinal * 1e9 + pos`` as a bigint."""
    return ordinal.cast("bigint") * F.lit(1_000_000_000) + pos.cast("bigint")
