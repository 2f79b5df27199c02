"""Ordered series that are larger than a task: row numbers, prefix sums and windows over chunks.

A series is the rows of one group of ``keys`` in the order of ``order``. Rows are dealt to range partitions of
(keys, order) and sorted in them, so a long series spreads over many tasks and many short series share one. A row's number is its place among the
sorted rows of its series in the partition and what lies before the partition, which comes from one row per
(keys, partition). Windows of bounded reach then run on chunks of consecutive rows, each with a few rows of its
neighbours (the halo). No window is wider than a range partition or a chunk with its halo.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baflow.session import cut_lineage

CHUNK = 1024           # rows of a chunk, without its halo


def null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on equal or both-null ``keys``; the columns of ``left``, then those of ``right`` without the keys."""
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def before_parts(totals: DataFrame, keys, part: str, cols: dict[str, str]) -> DataFrame:
    """For each (keys, part) the sums of ``cols`` over the parts before it, named by the values of ``cols``.

    ``totals`` has one row for each (keys, part): the window is as long as a series has parts.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, part, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(out) for c, out in cols.items()])


def ranked(df: DataFrame, keys, order, out: str = "rn", total: str | None = "n") -> DataFrame:
    """Add ``out``, the 1-based place of a row in its series, and ``total``, the rows of the series (None: leave out).

    ``order`` are names or sort expressions (``F.desc("x")``, ``F.asc_nulls_last("x")``). Rows that are equal in keys and order are numbered in any
    order. The dealt rows are written to the checkpoint folder once, so a lost task cannot deal them otherwise.
    """
    keys, order = list(keys), list(order)
    sort = [F.asc(o) if isinstance(o, str) else o for o in order]
    dealt = df.repartitionByRange(*[F.asc(k) for k in keys], *sort).sortWithinPartitions(*[F.asc(k) for k in keys], *sort)
    # the id counts the sorted rows of a partition, from the partition's number shifted by 33 bits
    dealt = dealt.withColumn("__id", F.monotonically_increasing_id())
    if not keys:                                # one series of all rows
        dealt, keys = dealt.withColumn("__all", F.lit(0)), ["__all"]
    dealt = cut_lineage(dealt.withColumn("__part", F.shiftright("__id", 33)))
    counts = dealt.groupBy(*keys, "__part").agg(F.count("*").alias("__rows"), F.min("__id").alias("__first"))
    ahead = null_safe(before_parts(counts, keys, "__part", {"__rows": "__before"}), counts.select(*keys, "__part", "__first"), [*keys, "__part"])
    if total:
        ahead = null_safe(ahead, counts.groupBy(*keys).agg(F.sum("__rows").alias(total)), keys)
    d = null_safe(dealt, ahead, [*keys, "__part"])
    return d.withColumn(out, F.col("__before") + F.col("__id") - F.col("__first") + 1).drop("__part", "__id", "__first", "__before", "__all")


def chunk_of(rn: str = "rn", size: int = CHUNK) -> Column:
    """Number of the chunk that holds place ``rn``."""
    return F.floor((F.col(rn) - 1) / size)


def with_halo(df: DataFrame, before: int, after: int, rn: str = "rn", size: int = CHUNK) -> DataFrame:
    """Rows with ``chunk``; a row also appears (``own`` false) in the chunks whose halo it lies in.

    The halo of a chunk are the ``before`` places ahead of it and the ``after`` places behind it.
    """
    home = chunk_of(rn, size)
    first = F.greatest(F.lit(0), F.floor((F.col(rn) - 1 - after) / size))
    last = F.floor((F.col(rn) - 1 + before) / size)
    return (df.withColumn("__home", home).withColumn("chunk", F.explode(F.sequence(first, last)))
            .withColumn("own", F.col("chunk") == F.col("__home")).drop("__home"))


def windowed(df: DataFrame, keys, before: int, after: int, fn, rn: str = "rn", size: int = CHUNK) -> DataFrame:
    """``fn(rows, window)`` on chunks with their halo; the window is (keys, chunk) in the order of ``rn``.

    What ``fn`` adds to a row may depend on rows from ``before`` places ahead of it to ``after`` places behind it.
    """
    d = with_halo(df, before, after, rn, size)
    d = fn(d, Window.partitionBy(*keys, "chunk").orderBy(rn))
    return d.where("own").drop("own", "chunk")


def prefix_sums(df: DataFrame, keys, sums: dict[str, Column], rn: str = "rn", size: int = CHUNK) -> DataFrame:
    """Running sums of the expressions ``sums`` (by output name) from the start of each series up to the row."""
    keys = list(keys)
    d = df.withColumn("__chunk", chunk_of(rn, size)).withColumns({f"__v_{o}": c for o, c in sums.items()})
    totals = d.groupBy(*keys, "__chunk").agg(*[F.sum(f"__v_{o}").alias(f"__t_{o}") for o in sums])
    ahead = before_parts(totals, keys, "__chunk", {f"__t_{o}": f"__b_{o}" for o in sums})
    w = Window.partitionBy(*keys, "__chunk").orderBy(rn).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"__s_{o}": F.sum(f"__v_{o}").over(w) for o in sums})
    d = null_safe(d, ahead, [*keys, "__chunk"])
    d = d.withColumns({o: F.col(f"__b_{o}") + F.coalesce(F.col(f"__s_{o}"), F.lit(0)) for o in sums})
    return d.drop("__chunk", *[f"__{p}_{o}" for o in sums for p in "vtbs"])
