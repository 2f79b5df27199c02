"""Exact quantiles of many groups of any size, by refinement (AG-07, AG-08, AG-17).

Each group's values are counted in ``BINS`` bins between their least and greatest value; the interval that holds the wanted ranks is
narrowed to their bins and counted again, until at most ``FEW`` values or one value are left in it, which are then sorted.
Counts are combined before the shuffle, no rank is given to a row, and no task sees more than ``BINS`` bins or ``FEW`` values of a group. The number
of rounds follows the spread of the values; after each, the driver learns only whether a group is still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baflow.operators.chunks import null_safe
from baflow.session import cut_lineage

BINS = 1024
FEW = 65_536


def _intervals(stats: DataFrame) -> DataFrame:
    """Open groups: more than ``FEW`` values, not all the same."""
    return stats.where((F.col("__held") > FEW) & (F.col("__low") < F.col("__high")))


def grouped_quantiles(df: DataFrame, keys, specs, carry=()) -> DataFrame:
    """(keys, outputs): R type-7 quantiles per group, several at once.

    ``specs``: (value column, condition that selects rows, probability, output name). The probability is a number or a
    function of the number of selected rows (a Column) and may use the columns ``carry``, which are constant in a group. Null values are not
    counted; a group without a selected value gets null, as does one whose probability is null.
    """
    keys, carry = list(keys), list(carry)
    parts = [F.when(cond & F.col(v).isNotNull(), F.struct(F.lit(k).alias("__spec"), F.col(v).cast("double").alias("__x")))
             for k, (v, cond, _, _) in enumerate(specs)]
    long = df.select(*keys, *carry, F.explode(F.array_compact(F.array(*parts))).alias("__e")).select(
        *keys, *carry, "__e.__spec", "__e.__x")
    by = [*keys, "__spec"]
    stats = long.groupBy(*by).agg(F.count("*").alias("__held"), F.min("__x").alias("__low"), F.max("__x").alias("__high"),
                                  *[F.first(c).alias(c) for c in carry])
    prob = F.lit(None).cast("double")
    for k, (_, _, p, _) in enumerate(specs):
        prob = F.when(F.col("__spec") == k, p(F.col("__held")) if callable(p) else F.lit(float(p))).otherwise(prob)
    place = F.lit(1.0) + (F.col("__held") - 1) * prob
    state = stats.withColumn("__place", place).where(F.col("__place").isNotNull()).select(
        *by, F.floor("__place").alias("__k"), F.least(F.floor("__place") + 1, F.col("__held")).alias("__k2"),
        (F.col("__place") - F.floor("__place")).alias("__part"),
        F.lit(0).cast("long").alias("__below"), "__held", "__low", "__high", F.col("__high").alias("__top"))
    state = cut_lineage(state)
    while _intervals(state).limit(1).count():
        state = cut_lineage(_narrowed(long, state, by))
    inside = null_safe(long.select(*by, "__x"), state.where(F.col("__low") < F.col("__high")), by).where(
        F.col("__x").between(F.col("__low"), F.col("__high")))
    few = inside.groupBy(*by).agg(F.sort_array(F.collect_list("__x")).alias("__v"))
    told = null_safe(state, few, by, "left")
    at = lambda k, alone: F.coalesce(F.try_element_at("__v", (F.col(k) - F.col("__below")).cast("int")), F.col(alone))
    told = told.withColumns({"__lo": at("__k", "__low"), "__hi": at("__k2", "__top")})
    value = F.when((F.col("__part") > 0) & (F.col("__hi") != F.col("__lo")),
                   (1 - F.col("__part")) * F.col("__lo") + F.col("__part") * F.col("__hi")).otherwise(F.col("__lo"))
    told = told.withColumn("__q", value)
    return told.groupBy(*keys).agg(*[F.max(F.when(F.col("__spec") == k, F.col("__q"))).alias(out)
                                     for k, (_, _, _, out) in enumerate(specs)])


def _narrowed(long: DataFrame, state: DataFrame, by) -> DataFrame:
    """``state`` with the intervals of its open groups cut down to the bins of the two wanted ranks."""
    open_groups = _intervals(state)
    rows = null_safe(long.select(*by, "__x"), open_groups, by).where(F.col("__x").between(F.col("__low"), F.col("__high")))
    share = (F.col("__x") / 2 - F.col("__low") / 2) / (F.col("__high") / 2 - F.col("__low") / 2)        # halves: no overflow
    rows = rows.withColumn("__bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    bins = rows.groupBy(*by, "__bin").agg(F.count("*").alias("__n"), F.min("__x").alias("__a"), F.max("__x").alias("__b"))
    run = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = null_safe(bins.withColumn("__upto", F.sum("__n").over(run)),
                     open_groups.select(*by, "__k", "__k2", "__part", "__below"), by)
    holds = lambda k: (F.col("__upto") >= F.col(k) - F.col("__below")) & (F.col("__upto") - F.col("__n") < F.col(k) - F.col("__below"))
    ends = bins.where(holds("__k") | holds("__k2")).groupBy(*by).agg(
        F.first("__k").alias("__k"), F.first("__k2").alias("__k2"), F.first("__part").alias("__part"),
        (F.first("__below") + F.min(F.col("__upto") - F.col("__n"))).alias("__under"), F.sum("__n").alias("__held"),
        F.min("__a").alias("__low"), F.max("__b").alias("__high"),
        # two bins: the ranks are the end of the first and the beginning of the second
        F.count("*").alias("__two"), F.min("__b").alias("__first"), F.max("__a").alias("__second"))
    two = F.col("__two") == 2
    ends = ends.select(*by, "__k", "__k2", "__part", F.col("__under").alias("__below"), "__held",
                       F.when(two, F.col("__first")).otherwise(F.col("__low")).alias("__low"),
                       F.when(two, F.col("__first")).otherwise(F.col("__high")).alias("__high"),
                       F.when(two, F.col("__second")).otherwise(F.col("__high")).alias("__top"))
    return state.where(~((F.col("__held") > FEW) & (F.col("__low") < F.col("__high")))).unionByName(ends)
