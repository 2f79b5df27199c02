"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a budget of words; its documents are taken in the order of a hash of their id, without ever
being sorted. One scan counts the words of every document. Words are summed by source and by the first ``BITS`` bits of
the hash; the bucket in which a source's budget ends is found with a running sum over its buckets, and only the rows
of that bucket are summed again by the next ``BITS`` bits, until it holds one hash value. A budget of several times the source
is the same threshold behind one or more whole copies, so a larger budget takes all that a smaller one takes.
Every document is then judged by comparing its hash with the threshold of its source.

The budget is met to the word: the document at the threshold gives as many of its words as are left. Rows that share the
threshold's hash (repeated ids) share what is left in proportion to their size, each rounded down, so such a source may stay under its
budget by less than one word for each such row. A null text or one without words has size 0 and takes nothing; a null id counts as the
empty id; a null source is a source of its own and comes last; an empty table gives an empty result; other columns are not read.

Plan: DataFrame functions only. One scan of the texts writes (doc_id, source, hash, size); everything else reads that table.
Sums are combined before the shuffle and keyed by (source, bucket), which spreads a hot source over ``2 ** BITS`` keys; the
final join has the same key. The driver sees three sums over the sources for each round of sharing out, and whether a threshold is still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baflow.llm.common import save
from baflow.operators.chunks import null_safe, ranked

WORD = "[^\\x20\\x09-\\x0D]+"
HASH_BITS = 60
BITS = 12                                     # of the hash, for each level of the histogram
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def hash60(col: str = "doc_id") -> Column:
    """The first 60 bits of the md5 of the value as text; null counts as the empty text."""
    digest = F.md5(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, h, size) of every row."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), hash60().alias("h"), size.alias("size"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): budgets by weight, at most ``most`` times the size.

    Weights repeat along the sources in code-point order, null last. What a capped source cannot take is shared among
    the others by weight until none is above its cap: level = (budget - capped sizes) / weight of the others, round by round.
    """
    placed = save(ranked(sources, [], [F.asc_nulls_last("source")], "place", None).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                               (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))), "mix-sources")
    cap = F.lit(most) * F.col("source_size")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    budget, level, known = share * total, 0.0, -1
    while True:
        full = cap <= F.lit(level) * F.col("weight") if known >= 0 else F.lit(False)
        got = placed.agg(F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, cap)).alias("held"),
                         F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if got["n"] == known or not got["open"]:
            break
        known, level = got["n"], (budget - (got["held"] or 0)) / got["open"]
    if known >= 0 and not got["open"]:
        return placed.select("source", "source_size", cap.cast("double").alias("target"))
    return placed.select("source", "source_size", F.least(cap.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def thresholds(rows: DataFrame, histogram: DataFrame, rest: DataFrame) -> DataFrame:
    """(source, edge, left, held): the hash at which ``rest`` words of the source end, the words left for rows of that hash, and their words.

    ``rows`` (source, h, size), ``histogram`` (source, bin, words, low, high) by the first bits of h, ``rest`` (source, rest) with rest > 0.
    """
    found, shift, table, need = None, HASH_BITS - BITS, histogram, rest
    while True:
        run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        upto = null_safe(table.withColumn("upto", F.sum("words").over(run)), need, ["source"])
        ends = save(upto.where("upto >= rest and upto - words < rest").select(
            "source", "bin", "words", "low", "high", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest")), "mix-edges")
        solved = ends.where("low = high").select("source", F.col("low").alias("edge"), F.col("rest").alias("left"),
                                                 F.col("words").alias("held"))
        found = solved if found is None else found.union(solved)
        open_bins = ends.where("low < high")
        if open_bins.limit(1).count() == 0:
            return found
        inside = rows.withColumn("bin", F.shiftright("h", shift))
        rows = save(null_safe(inside, open_bins.select("source", "bin"), ["source", "bin"]).select("source", "h", "size"), "mix-bucket")
        shift = max(0, shift - BITS)
        table, need = bins(rows, shift), open_bins.select("source", "rest")


def bins(rows: DataFrame, shift: int) -> DataFrame:
    """(source, bin, words, low, high): words and range of hashes of the rows with words, by the leading bits of h."""
    return rows.where("size > 0").groupBy("source", F.shiftright("h", shift).alias("bin")).agg(
        F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"))


def decisions(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs`` (doc_id, source, text)."""
    rows = save(sized(docs), "mix-sizes")
    shift = HASH_BITS - BITS
    histogram = save(bins(rows, shift), "mix-words")
    # sources without a word have no bin
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    told = targets(sources, weights, share, most)
    goal = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    told = save(told.withColumn("copies", whole).withColumn("rest", goal - F.col("copies") * F.col("source_size")), "mix-targets")
    edges = thresholds(rows.select("source", "h", "size"), histogram, told.where("rest > 0").select("source", "rest"))
    told = null_safe(told, edges, ["source"], "left")
    # one row for each source and bucket that occurs: a key that spreads hot sources
    keyed = save(null_safe(rows.select("source", F.shiftright("h", shift).alias("bin")).distinct(), told, ["source"]), "mix-plan")
    full = null_safe(rows.withColumn("bin", F.shiftright("h", shift)), keyed, ["source", "bin"])
    extra = (F.when(F.col("h") < F.col("edge"), F.col("size"))
             .when(F.col("h") == F.col("edge"), F.floor(F.col("size") * (F.col("left") / F.col("held")))).otherwise(F.lit(0)))
    return full.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies") + extra).cast("long").alias("taken"), "h", "source")


def repeated(text: Column, size: Column, taken: Column) -> Column:
    """The texts to put out for one document: whole copies, then the first words of the text for what is left."""
    parts = F.concat_ws(" ", F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.lit(1), (taken % size).cast("int")))
    whole = F.array_repeat(text, F.floor(taken / size).cast("int"))
    return F.when(size > 0, F.when(taken % size > 0, F.concat(whole, F.array(parts))).otherwise(whole)).otherwise(F.array().cast("array<string>"))
