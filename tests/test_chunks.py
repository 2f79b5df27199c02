"""Chunked windows, prefix sums, row numbers and quantiles against plain numpy, with chunks far smaller than the series."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from baflow.operators import chunks, quantiles
from baflow.operators import series as R

SIZES = {"a": 1, "b": 5, "c": 333, None: 70, "d": 1000}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = {k: rng.integers(-50, 50, n) / 8 for k, n in SIZES.items()}       # eighths: every sum is exact
    rows = [(k, int(10 * p + p % 3), float(v), p + 1) for k, xs in x.items() for p, v in enumerate(xs)]
    rng.shuffle(rows)
    rows = [(r[0], int(r[1]), float(r[2]), int(r[3])) for r in rows]
    return x, spark.createDataFrame(rows, "chrom string, position int, x double, place int").repartition(9)


def test_row_numbers_over_range_partitions(table):
    x, df = table
    for r in chunks.ranked(df, ["chrom"], ["position"]).collect():
        assert r["rn"] == r["place"] and r["n"] == len(x[r["chrom"]])
    every = chunks.ranked(df, [], [F.desc("position"), F.asc_nulls_last("chrom")], "at", None).collect()
    want = sorted(((-r["position"], r["chrom"] is None, r["chrom"] or "", r["at"]) for r in every))
    assert [w[3] for w in want] == list(range(1, len(every) + 1))


def test_prefix_sums_and_halos(table):
    x, df = table
    d = chunks.ranked(df, ["chrom"], ["position"])
    for r in chunks.prefix_sums(d, ["chrom"], {"s": F.col("x"), "q": F.col("x") * F.col("x")}, size=7).collect():
        upto = x[r["chrom"]][:r["rn"]]
        assert r["s"] == upto.sum() and r["q"] == (upto ** 2).sum()

    def neighbours(rows, w):
        return rows.withColumns({"before": F.lag("x", 9).over(w), "after": F.lead("x", 4).over(w)})

    got = chunks.windowed(d, ["chrom"], 9, 4, neighbours, size=5).collect()
    assert len(got) == sum(SIZES.values())
    for r in got:
        xs, k = x[r["chrom"]], r["rn"] - 1
        assert r["before"] == (xs[k - 9] if k >= 9 else None) and r["after"] == (xs[k + 4] if k + 4 < len(xs) else None)


def test_filters_do_not_depend_on_the_chunk(table):
    _, df = table
    d = chunks.ranked(df, ["chrom"], ["position"])
    cols = ["chrom", "rn", "cost1", "cost2", "short_ab", "test1", "test2", "mark"]
    # a chunk longer than any series is the plain window
    whole = {(r["chrom"], r["rn"]): r for r in R.mark_breakpoints(d, ["chrom"], "x", 3, size=5000).select(*cols).collect()}
    for size in (1, 50):
        part = R.mark_breakpoints(d, ["chrom"], "x", 3, size=size).select(*cols).collect()
        assert len(part) == len(whole) and all(r == whole[r["chrom"], r["rn"]] for r in part)


def quantile7(v, p):
    h = (len(v) - 1) * p
    lo = int(np.floor(h))
    v = np.sort(v)
    return v[lo] if h == lo else (1 - (h - lo)) * v[lo] + (h - lo) * v[min(lo + 1, len(v) - 1)]


@pytest.mark.parametrize("few,bins", [(4096, 1024), (1, 2), (2, 7), (1, 1024)])
def test_quantiles_by_refinement(spark, monkeypatch, few, bins):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = np.random.default_rng(3)
    groups = {"one": [2.5], "same": [1.0] * 40, "two": [1.0, 9.0], "ties": list(np.round(rng.random(200) * 4)),
              "wide": list(10.0 ** rng.integers(-8, 8, 60)), None: list(rng.normal(size=300)), "nulls": [None, 3.0, None]}
    rows = [(k, None if v is None else float(v), float(len([w for w in vs if w is not None]))) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double, m double").repartition(6)
    specs = [("x", F.lit(True), 0.5, "med"), ("x", F.lit(True), 0.15, "low"), ("x", F.col("x") > 0.5, 0.9, "part"),
             ("x", F.lit(True), lambda cnt: 1 - F.least(F.lit(0.8), 0.3 * F.col("m") / cnt), "own")]
    got = {r["g"]: r for r in quantiles.grouped_quantiles(df, ["g"], specs, carry=["m"]).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        v = np.array([x for x in vs if x is not None])
        for name, sub, p in (("med", v, 0.5), ("low", v, 0.15), ("part", v[v > 0.5], 0.9), ("own", v, 1 - min(0.8, 0.3))):
            if len(sub):
                assert got[k][name] == pytest.approx(quantile7(sub, p), rel=1e-12), (k, name)
            else:
                assert got[k][name] is None


def test_runs_over_range_partitions(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for name, n in (("a", 900), ("b", 1), (None, 300)):
        level = np.repeat(rng.integers(0, 3, n), rng.integers(1, 40, n))[:n]
        values = [None if v == 0 else (float("nan") if v == 1 else 0.5) for v in level]
        x = rng.integers(0, 64, n) / 8
        run = np.cumsum(np.r_[1, np.diff(level) != 0])
        mean = np.bincount(run, x) / np.maximum(np.bincount(run), 1)
        rows += [(name, p, v, float(y)) for p, (v, y) in enumerate(zip(values, x, strict=True))]
        want |= {(name, p): (int(r), mean[r]) for p, r in enumerate(run)}
    rng.shuffle(rows)
    df = spark.createDataFrame([(r[0], int(r[1]), None if r[2] is None else float(r[2]), float(r[3])) for r in rows],
                               "chrom string, position int, v double, x double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # runs that go on in the next partition
    try:
        for dealt in (False, True):
            d = df.repartitionByRange(7, F.asc("chrom"), F.asc("position")) if dealt else df
            got = R.run_ids(d, ["chrom"], ["position"], ["v"], "run", mean=("x", "m"), dealt=dealt).collect()
            assert {(r["chrom"], r["position"]): (r["run"], r["m"]) for r in got} == want and len(got) == len(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_few_segments_are_spread_over_the_cores(spark):
    from pyspark import TaskContext

    from baflow.operators.grids import cell_sums, with_spec
    spec = {"psi_min": 1.0, "psi_max": 2.0, "psi_by": 1.0, "rho_min": 0.5, "rho_max": 1.0, "rho_by": 0.5}
    segs = with_spec(spark.createDataFrame([("s", float(k)) for k in range(200)], "sample_id string, b double").coalesce(1), spec)

    def kernel(row, psi, rho):
        return {"n": np.ones_like(row["b"]), "late": np.full_like(row["b"], float(TaskContext.get().partitionId() > 0))}

    got = cell_sums(segs, ["b"], kernel, ("n", "late")).collect()
    assert len(got) == 4 and all(r["n"] == 200 and r["late"] >= 100 for r in got)


def test_segments_from_runs_are_those_from_points(spark):
    from baflow.operators import fit
    rows = [("s", c, 10 * k, 0.5 + (k // 7 % 3) * 0.1, 0.25 * (k // 7 % 2)) for c in ("1", "2") for k in range(60)]
    pts = spark.createDataFrame(rows, "sample_id string, chrom string, position long, b double, v double")
    m = fit.match_signals(pts.select("sample_id", "chrom", "position", F.col("v").alias("baf_phased"), F.col("b").alias("baf_seg")),
                          pts.withColumn("value", F.col("v")), pts.withColumn("value", F.col("v")))
    key = lambda d: sorted((r["seg_id"], r["r"], r["b"], r["length"]) for r in d.collect())
    whole = key(fit.make_segments(m, "logr_seg", "baf_seg"))
    assert len(whole) > 10 and key(fit.make_segments(m, "logr_seg", "baf_seg", "run_id")) == whole
