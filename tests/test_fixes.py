"""Cases where a null or a zero once changed the answer."""
import math

from pyspark.sql import functions as F

from baflow.operators import fit, pileup
from baflow.operators.call import call_states


def test_first_value_is_taken_after_nulls_go(spark):
    seg = spark.createDataFrame([("s", "1", 10, 0.4, 0.5), ("s", "1", 20, 0.4, 0.5)],
                                "sample_id string, chrom string, position int, baf_phased double, baf_seg double")
    kind = "sample_id string, chrom string, position int, event_id int, value double"
    baf = spark.createDataFrame([("s", "chr1", 10, 1, None), ("s", "chr1", 10, 2, 0.25), ("s", "chr1", 10, 3, 0.9), ("s", "1", 20, 4, None)], kind)
    logr = spark.createDataFrame([("s", "1", 10, 1, 0.5), ("s", "1", 20, 2, 0.1)], kind)
    rows = fit.match_signals(seg, baf, logr, tiebreak="event_id").collect()
    assert [(r["position"], r["baf"], r["logr"]) for r in rows] == [(10, 0.25, 0.5)]
    assert [r["baf"] for r in fit.match_signals(seg, baf, logr).collect()] == [0.25]


def test_levels_without_copies_at_full_purity(spark):
    one = spark.range(1).select(fit.baf_level(F.lit(1.0), F.lit(0), F.lit(0), zero_half=False).alias("x")).first()
    assert one["x"] is None
    segs = spark.createDataFrame([(20, 0.5, 0.1, 0.5, [(0, 0), (1, 0)])],
                                 "n long, mean double, sd double, l double, edges array<struct<major:int,minor:int>>")
    row = call_states(segs, F.lit(1.0)).first()
    assert row["test_level"] is None and row["clonal_major"] == 0


def test_uncovered_loci_have_zero_counts(spark):
    bases = spark.createDataFrame([("s", "tumour", "1", 10, "A", 30, 40), ("s", "normal", "1", 99, "C", 30, 40)],
                                  "sample_id string, sample_kind string, chrom string, position int, base string, baseq int, mapq int")
    loci = spark.createDataFrame([("1", 10), ("1", 20)], "chrom string, position int")
    rows = {(r["sample_kind"], r["position"]): (r["count_a"], r["good_depth"]) for r in pileup.pileup_counts(bases, loci).collect()}
    assert rows == {("tumour", 10): (1, 1), ("tumour", 20): (0, 0), ("normal", 10): (0, 0), ("normal", 20): (0, 0)}
    low = pileup.pileup_counts(bases, loci, min_mapq=50).agg(F.sum("good_depth")).first()[0]
    assert low == 0


def test_tail_of_student_t():
    from baflow.functions.rmath import t_two_sided_np
    import numpy as np
    # one and two degrees of freedom have closed forms; many degrees come near the normal tail
    t = np.array([0.1, 1.0, 5.0, 40.0])
    assert np.allclose(t_two_sided_np(t, np.full(4, 1.0)), 1 - 2 * np.arctan(t) / math.pi, rtol=1e-12)
    assert np.allclose(t_two_sided_np(t, np.full(4, 2.0)), 1 - t / np.sqrt(2 + t * t), rtol=1e-9)
    normal = np.array([math.erfc(x / math.sqrt(2)) for x in (0.1, 1.0, 5.0)])
    assert np.allclose(t_two_sided_np(t[:3], np.full(3, 1e8)), normal, rtol=1e-5)


def test_no_division_by_zero_without_depth_filters(spark):
    from baflow.operators import phase, signals
    counts = spark.createDataFrame([("s", "tumour", "1", 10, 0, 0, 0, 0), ("s", "tumour", "1", 20, 3, 1, 0, 0)],
                                   "sample_id string, sample_kind string, chrom string, position int, count_a int, count_c int, count_g int, count_t int")
    haps = spark.createDataFrame([("1", 10, "A", "C", "0", "1"), ("1", 20, "A", "C", "1", "0")],
                                 "chrom string, position int, ref string, alt string, allele1 string, allele2 string")
    assert {r["position"]: r["baf"] for r in phase.het_baf(counts, haps, 0).collect()} == {10: None, 20: 0.25}
    depth = spark.createDataFrame([("s", 0, 7), ("s", 0, 9), ("t", 4, 4)], "sample_id string, total_tumour int, total_normal int")
    got = [(r["sample_id"], r["mutant_logr"]) for r in signals.logr_normalised(depth).collect()]
    assert sorted(got, key=str) == [("s", None), ("s", None), ("t", 0.0)]


def test_first_row_of_a_position_stays(spark):
    kind = "sample_id string, chrom string, position int, value double"
    seg = spark.createDataFrame([("s", "1", 10, 0.4, 0.5)], "sample_id string, chrom string, position int, baf_phased double, baf_seg double")
    baf = spark.createDataFrame([("s", "1", 10, 0.9), ("s", "1", 10, 0.1)], kind).coalesce(1)
    logr = spark.createDataFrame([("s", "1", 10, 0.5)], kind)
    assert [r["baf"] for r in fit.match_signals(seg, baf, logr).collect()] == [0.9]


def test_range_means_of_overlapping_segments(spark):
    from baflow.operators.call import segment_range_mean
    points = spark.createDataFrame([("s", "1", p, float(p)) for p in (5, 10, 20, 30, 30, 40)] + [("s", "1", 25, float("nan")), ("s", "2", 7, 1.0)],
                                   "sample_id string, chrom string, position int, logr double")
    segs = spark.createDataFrame([("s", "1", 1, 10, 30), ("s", "1", 2, 20, 20), ("s", "1", 3, 21, 29), ("s", "1", 4, 0, 99), ("s", "2", 1, 7, 7)],
                                 "sample_id string, chrom string, seg_id long, start int, end int")
    got = {(r["chrom"], r["seg_id"]): r["logr"] for r in segment_range_mean(segs, points).collect()}
    assert got == {("1", 1): 22.5, ("1", 2): 20.0, ("1", 3): 0.0, ("1", 4): 22.5, ("2", 1): 1.0}


def test_grid_sums_are_the_plain_sums(spark, monkeypatch):
    """Partial vectors of several tasks, put out in small lots, against the direct sum; a null row adds nothing."""
    import numpy as np
    from baflow.operators import grids
    monkeypatch.setattr(grids, "HELD", 1)
    rows = [(f"s{k % 3}", float(k), None if k == 4 else 0.5 * k) for k in range(40)]
    df = spark.createDataFrame(rows, "sample_id string, a double, b double").repartition(6)
    spec = {"psi_min": 1.0, "psi_max": 1.5, "psi_by": 0.25, "rho_min": 0.1, "rho_max": 0.4, "rho_by": 0.1}
    got = grids.cell_sums(grids.with_spec(df, spec), ["a", "b"], lambda r, psi, rho: {"x": r["a"] * psi + rho, "y": r["b"] * rho}, ["x", "y"]).collect()
    assert len(got) == 3 * 3 * 4
    for r in got:
        mine = [(a, b) for s, a, b in rows if s == r["sample_id"]]
        psi, rho = 1 + 0.25 * r["i"], 0.1 + 0.1 * r["j"]
        assert np.isclose(r["psi"], psi) and np.isclose(r["rho"], rho)
        assert np.isclose(r["x"], sum(a * psi + rho for a, _ in mine)) and np.isclose(r["y"], sum(b * rho for _, b in mine if b is not None))
