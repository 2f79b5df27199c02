import numpy as np

from baflow.operators.potts import fit_blocks, optimal_breaks


def _best_cost(y, kmin, gamma):
    """Plain quadratic dynamic programme over points."""
    def sse(a, b):
        return ((y[a:b] - y[a:b].mean()) ** 2).sum()
    best = [-gamma]
    for e in range(1, len(y) + 1):
        cuts = [s for s in range(1, e) if e - s >= kmin] if e >= 2 * kmin else []
        best.append(min([sse(0, e)] + [best[s] + sse(s, e) + gamma for s in cuts]))
    return best[-1]


def _cost(y, ends, gamma):
    parts = np.split(y, ends[:-1])
    return sum(((p - p.mean()) ** 2).sum() for p in parts) + gamma * (len(parts) - 1)


def _series(seed=0, n=(60, 40, 30), lv=(0.3, 0.7, 0.4), sd=0.05):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(m, sd, k) for m, k in zip(lv, n)])


def test_pruned_partition_is_optimal():
    rng = np.random.default_rng(4)
    for k in range(25):
        y = _series(k, tuple(rng.integers(1, 40, 4)), (0.3, 0.6, 0.4, 0.5), 0.15)
        kmin, gamma = int(rng.integers(1, 6)), float(rng.choice([0.01, 0.05, 0.3]))
        ends = optimal_breaks(np.ones(len(y)), y, y * y, kmin, gamma)
        assert abs(_cost(y, ends, gamma) - _best_cost(y, kmin, gamma)) < 1e-9
        assert (np.diff(ends) >= kmin).all()


def test_blocks_of_several_points():
    y = _series(1)[:128]
    cut = np.arange(0, 128, 4)
    seg, mean = fit_blocks(np.full(32, 4.0), np.add.reduceat(y, cut), np.add.reduceat(y * y, cut), 3, 0.5)
    pts = np.repeat(seg, 4)
    assert (np.diff(seg) >= 0).all()
    assert all(abs(mean[seg == k][0] - y[pts == k].mean()) < 1e-9 for k in np.unique(seg))


def test_one_method_for_every_length():
    for n in (40, 900, 2000, 20000):
        rng = np.random.default_rng(n)
        y = np.r_[rng.normal(0.3, 0.05, n // 2), rng.normal(0.7, 0.05, n - n // 2)]
        cut = np.arange(0, n, 5)
        size = np.diff(np.r_[cut, n]).astype(float)
        seg, mean = fit_blocks(size, np.add.reduceat(y, cut), np.add.reduceat(y * y, cut), 3, 0.5)
        assert seg.max() == 1 and abs(mean[0] - 0.3) < 0.05 and abs(mean[-1] - 0.7) < 0.05


def test_short_series_has_one_mean():
    seg, mean = fit_blocks([2.0, 2.0], [1.0, 2.0], [0.5, 2.0], 3, 1.0)
    assert (seg == 0).all() and np.allclose(mean, 0.75)
    assert len(optimal_breaks([], [], [], 3, 1.0)) == 0


def test_segmentation_recovers_planted_levels(spark):
    """Two-pass phased segmentation on a planted series: phase blocks flip, levels 0.5 / 0.75 / 0.6."""
    from pyspark.sql import functions as F
    from baflow.operators.segment import segment_baf_phased
    rng = np.random.default_rng(11)
    levels = [0.5] * 200 + [0.75] * 250 + [0.6] * 150
    rows = []
    for i, lv in enumerate(levels):
        side = (i // 40) % 2            # phase switches every 40 points
        b = lv if side == 0 else 1 - lv
        rows.append(("s", "1", 1000 * (i + 1), float(min(max(b + rng.normal(0, 0.02), 0.001), 0.999))))
    df = spark.createDataFrame(rows, "sample_id string, chrom string, position long, baf double")
    out = segment_baf_phased(df).orderBy("position").select("baf_seg").collect()
    seg = np.array([r[0] for r in out])
    got = np.maximum(seg, 1 - seg)
    assert abs(np.median(got[:200]) - 0.5) < 0.03
    assert abs(np.median(got[220:430]) - 0.75) < 0.03
    assert abs(np.median(got[470:]) - 0.6) < 0.03


def test_parts_hand_on_their_live_starts():
    from baflow.operators.potts import Starts, advance
    rng = np.random.default_rng(9)
    for k in range(15):
        y = _series(k, tuple(rng.integers(1, 60, 5)), (0.3, 0.6, 0.4, 0.5, 0.45), 0.12)
        kmin, gamma = int(rng.integers(1, 6)), float(rng.choice([0.005, 0.05, 0.3]))
        whole = advance(Starts(), np.ones(len(y)), y, y * y, kmin, gamma)
        for part in (1, 7, 50):
            starts, got = Starts(), []
            for a in range(0, len(y), part):
                got.append(advance(starts, np.ones(len(y[a:a + part])), y[a:a + part], y[a:a + part] ** 2, kmin, gamma))
                starts = Starts.unpacked(starts.packed())
            assert (np.concatenate(got) == whole).all()


def test_segment_ends_do_not_depend_on_the_part(spark):
    from baflow.operators.segment import segment_ends
    rows, want = [], {}
    for k, name in enumerate(["a", "b", None]):
        y = _series(k, (37, 51, 40 + 30 * k), sd=0.08)
        rows += [(name, p, 1.0, float(v), float(v * v), 0.1) for p, v in enumerate(y)]
        want[name] = [int(e) - 1 for e in optimal_breaks(np.ones(len(y)), y, y * y, 3, 0.1)]
        assert len(want[name]) >= 3
    df = spark.createDataFrame(rows, "chrom string, block_id long, nr double, sm double, sq double, penalty double").repartition(5)
    for part in (50, 1000):
        got = {}
        for r in segment_ends(df, ["chrom"], 3, part).collect():
            got.setdefault(r["chrom"], []).append(r["end_block"])
        assert {k: sorted(v) for k, v in got.items()} == want
    assert segment_ends(df.limit(0), ["chrom"], 3).count() == 0


def test_parts_do_not_add_jobs_and_rounds_hand_on(spark):
    from baflow.operators.segment import segment_ends
    rows, want = [], {}
    for k, name in enumerate(["a", "b", None]):
        y = _series(k, (57, 81, 60 + 40 * k), sd=0.08)
        rows += [(name, p, 1.0, float(v), float(v * v), 0.1) for p, v in enumerate(y)]
        want[name] = [int(e) - 1 for e in optimal_breaks(np.ones(len(y)), y, y * y, 3, 0.1)]
    df = spark.createDataFrame(rows, "chrom string, block_id long, nr double, sm double, sq double, penalty double").repartition(5)

    def run(group, **how):
        spark.sparkContext.setJobGroup(group, group)
        try:
            got = {}
            for r in segment_ends(df, ["chrom"], 3, **how).collect():
                got.setdefault(r["chrom"], []).append(r["end_block"])
            assert {k: sorted(v) for k, v in got.items()} == want
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert run("few", part=1000) == run("many", part=4)
    run("rounds", part=30, most=100)                    # state between jobs; series that end in different rounds
    run("exact", part=33, most=99)


def test_segment_value_options(spark, caplog):
    from baflow.operators.segment import segment_value_rule
    rows = [("s", k + 1, s, v) for k, (s, v) in enumerate([(0.6, 0.5), (0.6, 0.9), (0.6, 0.4), (0.2, 0.0), (0.2, 0.0), (0.2, 0.6), (0.6, 0.8)])]
    df = spark.createDataFrame(rows, "sample_id string, rn int, baf_seg double, baf_phased double")
    value = lambda o: [r["baf_seg"] for r in segment_value_rule(df, ["sample_id"], o).orderBy("rn").collect()]
    assert value(1) == [0.5] * 3 + [0.0] * 3 + [0.8]
    assert value(3) == [0.5] * 3 + [0.2] * 3 + [0.8]
    assert value(2) == [r[2] for r in rows] and not caplog.records
    assert value(9) == [r[2] for r in rows] and "unknown" in caplog.text
