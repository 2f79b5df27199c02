"""Running median with R's end rule, checked against a direct numpy statement of the documented rule."""
import numpy as np
from pyspark.sql import functions as F

from baflow.operators import series as R


def runmed_ref(x, k_half=25):
    n = len(x)
    w = 2 * k_half + 1
    if w > n:
        w = 1 if n == 0 else (n - 1 if n % 2 == 0 else n)
    h = (w - 1) // 2
    res = np.array(x, dtype=float)
    for i in range(h, n - h):
        res[i] = np.median(x[i - h:i + h + 1])
    if h < 1:
        return res
    sm = res.copy()
    for i in range(2, h + 1):          # 1-based i, windows of the kept-ends vector
        sm[i - 1] = np.median(res[:2 * i - 1])
        sm[n - i] = np.median(res[n - 2 * i + 1:])
    med3 = lambda a, b, c: sorted([a, b, c])[1]
    sm[0] = med3(res[0], sm[1], 3 * sm[1] - 2 * sm[2])
    sm[n - 1] = med3(res[n - 1], sm[n - 2], 3 * sm[n - 2] - 2 * sm[n - 3])
    return sm


def test_running_median_matches_rule(spark):
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for n in (1, 2, 3, 4, 5, 8, 11, 50, 51, 52, 130):
        x = rng.random(n)
        want[n] = runmed_ref(x)
        rows += [(f"s{n}", i + 1, float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "chrom string, pos int, x double")
    d = R.index_series(df, ["chrom"], ["pos"])
    got = R.running_median(d, ["chrom"], "x", "rm").select("chrom", "rn", "rm").collect()
    for r in got:
        n = int(r["chrom"][1:])
        assert abs(r["rm"] - want[n][r["rn"] - 1]) < 1e-12, (n, r["rn"])


def test_noise_sd_floor(spark):
    df = spark.createDataFrame([("c", i, 0.5) for i in range(60)], "chrom string, position int, baf double")
    sd = R.noise_sd(df, ["chrom"], ["position"], "baf").collect()[0]
    assert sd["sd"] == 0.09
