import numpy as np
from pyspark.sql import functions as F

from baflow.functions.rmath import dbinom_np, t_two_sided_np


def test_t_closed_forms():
    t = np.array([0.0, 0.5, 1.0, 3.0, -2.0])
    # df = 1 (Cauchy) and df = 2 have closed forms
    assert np.allclose(t_two_sided_np(t, np.ones(5)), 1 - 2 / np.pi * np.arctan(np.abs(t)))
    assert np.allclose(t_two_sided_np(t, 2 * np.ones(5)), 1 - np.abs(t) / np.sqrt(2 + t * t))


def test_t_large_df_is_normal():
    # two-sided normal tail at 1.96 is 0.05
    assert abs(t_two_sided_np(np.array([1.959964]), np.array([1e6]))[0] - 0.05) < 1e-4


def test_dbinom_sums_to_one():
    for n, p in [(10, 0.3), (30, 0.5), (7, 0.0), (7, 1.0)]:
        k = np.arange(n + 1)
        assert abs(dbinom_np(k, np.full(n + 1, n), np.full(n + 1, p)).sum() - 1) < 1e-12


def test_half_even_rounding(spark):
    rows = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (-1.5,)], "x double")
    got = [r[0] for r in rows.select(F.rint("x")).collect()]
    assert got == [0.0, 2.0, 2.0, -0.0, -2.0]
