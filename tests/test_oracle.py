"""Spark queries against their DuckDB twins on the smallest fixture (the driver gate uses sf0.01)."""
import os

import pytest

from tests.oracle_check import check

SF = "/root/testdata/sf0.001"
FAST = ["allele_signal", "pileup_counts", "sex_call", "contig_style", "known_snps_anti", "vcf_projection",
        "phased_split", "het_baf", "presegments", "noise_sd", "breakpoint_marks", "block_compaction",
        "match_signals", "run_segments", "local_minima", "ascat_optimum", "reliability", "segment_range_logr",
        "edge_candidates", "call_states"]


@pytest.mark.skipif(not os.path.exists(SF), reason="fixture tables not present")
def test_oracle_fast(spark):
    res = check(spark, SF, FAST, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    assert not bad, bad


def test_planted_truth_recovered(spark):
    import __spark_entry__ as E
    if not os.path.exists("/root/testdata/sf0.01"):
        pytest.skip("fixture tables not present")
    r = E.queries()["ascat_optimum"](spark, "/root/testdata/sf0.01").collect()[0]
    assert abs(r["psi"] - 2.4) < 1e-9 and abs(r["rho"] - 0.7) < 1e-9 and r["goodness"] > 95


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())
