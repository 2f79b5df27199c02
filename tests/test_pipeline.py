"""The run as stored stages: built on demand, kept by key, rebuilt where something changed; sex and panel defaults."""
import dataclasses
import tempfile

import pytest

from baflow.plans.pipeline import RunParams, Store, run
from baflow.plans.q_signals import TP, test_side as side
from baflow.sources import views as V

SF = "/root/testdata/sf0.001"


def tables(spark):
    return {"bases": V.bases(spark, SF), "loci": V.loci(spark, SF), "phased": V.phased(spark, SF), "contig_stats": V.contigs(spark, SF)}


def test_second_run_builds_nothing_and_a_parameter_only_what_depends_on_it(spark):
    root = tempfile.mkdtemp(prefix="baflow-store-")
    p = RunParams(min_baseq=TP["min_baseq"], min_mapq=TP["min_mapq"], min_counts=TP["min_counts"], het_min_counts=TP["min_counts"])
    store = Store(root)
    first = run(tables(spark), p, side(), store)
    assert store.built == []                                  # nothing until a stage is asked for
    rows = sorted(map(tuple, first["het_baf"].collect()))
    assert store.built == ["counts", "het_baf"]
    store = Store(root)
    again = run(tables(spark), p, side(), store)
    assert sorted(map(tuple, again["het_baf"].collect())) == rows and store.built == []
    again["signal"].count()
    assert store.built == ["signal"]
    store = Store(root)
    more = run(tables(spark), dataclasses.replace(p, het_min_counts=p.het_min_counts + 2), side(), store)
    assert more["het_baf"].count() < len(rows) and store.built == ["het_baf"]
    store = Store(root)
    other = run(tables(spark), p, side(), store, snapshots={"bases": "another table"})
    other["counts"].count()
    assert store.built == ["counts"]


def test_given_tables_stand_for_stages(spark):
    t = tables(spark)
    counts = run(t, RunParams(min_baseq=20, min_mapq=0), side())["counts"]
    r = run({"counts": counts, "loci": t["loci"]}, RunParams(min_counts=3), side())
    assert r["counts"] is counts and "het_baf" not in r and "copy_number" not in r and "signal_mutant_baf" in r
    assert r["allele_quality"].agg({"n_loci": "sum"}).first()[0] == t["loci"].count()
    assert r["signal_mutant_baf"].columns == ["sample_id", "chrom", "position", "value"]


def test_panel_follows_the_sex_call(spark):
    info = spark.createDataFrame([("X", "a", 1), ("X", "b", 0), ("1", "c", 0)], "chrom string, impute_legend string, is_par int")
    stats = [("m", "1", 100, 100, 0), ("m", "chrX", 100, 100, 0), ("f", "1", 100, 100, 0), ("f", "chrX", 100, 50, 0)]
    schema = "sample_id string, chrom string, length long, mapped long, unmapped long"
    r = run({"contig_stats": spark.createDataFrame(stats, schema), "impute_info": info})
    got = sorted((x["sample_id"], x["impute_legend"]) for x in r["panel"].collect())
    assert got == [("f", "a"), ("f", "b"), ("f", "c"), ("m", "a")]
    without = run({"contig_stats": spark.createDataFrame(stats[:1], schema), "impute_info": info})
    with pytest.raises(Exception, match="no X contig"):
        without["panel"].collect()
