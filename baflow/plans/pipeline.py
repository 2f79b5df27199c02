"""End-to-end run (PIPE-01..05): counting -> phasing inputs -> segmentation -> fit -> calling -> frames.

A run is a table of stages. A stage is built when it is asked for, with what it needs, and stored once; many samples go
through one job. With a store the stages are kept under a key of the stage's name, its parameters and the keys of what it is built
from, so a later run reads what is there and builds only what a changed parameter or input touches.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.operators import call as K
from baflow.operators import fit as T
from baflow.operators import phase as H
from baflow.operators import pileup as P
from baflow.operators import plot_frames as PF
from baflow.operators import segment as G
from baflow.operators import signals as S
from baflow.session import cut_lineage


@dataclass(frozen=True)
class RunParams:
    """Run defaults (reference values); switches skip stages whose output is given as input."""
    min_baseq: int = 20
    min_mapq: int = 35
    min_counts: int = 10
    het_min_counts: int = 10
    seed: int = 42
    gamma_seg: float = 10.0
    phasegamma: float = 3.0
    kmin: int = 3
    phasekmin: int = 3
    hole_limit: int = 3_000_000
    calc_seg_baf_option: int = 3
    no_segmentation: bool = False
    fit: T.FitParams = field(default_factory=T.FitParams)


class Store:
    """Stored stages under ``root``: ``<name>-<key>`` with the rows and ``<name>-<key>.done`` once they are complete (FLT-14)."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.built: list[str] = []

    def get(self, name: str, key: str, build: Callable[[], DataFrame], spark) -> DataFrame:
        path = f"{self.root}/{name}-{key}"
        try:
            spark.read.schema("name string").parquet(f"{path}.done").limit(1).count()
        except AnalysisException:                       # no such folder: not built, or not to the end
            build().write.mode("overwrite").parquet(path)
            spark.createDataFrame([(name,)], "name string").write.mode("overwrite").parquet(f"{path}.done")
            self.built.append(name)
        return spark.read.parquet(path)


def snapshot(df: DataFrame) -> str:
    """What an input is known by: its files and schema. Inputs without files, or derived ones, should be named by the caller (``snapshots``)."""
    return json.dumps([sorted(df.inputFiles()), df.schema.jsonValue()], sort_keys=True)


class Run(Mapping):
    """PIPE-01: the stages of one run by name, built on demand.

    ``tables`` may hold: ``bases`` + ``loci`` (or ``counts``), ``phased`` (or ``het_baf``), ``breakpoints``, ``contig_stats``,
    ``baf_segmented`` (skips segmentation), ``legend`` with or without ``problem_loci`` (adds genotype calls and their
    VCF columns), ``impute_info`` (adds the reference panel's files that fit the sample's sex). A given table stands for its stage.
    """

    def __init__(self, tables: dict[str, DataFrame], params: RunParams = RunParams(), side=None, store: Store | None = None,
                 snapshots: dict[str, str] | None = None):
        self.tables, self.p, self.side, self.store = tables, params, side, store
        self.spark = next(iter(tables.values())).sparkSession
        self._frames: dict[str, DataFrame] = {}
        self._keys: dict[str, str] = {}
        self._snapshots = snapshots or {}
        params.fit.check()
        self._stages = self._plan()

    def _plan(self) -> dict[str, tuple[tuple[str, ...], tuple, bool, Callable[..., DataFrame]]]:
        """name -> (what it is built from, parameters, whether it is stored, how it is built)."""
        p, t, fit = self.p, self.tables, self.p.fit
        out: dict[str, tuple] = {}
        if "contig_stats" in t:                                        # PIPE-05 run defaults
            out["sex"] = (("contig_stats",), (), False, P.sex_call)
            out["chromosomes"] = (("contig_stats",), (), False, P.contig_style)
            if "impute_info" in t:
                out["panel"] = (("impute_info", "sex"), (), False, H.panel_files)
        # PIPE-02 counting
        out["allele_quality"] = (("loci",), (), False, S.allele_quality)
        out["counts"] = (("bases", "loci"), (p.min_baseq, p.min_mapq), True, lambda b, loci: P.pileup_counts(b, loci, p.min_baseq, p.min_mapq))
        out["signal"] = (("counts", "loci"), (p.min_counts, p.seed, str(self.side)), True, lambda counts, loci: S.logr_normalised(S.baf_side(
            cut_lineage(S.min_depth(S.allele_pair_counts(counts, loci), p.min_counts)), self.side, p.seed)))
        for name in S.SIGNAL_OUTPUTS:
            out[f"signal_{name}"] = (("signal",), (name,), False, lambda signal, name=name: S.signal_outputs(signal)[name])
        if "legend" in t:                                              # PH-01..04: what a phasing solver reads
            known = ("legend", "problem_loci") if "problem_loci" in t else ("legend",)
            out["genotypes"] = (("counts", *known), (), False, lambda counts, legend, bad=None: H.call_genotype(
                H.snp_baf(counts, legend if bad is None else H.known_snps(legend, bad))))
            out["vcf"] = (("genotypes",), (), False, H.vcf_projection)
        # PIPE-03 heterozygous BAF (the phasing solver itself is external)
        out["het_baf"] = (("counts", "phased"), (p.het_min_counts,), True,
                          lambda counts, phased: H.het_baf(counts, H.phased_split(phased), p.het_min_counts))
        # PIPE-04 segmentation -> fit -> call
        prior = ("breakpoints",) if "breakpoints" in t else ()
        seg = (p.gamma_seg, p.phasegamma, p.kmin, p.phasekmin, p.no_segmentation, p.calc_seg_baf_option, p.hole_limit)
        out["baf_segmented"] = (("het_baf", *prior), seg, True, lambda het, bps=None: G.segment_baf_phased(het, bps, *seg))
        raw = lambda signal, c: signal.select("sample_id", "chrom", "position", F.col(c).alias("value"))
        out["matched"] = (("baf_segmented", "signal"), (), True, lambda s, signal: T.match_signals(s, raw(signal, "mutant_baf"), raw(signal, "mutant_logr")))
        out["logr_segmented"] = (("matched",), (), False, lambda m: raw(m, "logr_seg"))
        grid = (fit.min_ploidy, fit.max_ploidy, fit.min_rho, fit.max_rho, fit.min_goodness, fit.uninformative_baf, fit.gamma, fit.ascat_dist_choice)
        whole = (*grid, fit.clonal_dist_choice, fit.siglevel_baf, fit.maxdist_baf)
        out["segments"] = (("matched",), (), True, T.segment_info)
        out["distance"] = (("segments",), grid, True, lambda s: T.first_distance(s, fit))
        out["ascat"] = (("distance",), grid, True, lambda d: T.ascat_optimum(d, fit))
        out["clonal_distance"] = (("segments", "ascat"), whole, True, lambda s, o: T.second_distance(s, o, fit))
        out["run_clonal"] = (("segments", "clonal_distance"), whole, True, lambda s, c: T.run_clonal(s, c, fit))
        out["rho_psi"] = (("ascat", "run_clonal"), (), False, T.rho_psi_table)
        out["reliability"] = (("segments", "ascat"), (fit.gamma,), False, lambda s, o: T.reliability(s.withColumn("b", 1 - F.col("b")), o, fit.gamma))
        plain = lambda df: df.withColumn("chrom", F.regexp_replace("chrom", "chr", ""))
        out["copy_number"] = (("baf_segmented", "signal", "rho_psi"), (fit.gamma, fit.siglevel_baf, fit.maxdist_baf), True,
                              lambda s, signal, rp: K.call_subclones(plain(s), plain(raw(signal, "mutant_logr")), rp, fit.gamma, fit.siglevel_baf, fit.maxdist_baf))
        # plot-ready frames
        out["plot_haplotype"] = (("het_baf",), (), False, PF.haplotype_frame)
        out["plot_segments"] = (("baf_segmented",), (), False, PF.segmented_frame)
        if prior:
            out["plot_breakpoints"] = (("breakpoints",), (), False, PF.breakpoint_frame)
        out["plot_distance"] = (("distance",), (), False, PF.distance_frame)
        out["plot_cnv"] = (("copy_number",), (), False, PF.cnv_frame)
        out["plot_cnv_points"] = (("het_baf", "copy_number"), (), False, PF.cnv_points_frame)
        out["plot_profile"] = (("reliability",), (), False, PF.profile_frame)
        out["plot_profile_raw"] = (("reliability",), (), False, lambda r: PF.profile_frame(r, rounded=False))
        known = set(t)
        for name, stage in out.items():                                # only what can be built from the given tables
            if set(stage[0]) <= known:
                known.add(name)
        return {name: stage for name, stage in out.items() if name in known and name not in t}

    def _key(self, name: str) -> str:
        if name not in self._keys:
            if name in self.tables:
                text = self._snapshots.get(name) or snapshot(self.tables[name])
            else:
                needs, params, _, _ = self._stages[name]
                text = json.dumps([name, [self._key(n) for n in needs], params])
            self._keys[name] = hashlib.sha256(text.encode()).hexdigest()[:24]
        return self._keys[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        if name not in self._frames:
            needs, _, stored, build = self._stages[name]
            make = lambda: build(*[self[n] for n in needs])
            if not stored:
                self._frames[name] = make()
            elif self.store is None:
                self._frames[name] = cut_lineage(make())
            else:
                self._frames[name] = self.store.get(name, self._key(name), make, self.spark)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._stages)

    def __len__(self) -> int:
        return len(self._stages)


def run(tables: dict[str, DataFrame], params: RunParams = RunParams(), side=None, store: Store | None = None,
        snapshots: dict[str, str] | None = None) -> Run:
    """The stages of a run; see ``Run``."""
    return Run(tables, params, side, store, snapshots)


def write_outputs(outputs: Mapping[str, DataFrame], root: str, names=None) -> None:
    """SNK-11: every stage as Parquet under ``root/<name>``, one directory per sample."""
    from baflow.sources.io import write_table
    for name in outputs:
        if names is None or name in names:
            write_table(outputs[name], f"{root}/{name}")
