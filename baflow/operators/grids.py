"""Sums over the cells of a rho x psi grid by partial vectors (FIT-04, FIT-05, FIT-12, JN-13).

Every row of a sample adds a term to each cell of the sample's grid. A task adds its rows into one array per sample and
sum, and puts out that array in rows of one psi each; a second step adds the arrays of the tasks. What is shuffled is tasks x samples
arrays, not rows x cells. A task holds ``HELD`` samples' arrays at a time (about 1 MB each) and puts them out before it takes more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from baflow.session import ship_package, spread

HELD = 32              # samples whose arrays a task holds
ROWS = 16              # rows that are spread over the grid at once
SPEC = ("psi_min", "psi_by", "n_psi", "rho_min", "rho_by", "n_rho")


def seq_len(lo, hi, by):
    """Number of points of R ``seq(lo, hi, by)``."""
    return (F.floor((hi - lo) / by + F.lit(1e-10)) + 1).cast("int")


def with_spec(rows: DataFrame, spec) -> DataFrame:
    """Attach the grid of each row's sample: psi_min, psi_by, n_psi, rho_min, rho_by, n_rho.

    ``spec`` is either a dict of constants or a DataFrame with one row per sample (psi_min, psi_max,
    psi_by, rho_min, rho_max, rho_by) joined on sample_id (one row per sample; Spark broadcasts it when
    its measured size is under the threshold).
    """
    if isinstance(spec, dict):
        d = rows.withColumns({k: F.lit(float(v)) for k, v in spec.items()})
    else:
        d = rows.join(spec.select("sample_id", "psi_min", "psi_max", "psi_by", "rho_min", "rho_max", "rho_by"), "sample_id")
    return d.withColumns({"n_psi": seq_len(F.col("psi_min"), F.col("psi_max"), F.col("psi_by")),
                          "n_rho": seq_len(F.col("rho_min"), F.col("rho_max"), F.col("rho_by"))}).drop("psi_max", "rho_max")


def cell_sums(rows: DataFrame, columns, kernel, sums) -> DataFrame:
    """(sample_id, i, j, psi, rho, n_psi, n_rho, sums): for every cell of each sample's grid the sums of ``kernel``'s terms.

    ``rows`` carry sample_id, ``SPEC`` and ``columns``. ``kernel(row, psi, rho)`` gets a dict of the columns as
    arrays of shape (rows, 1, 1) (null: NaN) and psi, rho of shapes (1, n_psi, 1) and (1, 1, n_rho); it returns one array
    for each name in ``sums``; terms that are NaN do not count.
    """
    ship_package(rows.sparkSession)
    columns, sums = list(columns), list(sums)
    kind = rows.schema["sample_id"].dataType.simpleString()
    key_type = to_arrow_type(rows.schema["sample_id"].dataType)
    partial = f"sample_id {kind}, psi_min double, psi_by double, n_psi int, rho_min double, rho_by double, n_rho int, i int, v array<double>"

    def put(held):
        for (key, spec), total in held.items():
            n = total.shape[1]
            cols = [pa.array([key] * n, key_type)] + [pa.array([x] * n, pa.int32() if c[0] == "n" else pa.float64())
                                                      for c, x in zip(SPEC, spec, strict=True)]
            flat = np.ascontiguousarray(total.transpose(1, 0, 2)).reshape(n, -1)
            cols += [pa.array(np.arange(n, dtype="i4")), pa.array(list(flat), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["sample_id", *SPEC, "i", "v"])

    def add(batches):
        held = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            keys = b.column("sample_id").to_pylist()
            specs = list(zip(*[b.column(c).to_pylist() for c in SPEC], strict=True))
            values = {c: b.column(c).to_numpy(zero_copy_only=False).astype("f8") for c in columns}
            places = {}
            for k, key in enumerate(zip(keys, specs, strict=True)):
                places.setdefault(key, []).append(k)
            for key, at in places.items():
                if key not in held and len(held) == HELD:
                    yield from put(held)
                    held = {}
                psi_min, psi_by, n_psi, rho_min, rho_by, n_rho = key[1]
                total = held.setdefault(key, np.zeros((len(sums), n_psi, n_rho)))
                psi = (psi_min + np.arange(n_psi) * psi_by)[None, :, None]
                rho = (rho_min + np.arange(n_rho) * rho_by)[None, None, :]
                for lo in range(0, len(at), ROWS):
                    part = at[lo:lo + ROWS]
                    with np.errstate(all="ignore"):
                        terms = kernel({c: v[part][:, None, None] for c, v in values.items()}, psi, rho)
                    for k, name in enumerate(sums):
                        term = np.broadcast_to(terms[name], (len(part), n_psi, n_rho))
                        total[k] += np.where(np.isnan(term), 0.0, term).sum(axis=0)
        yield from put(held)

    def merge(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        first = t.slice(0, 1).to_pylist()[0]
        total = np.zeros(len(sums) * first["n_rho"])
        for v in t.column("v").chunk(0):
            total += v.values.to_numpy()
        n, i = first["n_rho"], first["i"]
        j = np.arange(n)
        out = {"sample_id": pa.array([first["sample_id"]] * n, key_type), "i": pa.array(np.full(n, i, "i4")), "j": pa.array(j.astype("i4")),
               "psi": pa.array(np.full(n, first["psi_min"] + i * first["psi_by"])), "rho": pa.array(first["rho_min"] + j * first["rho_by"]),
               "n_psi": pa.array(np.full(n, first["n_psi"], "i4")), "n_rho": pa.array(np.full(n, n, "i4"))}
        return pa.table(out | {name: pa.array(x) for name, x in zip(sums, total.reshape(len(sums), n), strict=True)})

    # a row is small but stands for thousands of cells; in ranges, a sample's rows lie in few tasks
    told = spread(rows.select("sample_id", *SPEC, *columns), "sample_id", *columns).mapInArrow(add, partial)
    # the grid is the sample's, so its numbers may stand in the key
    return told.groupBy("sample_id", "i").applyInArrow(
        merge, f"sample_id {kind}, i int, j int, psi double, rho double, n_psi int, n_rho int, " + ", ".join(f"{s} double" for s in sums))
