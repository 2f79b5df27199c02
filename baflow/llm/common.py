"""Helpers shared by the operators: inputs, folds, saved tables and bounded training samples."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from baflow.session import checkpoint_dir, ship_package


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The whole given table."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    What reads the result restarts from these files, also when executors are lost. The folder has a
    new name each time; it lives as long as other files of ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def sample_rate(rows: int, bound: int) -> float:
    """Share of rows that gives ``bound`` rows on average."""
    return min(1.0, bound / rows) if rows else 1.0


def hash_share(rate: float, *cols: str, seed: int = 7) -> Column:
    """True for a repeatable share ``rate`` of the values of ``cols``."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(1 << 20)) < int(rate * (1 << 20) + 0.999)


def slices(batches: Iterator[pa.RecordBatch], col: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of about ``size`` bytes of the text column ``col``; one long text stays whole."""
    for b in batches:
        if b.num_rows == 0:
            continue
        total = pc.fill_null(pc.binary_length(b.column(col)), 0).to_numpy(zero_copy_only=False).astype("i8").cumsum()
        start = 0
        while start < b.num_rows:
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(total.searchsorted(base + size, "right")))
            yield b.slice(start, stop - start)
            start = stop


def map_texts(docs: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str,
              keep: tuple[str, ...] = ("doc_id",), size: int = 8_000_000) -> DataFrame:
    """Apply ``fn`` to pieces of ``docs`` (columns ``keep`` and ``text``); ``fn`` gives the new columns.

    ``fn(batch)`` returns a dict of arrays of the batch's length; the result has ``keep`` (types as they
    were, nulls untouched) and the columns of ``schema``.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    new_fields = T.StructType.fromDDL(schema).fields
    names, types = [f.name for f in new_fields], [to_arrow_type(f.dataType) for f in new_fields]
    cols = [F.col(c) for c in keep if c != "text"] + [F.col("text").cast("string").alias("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", size):
            new = fn(b)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(new[c], t) for c, t in zip(names, types, strict=True)],
                                             names=[*keep, *names])

    full = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [schema])
    return docs.select(*cols).mapInArrow(run, full)
