"""Session helpers: one place for configuration and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs regardless of cluster size. Partition counts are left to AQE.
_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "baflow") -> SparkSession:
    """Build (or reuse) a session. ``master`` is only set for local runs and tests."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        b = (b.config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
             .config("spark.ui.showConsoleProgress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the cluster configuration (a shared file system);
    only a local master may fall back to a fresh temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        d = tempfile.mkdtemp(prefix="baflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it back.

    What reads the result restarts from these files, also when executors are lost. Nothing is cached on
    executors and nothing is written twice; later steps read only the columns they need. The folder has a new name each time and lives as long as
    other files of ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *order: str) -> DataFrame:
    """Deal few rows with much work each to one task per core, in ranges of ``order`` if given; adaptive planning would put them into one task."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(n, *order) if order else df.repartition(n)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``baflow`` importable in the Python workers (pandas UDFs) -- the ``--py-files`` step.

    The package source is zipped once per application and added with ``SparkContext.addPyFile``,
    which Spark distributes to every executor; harmless when the package is installed there already.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    import baflow
    pkg = os.path.dirname(os.path.abspath(baflow.__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="baflow-pyfiles-"), "baflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
