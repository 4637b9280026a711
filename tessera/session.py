"""Session helpers: a local session for tests and a lineage-cutting checkpoint."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes. AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splits hot keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset (local runs, tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Materialize ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    With a ``path`` the table lies there and outlives any ``scratch_scope``.

    Survives executor loss (nothing lives only on an executor), cuts the
    lineage, and — unlike ``DataFrame.checkpoint`` — keeps column pruning,
    predicate pushdown and vectorized reads for every later use. The shuffle
    files of the write go when it ends, not when the driver happens to collect
    its garbage.
    """
    spark = df.sparkSession
    scopes = _SCOPES if path is None else []
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    with dropping_shuffles(spark):
        df.write.mode("overwrite").parquet(path)
    for scope in scopes:
        scope.append(path)
    return spark.read.parquet(path)


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Have a write inside the block remove its shuffle files as it ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables ``cut_lineage`` writes inside the block when it exits.

    Use around work whose results are written elsewhere before the block ends
    (DataFrames that still read a scratch table must not outlive the scope).
    Deletion goes through the Hadoop FileSystem of each path, so it works on
    shared cluster storage as well as locally.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.remove(paths)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(conf).delete(hp, True)
