"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at any scale. On a cluster, raise
# spark.sql.shuffle.partitions to several times the core count and let AQE
# coalesce small partitions; the advisory size keeps each reducer's input
# spill-free on a typical executor.
# Broadcasts: the planner's static estimate for a file scan is its compressed
# size, which says little about the table in memory, so static automatic
# broadcasting is off. AQE still turns a join into a broadcast join after the
# shuffle stage has run, from the measured (uncompressed) size of that side.
# Explicit broadcast() hints are used only on data whose size is bounded by
# construction (25 nations, one row per partition, a forest's node table).
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "credtrail", master: str | None = None,
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM
        settings.setdefault("spark.driver.memory", "16g")
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


COMPRESSION = "zstd"  # of written tables: about two thirds of snappy's bytes


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring Spark to use it.

    The cluster names the folder in ``spark.checkpoint.dir``; it is only
    invented here (as a fresh temporary folder) when Spark runs in local mode
    and nothing is configured, as in tests.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        current = sc.getCheckpointDir()
        if current:
            return current.rsplit("/", 1)[0]
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) that every executor can reach")
        configured = tempfile.mkdtemp(prefix="credtrail-ckpt-")
        warnings.warn(f"spark.checkpoint.dir is not set: local mode writes to {configured}", stacklevel=2)
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def temporary_snapshots(spark: SparkSession):
    """Snapshots that are made inside are deleted at the end: for runs that write their results
    elsewhere before they leave the block."""
    _open_scopes.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _open_scopes.pop():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(hadoop).delete(p, True)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Each write inside deletes its shuffle files when it ends; otherwise they stay until the driver
    happens to collect garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def write_snapshot(df, name: str = "snapshot"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but stays columnar; the written files
    survive executor loss.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``credtrail`` importable in Python workers (pandas UDFs pickle its functions
    by reference): zip the package once per application into the shared checkpoint
    folder and register it with ``addPyFile``."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    if "://" in root and not root.startswith("file:"):
        target_dir = None  # remote folder: build locally, Spark uploads it
    else:
        target_dir = root.replace("file:", "")
    import tempfile
    out_dir = target_dir or tempfile.mkdtemp(prefix="credtrail-pyfiles-")
    os.makedirs(out_dir, exist_ok=True)
    path = os.path.join(out_dir, f"credtrail-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
