"""Session settings and the shared folder used to cut lineage.

Every setting here is a plain Spark option a user would put in
``spark-defaults.conf``; ``configure`` only fills in what is not set yet, so a
cluster's own choices win.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Options the engine relies on.  AQE re-plans joins on measured sizes and splits
# skewed join partitions; co-partitioning on a subset of the join keys lets a
# table that is hash-partitioned by user join its (user, x) aggregates without
# a second shuffle.
ENGINE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # feature rows are wide (~400 columns): keep whole-stage codegen for them
    "spark.sql.codegen.maxFields": "2000",
    # small shuffles of heavy rows: do not coalesce below 64 KB per task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``ENGINE_DEFAULTS`` where the session does not set them.

    ``spark.sql.requireAllClusterKeysForCoPartition`` is forced: it is what
    makes the per-user layout shuffle-free.  The session's time zone is left
    alone; the tables hold zone-free ``TIMESTAMP_NTZ``.
    """
    forced = {"spark.sql.requireAllClusterKeysForCoPartition"}
    for key, value in ENGINE_DEFAULTS.items():
        if key in forced or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clickweave") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers: a zip that Spark distributes, once per application."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        at = os.path.join(tempfile.mkdtemp(), "clickweave-package")
        spark.sparkContext.addPyFile(shutil.make_archive(at, "zip", os.path.dirname(package), os.path.basename(package)))
        _SHIPPED.add(spark.sparkContext.applicationId)


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for stage tables and checkpoints.

    ``spark.checkpoint.dir`` of the session, else of the application, else the
    folder given to ``SparkContext.setCheckpointDir``.  Only a local session
    may do without: it gets one temporary folder per application (tests).
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    root = root or _LOCAL_ROOTS.get(context.applicationId) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        # the option itself cannot be set on a running session, so the folder is remembered here
        root = _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="clickweave-checkpoints-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for a written table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir``.

    Unlike a written parquet table, ``Dataset.checkpoint`` keeps the physical
    output partitioning, so a table hash-partitioned by user stays co-located
    with the next stage's per-user joins.  Files live in the shared folder, so
    a lost executor does not lose them (never ``localCheckpoint``).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a stage folder (in whatever file system the path names)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_table(df: DataFrame, name: str, path: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Cut lineage by writing a parquet table into the shared checkpoint
    folder and reading it back.

    Used for wide stage outputs that later stages read only in part (the
    feature table has ~270 columns, the encoders read ~35): parquet lets the
    scan prune columns, which a checkpoint of serialized rows cannot.  The
    hash partitioning is not kept, so tables that are joined on their
    partitioning key use ``cut_lineage`` instead.  ``path`` names the folder
    of a stage that is kept; an unfinished earlier attempt there is replaced.
    ``by`` names columns of few values that become sub-folders, so that a
    filter on them reads only its own files.
    """
    mode = "overwrite" if path else "errorifexists"
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode(mode).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
