"""Session construction for the command line, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, driver_memory: str = "6g", **conf: str) -> SparkSession:
    """A local session with adaptive execution. On a cluster, pass the cluster's own session around instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName("sedimenta")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only where none is set and driver and executors are one process."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="sedimenta-checkpoint-"))
    return sc.getCheckpointDir()


#: Folders of checkpoints that were made within scratch(), by thread.
_made = threading.local()


def cut_lineage(df):
    """Materialise df once in the checkpoint folder; later plans read those files."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if (made := getattr(_made, "folders", None)) is not None:
        folder = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if folder.isDefined():
            made.append(folder.get())
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the checkpoints that this thread made within it, at its end: what was derived of them has to be written by then."""
    outer, _made.folders = getattr(_made, "folders", None), []
    try:
        yield
    finally:
        folders, _made.folders = _made.folders, outer
        for folder in folders:
            remove(spark, folder)


def cut_all(df):
    """As cut_lineage(), without the size that Catalyst estimates: for loops of joins, whose estimates are products that double their digits with each round."""
    spark, cut = df.sparkSession, cut_lineage(df)
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(cut._jdf.queryExecution().toRdd(), cut._jdf.schema(), False), spark)


#: Bytes of an Arrow batch on its way to a Python worker. Ten thousand texts (Spark's own bound) can be 35 MB, which an executor holds several times over for each task.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """spark, with Arrow batches of BATCH_BYTES at most where the session names no smaller bound; one row is always whole."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def share_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine find the package wherever the driver was started; a cluster gets it by --py-files or an image."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return spark
