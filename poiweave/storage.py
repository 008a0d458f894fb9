"""Tables written to the folder that all executors share, to cut lineage and survive lost executors."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no ``spark.checkpoint.dir`` (tests, local runs).
LOCAL_DEFAULT = "file:/tmp/checkpoints/poiweave"
#: Spark's setting by which a finished write has its shuffle files removed.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Options of a write. Without Hadoop's native library every local file and folder that is made starts a ``chmod``, which for a moment
#: holds the memory of its JVM a second time; no checksum file and no success file means three of these less a file and six less a table.
#: Other file systems do not read the first two.
_FEW_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}
#: Seconds after which the next written table has the driver give memory back again.
GIVE_BACK_S = 5
_given = {"at": 0.0}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; in local mode a local default where the setting is unset, on a cluster a ValueError."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (folder or LOCAL_DEFAULT).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/poiweave/{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    """Hadoop's file system and path of a path."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's JVM delete a path when it ends."""
    files, there = _at(spark, path)
    files.deleteOnExit(there)


def give_back(spark: SparkSession) -> None:
    """Have the driver's JVM collect its garbage and give freed memory back to the system: plans of many exchanges use some hundred threads,
    of whose memory the C library keeps what it once had, and the heap does not shrink by itself."""
    jvm = spark._jvm
    jvm.java.lang.System.gc()
    try:  # called by reflection, since the server's own class is not open to the gateway; other JVMs have no such command
        server, command = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        command[0], command[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke").invoke(server, command)
    except Py4JError:
        pass


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: a plan without lineage.

    The files stay until ``discard`` or the end of the driver, since a lazy result may read them at any time. Shuffle files of the
    plan go as soon as the table is written: with many partitions a plan of many exchanges leaves three files a task and exchange, however few its rows.
    The driver gives memory back after a write, once in GIVE_BACK_S seconds at most.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.options(**_FEW_FILES).parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    drop_at_exit(spark, path)
    if time.monotonic() - _given["at"] > GIVE_BACK_S:
        give_back(spark)
        _given["at"] = time.monotonic()
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` wrote; nothing may read it afterwards."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/poiweave/" in f}:
        files, there = _at(df.sparkSession, folder)
        files.delete(there, True)
        files.cancelDeleteOnExit(there)
