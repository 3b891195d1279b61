"""The folder jobs write intermediate tables and checkpoints to."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Where the setting is absent, a temporary folder serves on a local master only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return _reachable(spark, folder)
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _reachable(spark: SparkSession, folder: str) -> str:
    """`folder`, unless the executors of a cluster write to disks of their own there.

    A path of the machine's file system may be a mount that all share. Its name does not tell, so a trial write does.
    """
    local = spark.sparkContext.master.startswith("local")
    if not local and (folder.startswith("file:") or (folder.startswith("/") and _default_scheme(spark) == "file")):
        if not _shared(spark, folder):
            raise ValueError(f"{folder} is a folder of one machine; name one that all executors share")
    return folder


_FOUND_SHARED: set[tuple[str, str]] = set()


def _shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver sees what tasks write to the folder. Tried once in an application, by a task for each core."""
    tried = spark.sparkContext.applicationId, folder
    if tried not in _FOUND_SHARED:
        tasks = max(1, spark.sparkContext.defaultParallelism)
        trial = f"{folder.rstrip('/')}/trial-{uuid.uuid4().hex}"
        spark.range(0, tasks, 1, tasks).write.parquet(trial)
        seen = child_names(spark, f"{trial}/part-*")
        delete_folder(spark, trial)
        if len(seen) < tasks:
            return False
        _FOUND_SHARED.add(tried)
    return True


def _default_scheme(spark: SparkSession) -> str:
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).getScheme()


def new_table_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for a table's files, below the location of its database."""
    *database, table = name.split(".")
    home = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase()).locationUri
    return f"{_reachable(spark, home).rstrip('/')}/{table}-{uuid.uuid4().hex}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def child_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, by metadata only."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def create_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
