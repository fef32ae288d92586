"""Session helpers: a local session for tests, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cores: int | str = 8, memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the bench. On a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyrec")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder of its own; anywhere else a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallyrec-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_workspace: ContextVar[str | None] = ContextVar("workspace", default=None)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the tables that :func:`materialize` writes, deleted at the end.

    What a job returns reads those tables, so write or collect it before the end.
    """
    path = f"{shared_folder(spark)}/workspace-{uuid.uuid4().hex}"
    token = _workspace.set(path)
    try:
        yield path
    finally:
        _workspace.reset(token)
        delete(spark, path)


def _hadoop_path(spark: SparkSession, path: str):
    # PySpark has no public way to look at or delete files of a store that only Spark reaches
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name."""
    found, store = _hadoop_path(spark, path)
    return store.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it."""
    found, store = _hadoop_path(spark, path)
    store.delete(found, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the files and folders in a folder."""
    found, store = _hadoop_path(spark, path)
    return sorted(status.getPath().getName() for status in store.listStatus(found))


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole; False if there is one of that name already.

    The text goes to a hidden file first, which is then renamed, so nobody sees half a file.
    """
    found, store = _hadoop_path(spark, path)
    if store.exists(found):
        return False
    hidden, _ = _hadoop_path(spark, f"{found.getParent()}/.{uuid.uuid4().hex}")
    out = store.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if store.rename(hidden, found):
        return True
    store.delete(hidden, False)
    return False


def materialize(df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, under another ``schema`` if one is given.

    This cuts the lineage and, unlike a checkpointed RDD, keeps column pruning and gives the
    optimizer the true size of the table, so its choice of broadcast or shuffle join is checked.
    """
    folder = _workspace.get() or shared_folder(df.sparkSession)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
