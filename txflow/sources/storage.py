"""Small file-system helpers over the Hadoop API, and staging in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[tuple[str, bool, float]]:
    """Name, is-directory and modification time in seconds of each entry; empty if there is no such path."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime() / 1000) for s in fs.listStatus(p)]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*`` for parts of names."""
    fs, p = _fs(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file, whole or not at all; False if the name is taken.

    The text goes to a hidden file first and is then renamed without overwriting.
    """
    folder, name = path.rsplit("/", 1)
    fs, draft = _fs(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:8]}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    no_overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    no_overwrite[0] = rename.NONE
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(fs.makeQualified(draft), target, no_overwrite)
    except Py4JJavaError:
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a fresh temporary folder; on a cluster that
    would not be visible to the executors, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # a local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="run-")
    return _local_scratch[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/txflow/{name}-{uuid.uuid4().hex[:12]}"


class Staged(NamedTuple):
    """A frame that has been written once: its stored rows and where they lie."""

    rows: DataFrame
    path: str


@contextmanager
def staged(df: DataFrame, name: str, stored_at: str | None = None) -> Iterator[Staged]:
    """Write a frame once and read it back, for work that uses it several times.

    Cuts lineage, gives Spark the true size, and survives lost executors. The copy is
    removed at the end of the block, so no frame built on it may leave the block unread.
    A frame that is a plain read of files names their folder in ``stored_at`` and is not copied.
    """
    if stored_at is not None:
        yield Staged(df, stored_at)
        return
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    try:
        yield Staged(spark.read.schema(df.schema).parquet(path), path)
    finally:
        delete(spark, path)
