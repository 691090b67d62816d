"""Small files and directories on the cluster's shared file system.

Only metadata passes through here (schemas, commit markers, version
pointers).  Data is read and written by Spark jobs.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Entry names of a directory, sorted; an absent directory has none."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def size(spark: SparkSession, path: str) -> int:
    """Bytes stored below a directory."""
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; it appears whole or not at all, and is never replaced."""
    fs, target = _resolve(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    _, draft = _resolve(spark, f"{target.getParent().toString()}/.draft-{uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new directory name under the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a local folder is used on a local master only; on a
    cluster a machine-local folder would not be seen by the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
    return f"{root.rstrip('/')}/{label}-{uuid4().hex}"
