"""The few file operations a commit needs, on the file system that Spark itself uses for a path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted, without hidden ones; none if there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n[0] not in "._")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet; False if it does. Of two writers of one name, one succeeds."""
    fs, p = _fs(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or "already exists" in str(e.java_exception.getMessage()):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)
