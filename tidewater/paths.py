"""Path operations through the Hadoop FileSystem of the session.

Renames and deletes go through the same FileSystem the writers use, so
they work on any Hadoop-compatible store the cluster is configured for
(HDFS, object stores with a committer, local files in tests). These run
on the driver and touch directory metadata only, never row data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(s, d):
        raise IOError(f"rename failed: {src} -> {dst}")


def size(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (a file or a folder)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small marker files (commit markers); never row data."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small marker file written by ``write_text``."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")
