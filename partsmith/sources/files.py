"""File-system calls through the Hadoop API, so that any store Spark reads works alike
(a path without a scheme means the cluster's default store, not the driver's disk)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def file_size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getLen()


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def names(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder; None if there is no such folder.  Other errors are raised."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Give the folder ``new`` the name ``path``; a folder that has it goes only after that, and
    keeps it if the renaming fails."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    fresh = jvm.org.apache.hadoop.fs.Path(new)
    old = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.old")
    had = fs.exists(p)
    if had and not fs.rename(p, old):
        raise OSError(f"cannot rename {path}")
    if not fs.rename(fresh, p):
        if had:
            fs.rename(old, p)
        raise OSError(f"cannot rename to {path}")
    if had:
        fs.delete(old, True)


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all; of several writers of one path one succeeds,
    for the others the existing file is an error.

    The text goes to a file of its own first.  That gets the name in one step that fails if
    the name is taken: a link on the local file system, elsewhere a rename without
    overwriting (atomic where the store's renames are, as with HDFS)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.nio.file.Paths.get(x.toUri().getPath(), _strings(spark))
                     for x in (fs.makeQualified(p), fs.makeQualified(tmp))]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(
                getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(tmp, p, none)
    except Py4JJavaError as e:
        if fs.exists(p):
            raise FileExistsError(path) from e
        raise
    finally:
        if fs.exists(tmp):
            fs.delete(tmp, False)


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.String, 0)
