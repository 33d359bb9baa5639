"""Thin Hadoop FileSystem access from the driver, for metadata only.

Used to list what Spark's own listing leaves out (zero-byte files, hidden names)
and to remove scratch folders. Never reads or writes row data.
Works on any Hadoop-compatible store the session is configured for.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, directory: str) -> list[tuple[str, int]]:
    """``(path, length)`` of the files directly inside ``directory`` (zero-byte ones included)."""
    p, fs = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return [(st.getPath().toString(), int(st.getLen())) for st in fs.listStatus(p) if st.isFile()]


def list_dirs(spark: SparkSession, directory: str) -> list[str]:
    """Paths of the sub-directories directly inside ``directory``."""
    p, fs = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return [st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory()]


def mkdirs(spark: SparkSession, directory: str) -> None:
    p, fs = _fs(spark, directory)
    fs.mkdirs(p)


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file (a header line, a marker); not for data."""
    write_small_file(spark, path, text.encode("utf-8"))


def write_small_file(spark: SparkSession, path: str, content: bytes) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_small_text(spark: SparkSession, path: str) -> str:
    """The content of a small file (a commit)."""
    p, fs = _fs(spark, path)
    source = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its content at once, unless it is there: of several writers exactly one succeeds.

    The content is written under another name first. A local file system (one machine, or a mounted share) links it,
    any other renames it without overwriting; both fail where the name is taken. The store must rename atomically.
    """
    p, fs = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if exists(spark, path):
        return False
    other = f"{p.getParent().toString()}/.{uuid.uuid4().hex}"
    write_small_text(spark, other, text)
    q, _ = _fs(spark, other)
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(q.toUri().getPath(), p.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return _renamed(spark, q, p)
    finally:
        fs.delete(q, False)


def _renamed(spark: SparkSession, source, target) -> bool:
    """Rename without overwriting; false if the target is there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(source, target, options)
        return True
    except Exception as e:  # noqa: BLE001 — py4j wraps the Java exception
        if "AlreadyExists" in str(e):
            return False
        raise


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's file sources show it."""
    p, fs = _fs(spark, path)
    return fs.makeQualified(p).toString()


def glob_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files that match a glob pattern (Spark's own listing hides some names)."""
    p, fs = _fs(spark, pattern)
    return [st.getPath().toString() for st in (fs.globStatus(p) or []) if st.isFile()]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this session wrote (scratch of a finished load)."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)
