"""Small text files and listings on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file; None if it is missing."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, without reading on."""
    fs, where = _at(spark, path)
    stream = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(where), "UTF-8"))
    try:
        return stream.readLine() or ""
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, *, overwrite: bool = True) -> None:
    """Without `overwrite` an existing file is an error, also if another writer just made it."""
    fs, where = _at(spark, path)
    stream = fs.create(where, overwrite)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; nothing happens if the session is gone already."""
    try:
        fs, where = _at(spark, path)
        fs.delete(where, True)
    except Exception:
        pass
