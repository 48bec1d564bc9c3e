"""Small operations on a (possibly remote) folder through the session's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is_directory) of the entries directly under ``path`` (a listing, metadata only)."""
    fs, hpath = _at(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted((st.getPath().getName(), st.isDirectory()) for st in fs.listStatus(hpath))


def children(spark: SparkSession, path: str) -> list[str]:
    return [name for name, _ in entries(spark, path)]


def uri_path(spark: SparkSession, path: str) -> str:
    """The path without scheme and authority, absolute."""
    fs, hpath = _at(spark, path)
    return fs.makeQualified(hpath).toUri().getPath()


def uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority, special characters in per cent form."""
    fs, hpath = _at(spark, path)
    return fs.makeQualified(hpath).toUri().toString()


def qualified(spark: SparkSession, path: str) -> str:
    """The same as plain text, as Spark shows the paths of files."""
    fs, hpath = _at(spark, path)
    return fs.makeQualified(hpath).toString()


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that must not exist yet: of two writers only one succeeds."""
    fs, hpath = _at(spark, path)
    out = fs.create(hpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, hpath = _at(spark, path)
        fs.delete(hpath, True)
