"""Raw tree of one-JSON-object-per-file documents, and plain file listings."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from fnmatch import fnmatchcase
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave import storage
from citeweave.session import materialize

# Bytes of file contents that a task gathers before it passes them on.
_READ_BYTES = 8 << 20


def read_raw_tree(spark: SparkSession, root: str | list[str], schema: T.StructType | None = None,
                  glob: str = "*.json", mode: str = "FAILFAST") -> DataFrame:
    """Every ``glob``-matching file under ``root`` (recursively) as one record.

    Each file holds one JSON object (``multiLine``). ``_file_name`` / ``_file_path`` come from the
    scan's hidden ``_metadata`` column. Pass a declared ``schema`` to skip inference (inference
    reads every file once more). A file that is not valid JSON is an error; ``mode`` may say
    otherwise.
    """
    reader = (spark.read.option("multiLine", True).option("recursiveFileLookup", True)
              .option("pathGlobFilter", glob).option("mode", mode))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(root)
    return (df.withColumn("_file_name", F.col("_metadata.file_name"))
            .withColumn("_file_path", F.col("_metadata.file_path")))


def top_folder(spark: SparkSession, root: str) -> Column:
    """The folder directly under ``root`` that a scanned file lies in, from the scan's path (a URI,
    with special characters in per cent form). One scan then serves any number of folders."""
    depth = len([c for c in storage.uri_path(spark, root).split("/") if c])
    parts = F.filter(F.split(F.regexp_replace(F.col("_metadata.file_path"),
                                              "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/"),
                     lambda c: c != "")
    return F.url_decode(F.replace(F.element_at(parts, depth + 1), F.lit("+"), F.lit("%2B")))


def read_raw_text(spark: SparkSession, root: str | list[str], glob: str = "*.json",
                  folder_of: str | None = None) -> DataFrame:
    """Every ``glob``-matching file under ``root`` (recursively) as its whole text: ``text``,
    ``_file_name`` and, with ``folder_of``, ``_folder`` (see :func:`top_folder`). No parsing, no
    schema."""
    # load, not text: that method's own default would override the option.
    scan = (spark.read.format("text").option("wholetext", True)
            .option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root))
    folder = [top_folder(spark, folder_of).alias("_folder")] if folder_of else []
    return scan.select(F.col("value").alias("text"),
                       F.col("_metadata.file_name").alias("_file_name"), *folder)


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    parts = urlsplit(uri)
    if parts.scheme == "file":
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(uri)


def can_walk(spark: SparkSession, root: str) -> bool:
    """Whether tasks can open the tree's storage themselves; if not, Spark has to list it."""
    try:
        _opened(storage.uri(spark, root))
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def _taken(entry: pafs.FileInfo, glob: str) -> bool:
    """As Spark's own listing does: hidden names and empty files are no input."""
    name = entry.base_name
    hidden = name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name)
    if entry.type == pafs.FileType.Directory:
        return not hidden or name.startswith(("_metadata", "_common_metadata"))
    return not hidden and entry.size > 0 and fnmatchcase(name, glob)


def walked_files(spark: SparkSession, root: str, folders: Sequence[str],
                 glob: str = "*") -> DataFrame:
    """(``rel``: the path below ``root``, ``length``) of every ``glob``-matching file under these
    folders of ``root``, recursively, that is not empty. Tasks list the folders, one level of the tree per job, and
    write what they find to scratch: names and sizes never go through the driver."""
    uri = storage.uri(spark, root)

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _opened(uri)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [x for x in fs.get_file_info(pafs.FileSelector(f"{base}/{folder}"))
                         if _taken(x, glob)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{x.base_name}" for x in found], pa.string()),
                     pa.array([None if x.type == pafs.FileType.Directory else x.size
                               for x in found], pa.int64())], ["rel", "length"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = spark.createDataFrame([(f,) for f in folders], "rel string")
    files = spark.createDataFrame([], "rel string, length long")
    width = len(folders)
    while width:
        found = materialize(level.repartition(min(width, tasks))
                            .mapInArrow(listed, "rel string, length long"), "listed-files")
        files = files.unionByName(found.where("length IS NOT NULL"))
        level = found.where("length IS NULL").select("rel")
        width = level.count()
    return files


def read_walked_text(spark: SparkSession, root: str, folders: Sequence[str], glob: str = "*.json",
                     open_cost_bytes: int = 64 * 1024) -> DataFrame:
    """What :func:`read_raw_text` reads of these folders of ``root`` (``text``, ``_file_name``,
    ``_folder``), listed and read in tasks; a task takes as many files as one scan task would."""
    uri = storage.uri(spark, root)
    files = walked_files(spark, root, folders, glob)
    cost = files.agg(F.sum(F.col("length") + F.lit(open_cost_bytes))).first()[0] or 0
    size = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    cores = spark.sparkContext.defaultParallelism
    tasks = max(math.ceil(cost / size), min(cores, math.ceil(cost / open_cost_bytes)), 1)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _opened(uri)
        for batch in batches:
            names, texts, held = [], [], 0
            for rel in batch.column(0).to_pylist():
                with fs.open_input_file(f"{base}/{rel}") as file:
                    names.append(rel)
                    texts.append(file.read())
                held += len(texts[-1])
                if held > _READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()),
                                                      pa.array(texts, pa.binary())], ["rel", "text"])
                    names, texts, held = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()),
                                                  pa.array(texts, pa.binary())], ["rel", "text"])

    rows = files.select("rel").repartition(tasks).mapInArrow(read, "rel string, text binary")
    return rows.select(F.col("text").cast("string").alias("text"),
                       F.substring_index("rel", "/", -1).alias("_file_name"),
                       F.substring_index("rel", "/", 1).alias("_folder"))


@contextmanager
def many_small_files(spark: SparkSession, open_cost_bytes: int = 64 * 1024):
    """Within the block, scans are planned with a low cost per file (4 MB by default), so a task
    packs thousands of files of a few KB. The setting is put back afterwards."""
    key = "spark.sql.files.openCostInBytes"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(open_cost_bytes))
    try:
        yield
    finally:
        spark.conf.set(key, previous)


def list_files(spark: SparkSession, root: str | list[str], glob: str = "*") -> DataFrame:
    """(path, name, length) of every file under ``root``; file contents are never read.

    The binary-file source only reads content when the ``content`` column is selected.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
          .option("pathGlobFilter", glob).load(root))
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length")
