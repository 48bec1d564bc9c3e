"""JSON-lines collections: typed scans by parse type, schemaless (VARIANT) scans, identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.schemas import IDENTIFIER_JSON

# What follows the bucket in the file names of a collated collection, by parse type.
COLLECTION_SUFFIXES = {
    "papers": ".jsonl",
    "pdf": ".software.jsonl",
    "latex": ".latex.tei.software.jsonl",
    "jats": ".jats.software.jsonl",
    "grobid": ".grobid.tei.software.jsonl",
    "pub2tei": ".pub2tei.tei.jsonl",
}
_HEX2 = "[0-9a-f][0-9a-f]"


def collection_pattern(parse_type: str) -> str:
    """Regular expression of a parse type's file names; only papers have the bucket ``gg``."""
    bucket = f"({_HEX2}|gg)" if parse_type == "papers" else _HEX2
    return "^" + bucket + COLLECTION_SUFFIXES[parse_type].replace(".", r"\.") + r"(\.gz)?$"


def collection_glob(parse_type: str) -> str:
    """The same as a glob, applied while listing so that other files are never opened."""
    bucket = "{" + _HEX2 + ",gg}" if parse_type == "papers" else _HEX2
    return bucket + COLLECTION_SUFFIXES[parse_type] + "*"


def read_collection(spark: SparkSession, path: str, schema: T.StructType,
                    parse_type: str | None = None, mode: str = "FAILFAST",
                    repartition: int | None = None) -> DataFrame:
    """Typed scan of a JSONL collection, optionally restricted to one parse type's files.

    Files are selected while listing (``pathGlobFilter``), so other parse types are never opened;
    the exact pattern is then checked on ``_metadata.file_name``. ``bucket`` is the file's prefix
    (text before the first dot),
    which orders papers the way the files are listed. gzip files are not splittable, so pass
    ``repartition`` to spread rows over more tasks right after the scan.
    """
    if parse_type is not None and parse_type not in COLLECTION_SUFFIXES:
        raise ValueError(f"parse type must be one of {sorted(COLLECTION_SUFFIXES)}: {parse_type}")
    reader = spark.read.schema(schema).option("mode", mode)
    if parse_type is not None:
        reader = reader.option("pathGlobFilter", collection_glob(parse_type))
    df = reader.json(path)
    name = F.col("_metadata.file_name")
    if parse_type is not None:
        df = df.where(name.rlike(collection_pattern(parse_type)))
    df = df.withColumn("bucket", F.substring_index(name, ".", 1))
    if repartition:
        df = df.repartition(repartition)
    return df


def read_collated(spark: SparkSession, path: str, schema: T.StructType,
                  parse_type: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Typed scan of a collection written by ``write_collection`` (``parse_type=…/prefix=…``).

    The parse type is a partition column, so the filter prunes whole directories at planning
    time; ``bucket`` is the prefix partition.
    """
    full = T.StructType(schema.fields + [T.StructField("parse_type", T.StringType()),
                                         T.StructField("prefix", T.StringType())])
    df = spark.read.schema(full).option("mode", mode).json(path)
    if parse_type is not None:
        df = df.where(F.col("parse_type") == parse_type)
    return df.withColumn("bucket", F.col("prefix")).drop("parse_type", "prefix")


def read_text_lines(spark: SparkSession, path: str, name_pattern: str | None = None) -> DataFrame:
    """Lines (``value``) that are not blank, of all files under ``path`` whose names match."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    if name_pattern is not None:
        lines = lines.where(F.col("_metadata.file_name").rlike(name_pattern))
    return lines.where(F.trim("value") != "")


def read_variant_lines(spark: SparkSession, path: str, column: str = "v",
                       name_pattern: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Schemaless scan: each JSON line as one VARIANT value (no inference pass, no widening).

    Folders are read recursively; ``name_pattern`` is a regular expression that file names must
    match. A malformed line is an error; with ``mode`` "PERMISSIVE" it becomes a null value.
    """
    lines = read_text_lines(spark, path, name_pattern)
    parse = F.parse_json if mode == "FAILFAST" else F.try_parse_json
    return lines.select(parse("value").alias(column))


def read_identifiers(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Identifier records (``.jsonl`` files only, as the converter requires)."""
    if not (path.endswith(".jsonl") or path.endswith("/") or "*" in path):
        raise ValueError(f"identifier input must be a .jsonl file: {path}")
    reader = spark.read.schema(IDENTIFIER_JSON).option("mode", mode)
    if path.endswith("/"):
        reader = reader.option("pathGlobFilter", "*.jsonl")
    return reader.json(path)
