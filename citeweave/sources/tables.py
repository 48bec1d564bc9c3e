"""Parquet tables and the small side inputs (id map, membership list)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_FILES = {
    "papers": "papers.parquet",
    "mentions": "mentions.{type}.parquet",
    "purpose_assessments": "purpose_assessments.{type}.parquet",
}


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; selecting columns here prunes the scan's ``ReadSchema``."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_tables(spark: SparkSession, folder: str, source_type: str = "pdf"):
    """(papers, mentions, purpose_assessments) of one folder, as written by the table sinks."""
    return tuple(spark.read.parquet(os.path.join(folder, TABLE_FILES[name].format(type=source_type)))
                 for name in ("papers", "mentions", "purpose_assessments"))


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """Two-field CSV (paper_id, uuid) with an explicit schema, for exchange with other tools."""
    return (spark.read.schema("paper_id long, source_uuid string").option("mode", "FAILFAST")
            .csv(path))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def read_uuid_list(spark: SparkSession, path: str) -> DataFrame:
    """One UUID per line; a missing file is an empty set."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "source_uuid string")
    df = spark.read.text(path)
    return df.select(F.trim("value").alias("source_uuid")).where(F.col("source_uuid") != "")
