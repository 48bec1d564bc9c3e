"""Slim per-paper mention records: the paper's 16-byte id and its normalized software names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.identifiers import parse_uuid
from citeweave.functions.keys import first_dotted_part


def keep_uuid_named(records: DataFrame, name_col: str = "_file_name") -> DataFrame:
    """Drop records whose file name does not start with a 36-character id (skipped silently)."""
    return records.where(F.length(first_dotted_part(name_col)) == 36)


def slim_mentions(records: DataFrame, name_col: str = "_file_name") -> DataFrame:
    """(id binary(16), mentions array<struct<normalized_form, wikidata_id>>) per record.

    A per-row ``transform`` over the nested list: no explode, no shuffle.
    """
    return keep_uuid_named(records, name_col).select(
        parse_uuid(first_dotted_part(name_col)).alias("id"),
        F.transform("mentions", lambda m: F.struct(
            m["software-name"]["normalizedForm"].alias("normalized_form"),
            m["software-name"]["wikidataId"].alias("wikidata_id"))).alias("mentions"))


def name_occurrences(slim: DataFrame, alias: str = "n") -> DataFrame:
    """Occurrences of each normalized name over all mentions (every mention counts)."""
    names = slim.select(F.explode("mentions.normalized_form").alias("normalized_form"))
    return names.groupBy("normalized_form").agg(F.count(F.lit(1)).alias(alias))
