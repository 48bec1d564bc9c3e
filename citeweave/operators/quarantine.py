"""Accepted and rejected rows of an input from one pass over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from citeweave.session import write_scratch


@dataclass(frozen=True)
class Split:
    """``accepted`` (the input's columns), ``rejected`` (the same and ``reason``), both read from
    one written table, and their row counts."""

    accepted: DataFrame
    rejected: DataFrame
    n_accepted: int
    n_rejected: int


def split(records: DataFrame, reason: Column, name: str) -> Split:
    """Tag every record with why it is rejected (null: accepted) and write all of them once, in one
    folder per outcome; the counts are observed while the rows are written. An expression that would
    raise on a rejected record must come after the split: it then never meets one."""
    columns = records.columns
    counts = Observation(f"{name} quarantine")
    tagged = records.withColumn("reason", reason).withColumn(
        "_rejected", F.col("reason").isNotNull()).observe(
        counts, F.count_if(~F.col("_rejected")).alias("accepted"),
        F.count_if("_rejected").alias("rejected"))
    written = records.sparkSession.read.schema(tagged.schema).parquet(
        write_scratch(tagged, f"{name}-tagged", partition_by=["_rejected"]))
    found = counts.get
    return Split(written.where("NOT _rejected").select(*columns),
                 written.where("_rejected").select(*columns, "reason"),
                 found["accepted"], found["rejected"])


def not_an_object(text: Column) -> Column:
    """Why a text is not one JSON object (null if it is)."""
    value = F.try_parse_json(text)
    return (F.when(value.isNull(), F.lit("malformed JSON"))
            .when(~F.schema_of_variant(value).startswith("OBJECT"), F.lit("not a JSON object")))
