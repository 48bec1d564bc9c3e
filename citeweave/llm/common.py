"""Column helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space as the query contracts define it: space, tab, newline, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]"
NON_SPACE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(folder: str):
    """(file system, path in it) of a shared folder given as a path or any URI that Arrow opens."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def free_name(name: str, *taken: list[str]) -> str:
    """``name``, with underscores behind it until no column in ``taken`` has it."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda variable, unlike a column alias, is
    never inlined by the optimizer into the inner loops that use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts (as many bytes as characters) take the fast built-in;
    others go through ``translate``, which leaves accented capitals as they are."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def collapse_space(text: Column) -> Column:
    """Every run of ASCII white space becomes one space (single spaces are not touched, so the
    pattern matches only where something changes)."""
    return F.regexp_replace(text, rf"[\x09-\x0D]{SPACE}*|\x20{SPACE}+", " ")
