"""Ids that survive an append: a registry of (key, id) in committed generations.

Layout under the registry's folder:

    keys/<generation>-<attempt>/   Parquet (key, id) of the keys that generation added
    commits/<generation>           one JSON line: the folder above, its number of keys, its last id

An append numbers only keys that no committed generation holds, behind the last committed id, writes
them to a folder of its own, and then creates the commit file. That file is created exclusively, so
of two appends that started from the same generation one fails and leaves no trace in the registry;
a folder without a commit (a run that died) is never read, and the next append takes another name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave import storage
from citeweave.operators.keys import dense_ids


def commits(spark: SparkSession, root: str) -> list[dict]:
    """The committed generations in order (one small file each): ``generation``, ``folder``,
    ``n_keys``, ``last_id``. A commit file that was not written to its end does not count."""
    if not storage.children(spark, f"{root}/commits"):
        return []
    schema = "generation int, folder string, n_keys long, last_id long"
    rows = (spark.read.schema(schema).option("mode", "DROPMALFORMED").json(f"{root}/commits")
            .where("generation IS NOT NULL AND last_id IS NOT NULL"))
    return [r.asDict() for r in rows.orderBy("generation").collect()]


def read_registry(spark: SparkSession, root: str, key: str = "source_uuid",
                  id_col: str = "paper_id", key_type: str = "string",
                  done: list[dict] | None = None) -> DataFrame:
    """(key, id, generation) of every committed generation; empty if there is none."""
    done = commits(spark, root) if done is None else done
    schema = f"{key} {key_type}, {id_col} long"
    parts = [spark.read.schema(schema).parquet(f"{root}/keys/{c['folder']}")
             .withColumn("generation", F.lit(c["generation"])) for c in done]
    empty = spark.createDataFrame([], f"{schema}, generation int")
    return reduce(DataFrame.unionByName, parts) if parts else empty


def append_keys(rows: DataFrame, root: str, key: str = "source_uuid", id_col: str = "paper_id",
                order: Sequence[Column | str] | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Register the keys of ``rows`` and return the whole registry: (key, id, generation).

    New keys get the ids behind the last one, dense and in the order of ``order`` (the key if not
    given; it must end with the key). Ids of known keys never change; a key that is no longer
    among the rows keeps its id. Repeated keys count once, by their smallest order; a null key is
    an error. Rows without a new key add no generation.
    """
    spark = rows.sparkSession
    done = commits(spark, root)
    key_type = rows.schema[key].dataType.simpleString()
    known = read_registry(spark, root, key, id_col, key_type, done)
    place = [c if isinstance(c, Column) else F.col(c) for c in (order or [key])]
    checked = F.coalesce(F.col(key), F.raise_error(F.lit(f"{key} is null")).cast(key_type))
    fresh = rows.select(checked.alias(key), F.struct(*place).alias("_place")).groupBy(key).agg(
        F.min("_place").alias("_place"))
    if done:
        fresh = fresh.join(known.select(key), key, "left_anti")
    last = done[-1]["last_id"] if done else 0
    generation = done[-1]["generation"] + 1 if done else 1
    # A file of an append that died while it committed keeps its number.
    taken = [int(n) for n in storage.children(spark, f"{root}/commits") if n.isdigit()]
    generation = max([generation, *(t + 1 for t in taken)])
    folder = f"{generation}-{uuid.uuid4().hex}"
    numbered = dense_ids(fresh, ["_place", key], id_col, start=last + 1,
                         num_partitions=num_partitions).select(key, id_col)
    numbered.write.parquet(f"{root}/keys/{folder}")
    written = spark.read.parquet(f"{root}/keys/{folder}")
    n, top = written.agg(F.count(F.lit(1)), F.max(id_col)).first()
    if n:
        storage.create_file(spark, f"{root}/commits/{generation}", json.dumps(
            {"generation": generation, "folder": folder, "n_keys": n, "last_id": top}) + "\n")
    else:
        storage.delete(spark, f"{root}/keys/{folder}")
    return read_registry(spark, root, key, id_col, key_type)
