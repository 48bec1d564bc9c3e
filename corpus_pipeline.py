"""A training corpus from raw documents: five stages, each one of the training-data operators.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame;
what it returns is written as Parquet and read again as the next stage's ``docs``, so each stage
starts from a table in shared storage and a lost executor repeats at most its own stage's work.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from citeweave.llm import decontaminate, language, mixing, simhash, token_shards
from citeweave.llm.common import table
from citeweave.session import release_scratch, scratch_path, scratch_scope


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known with enough certainty; the others go."""
    return language.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in the shared scratch folder; one row per document as read back from them."""
    import public_tokenizers

    out = token_shards.shard_folder(spark)
    shards = token_shards.write_token_shards(
        docs, public_tokenizers.path("byte_bpe_50k.json"), out)
    return token_shards.read_token_shards(shards, out)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# Model training, fingerprints' components and tokenization have no SQL form; tests/llm compares
# the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table; the rows of the last one.

    A stage's own scratch tables go when its table is written, and that table goes when the next
    stage is done: of the scratch folder only the shards and their list, which the result reads,
    are left.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        release_scratch(spark, *before)
        docs, before = spark.read.parquet(path), [path]
    shards = STAGES[-1][1](spark, docs, sf_dir)
    release_scratch(spark, *before)
    return shards
