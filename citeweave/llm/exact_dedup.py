"""Exact deduplication by distributed most-significant-digit radix partitioning.

Texts are keys over bytes, with the byte length as the first digit (so all members of a group end
together) and blocks of successive bytes as the following digits. A round splits every open group
by its next digit; a group is closed when it has one member or its text has ended. Two texts share
a closed group only if all their bytes are equal: no digest decides equality.

Per round the digits are counted with a map-side combine (a hot group shrinks to one row per task
before the shuffle) and only rows of groups that really split are relabelled, so the texts of
copies are not shuffled again in each round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.session import release_scratch, write_scratch

# Bytes of the first block; each following block ends GROWTH times as far, at most MAX_BLOCK later.
FIRST_BLOCK, GROWTH, MAX_BLOCK = 64, 16, 1 << 24


def _block(text: str, start: int, end: int) -> Column:
    return F.substring(F.col(text), start + 1, end - start)


def exact_groups(rows: DataFrame, id_col: str, key: Column, first_block: int = FIRST_BLOCK,
                 growth: int = GROWTH) -> DataFrame:
    """Group rows of equal ``key`` (a string; null counts as empty).

    Returns one row per input row: ``id`` (the value of ``id_col``), ``keep_id`` (the smallest
    non-null id of the group), ``group_size``, ``kept`` (true for exactly one row of each group:
    one with the smallest id; null ids come last, and among repeated ids an arbitrary one stays)
    and ``text_sha256`` (of the key's UTF-8 bytes; informative, never compared).
    An empty table gives an empty result; other columns of ``rows`` are not looked at.
    """
    spark = rows.sparkSession
    base = (rows.select(F.col(id_col).alias("id"),
                        F.coalesce(key, F.lit("")).cast("binary").alias("bytes"))
            .withColumn("n_bytes", F.octet_length("bytes"))
            .withColumn("head", _block("bytes", 0, first_block)))

    # Round 0 over all rows: length and first block. Only shared digits are kept, with a group id.
    # The join is a sort-merge join at every size, so that a hot digit can be split.
    heads = write_scratch(
        base.groupBy("n_bytes", "head").agg(F.count("*").alias("n")).where("n > 1")
        .select("n_bytes", "head", F.monotonically_increasing_id().alias("grp")), "radix-heads")
    members = write_scratch(
        base.join(spark.read.parquet(heads).hint("merge"), ["n_bytes", "head"], "left")
        .select(F.monotonically_increasing_id().alias("row"), "id", "n_bytes", "grp",
                F.sha2("bytes", 256).alias("text_sha256"),
                F.when(F.col("grp").isNotNull() & (F.col("n_bytes") > first_block),
                       F.col("bytes")).alias("bytes")), "radix-members")
    release_scratch(spark, heads)
    everything = spark.read.parquet(members)
    singles = everything.where("grp is null")
    grouped = everything.where("grp is not null")

    longest = grouped.where("bytes is not null").agg(F.max("n_bytes")).first()[0] or 0
    start, round_no = first_block, 0
    while start < longest:
        end, round_no = min(start * growth, start + MAX_BLOCK), round_no + 1
        open_rows = grouped.where(F.col("bytes").isNotNull() & (F.col("n_bytes") > start))
        digit = _block("bytes", start, end)
        split = write_scratch(
            open_rows.groupBy("grp", digit.alias("digit")).agg(F.count("*").alias("n"))
            .groupBy("grp").agg(F.count("*").alias("parts")).where("parts > 1").select("grp"),
            "radix-split")
        splitting = spark.read.parquet(split)
        if splitting.isEmpty():
            release_scratch(spark, split)
        else:
            apart = grouped.join(splitting, "grp", "left_semi").withColumn("digit", digit)
            parts = write_scratch(
                apart.groupBy("grp", "digit").agg(F.count("*").alias("n"))
                .withColumn("part", F.shiftleft(F.lit(round_no).cast("long"), 56)
                            + F.monotonically_increasing_id()), "radix-parts")
            relabelled = write_scratch(
                apart.join(spark.read.parquet(parts), ["grp", "digit"])
                .select("row", "id", "n_bytes", F.col("part").alias("grp"), "text_sha256",
                        F.when(F.col("n") > 1, F.col("bytes")).alias("bytes")), "radix-part-rows")
            release_scratch(spark, parts)
            grouped = (grouped.join(splitting, "grp", "left_anti").select(*everything.columns)
                       .unionByName(spark.read.parquet(relabelled)))
        start = end

    labels = grouped.select("row", "id", "grp", "text_sha256")
    # Written first: the aggregate must not share the join's shuffle, or a hot group is one task.
    groups = spark.read.parquet(write_scratch(labels.groupBy("grp").agg(
        F.count("*").alias("group_size"), F.min("id").alias("keep_id"),
        F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "row")).alias("first"))
        .select("grp", "group_size", "keep_id", "first.row"), "radix-groups")
        ).withColumnRenamed("row", "first_row")
    copies = (labels.join(groups, "grp")
              .select("id", "keep_id", "group_size", (F.col("first_row") == F.col("row"))
                      .alias("kept"), "text_sha256"))
    alone = singles.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long")
                           .alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(copies)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text equals, byte for byte, that of a row that stays. Ids
    must identify rows here (rows of one repeated id stay or go together)."""
    kept = exact_groups(docs, id_col, F.col(text_col)).where("kept").select(F.col("id"))
    return docs.join(kept, docs[id_col].eqNullSafe(kept["id"]), "left_semi")
