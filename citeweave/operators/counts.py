"""Popularity, ranking and co-occurrence counts over (owner, item) incidence.

Owner is a paper and item a software name in the published tables; every function takes the
column names as parameters.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.operators import pair_tiles
from citeweave.operators.keys import dense_ids
from citeweave.schemas import DEFAULT_MIN_SUPPORT, GENERIC_SOFTWARE_NAMES
from citeweave.session import materialize


def owner_item_set(df: DataFrame, owner: str, item: str,
                   stop_list: Iterable | None = None) -> DataFrame:
    """Distinct (owner, item) pairs after dropping stop-listed items (case-sensitive)."""
    if stop_list:
        df = df.where(~F.col(item).isin(list(stop_list)))
    return df.select(owner, item).distinct()


def item_support(df: DataFrame, owner: str = "paper_id", item: str = "software_normalized",
                 stop_list: Iterable | None = tuple(GENERIC_SOFTWARE_NAMES),
                 min_support: int = DEFAULT_MIN_SUPPORT, alias: str = "n") -> DataFrame:
    """Items held by at least ``min_support`` distinct owners, with that number.

    distinct(owner, item) shuffles on both columns, so a hot item is spread over many tasks; the
    count per item is pre-aggregated in each task before the second shuffle.
    """
    pairs = owner_item_set(df, owner, item, stop_list)
    counts = pairs.groupBy(item).agg(F.count(F.lit(1)).alias(alias))
    return counts.where(F.col(alias) >= min_support) if min_support else counts


def supported_item_total(support: DataFrame, alias: str = "n_items") -> DataFrame:
    return support.agg(F.count(F.lit(1)).alias(alias))


def top_ranked(df: DataFrame, order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows under a total order, with a 0-based rank.

    ``orderBy().limit()`` plans as TakeOrderedAndProject (a per-task top-k heap, then a merge of
    k rows per task); the rank window then runs over at most k rows.
    """
    head = df.orderBy(*order).limit(k)
    return head.withColumn(rank_col, (F.row_number().over(Window.orderBy(*order)) - 1).cast("int"))


def occurrence_counts(df: DataFrame, item: str, alias: str = "n") -> DataFrame:
    """Every occurrence counts (not distinct owners)."""
    return df.groupBy(item).agg(F.count(F.lit(1)).alias(alias))


def zero_filled_counts(dimension: DataFrame, facts: DataFrame, key: str,
                       alias: str = "n") -> DataFrame:
    """One row per dimension member, with the number of facts for it (0 when there are none).

    Facts are aggregated first; the join input is then one row per key on both sides.
    """
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (dimension.join(counts, key, "left")
            .withColumn(alias, F.coalesce(F.col("_n"), F.lit(0)).cast("long")).drop("_n"))


def _pairs_in_owners(pairs: DataFrame, owner: str, item: str, left: str, right: str,
                     alias: str) -> DataFrame:
    """Pair counts by a plain self-join on the owner (owners here hold a bounded item set). The join
    makes far more rows than it reads, so its tasks are not merged by their input's size."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(parts, owner)
    a = pairs.select(owner, F.col(item).alias(left))
    b = pairs.select(owner, F.col(item).alias(right))
    return (a.join(b, owner).where(F.col(left) < F.col(right))
            .groupBy(left, right).agg(F.count(F.lit(1)).alias(alias)))


def _pairs_in_blocks(pairs: DataFrame, owner: str, item: str, block_size: int, left: str,
                     right: str, alias: str) -> DataFrame:
    """Pair counts with every owner of more than ``block_size`` items split into hash blocks.

    Each item row is copied to the block pairs it belongs to and the pairs are formed by an
    equi-join on (owner, block_i, block_j): an owner with k items is spread over about
    (k / block_size)^2 / 2 join keys and no task forms more than about block_size^2 of its pairs.
    """
    sizes = (pairs.groupBy(owner).agg(F.count(F.lit(1)).alias("_k"))
             .where(F.col("_k") > block_size)
             .select(owner, F.ceil(F.col("_k") / F.lit(block_size)).cast("int").alias("_nb")))
    blocked = (pairs.join(sizes, owner, "left")
               .withColumn("_nb", F.coalesce(F.col("_nb"), F.lit(1)))
               .withColumn("_b", F.pmod(F.xxhash64(F.col(item)), F.col("_nb")).cast("int")))
    # As left member an item pairs with its own block and every later block; as right member
    # with its own block and every earlier one.
    lhs = blocked.select(F.col(owner), F.col(item).alias("_a"), F.col("_b").alias("_bi"),
                         F.explode(F.sequence(F.col("_b"), F.col("_nb") - 1)).alias("_bj"))
    rhs = blocked.select(F.col(owner), F.col(item).alias("_c"),
                         F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_bi"),
                         F.col("_b").alias("_bj"))
    joined = lhs.join(rhs, [owner, "_bi", "_bj"], "inner").where(
        (F.col("_bi") < F.col("_bj")) | (F.col("_a") < F.col("_c")))
    return (joined.select(F.least("_a", "_c").alias(left), F.greatest("_a", "_c").alias(right))
            .groupBy(left, right).agg(F.count(F.lit(1)).alias(alias)))


# Items up to which the dictionary is sent to every executor instead of shuffling rows to it.
BROADCAST_ITEMS = 500_000


def _encoded_counts(df: DataFrame, owner: str, item: str, stop_list: Iterable | None,
                    min_item_support: int, threshold: int, left: str, right: str,
                    alias: str) -> DataFrame:
    """Pair counts with items as integers, counted in tiles of the pair matrix.

    An item with fewer rows than ``min_item_support`` cannot have as many owners, so only the others
    are numbered (by falling number of rows) and no other row is shuffled. The set of codes of every
    owner is written once to the shared checkpoint folder; an item's support is its number of sets.
    The pairs of an owner, however many items it holds, are never rows (see ``pair_tiles``); only
    those that reach the threshold are decoded.
    """
    if stop_list:
        df = df.where(~F.col(item).isin(list(stop_list)))
    often = materialize(df.where(F.col(item).isNotNull()).groupBy(item).agg(
        F.count(F.lit(1)).alias("_s")).where(F.col("_s") >= min_item_support), "frequent-items")
    n_items = often.count()
    small = F.broadcast if n_items <= BROADCAST_ITEMS else lambda codes: codes
    codes = dense_ids(often, [F.desc("_s"), F.asc(item)], "_code", start=0).select(
        F.col(item).alias("_name"), F.col("_code").cast("int").alias("_code"))
    coded = df.select(owner, F.col(item).alias("_name")).join(small(codes), "_name")
    sets = materialize(pair_tiles.packed_sets(coded, owner, "_code"), "owner-item-codes")
    support = materialize(
        sets.select(F.explode("codes").alias("_code")).groupBy("_code")
        .agg(F.count(F.lit(1)).alias("_s")).join(codes, "_code"), "item-support")
    n_members = support.agg(F.sum("_s")).first()[0] or 0
    names = support.where(F.col("_s") >= min_item_support).select("_code", "_name")
    # A null owner counts as one for an item's support, but joins no owner, so it has no pairs.
    counts = pair_tiles.pair_counts(sets.where(F.col(owner).isNotNull()), n_items, n_members,
                                    threshold, left, right, alias)
    a, b = (small(names.select(F.col("_code").alias(c), F.col("_name").alias(n)))
            for c, n in ((left, "_a"), (right, "_b")))
    return counts.join(a, left).join(b, right).select(
        F.least("_a", "_b").alias(left), F.greatest("_a", "_b").alias(right), alias)


def co_occurrence_counts(df: DataFrame, owner: str = "paper_id",
                         item: str = "software_normalized",
                         stop_list: Iterable | None = tuple(GENERIC_SOFTWARE_NAMES),
                         min_item_support: int = DEFAULT_MIN_SUPPORT,
                         min_pair_support: int = DEFAULT_MIN_SUPPORT,
                         block_size: int = 2048, left: str = "item_a", right: str = "item_b",
                         alias: str = "n", materialize_pairs: bool = True,
                         encode: bool | None = None) -> DataFrame:
    """Number of owners holding both items, for every unordered item pair (left < right).

    1. A-priori pruning: only items with ``min_item_support`` owners can take part. The pruned
       (owner, item) set feeds several branches, so it is written once to the shared checkpoint
       folder (``materialize_pairs``).
    2. Owners holding more than ``block_size`` of those items are *heavy*; their number h is
       counted (one small aggregation).
       * h = 0: pairs come from a self-join on the owner.
       * 0 < h < ``min_pair_support``: a pair held by no ordinary owner is held by at most h
         owners and cannot qualify, so heavy owners only add to pairs that ordinary owners
         produce. Ordinary pairs with at least ``min_pair_support - h`` owners are the candidates,
         and each heavy owner holding both items of a candidate adds one, found by joining the
         candidates with the heavy owners' items on both members. No pair of a heavy owner is
         enumerated, however many items it holds.
       * otherwise (or with no pair threshold): every owner's pairs are formed in hash blocks
         (see :func:`_pairs_in_blocks`), so a heavy owner is spread over many tasks.
    3. Pair counts are pre-aggregated in each task before the shuffle on the pair.

    Items that are texts (or with ``encode``) go another way, see :func:`_encoded_counts`. It needs
    an item threshold, without which the dictionary would hold every item there is.
    """
    if min_item_support and min_item_support > 1:
        if encode is None:
            encode = df.schema[item].dataType.simpleString() == "string"
        if encode:
            return _encoded_counts(df, owner, item, stop_list, min_item_support,
                                   min_pair_support or 0, left, right, alias)
    pairs = owner_item_set(df, owner, item, stop_list)
    if min_item_support and min_item_support > 1:
        supported = (pairs.groupBy(item).agg(F.count(F.lit(1)).alias("_s"))
                     .where(F.col("_s") >= min_item_support))
        pairs = pairs.join(supported.select(item), item, "left_semi")
    if materialize_pairs:
        pairs = materialize(pairs, "co-occurrence-pairs")

    heavy = (pairs.groupBy(owner).agg(F.count(F.lit(1)).alias("_k"))
             .where(F.col("_k") > block_size).select(owner))
    n_heavy = heavy.count()
    threshold = min_pair_support or 0
    if n_heavy == 0:
        counts = _pairs_in_owners(pairs, owner, item, left, right, alias)
    elif threshold > n_heavy:
        ordinary = pairs.join(heavy, owner, "left_anti")
        heavy_items = pairs.join(heavy, owner, "left_semi")
        base = (_pairs_in_owners(ordinary, owner, item, left, right, "_n")
                .where(F.col("_n") >= threshold - n_heavy))
        lift = (base.select(left, right)
                .join(heavy_items.select(owner, F.col(item).alias(left)), left)
                .join(heavy_items.select(owner, F.col(item).alias(right)), [owner, right],
                      "left_semi")
                .groupBy(left, right).agg(F.count(F.lit(1)).alias("_h")))
        counts = (base.join(lift, [left, right], "left")
                  .select(left, right,
                          (F.col("_n") + F.coalesce(F.col("_h"), F.lit(0))).alias(alias)))
    else:
        counts = _pairs_in_blocks(pairs, owner, item, block_size, left, right, alias)
    if threshold:
        counts = counts.where(F.col(alias) >= threshold)
    return counts


def ranked_counts(counts_df: DataFrame, name: str, alias: str = "n") -> DataFrame:
    """A frequency table in report order: count descending, then name (a deterministic tie-break
    the original ranking lacked)."""
    return counts_df.orderBy(F.desc(alias), F.asc(name))
