"""Dense sequential ids and global positions without a single-task window.

``dense_ids`` gives the same numbers as ``row_number() OVER (ORDER BY keys)`` but ranges the rows
over many partitions: the data are range-partitioned and sorted on the key, each row's place in
its partition comes from ``monotonically_increasing_id`` (whose low 33 bits are the row's index in
the task's partition), and the per-partition counts give offsets through a running sum over a
table with one row per partition. The ranged rows are written once to the shared scratch folder
and both the positions and the counts are read from there: two evaluations of one range
partitioning may sample different bounds, so they must not be mixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.session import write_scratch

_LOW_33_BITS = (1 << 33) - 1


def _num_partitions(df: DataFrame, requested: int | None) -> int:
    if requested:
        return requested
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_ids(df: DataFrame, order: Sequence[Column | str], id_col: str = "paper_id",
              start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the total order given by ``order``.

    ``order`` must be a total order (end it with a unique column); then the ids do not depend on
    the input partitioning. Work per task is bounded by the range partitioning, which the sampler
    balances even when one leading key value (for example one prefix bucket) is very common.
    The range partitioner reads its input twice (a sampling pass, then the shuffle), so an input
    that is expensive to produce (parsed JSON) is best written once first (``materialize``).
    The call runs a job: it writes the ranged rows under the shared checkpoint folder.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    n = _num_partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_33_BITS))))
    # One row per non-empty partition; the running sum runs over those few rows only.
    ranged = df.sparkSession.read.parquet(write_scratch(ranged, "ranged-rows"))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_cnt")).alias("_off"))
    # The offsets table has one row per partition: its size is bounded by ``n``, not by the data.
    return (ranged.join(F.broadcast(offsets), "_pid", "inner")
            .withColumn(id_col, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
            .drop("_pid", "_pos", "_off"))


def bucketed_dense_ids(df: DataFrame, bucket: Column | str, key: Column | str,
                       tiebreak: Sequence[Column | str] = (), id_col: str = "paper_id",
                       num_partitions: int | None = None) -> DataFrame:
    """Ids in file order of a prefix-bucketed collection: by bucket, then by key inside it."""
    return dense_ids(df, [bucket, key, *tiebreak], id_col=id_col, num_partitions=num_partitions)
