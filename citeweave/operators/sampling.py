"""Seeded, mutually exclusive subsamples that stay consistent across related tables.

Every eligible key draws one uniform number u = unit_hash(seed, key) and goes to the first sample
whose cumulative threshold exceeds u (or to none). Because u is a pure function of the key,
any table carrying the key can be routed by recomputing u: no id set is collected, broadcast or
joined, and the assignment is the same for any partitioning of the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.keys import unit_hash
from citeweave.schemas import DEFAULT_SAMPLE_FRACTIONS


def cumulative_thresholds(fractions: Sequence[float]) -> list[float]:
    """Fractions [0.01, 0.05] become cut points [0.01, 0.06]; their sum must lie in (0, 1]."""
    if not fractions or any(f <= 0 for f in fractions):
        raise ValueError(f"sample fractions must be positive: {list(fractions)}")
    cuts = list(accumulate(fractions))
    if cuts[-1] > 1.0 + 1e-12:
        raise ValueError(f"sample fractions add up to more than 1: {list(fractions)}")
    return cuts


def sample_of(key: Column | str, seed: int,
              fractions: Sequence[float] = DEFAULT_SAMPLE_FRACTIONS) -> Column:
    """0-based sample number of a key, or NULL when the key falls in no sample."""
    u = unit_hash(seed, key)
    expr = None
    for i, cut in enumerate(cumulative_thresholds(fractions)):
        cond = u < F.lit(cut)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.cast("int")


def assign_samples(df: DataFrame, key: str, seed: int,
                   fractions: Sequence[float] = DEFAULT_SAMPLE_FRACTIONS,
                   eligible: Column | str | None = "has_mentions",
                   sample_col: str = "sample") -> DataFrame:
    """Rows of eligible keys that fall in a sample, with their sample number."""
    if eligible is not None:
        df = df.where(F.col(eligible) if isinstance(eligible, str) else eligible)
    return (df.withColumn(sample_col, sample_of(key, seed, fractions))
            .where(F.col(sample_col).isNotNull()))


def route_children(children: DataFrame, key: str, seed: int,
                   fractions: Sequence[float] = DEFAULT_SAMPLE_FRACTIONS,
                   eligible_parents: DataFrame | None = None,
                   sample_col: str = "sample") -> DataFrame:
    """Rows of a child table follow their parent's sample.

    When having a child row already makes the parent eligible (mentions of a paper make it
    ``has_mentions``), the hash alone routes the row: a narrow map, no shuffle. Otherwise pass the
    eligible parent keys, which are semi-joined after the (much smaller) sampled subset is formed.
    """
    routed = (children.withColumn(sample_col, sample_of(key, seed, fractions))
              .where(F.col(sample_col).isNotNull()))
    if eligible_parents is not None:
        parents = (eligible_parents.select(key)
                   .where(sample_of(key, seed, fractions).isNotNull()))
        routed = routed.join(parents, key, "left_semi")
    return routed


def sample_sizes(sampled: DataFrame, sample_col: str = "sample", alias: str = "n") -> DataFrame:
    return sampled.groupBy(sample_col).agg(F.count(F.lit(1)).alias(alias))
