"""Mixing sources to target weights, in DataFrame functions only.

Sizes are summed per source, targets follow from the weights (no source may be repeated more than
``max_repeats`` times; what it cannot take is reshared by weight), and a document is emitted
floor(rate) times plus one more copy with probability equal to the rate's fraction, decided by a
seeded hash: runs agree, and no state passes between rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import NON_SPACE, free_name
from citeweave.operators.keys import dense_ids
from citeweave.session import write_scratch

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20
PLAN_COLUMNS = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(NON_SPACE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of the sources in ``sizes`` (``source``, ``source_size``; one row per source).

    Sources in code-point order, null last, get ``weights`` in turn and share the total of all
    sizes; a target stops at ``max_repeats`` times its source's size and the excess is reshared by
    weight until none is above. Each round sums two numbers over the sources: the driver holds
    scalars only, and rounds end when no further source is capped. Returns ``source``,
    ``source_size``, ``weight``, ``target`` and ``rate`` (target per size; 0 for an empty source).
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.sparkSession.read.parquet(write_scratch(
        dense_ids(sizes, [F.asc_nulls_last("source")], id_col="place", start=0)
        .withColumn("weight", weight.cast("long")), "mix-sources"))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * max_repeats
    level, capped = 0.0, -1
    while True:
        above = most < F.lit(level) * F.col("weight") if capped >= 0 else F.lit(False)
        taken, shares, now = ranked.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(above.cast("long")), F.lit(0))).first()
        if now == capped or not shares:
            break
        level, capped = (total - taken) / shares, now
    target = F.when(most < F.lit(level) * F.col("weight"), most.cast("double")).otherwise(
        F.lit(level) * F.col("weight"))
    return (ranked.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0,
                                       F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0)))
            .select("source", "source_size", "weight", "target", "rate"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights: Sequence[int] = WEIGHTS,
             max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` (all columns) with ``mix_size``, ``mix_source_size``, ``mix_target`` and
    ``mix_copies``, the number of times the mix takes the row. Columns of ``docs`` that have one of
    these names are replaced.

    A row's draw depends on the seed and its id only (rows that repeat an id decide alike); a null
    id draws by its text. A null source is a source of its own; null and empty texts have size 0
    and are taken by the same rule. If all texts are empty nothing is taken.
    """
    plain = docs.drop(*[c for c in docs.columns if c.lower() in PLAN_COLUMNS])
    return _planned(plain, PLAN_COLUMNS, id_col, text_col, source_col, weights, max_repeats, seed)


def _planned(docs: DataFrame, names: Sequence[str], id_col: str, text_col: str, source_col: str,
             weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS,
             seed: int = SEED) -> DataFrame:
    """``docs`` with the plan's columns under ``names``, none of which ``docs`` has."""
    size, source_size, target, copies = names
    source, rate = (free_name(n, docs.columns, names) for n in ("mix_source", "mix_rate"))
    sized = docs.withColumn(size, word_count(F.col(text_col)))
    targets = source_targets(sized.groupBy(F.col(source_col).alias("source"))
                             .agg(F.sum(size).alias("source_size")), weights, max_repeats)
    targets = targets.select(F.col("source").alias(source),
                             F.col("source_size").alias(source_size),
                             F.col("target").alias(target), F.col("rate").alias(rate))
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    # 52 bits of a digest as a number in [0, 1).
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast(
        "double") / F.lit(float(1 << 52))
    # One row per source: the planner broadcasts the targets while they are small.
    return (sized.join(targets, F.col(source_col).eqNullSafe(F.col(source)), "left")
            .withColumn(copies, (F.floor(rate) + F.when(
                draw < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("int"))
            .drop(source, rate))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` (all columns, whatever their names, unchanged) as often
    as the plan takes it."""
    names = [free_name(n, docs.columns) for n in PLAN_COLUMNS]
    plan = _planned(docs, names, id_col, text_col, source_col, **options)
    copies = F.sequence(F.lit(1), F.col(names[-1]))
    return (plan.where(F.col(names[-1]) > 0)
            .withColumn(free_name("mix_copy", plan.columns), F.explode(copies))
            .select(*[plan[c] for c in docs.columns]))
