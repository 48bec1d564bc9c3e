"""The three documented analyses over papers / mentions / purpose assessments.

Each function is written against column names given as parameters (defaults are the table
columns), so the same plan runs on the published tables and on any analogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_owner_count(items: DataFrame, item_col: str = "software_normalized",
                         item: str = "OpenStreetMap", owner_col: str = "paper_id",
                         alias: str = "n") -> DataFrame:
    """How many distinct owners (papers) hold a given item (software).

    Filter on the item (pushed into the Parquet scan), project the owner, count distinct. Spark
    plans a partial distinct per task, so only distinct owner keys cross the shuffle.
    """
    return (items.where(F.col(item_col) == F.lit(item))
            .agg(F.count_distinct(owner_col).alias(alias)))


def yearly_counts(items: DataFrame, owners: DataFrame, item_col: str = "software_normalized",
                  item: str = "STATA", owner_col: str = "paper_id",
                  year_col: str = "published_year", year_from: int = 2000,
                  year_to: int = 2020, alias: str = "n") -> DataFrame:
    """Owners holding an item, counted per year of the owner, for years in [year_from, year_to].

    The year predicate is applied to the owners before the join, so it reaches their scan; the
    distinct owner set of the item is built before joining, so the join input is one row per owner.
    """
    holders = items.where(F.col(item_col) == F.lit(item)).select(owner_col).distinct()
    years = (owners.where((F.col(year_col) >= year_from) & (F.col(year_col) <= year_to))
             .select(owner_col, year_col))
    return (holders.join(years, owner_col, "inner")
            .groupBy(year_col).agg(F.count(F.lit(1)).alias(alias)))


def distinct_pair_counts(facts: DataFrame, owner_col: str = "paper_id",
                         item_col: str = "software_normalized", alias: str = "n") -> DataFrame:
    """Distinct owners per item: distinct (owner, item) then a count per item.

    The distinct shuffles on (owner, item), which spreads a very common item over many tasks;
    the count per item is then pre-aggregated in each task before its own shuffle.
    """
    return (facts.select(owner_col, item_col).distinct()
            .groupBy(item_col).agg(F.count(F.lit(1)).alias(alias)))


def popular_used_since(papers: DataFrame, mentions: DataFrame, purposes: DataFrame,
                       since_year: int = 2020, scope: str = "document", purpose: str = "used",
                       min_score: float = 0.5, alias: str = "n") -> DataFrame:
    """Software ranked by the number of distinct recent papers that used it.

    papers(year >= since) ⋈ mentions on paper_id ⋈ assessments(scope, purpose, score > min) on
    software_mention_id → distinct (paper_id, software_normalized) → count per software.
    All three filters sit on their own scans; every join input is projected to the columns it needs.
    The assessment join also equates paper_id (implied by the mention id), so when the tables are
    bucketed or partitioned by paper_id all three sides can share one partitioning.
    """
    recent = papers.where(F.col("published_year") >= since_year).select("paper_id")
    named = mentions.select("paper_id", "software_mention_id", "software_normalized")
    judged = (purposes.where((F.col("scope") == scope) & (F.col("purpose") == purpose)
                             & (F.col("certainty_score") > min_score))
              .select("paper_id", "software_mention_id"))
    facts = (recent.join(named, "paper_id", "inner")
             .join(judged, ["paper_id", "software_mention_id"], "inner"))
    return distinct_pair_counts(facts, "paper_id", "software_normalized", alias)
