"""Identifier records ↔ typed identifiers, the round-trip check and the licence distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions import identifiers as ids
from citeweave.operators.counts import zero_filled_counts
from citeweave.schemas import LICENCE_CANONICAL, LICENCE_SPELLINGS


def violation_reason() -> Column:
    """The first identifier field that does not convert, or NULL when the record converts."""
    return (F.when(~ids.valid_uuid("id"), F.lit("id"))
            .when(~ids.valid_pmid("pmid"), F.lit("pmid"))
            .when(~ids.valid_pmcid("pmcid"), F.lit("pmcid"))
            .when(~ids.valid_istex("istexId"), F.lit("istexId"))
            .when(~ids.all_known(ids.resource_codes("resources")), F.lit("resources"))
            .when(ids.licence_code("license").isNull(), F.lit("license")))


def identifier_violations(records: DataFrame) -> DataFrame:
    """Records that cannot be converted, with the first failing field as ``reason``."""
    return records.withColumn("reason", violation_reason()).where(F.col("reason").isNotNull())


def typed_identifiers(records: DataFrame, keep_oa_link: bool = True,
                      strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Convert text identifiers to their typed form (one narrow projection, no shuffle).

    Strict mode raises on the first record that does not convert; otherwise such records are
    dropped here and listed by :func:`identifier_violations` (same predicate). ``keep`` names
    caller columns (such as a row key) to carry through unchanged.
    """
    reason = violation_reason()
    if strict:
        guard = F.when(reason.isNotNull(), F.raise_error(F.concat(
            F.lit("cannot convert identifier field "), reason, F.lit(" of "),
            F.coalesce(F.col("id"), F.lit("NULL")))))
        records = records.withColumn("id", F.coalesce(guard.cast("string"), F.col("id")))
    else:
        records = records.where(reason.isNull())
    return records.select(
        *keep,
        ids.parse_uuid("id").alias("id"),
        F.col("doi"), F.col("arxiv"),
        ids.parse_pmid("pmid").alias("pmid"),
        ids.parse_pmcid("pmcid").alias("pmcid"),
        ids.parse_istex("istexId").alias("istex_id"),
        ids.resource_codes("resources").cast("array<int>").alias("resources"),
        ids.licence_code("license").cast("int").alias("license"),
        (F.col("oa_link") if keep_oa_link else F.lit(None).cast("string")).alias("oa_link"),
    )


def identifier_records(typed: DataFrame) -> DataFrame:
    """Typed identifiers back to text records."""
    return typed.select(
        ids.format_uuid("id").alias("id"),
        F.col("doi"), F.col("arxiv"),
        ids.format_pmid("pmid").alias("pmid"),
        ids.format_pmcid("pmcid").alias("pmcid"),
        ids.format_istex("istex_id").alias("istexId"),
        ids.resource_names("resources").alias("resources"),
        ids.licence_name("license").alias("license"),
        F.col("oa_link"),
    )


def roundtrip_violations(records: DataFrame, key: str = "row_key") -> DataFrame:
    """Records whose conversion there and back changes a field; one row per changed field.

    Licences compare by code (so 'CC BY' and 'cc-by' agree); NULL and '' text compare equal, and
    an absent resource list equals an empty one. Records keep a caller key so the comparison is
    a narrow projection of each row, with no join.
    """
    t = records.select(
        key, "id", "doi", "arxiv", "pmid", "pmcid", "istexId", "resources", "license", "oa_link",
        F.struct(
            ids.parse_uuid("id").alias("id"), F.col("doi"), F.col("arxiv"),
            ids.parse_pmid("pmid").alias("pmid"), ids.parse_pmcid("pmcid").alias("pmcid"),
            ids.parse_istex("istexId").alias("istex_id"),
            ids.resource_codes("resources").alias("resources"),
            ids.licence_code("license").alias("license"), F.col("oa_link")).alias("_t"))
    back = t.select(
        key, "id", "doi", "arxiv", "pmid", "pmcid", "istexId", "resources", "license", "oa_link",
        ids.format_uuid("_t.id").alias("id2"),
        ids.format_pmid("_t.pmid").alias("pmid2"),
        ids.format_pmcid("_t.pmcid").alias("pmcid2"),
        ids.format_istex("_t.istex_id").alias("istex2"),
        ids.resource_names("_t.resources").alias("res2"),
        F.col("_t.license").alias("lic1"))

    def txt(c):
        return F.coalesce(F.col(c), F.lit(""))

    def arr(c):
        return F.coalesce(F.col(c), F.array().cast("array<string>"))

    checks = [
        ("id", txt("id") != txt("id2")),
        ("pmid", txt("pmid") != txt("pmid2")),
        ("pmcid", txt("pmcid") != txt("pmcid2")),
        ("istexId", txt("istexId") != txt("istex2")),
        ("resources", arr("resources") != arr("res2")),
        ("license", ~F.equal_null(F.col("lic1"),
                                  ids.licence_code(ids.licence_name(F.col("lic1"))))),
    ]
    cells = F.array(*[F.when(cond, F.lit(name)) for name, cond in checks])
    return (back.select(key, F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("field")))


def licence_dimension(spark) -> DataFrame:
    """17 licence codes with their canonical spelling (a fixed 17-row table)."""
    return spark.createDataFrame([(c, n) for c, n in LICENCE_CANONICAL],
                                 "license int, licence_name string")


def spelling_dimension(spark) -> DataFrame:
    """24 accepted spellings with their code (a fixed 24-row table)."""
    return spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(LICENCE_SPELLINGS)],
                                 "spelling_index int, spelling string, license int")


def licence_distribution(typed: DataFrame, alias: str = "n") -> DataFrame:
    """Papers per licence code, every code present (zero when unused), count descending.

    The 17-row dimension is a literal table; the facts are aggregated before the join.
    """
    dim = licence_dimension(typed.sparkSession)
    return zero_filled_counts(dim, typed.select("license"), "license", alias)
