"""Identifier conversion, round trip and licences (FIXTURES.md F3)."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# A strict check raises inside a task; PySpark reports it as a PySparkException, or as the raw
# JVM error when several stages fail at once.
SPARK_ERRORS = (PySparkException, Py4JJavaError)

from citeweave.operators import identifiers as I

SCHEMA = ("row_key long, id string, doi string, arxiv string, pmid string, pmcid string, "
          "istexId string, resources array<string>, license string, oa_link string")
U = "6f1c2d3e-4a5b-4c6d-8e9f-0a1b2c3d4e5f"
ISTEX = "4B98414E076FB3C1053BA36A5A2A7C2FA4ED35A1"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_convert_and_back(spark):
    df = _df(spark, [
        (1, U, "10.1/x", "", "12862144", "PMC6665909", ISTEX, ["json", "pdf"], "CC BY", "http://o"),
        (2, U, "", None, "", "", "", None, "cc-by", None),
        (3, U, "", None, "", "PMC12.3", "", [], "", None),
    ])
    typed = {r.id and r.license: r for r in I.typed_identifiers(df.drop("row_key")).collect()}
    rows = I.typed_identifiers(df, keep=["row_key"]).orderBy("row_key").collect()
    assert rows[0].pmid == 12862144 and rows[0].pmcid.id == 6665909
    assert rows[0].resources == [1, 2] and rows[0].license == 1 and rows[1].license == 1
    assert rows[1].pmid is None and rows[1].pmcid is None and rows[1].istex_id is None
    assert (rows[2].pmcid.id, rows[2].pmcid.version, rows[2].license) == (12, 3, 0)
    back = I.identifier_records(I.typed_identifiers(df)).collect()
    assert back[0].id == U and back[0].license == "cc-by" and back[0].istexId == ISTEX
    assert back[0].pmcid == "PMC6665909" and back[2].pmcid == "PMC12.3"
    assert typed


def test_roundtrip_reports_lossy_fields(spark):
    df = _df(spark, [
        (1, U, "", None, "0012", "", ISTEX.lower(), None, "CC BY", None),
        (2, U, "", None, "12", "", ISTEX, [], "cc-by", None),   # NULL and [] resources agree
    ])
    got = sorted(tuple(r) for r in I.roundtrip_violations(df).collect())
    assert got == [(1, "istexId"), (1, "pmid")]


def test_bad_values_raise_or_are_listed(spark):
    df = _df(spark, [
        (1, U, "", None, "", "", "", None, "made-up", None),
        (2, U, "", None, "", "", "", ["epub"], "", None),
        (3, U, "", None, "", "", ISTEX[:39], None, "", None),
        (4, "not-a-uuid", "", None, "", "", "", None, "", None),
        (5, U, "", None, "-4", "", "", None, "", None),
        (6, U, "", None, "", "", "", None, "", None),
    ])
    reasons = {r.row_key: r.reason for r in I.identifier_violations(df).collect()}
    assert reasons == {1: "license", 2: "resources", 3: "istexId", 4: "id", 5: "pmid"}
    with pytest.raises(SPARK_ERRORS):
        I.typed_identifiers(df).collect()
    assert I.typed_identifiers(df, strict=False).count() == 1


def test_licence_distribution_zero_filled(spark):
    df = _df(spark, [(i, U, "", None, "", "", "", None, lic, None)
                     for i, lic in enumerate(["CC BY", "cc-by", "cc0", "pd"])])
    dist = {r.license: r.n for r in I.licence_distribution(I.typed_identifiers(df)).collect()}
    assert len(dist) == 17 and dist[1] == 2 and dist[7] == 1 and dist[10] == 1 and dist[0] == 0


def test_pmcid_range(spark):
    from pyspark.sql import functions as F

    from citeweave.functions import identifiers as ids

    rows = spark.createDataFrame([("PMC4294967295",), ("PMC9999999999",), ("PMC1.9999999999",),
                                  ("PMC1.2",), ("",)], "t string")
    got = rows.select(ids.valid_pmcid("t").alias("ok"), F.col("t"),
                      ids.parse_pmcid("t")["id"].alias("id")).collect()
    assert [r.ok for r in got] == [True, False, False, True, True]
    assert [r.id for r in got] == [4294967295, None, None, 1, None]
