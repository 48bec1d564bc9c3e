"""Nested JSON → papers / mentions / assessments (FIXTURES.md F1, F2)."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# A strict check raises inside a task; PySpark reports it as a PySparkException, or as the raw
# JVM error when several stages fail at once.
SPARK_ERRORS = (PySparkException, Py4JJavaError)
from pyspark.sql import functions as F

from citeweave.operators import tables
from citeweave.schemas import MENTION_JSON, PAPER_JSON
from citeweave.sources.jsonl import read_collection
from jsonl_files import write_jsonl

U1 = "0a000000-0000-4000-8000-000000000001"
U2 = "0a000000-0000-4000-8000-000000000002"
U3 = "1b000000-0000-4000-8000-000000000003"
UG = "ff000000-0000-4000-8000-00000000000g"[:-1] + "9"  # ordinary uuid in the special file


def _mention(name, raw="", version=None, doc=True, context="ctx"):
    m = {"software-name": {"normalizedForm": name, "rawForm": raw, "wikidataId": "Q1"},
         "version": {"normalizedForm": "", "rawForm": version or ""},
         "publisher": {"normalizedForm": "Pub", "rawForm": "pub"},
         "context": context,
         "mentionContextAttributes": {"created": {"score": 0.1, "value": False},
                                      "shared": {"score": 0.2, "value": False},
                                      "used": {"score": 0.9, "value": True}}}
    if doc:
        m["documentContextAttributes"] = {"created": {"score": 0.3, "value": False},
                                          "shared": {"score": 0.4, "value": False},
                                          "used": {"score": 0.8, "value": True}}
    return m


@pytest.fixture()
def collection(tmp_path):
    d = tmp_path / "jsonl"
    write_jsonl(str(d / "0a.jsonl"), [
        {"id": U2, "file": U2 + ".json", "title": "", "year": 0, "published_date": "",
         "journal_name": "J", "license": "cc-by"},
        {"id": U1, "file": U1 + ".json", "title": "T1", "year": 2021,
         "published_date": "2021-03-04", "doi": "10.1/x", "pmid": "", "genre": "journal-article"},
    ])
    write_jsonl(str(d / "1b.jsonl"), [{"id": U3, "file": U3 + ".json", "title": "T3",
                                       "year": 2019}])
    write_jsonl(str(d / "gg.jsonl"), [{"id": UG, "file": UG + ".json", "title": "G"}])
    write_jsonl(str(d / "0a.software.jsonl"), [
        {"file": U1 + ".software.json",
         "mentions": [_mention("SPSS", "spss", "22"), _mention("R", doc=False, context="")]},
        {"file": U2 + ".software.json", "mentions": []},
    ])
    write_jsonl(str(d / "1b.software.jsonl"), [
        {"file": U3 + ".software.json", "mentions": [_mention("")]}])
    return str(d)


def _build(spark, path, strict=True):
    papers = read_collection(spark, path, PAPER_JSON, "papers")
    mentions = read_collection(spark, path, MENTION_JSON, "pdf")
    return tables.build_tables(papers, mentions, "pdf", strict=strict, num_partitions=3)


def test_papers_ids_nulls_and_flags(spark, collection):
    papers, _, _ = _build(spark, collection)
    rows = {r.source_uuid: r for r in papers.collect()}
    # ids follow file order: 0a (uuid order), then 1b, then the special gg file last
    assert [rows[u].paper_id for u in (U1, U2, U3, UG)] == [1, 2, 3, 4]
    p2 = rows[U2]
    assert p2.title is None and p2.published_year is None and p2.published_date is None
    assert p2.doi == "" and p2.license_type == "cc-by" and p2.has_mentions is False
    p1 = rows[U1]
    assert str(p1.published_date) == "2021-03-04" and p1.pmid is None and p1.has_mentions
    assert rows[U3].has_mentions and not rows[UG].has_mentions
    assert papers.schema["paper_id"].metadata["comment"]


def test_mentions_and_assessments(spark, collection):
    _, mentions, assess = _build(spark, collection)
    m = {r.software_mention_id: r for r in mentions.collect()}
    assert set(m) == {"         1.pdf.00000", "         1.pdf.00001", "         3.pdf.00000"}
    first = m["         1.pdf.00000"]
    assert (first.software_raw, first.version_raw, first.version_normalized) == ("spss", "22", None)
    assert m["         1.pdf.00001"].context_full_text is None
    assert m["         3.pdf.00000"].software_normalized == ""
    rows = assess.collect()
    assert len(rows) == 6 * len(m)
    second = sorted((r.scope, r.purpose, r.certainty_score) for r in rows
                    if r.software_mention_id == "         1.pdf.00001")
    # no documentContextAttributes: still six rows, document scores 0.0
    assert second == [("document", "created", 0.0), ("document", "shared", 0.0),
                      ("document", "used", 0.0), ("local", "created", 0.1),
                      ("local", "shared", 0.2), ("local", "used", 0.9)]


def test_comments_survive_parquet(spark, collection, tmp_path):
    papers, mentions, _ = _build(spark, collection)
    out = str(tmp_path / "papers.parquet")
    papers.write.parquet(out)
    back = spark.read.parquet(out)
    assert back.schema["source_uuid"].metadata.get("comment")


def test_bad_date_raises_or_is_quarantined(spark, tmp_path):
    d = str(tmp_path / "bad")
    write_jsonl(d + "/0a.jsonl", [{"id": U1, "published_date": "2020-13-01"}])
    papers = read_collection(spark, d, PAPER_JSON, "papers")
    with pytest.raises(SPARK_ERRORS):
        tables.papers_table(papers).collect()
    assert [r.reason for r in tables.paper_violations(papers).collect()] == ["published_date"]
    lenient = tables.papers_table(papers, strict=False).collect()
    assert lenient[0].published_date is None


def test_short_id_raises(spark, tmp_path):
    d = str(tmp_path / "short")
    write_jsonl(d + "/0a.jsonl", [{"id": U1[:35]}])
    papers = read_collection(spark, d, PAPER_JSON, "papers")
    with pytest.raises(SPARK_ERRORS):
        tables.papers_table(papers).collect()
    assert tables.paper_violations(papers).count() == 1


def test_missing_paper_is_an_error_or_violation(spark, collection, tmp_path):
    d = str(tmp_path / "orphan")
    write_jsonl(d + "/0a.software.jsonl", [{"file": U3 + ".software.json",
                                            "mentions": [_mention("x")]}])
    papers = read_collection(spark, collection, PAPER_JSON, "papers")
    only_u1 = tables.papers_table(papers).where(F.col("source_uuid") == U1)
    orphans = read_collection(spark, d, MENTION_JSON, "pdf")
    with pytest.raises(SPARK_ERRORS):
        tables.mention_rows(orphans, only_u1, "pdf").collect()
    keyed = orphans.select(F.substring("file", 1, 36).alias("source_uuid"))
    assert tables.lookup_violations(keyed, only_u1, "source_uuid").count() == 1


def test_parse_type_validated(spark, collection):
    with pytest.raises(ValueError):
        read_collection(spark, collection, PAPER_JSON, "software")
