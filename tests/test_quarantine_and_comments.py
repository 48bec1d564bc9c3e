"""Lenient jobs split their input in one pass; last records, table comments, encoded pairs."""

import json

import pytest
from jsonl_files import write_jsonl
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from citeweave.operators import collate, counts, quarantine
from citeweave.plans import jobs
from citeweave.schemas import PAPERS_COMMENT, TABLE_COMMENTS
from citeweave.sinks import writers

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def _uuid(k):
    return f"ab{k:06x}-0000-4000-8000-{k:012d}"


def test_split_counts_and_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(100).mapInArrow(touch, "id long")
    parts = quarantine.split(rows, F.when(F.col("id") % 7 == 0, F.lit("seventh")), "test")
    assert (parts.n_accepted, parts.n_rejected) == (85, 15)
    assert parts.accepted.columns == ["id"] and parts.accepted.count() == 85
    assert {r.reason for r in parts.rejected.collect()} == {"seventh"}
    assert seen.value == 100
    empty = quarantine.split(spark.range(0), F.lit(None).cast("string"), "empty")
    assert (empty.n_accepted, empty.n_rejected, empty.rejected.count()) == (0, 0, 0)


def test_lenient_collation(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    files = {f"aa/{_uuid(1)}.json": '{"a": 1}', f"aa/{_uuid(2)}.json": '{"a": ', f"aa/x.json": "bad",
             f"b b/{_uuid(3)}.software.json": '"text"', f"b b/{_uuid(4)}.json": "{}"}
    for path, text in files.items():
        (raw / path).parent.mkdir(parents=True, exist_ok=True)
        (raw / path).write_text(text)
    with pytest.raises(SPARK_ERRORS):
        jobs.collate_tree(spark, str(raw), str(tmp_path / "strict"))
    assert jobs.collate_tree(spark, str(raw), out, strict=False) == ["aa", "b b"]
    bad = {(r.folder, r.parse_type, r.file, r.text, r.reason)
           for r in jobs.rejected_files(spark, out).collect()}
    assert bad == {("aa", "paper", f"{_uuid(2)}.json", '{"a": ', "malformed JSON"),
                   ("b b", "pdf", f"{_uuid(3)}.software.json", '"text"', "not a JSON object")}
    assert spark.read.text(out).count() == 2
    ledger = {(r.folder, r.parse_type, r.n_records) for r in
              jobs.collation_ledger(spark, out).collect()}
    assert ledger == {("aa", "paper", 1), ("b b", "paper", 1)}
    # Mended files are taken, and are no longer rejected, when everything is done again.
    (raw / f"aa/{_uuid(2)}.json").write_text("{}")
    jobs.collate_tree(spark, str(raw), out, resume=False, strict=False)
    assert [r.folder for r in jobs.rejected_files(spark, out).collect()] == ["b b"]
    assert spark.read.text(out).count() == 3


def test_lenient_profile(spark, tmp_path):
    write_jsonl(str(tmp_path / "in/a.jsonl"), ['{"x": 1, "y": 1}', '{"x": 2, "y": "s"}', '{"x": ', "[3]"])
    with pytest.raises(SPARK_ERRORS):
        jobs.json_stats(spark, str(tmp_path / "in")).collect()
    lines = [tuple(r) for r in jobs.json_stats(
        spark, str(tmp_path / "in"), str(tmp_path / "report"),
        rejected=str(tmp_path / "bad")).collect()]
    assert [p for p, _ in lines] == [".x", "[]"]
    bad = spark.read.parquet(str(tmp_path / "bad/lines")).collect()
    assert [(r.file, r.value, r.reason) for r in bad] == [("a.jsonl", '{"x": ', "malformed JSON")]
    conflicts = spark.read.parquet(str(tmp_path / "bad/conflicts")).collect()
    assert [(r.path, r.types) for r in conflicts] == [(".y", "number,string")]


def test_lenient_identifiers(spark, tmp_path):
    good = {"id": _uuid(1), "doi": "10.1/x", "pmid": "12", "resources": ["pdf"]}
    write_jsonl(str(tmp_path / "ids.jsonl"), [good, {**good, "pmid": "12x"}, {**good, "id": "short"}])
    args = (spark, str(tmp_path / "ids.jsonl"), str(tmp_path / "typed"))
    with pytest.raises(SPARK_ERRORS):
        jobs.paper_id_convert(*args)
    left = jobs.paper_id_convert(*args, validate=True, rejected=str(tmp_path / "bad"))
    assert left.count() == 0 and spark.read.parquet(str(tmp_path / "typed")).count() == 1
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def _sorted(spark, tmp_path, **options):
    jobs.sort_jsonl(spark, str(tmp_path / "in"), str(tmp_path / "out"), **options)
    return [(json.loads(r.value)["file"][:36], json.loads(r.value)["n"])
            for r in spark.read.text(str(tmp_path / "out")).collect()]


def test_last_records_over_two_files(spark, tmp_path):
    write_jsonl(str(tmp_path / "in/a.jsonl"), [{"file": f"{_uuid(k % 5)}.json", "n": k}
                                               for k in range(20)])
    write_jsonl(str(tmp_path / "in/b.jsonl"), [{"file": f"{_uuid(k)}.json", "n": 100 + k}
                                               for k in (3, 7, 3)] + [
        {"file": f"{_uuid(3)}.json", "n": 999}])
    want = {0: 15, 1: 16, 2: 17, 3: 999, 4: 19, 7: 107}
    assert _sorted(spark, tmp_path, last_only=True) == [(_uuid(k), n) for k, n in want.items()]


def test_last_records_aggregate_narrow_rows_by_hash(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 3 AS k", "cast(id AS decimal(38,0)) AS at",
                                        "repeat('x', 50) AS body")
    rows.write.parquet(str(tmp_path / "rows"))
    last = collate.last_at(spark.read.parquet(str(tmp_path / "rows")), "k", "at")
    assert sorted((r.k, int(r["at"])) for r in last.collect()) == [(0, 999), (1, 997), (2, 998)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_lenient_sort(spark, tmp_path):
    write_jsonl(str(tmp_path / "in/a.jsonl"), [{"file": f"{_uuid(2)}.json", "n": 2}, "{broken",
                                               {"file": "none", "n": 3}, {"n": 4},
                                               {"file": f"{_uuid(1)}.json", "n": 1}])
    with pytest.raises(SPARK_ERRORS):
        _sorted(spark, tmp_path)
    assert _sorted(spark, tmp_path, rejected=str(tmp_path / "bad")) == [(_uuid(1), 1), (_uuid(2), 2)]
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert {r.reason: r["count"] for r in bad.groupBy("reason").count().collect()} == {
        "malformed JSON": 1, "no UUID in file": 2}


def test_table_comments_survive_parquet_and_the_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "paper_id long, t string")
    noted = writers.with_comments(df, {"paper_id": "The id."})
    noted = writers.with_table_comment(noted, "It's one row per \\ paper.")
    writers.write_table(noted, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert writers.comment_of_table(back) == "It's one row per \\ paper."
    assert writers.table_comment(back, "paper_id") == "The id."
    assert writers.comment_of_table(df) is None
    writers.write_bucketed_table(noted, "noted_papers", str(tmp_path / "b"), num_buckets=2)
    try:
        told = {r.col_name: r.data_type for r in
                spark.sql("DESCRIBE TABLE EXTENDED noted_papers").collect()}
        assert told["Comment"] == "It's one row per \\ paper."
    finally:
        spark.sql("DROP TABLE noted_papers")


def test_job_tables_carry_their_comments(spark, tmp_path):
    write_jsonl(str(tmp_path / "c/ab.jsonl"), [{"id": _uuid(1), "file": "x"}])
    write_jsonl(str(tmp_path / "c/ab.software.jsonl"), [{"file": f"{_uuid(1)}.software.json",
                                                         "mentions": []}])
    jobs.extract_tables(spark, str(tmp_path / "c"), str(tmp_path / "t"))
    for name, file in (("papers", "papers"), ("mentions", "mentions.pdf"),
                       ("purpose_assessments", "purpose_assessments.pdf")):
        table = spark.read.parquet(str(tmp_path / f"t/{file}.parquet"))
        assert writers.comment_of_table(table) == TABLE_COMMENTS[name]
    assert TABLE_COMMENTS["papers"] == PAPERS_COMMENT


@pytest.mark.parametrize("block_size", [3, 2048])
@pytest.mark.parametrize("pair_support", [1, 4])
def test_encoded_pairs_equal_plain_ones(spark, block_size, pair_support):
    rows = spark.range(400).selectExpr("id % 37 AS paper", "concat('n', (id * id) % 23) AS name",
                                       "cast((id * id) % 23 AS int) AS code")
    rows = rows.unionByName(spark.range(23).selectExpr("100L AS paper", "concat('n', id) AS name",
                                                       "cast(id AS int) AS code"))
    found = [sorted(map(tuple, counts.co_occurrence_counts(
        rows, "paper", "name", ["n4"], 3, pair_support, block_size, encode=e).collect()))
        for e in (True, False, None)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 20
