"""Raw tree collation, residual files, UUID sort, last value per key (FIXTURES.md F4, F5)."""

import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# A strict check raises inside a task; PySpark reports it as a PySparkException, or as the raw
# JVM error when several stages fail at once.
SPARK_ERRORS = (PySparkException, Py4JJavaError)

from citeweave.operators import collate
from citeweave.sinks.writers import write_collection
from citeweave.sources.raw_tree import list_files, read_raw_tree
from citeweave.streaming.incremental import collate_stream

A = "ab12cd34-0000-4000-8000-000000000001"
B = "ab99cd34-0000-4000-8000-000000000002"
C = "cd12cd34-0000-4000-8000-000000000003"


def _put(root, rel, obj):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as fh:
        fh.write(obj if isinstance(obj, str) else json.dumps(obj, indent=1))


@pytest.fixture()
def raw(tmp_path):
    root = str(tmp_path / "raw")
    for u in (A, B, C):
        d = f"{u[:2]}/{u[2:4]}/{u[4:6]}/{u[6:8]}/{u}"
        _put(root, f"{d}/{u}.json", {"id": u, "title": "t", "file": "old-name"})
        _put(root, f"{d}/{u}.software.json", {"file": "x", "mentions": []})
    _put(root, f"ab/99/cd/34/{B}/{B}.jats.software.json", {"mentions": [{"context": "c"}]})
    _put(root, f"ab/99/cd/34/{B}/{B}.pub2tei.tei.software.json", {"mentions": []})
    _put(root, "ab/notes.txt", "hello")
    _put(root, "ab/12/x.software.json", {"mentions": []})
    return root


def test_classify_and_collate(spark, raw, tmp_path):
    records = read_raw_tree(spark, raw, schema="id string, title string, file string, "
                                              "mentions array<struct<context:string>>")
    tagged = collate.collate_records(records, "_file_name")
    got = sorted((r.file, r.parse_type, r.prefix) for r in tagged.collect())
    assert (f"{A}.json", "paper", "ab") in got and (f"{B}.jats.software.json", "jats", "ab") in got
    assert (f"{B}.pub2tei.tei.software.json", "pub2tei", "ab") in got
    assert all(not f.startswith("x.") for f, _, _ in got) and len(got) == 8
    # the 'file' key is overwritten by the base name
    assert {r.file for r in tagged.where("parse_type = 'paper'").collect()} == {
        f"{u}.json" for u in (A, B, C)}
    out = str(tmp_path / "collated")
    write_collection(tagged.drop("_file_path"), out)
    back = spark.read.json(out)
    assert back.where("parse_type = 'paper' AND prefix = 'ab'").count() == 2
    summary = {(r.parse_type, r.prefix): r.n_records for r in
               collate.bucket_summary(tagged).collect()}
    assert summary[("pdf", "ab")] == 2 and summary[("paper", "cd")] == 1


def test_residual(spark, raw):
    files = list_files(spark, raw)
    assert sorted(r.name for r in collate.residual_files(files).collect()) == [
        "notes.txt", "x.software.json"]


def test_sort_and_last_by_key(spark):
    rows = [(f"{B}.software.json", 1), (f"{A.upper()}.software.json", 2), (f"{A}.json", 3)]
    df = spark.createDataFrame(rows, "file string, pos int")
    ordered = [r.pos for r in collate.sort_by_uuid(df, tiebreak=["pos"]).collect()]
    assert ordered == [2, 3, 1]                       # duplicates both kept, in order
    last = collate.last_by_key(df.withColumn("k", collate.uuid_sort_key("file")), "k", "pos")
    assert sorted((r.key, r.pos) for r in last.collect()) == [(A, 3), (B, 1)]
    bad = spark.createDataFrame([(None, 1)], "file string, pos int")
    with pytest.raises(SPARK_ERRORS):
        collate.sort_by_uuid(bad).collect()


def test_streaming_collation_processes_each_file_once(spark, raw, tmp_path):
    out, ckpt = str(tmp_path / "stream_out"), str(tmp_path / "stream_ckpt")
    collate_stream(spark, raw, out, ckpt)
    first = spark.read.json(out).count()
    _put(raw, f"cd/99/00/00/{C[:2]}99/{C[:2]}99{C[4:]}.json", {"id": "new"})
    collate_stream(spark, raw, out, ckpt)
    assert first == 8 and spark.read.json(out).count() == 9


def test_collated_layout_feeds_table_build(spark, raw, tmp_path):
    from citeweave.operators import tables
    from citeweave.schemas import MENTION_JSON, PAPER_JSON
    from citeweave.sources.jsonl import read_collated

    schema = ("id string, title string, file string, "
              "mentions array<struct<`software-name`:struct<normalizedForm:string>>>")
    records = read_raw_tree(spark, raw, schema=schema)
    out = str(tmp_path / "collated")
    write_collection(collate.collate_records(records, "_file_name").drop("_file_path"), out)
    papers = read_collated(spark, out, PAPER_JSON, "paper")
    mentions = read_collated(spark, out, MENTION_JSON, "pdf")
    p = tables.papers_table(papers, mentions, num_partitions=2)
    assert [(r.source_uuid, r.paper_id) for r in p.orderBy("paper_id").collect()] == [
        (A, 1), (B, 2), (C, 3)]
    plan = papers._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(parse_type" in plan and "(parse_type" in plan


def test_stream_after_backfill_holds_every_record_once(spark, raw, tmp_path):
    import time

    from citeweave.plans import jobs

    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    jobs.collate_tree(spark, raw, batch)
    time.sleep(1.1)
    start = spark.sql("select string(current_timestamp())").first()[0]
    time.sleep(1.1)
    _put(raw, f"cd/99/00/00/{C[:2]}99/{C[:2]}99{C[4:]}.json", {"id": "new"})
    collate_stream(spark, raw, stream, str(tmp_path / "ckpt"), newer_than=start)
    files = [r.file for path in (batch, stream) for r in spark.read.json(path).collect()]
    assert len(files) == len(set(files)) == 9


def test_collation_copies_objects_and_takes_every_folder(spark, tmp_path):
    from citeweave.plans import jobs

    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    odd = {"a": None, "n": 1, "o": {"x": [1, None, "y"]}, "file": "old"}
    for k in range(5):
        u = f"ab{k:06x}-0000-4000-8000-{k:012d}"
        _put(raw, f"ab/{u}.json", {**odd, "n": str(k)})
    strays = ["ab0000ff-0000-4000-8000-00000000000a", "cd0000ff-0000-4000-8000-00000000000b"]
    for folder, u in zip(("gg", "misc"), strays):
        _put(raw, f"{folder}/{u}.json", odd)
    assert jobs.collate_tree(spark, raw, out, prefixes_per_job=1) == ["ab", "gg", "misc"]
    rows = spark.read.text(out).collect()
    assert sorted((r.parse_type, r.prefix) for r in rows) == [("paper", "ab")] * 5 + [
        ("paper", "gg"), ("paper", "misc")]
    got = {json.loads(r.value)["file"]: json.loads(r.value) for r in rows}
    assert got[f"{strays[0]}.json"] == {**odd, "file": f"{strays[0]}.json"}
    assert {got[f][k] for f in got for k in ("n",)} == {1, "0", "1", "2", "3", "4"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_collation_stops_at_broken_files(spark, tmp_path):
    from citeweave.plans import jobs

    _put(str(tmp_path / "raw"), f"ab/{A}.json", '{"id": ')
    with pytest.raises(SPARK_ERRORS):
        jobs.collate_tree(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
