"""Ids that survive an append, and the ledger of finished folders."""

import os

import pytest
from jsonl_files import write_jsonl
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from citeweave import storage
from citeweave.operators import registry
from citeweave.plans import jobs
from citeweave.sinks import writers

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def _uuid(k, prefix="ab"):
    return f"{prefix}{k:06x}-0000-4000-8000-{k:012d}"


def _ids(df):
    return {r["source_uuid"]: r["paper_id"] for r in df.collect()}


def _keys(spark, ks):
    return spark.createDataFrame([(_uuid(k),) for k in ks], "source_uuid string")


def test_two_appends_keep_every_old_id(spark, tmp_path):
    root = str(tmp_path / "registry")
    first = _ids(registry.append_keys(_keys(spark, [5, 1, 9, 5]), root))
    assert first == {_uuid(1): 1, _uuid(5): 2, _uuid(9): 3}
    second = _ids(registry.append_keys(_keys(spark, [9, 0, 7, 1]), root, num_partitions=3))
    assert second == {**first, _uuid(0): 4, _uuid(7): 5}
    third = registry.append_keys(_keys(spark, [2, 0]), root)
    assert _ids(third) == {**second, _uuid(2): 6}
    assert {r["paper_id"]: r["generation"] for r in third.collect()} == {
        1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3}


def test_nothing_new_adds_no_generation(spark, tmp_path):
    root = str(tmp_path / "registry")
    assert registry.append_keys(_keys(spark, []), root).count() == 0
    registry.append_keys(_keys(spark, [1]), root)
    assert _ids(registry.append_keys(_keys(spark, [1]), root)) == {_uuid(1): 1}
    assert [c["generation"] for c in registry.commits(spark, root)] == [1]
    assert len(os.listdir(tmp_path / "registry" / "keys")) == 1


def test_appends_that_died_are_not_read(spark, tmp_path):
    root = str(tmp_path / "registry")
    registry.append_keys(_keys(spark, [1]), root)
    # One run died before its commit, one while it wrote the commit file.
    spark.createDataFrame([(_uuid(8), 2)], "source_uuid string, paper_id long").write.parquet(
        f"{root}/keys/2-dead")
    storage.create_file(spark, f"{root}/commits/2", '{"generation": 2, "fol')
    assert _ids(registry.append_keys(_keys(spark, [8, 3]), root)) == {
        _uuid(1): 1, _uuid(3): 2, _uuid(8): 3}
    assert [c["generation"] for c in registry.commits(spark, root)] == [1, 3]


def test_of_two_appends_at_once_one_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "registry")
    registry.append_keys(_keys(spark, [1]), root)
    real = registry.dense_ids

    def overtaken(*args, **kwargs):
        monkeypatch.setattr(registry, "dense_ids", real)
        registry.append_keys(_keys(spark, [4]), root)
        return real(*args, **kwargs)

    monkeypatch.setattr(registry, "dense_ids", overtaken)
    with pytest.raises(SPARK_ERRORS):
        registry.append_keys(_keys(spark, [3]), root)
    assert _ids(registry.read_registry(spark, root)) == {_uuid(1): 1, _uuid(4): 2}


def test_null_keys_are_an_error(spark, tmp_path):
    rows = spark.createDataFrame([(None,), (_uuid(1),)], "source_uuid string")
    with pytest.raises(SPARK_ERRORS):
        registry.append_keys(rows, str(tmp_path / "registry"))


def _collection(folder, ks, titles=None):
    papers = [{"id": _uuid(k), "file": f"{_uuid(k)}.json",
               "title": (titles or {}).get(k, f"t{k}")} for k in ks]
    mentions = [{"file": f"{_uuid(k)}.software.json", "mentions": [
        {"software-name": {"normalizedForm": f"s{k}", "rawForm": f"s{k}"}}]} for k in ks]
    write_jsonl(f"{folder}/ab.jsonl", papers)
    write_jsonl(f"{folder}/ab.software.jsonl", mentions)
    return str(folder)


def test_tables_keep_their_ids_when_papers_are_added(spark, tmp_path):
    root = str(tmp_path / "registry")
    jobs.extract_tables(spark, _collection(tmp_path / "c1", [3, 6]), str(tmp_path / "t1"),
                        id_registry=root)
    jobs.extract_tables(spark, _collection(tmp_path / "c2", [3, 1, 6, 4]), str(tmp_path / "t2"),
                        id_registry=root)
    old = _ids(spark.read.parquet(str(tmp_path / "t1/papers.parquet")))
    new = _ids(spark.read.parquet(str(tmp_path / "t2/papers.parquet")))
    assert old == {_uuid(3): 1, _uuid(6): 2}
    assert new == {**old, _uuid(1): 3, _uuid(4): 4}
    mentions = spark.read.parquet(str(tmp_path / "t2/mentions.pdf.parquet"))
    assert {r["paper_id"]: r["software_normalized"] for r in mentions.collect()} == {
        new[_uuid(k)]: f"s{k}" for k in (1, 3, 4, 6)}


def test_repeated_papers_with_a_registry(spark, tmp_path):
    coll = _collection(tmp_path / "c", [1, 2])
    with open(f"{coll}/ab.jsonl", "a") as fh:
        fh.write('{"id": "%s", "file": "x", "title": "zz"}\n' % _uuid(2))
    with pytest.raises(SPARK_ERRORS):
        jobs.extract_tables(spark, coll, str(tmp_path / "t"), id_registry=str(tmp_path / "r"))
    jobs.extract_tables(spark, coll, str(tmp_path / "t"), strict=False,
                        id_registry=str(tmp_path / "r"))
    papers = spark.read.parquet(str(tmp_path / "t/papers.parquet"))
    assert {(r["paper_id"], r["title"]) for r in papers.collect()} == {(1, "t1"), (2, "zz")}
    rejected = spark.read.parquet(str(tmp_path / "t/rejected.repeated_papers"))
    assert [r["title"] for r in rejected.collect()] == ["t2"]


# ---------------------------------------------------------------- ledger

def _raw(folder, files):
    for path, text in files.items():
        os.makedirs(os.path.dirname(f"{folder}/{path}"), exist_ok=True)
        with open(f"{folder}/{path}", "w") as fh:
            fh.write(text)
    return str(folder)


FILES = {f"aa/{_uuid(1)}.json": "{}", f"aa/{_uuid(1)}.software.json": "{}",
         f"bb/{_uuid(2)}.json": "{}", f"bb/x/notes.json": "no json", f"cc/{_uuid(3)}.jats.software.json":
         "{}", "dd/readme.txt": "text", f"ee f%/{_uuid(5)}.json": "{}"}


def _ledger(spark, out):
    return sorted((r["folder"], r["parse_type"], r["n_records"], r["n_files"])
                  for r in jobs.collation_ledger(spark, out).collect())


LEDGER = [("aa", "paper", 1, 2), ("aa", "pdf", 1, 2), ("bb", "paper", 1, 2), ("cc", "jats", 1, 1),
          ("dd", None, 0, 0), ("ee f%", "paper", 1, 1)]


def test_folders_without_some_type_are_done(spark, tmp_path):
    raw, out = _raw(tmp_path / "raw", FILES), str(tmp_path / "out")
    assert jobs.collate_tree(spark, raw, out, prefixes_per_job=2) == ["aa", "bb", "cc", "dd", "ee f%"]
    assert _ledger(spark, out) == LEDGER
    assert jobs.collate_tree(spark, raw, out) == []
    _raw(tmp_path / "raw", {f"gg/{_uuid(7)}.json": "{}"})
    assert jobs.collate_tree(spark, raw, out) == ["gg"]
    assert spark.read.text(out).count() == 6


def test_a_run_broken_between_buckets_is_redone(spark, tmp_path, monkeypatch):
    raw, out = _raw(tmp_path / "raw", FILES), str(tmp_path / "out")
    real = writers.write_collection

    def broken(collated, path, *args, **kwargs):
        real(collated.where("parse_type = 'paper'"), path, *args, **kwargs)
        raise RuntimeError("lost between two buckets")

    monkeypatch.setattr(writers, "write_collection", broken)
    with pytest.raises(RuntimeError):
        jobs.collate_tree(spark, raw, out, prefixes_per_job=10)
    assert _ledger(spark, out) == []
    monkeypatch.setattr(writers, "write_collection", real)
    # Meanwhile a file has gone: its bucket, left by the broken run, must go as well.
    os.remove(f"{raw}/bb/{_uuid(2)}.json")
    assert len(jobs.collate_tree(spark, raw, out, prefixes_per_job=10)) == 5
    want = [r for r in LEDGER if r[0] != "bb"] + [("bb", None, 0, 1)]
    assert _ledger(spark, out) == sorted(want, key=lambda r: r[0])
    rows = sorted((r["parse_type"], r["prefix"]) for r in spark.read.text(out).collect())
    assert rows == [("jats", "cc"), ("paper", "aa"), ("paper", "ee f%"), ("pdf", "aa")]


def test_without_resume_everything_is_redone(spark, tmp_path):
    raw, out = _raw(tmp_path / "raw", FILES), str(tmp_path / "out")
    jobs.collate_tree(spark, raw, out)
    assert len(jobs.collate_tree(spark, raw, out, resume=False)) == 5
    assert _ledger(spark, out) == LEDGER and spark.read.text(out).count() == 5
