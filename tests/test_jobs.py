"""Command-level jobs end to end on hand-written fixtures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from citeweave.plans import jobs
from jsonl_files import write_jsonl

UUIDS = [f"{p:02x}{i:06d}-0000-4000-8000-{i:012d}" for p in (0x0a, 0x1b, 0xc3) for i in range(40)]


def _mention(name, used):
    att = {"created": {"score": 0.1}, "shared": {"score": 0.1}, "used": {"score": used}}
    return {"software-name": {"normalizedForm": name, "rawForm": name.lower()},
            "context": "c", "mentionContextAttributes": att, "documentContextAttributes": att}


def _collection(root):
    by_prefix = {}
    for k, u in enumerate(UUIDS):
        by_prefix.setdefault(u[:2], []).append(u)
    for prefix, us in by_prefix.items():
        write_jsonl(f"{root}/{prefix}.jsonl",
                    [{"id": u, "title": f"t{u[-3:]}", "year": 2018 + (int(u[-2:]) % 5)} for u in us])
        write_jsonl(f"{root}/{prefix}.software.jsonl", [
            {"file": u + ".software.json",
             "mentions": ([_mention("SPSS", 0.9), _mention("R", 0.2 + 0.02 * (int(u[-2:]) % 40))]
                          if int(u[-2:]) % 4 else [])} for u in us])


def test_extract_subsample_and_analyses(spark, tmp_path):
    coll, tabs, samples = (str(tmp_path / n) for n in ("coll", "tables", "samples"))
    _collection(coll)
    from citeweave.session import ensure_checkpoint_dir

    ckpt = ensure_checkpoint_dir(spark)

    def scratch():
        return {n for n in os.listdir(ckpt) if n.startswith(("paper-rows", "papers-with-ids",
                                                             "mention-rows"))}

    before = scratch()
    jobs.extract_tables(spark, coll, tabs)
    assert scratch() == before                             # intermediates released
    papers = spark.read.parquet(f"{tabs}/papers.parquet")
    mentions = spark.read.parquet(f"{tabs}/mentions.pdf.parquet")
    purposes = spark.read.parquet(f"{tabs}/purpose_assessments.pdf.parquet")
    assert papers.count() == 120 and mentions.count() == 2 * 90 and purposes.count() == 6 * 180
    assert papers.agg(F.min("paper_id"), F.max("paper_id")).first() == (1, 120)
    assert mentions.select("software_mention_id").distinct().count() == 180

    sizes = {r.sample: r.n for r in jobs.subsample(spark, tabs, samples, 3, (0.3, 0.3)).collect()}
    sp = spark.read.parquet(f"{samples}/papers")
    sm = spark.read.parquet(f"{samples}/mentions.pdf")
    sa = spark.read.parquet(f"{samples}/purpose_assessments.pdf")
    assert sum(sizes.values()) == sp.count() and sp.where("NOT has_mentions").count() == 0
    # every extraction of a sampled paper follows it into the same sample, and nothing else
    keys = {(r.paper_id, r.sample) for r in sp.collect()}
    assert {(r.paper_id, r.sample) for r in sm.collect()} <= keys
    assert sm.count() == 2 * len(keys) and sa.count() == 12 * len(keys)

    res = jobs.readme_analyses(spark, tabs)
    assert res["papers_mentioning_openstreetmap"].first().n == 0
    top = res["popular_used_since_2020"].collect()
    n_2020 = papers.where("published_year >= 2020 AND has_mentions").count()
    assert top[0].software_normalized == "SPSS" and top[0].n == n_2020

    mc = jobs.mentions_count(mentions, min_support=10, out=str(tmp_path / "mc"))
    assert mc["n_items"].first().n_items == 2
    assert [tuple(r) for r in mc["top_pairs"].collect()] == [(0, "R", "SPSS", 90)]
    from citeweave.sinks.writers import read_report_lines
    assert read_report_lines(spark, str(tmp_path / "mc/top_items")) == ["0;R;90", "1;SPSS;90"]
    assert read_report_lines(spark, str(tmp_path / "mc/n_items")) == ["2"]


def test_json_stats_and_sort(spark, tmp_path):
    src = str(tmp_path / "docs.jsonl")
    u1, u2 = UUIDS[5], UUIDS[1]
    write_jsonl(src, [{"file": u1 + ".x", "n": 1, "b": True},
                      {"file": u2 + ".x", "n": 2, "b": False},
                      {"file": u1 + ".x", "n": 3}])
    lines = [tuple(r) for r in jobs.json_stats(spark, src, str(tmp_path / "stats")).collect()]
    from citeweave.sinks.writers import read_report_lines
    assert read_report_lines(spark, str(tmp_path / "stats"))[0] == ".b;true:1;false:1"
    assert lines[0] == (".b", "true:1;false:1") and lines[2] == (".n", "uint8;1;3;1:1;2:1;3:1;")
    out = str(tmp_path / "sorted")
    jobs.sort_jsonl(spark, src, out)
    got = [json.loads(r.value)["n"] for r in spark.read.text(out).collect()]
    assert got == [2, 1, 3]
    jobs.sort_jsonl(spark, src, out + "_last", last_only=True)
    got = sorted(json.loads(r.value)["n"] for r in spark.read.text(out + "_last").collect())
    assert got == [2, 3]


def test_identifier_jobs(spark, tmp_path):
    src = str(tmp_path / "ids.jsonl")
    write_jsonl(src, [{"id": UUIDS[0], "pmid": "0012", "license": "CC BY", "oa_link": "x"},
                      {"id": UUIDS[1], "license": "cc0", "resources": ["pdf"]}])
    bad = jobs.paper_id_convert(spark, src, str(tmp_path / "typed"), keep_oa_link=False,
                                validate=True)
    assert [r.field for r in bad.collect()] == ["pmid"]
    typed = spark.read.parquet(str(tmp_path / "typed"))
    assert typed.where("oa_link IS NOT NULL").count() == 0
    dist = jobs.license_count(spark, str(tmp_path / "typed"), str(tmp_path / "lic")).collect()
    from citeweave.sinks.writers import read_report_lines
    assert read_report_lines(spark, str(tmp_path / "lic"))[:2] == ["cc-by;1", "cc0;1"]
    assert len(dist) == 17 and {dist[0].license, dist[1].license} == {1, 7}


def test_raw_tree_jobs(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for u in UUIDS[:3] + UUIDS[40:42]:
        d = os.path.join(raw, u[:2], u[2:4], u)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, u + ".json"), "w") as fh:
            json.dump({"id": u}, fh)
        with open(os.path.join(d, u + ".software.json"), "w") as fh:
            json.dump({"mentions": [_mention("SPSS", 0.5), _mention("R", 0.5),
                                    _mention("SPSS", 0.1)]}, fh)
    with open(os.path.join(raw, "0a", "readme.txt"), "w") as fh:
        fh.write("x")
    out = str(tmp_path / "coll")
    assert jobs.collate_tree(spark, raw, out, prefixes_per_job=1) == ["0a", "1b"]
    assert jobs.collate_tree(spark, raw, out) == []           # resumed: nothing left to do
    assert spark.read.json(out).where("parse_type = 'paper'").count() == 5
    counts = jobs.mentions_convert(spark, raw, str(tmp_path / "slim"),
                                   prefixes_per_job=1).collect()
    assert [tuple(r) for r in counts] == [("SPSS", 10), ("R", 5)]
    slim = spark.read.parquet(str(tmp_path / "slim"))
    assert slim.schema["id"].dataType.typeName() == "binary" and slim.count() == 5
    assert [r.name for r in jobs.residual_report(spark, raw).collect()] == ["readme.txt"]
    with open(os.path.join(raw, "notes.md"), "w") as fh:
        fh.write("x")
    grouped = jobs.residual_report(spark, raw, str(tmp_path / "residual"), prefixes_per_job=1)
    assert sorted(r.name for r in grouped.collect()) == ["notes.md", "readme.txt"]


def test_extract_tables_bucketed(spark, tmp_path):
    coll, tabs = str(tmp_path / "coll"), str(tmp_path / "tables")
    _collection(coll)
    jobs.extract_tables(spark, coll, tabs, table_prefix="cw_built_", num_buckets=4)
    papers = spark.table("cw_built_papers")
    mentions = spark.table("cw_built_mentions")
    assert papers.count() == 120 and mentions.count() == 180
    assert spark.read.parquet(f"{tabs}/purpose_assessments.pdf.parquet").count() == 1080


def test_raw_tree_to_analyses(spark, tmp_path):
    """The whole chain: raw tree, collection, tables of two source types, subsample, analyses."""
    raw, coll, tabs = (str(tmp_path / n) for n in ("raw", "coll", "tables"))
    for k, u in enumerate(UUIDS[:30]):
        d = os.path.join(raw, u[:2])
        os.makedirs(d, exist_ok=True)
        files = {".json": {"id": u, "title": "t", "year": 2021}}
        if k % 3 == 0:
            files[".software.json"] = {"mentions": [_mention("SPSS", 0.9)]}
        if k % 5 == 0:
            files[".jats.software.json"] = {"mentions": [_mention("R", 0.9)]}
        for suffix, obj in files.items():
            with open(os.path.join(d, u + suffix), "w") as fh:
                json.dump(obj, fh)
    jobs.collate_tree(spark, raw, coll)
    jobs.extract_tables(spark, coll, tabs, ["pdf", "jats"])
    papers = spark.read.parquet(f"{tabs}/papers.parquet")
    assert papers.count() == 30 and papers.where("has_mentions").count() == 14
    assert spark.read.parquet(f"{tabs}/mentions.pdf.parquet").count() == 10
    assert spark.read.parquet(f"{tabs}/mentions.jats.parquet").count() == 6
    assert spark.read.parquet(f"{tabs}/purpose_assessments.jats.parquet").count() == 36
    sizes = {r.sample: r.n for r in jobs.subsample(spark, tabs, str(tmp_path / "s"), 1, (0.5, 0.5))
             .collect()}
    assert sum(sizes.values()) == 14
    top = jobs.readme_analyses(spark, tabs)["popular_used_since_2020"].collect()
    assert [tuple(r) for r in top] == [("SPSS", 10)]


def test_no_matching_input_is_an_error(spark, tmp_path):
    write_jsonl(f"{tmp_path}/coll/notes.jsonl", [{"a": 1}])
    with pytest.raises(FileNotFoundError):
        jobs.extract_tables(spark, f"{tmp_path}/coll", f"{tmp_path}/out")


def test_rejected_rows_are_written(spark, tmp_path):
    coll, out = str(tmp_path / "coll"), str(tmp_path / "out")
    write_jsonl(f"{coll}/0a.jsonl", [{"id": UUIDS[0]}, {"id": "short"}])
    write_jsonl(f"{coll}/0a.software.jsonl", [
        {"file": u + ".software.json", "mentions": [_mention("R", 0.5)]} for u in UUIDS[:2]])
    jobs.extract_tables(spark, coll, out, strict=False)
    assert spark.read.parquet(f"{out}/papers.parquet").count() == 1
    assert [r.reason for r in spark.read.parquet(f"{out}/rejected.papers").collect()] == [
        "id length"]
    assert spark.read.parquet(f"{out}/rejected.mentions.pdf").count() == 1


def test_subsample_again_and_ineligible_papers(spark, tmp_path):
    folder, out = str(tmp_path / "tables"), str(tmp_path / "samples")
    papers = spark.range(1000).selectExpr("id AS paper_id", "id % 2 = 0 AS has_mentions")
    papers.write.parquet(f"{folder}/papers.parquet")
    for name in ("mentions", "purpose_assessments"):
        papers.select("paper_id").write.parquet(f"{folder}/{name}.pdf.parquet")
    jobs.subsample(spark, folder, out, 1, (0.1, 0.2))
    sizes = {r.sample: r.n for r in jobs.subsample(spark, folder, out, 1, (0.1,)).collect()}
    assert set(sizes) == {0}
    kept = spark.read.parquet(f"{out}/mentions.pdf")
    assert kept.count() == sizes[0] and kept.where("paper_id % 2 = 1").count() == 0


def test_last_record_is_by_path_then_place(spark, tmp_path):
    src = str(tmp_path / "in")
    write_jsonl(f"{src}/01.jsonl", [{"file": UUIDS[0], "n": 1}])
    write_jsonl(f"{src}/02.jsonl", [{"file": UUIDS[0], "n": 2, "pad": "x" * 5000},
                                    {"file": UUIDS[0], "n": 3}])
    jobs.sort_jsonl(spark, src, str(tmp_path / "out"), last_only=True)
    assert [json.loads(r.value)["n"] for r in spark.read.text(str(tmp_path / "out")).collect()] == [3]


def test_json_stats_reads_folders_and_stops_at_junk(spark, tmp_path):
    src = str(tmp_path / "in")
    write_jsonl(f"{src}/a.jsonl", [{"x": 1}])
    write_jsonl(f"{src}/sub/b.jsonl", [{"y": 2}])
    write_jsonl(f"{src}/sub/c.txt", ["junk"])
    report = jobs.json_stats(spark, src, f"{tmp_path}/out", name_pattern=r"\.jsonl$")
    assert [r[0] for r in report.collect()] == [".x", ".y"]
    with pytest.raises(Exception):
        jobs.json_stats(spark, src, f"{tmp_path}/out2").collect()


def test_jobs_leave_the_scratch_folder_as_it_was(spark, tmp_path):
    from citeweave.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    write_jsonl(f"{tmp_path}/d.jsonl", [{"x": 1}])
    mentions = spark.range(500).selectExpr("id % 100 AS paper_id",
                                           "string(id % 7) AS software_normalized")
    before = set(os.listdir(folder))
    jobs.mentions_count(mentions, min_support=2)
    jobs.json_stats(spark, f"{tmp_path}/d.jsonl", f"{tmp_path}/stats")
    assert set(os.listdir(folder)) == before
