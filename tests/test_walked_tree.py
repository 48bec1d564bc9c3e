import os

import pytest

from citeweave.plans import jobs
from citeweave.sources import raw_tree

UUID = "0123abcd-0123-4567-89ab-0123456789a{}"


@pytest.fixture
def tree(tmp_path):
    """Nested, hidden, empty and oddly named folders; files of both kinds and of none."""
    root = tmp_path / "raw tree"
    files = {f"a/{UUID.format(0)}.json": b'{"id": "x"}',
             f"a/b=1/c d/{UUID.format(1)}.software.json":
                 b'{"mentions": [{"software-name": {"normalizedForm": "R"}}]}',
             f"a/b=1/%41+\xe9/{UUID.format(2)}.software.json": b"\xef\xbb\xbf" + b'{"mentions": []}',
             f"_z/{UUID.format(3)}.software.json":
                 b'[{"mentions": []}, {"mentions": [{"software-name": {"normalizedForm": "S"}}]}]',
             "a/notes.txt": b"n", "a/.hidden/x.json": b"{}", "a/_skipped/x.json": b"{}",
             "a/_k=v/x.json": b"{}", "a/_metadata.json": b"{}", "a/empty.json": b"",
             "a/x.json._COPYING_": b"{}", "loose.json": b"{}"}
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text)
    (root / "none").mkdir()
    return str(root)


def _folders(tree):
    return sorted(n for n in os.listdir(tree) if os.path.isdir(f"{tree}/{n}"))


def test_walked_files_are_those_that_spark_lists(spark, tree):
    paths = [f"{tree}/{f}" for f in _folders(tree)]
    want = sorted((r.name, r.length) for r in raw_tree.list_files(spark, paths).collect())
    got = raw_tree.walked_files(spark, tree, _folders(tree)).collect()
    assert sorted((r.rel.rpartition("/")[2], r.length) for r in got) == want and len(want) == 6
    texts = raw_tree.read_raw_text(spark, paths, folder_of=tree).collect()
    walked = raw_tree.read_walked_text(spark, tree, _folders(tree)).collect()
    as_rows = [sorted((r.text, r._file_name, r._folder) for r in x) for x in (texts, walked)]
    assert as_rows[0] == as_rows[1] and len(walked) == 5


def test_jobs_do_not_list_the_tree_in_the_driver(spark, tree, tmp_path, monkeypatch):
    """Spark's own readers send the status of every file to the driver."""
    by_spark = {}
    for walk in (False, True):
        out = str(tmp_path / f"out-{walk}")
        with monkeypatch.context() as m:
            if walk:
                for name in ("read_raw_text", "read_raw_tree", "list_files"):
                    m.setattr(raw_tree, name, None)
            else:
                m.setattr(raw_tree, "can_walk", lambda *_: False)
            jobs.collate_tree(spark, tree, f"{out}/c", strict=False)
            left = jobs.residual_report(spark, tree, f"{out}/r").collect()
        by_spark[walk] = (sorted(map(str, jobs.collation_ledger(spark, f"{out}/c").collect())),
                          sorted(map(str, jobs.rejected_files(spark, f"{out}/c").collect())),
                          sorted(map(str, left)))
    assert by_spark[True] == by_spark[False] and all(by_spark[True])


def test_mention_files_keep_marks_and_arrays(spark, tree, tmp_path, monkeypatch):
    for name in ("read_raw_text", "read_raw_tree", "list_files"):
        monkeypatch.setattr(raw_tree, name, None)
    jobs.mentions_convert(spark, tree, str(tmp_path / "slim"))
    slim = spark.read.parquet(str(tmp_path / "slim"))
    assert sorted(len(r.mentions) for r in slim.collect()) == [0, 0, 1, 1]
