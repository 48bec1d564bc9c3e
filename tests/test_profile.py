"""JSON profile (FIXTURES.md F5)."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# A strict check raises inside a task; PySpark reports it as a PySparkException, or as the raw
# JVM error when several stages fail at once.
SPARK_ERRORS = (PySparkException, Py4JJavaError)

from citeweave.operators import profile


def _profile(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "j string")
    typed = profile.typed_leaves(profile.json_leaves(profile.parse_documents(df, "j")))
    prof, enums = profile.profile_parts(typed)
    return {r.path: r for r in prof.collect()}, enums, typed


def test_paths_kinds_and_empty(spark):
    prof, _, _ = _profile(spark, ['{"m":[{"s":0.5},{"s":1}],"e":[],"z":null}'])
    assert set(prof) == {".m[].s", ".z"}                  # no row for the empty array
    assert prof[".z"].kind == "empty"
    s = prof[".m[].s"]
    assert (s.kind, s.number_type, s.min, s.max) == ("number", "float32", 0.5, 1.0)


def test_conflict(spark):
    prof, _, typed = _profile(spark, ['{"a":1}', '{"a":"x"}', '{"a":null}'])
    assert prof[".a"].kind == "conflict"
    assert [tuple(r) for r in profile.type_conflicts(typed).collect()] == [
        (".a", 2, "number,string")]
    with pytest.raises(SPARK_ERRORS):
        profile.assert_no_conflicts(typed).collect()
    with pytest.raises(SPARK_ERRORS):
        profile.raise_on_conflicts(profile.json_profile(typed)).collect()


def test_enum_limit(spark):
    twenty = [f'{{"s":"v{i}","t":"w{i}"}}' for i in range(20)] + ['{"t":"w20"}']
    prof, enums, _ = _profile(spark, twenty)
    assert prof[".s"].n_values == 20 and prof[".t"].n_values is None
    assert {r.value for r in enums.collect() if r.path == ".s"} == {f"v{i}" for i in range(20)}


def test_integer_types_and_booleans(spark):
    prof, enums, _ = _profile(spark, ['{"n":-5,"b":true,"u":3000000000}', '{"n":300,"b":false}',
                                      '{"b":true,"r":[1e300]}'])
    assert (prof[".n"].number_type, prof[".n"].min, prof[".n"].max) == ("int16", -5.0, 300.0)
    assert (prof[".b"].n_true, prof[".b"].n_false) == (2, 1)
    assert prof[".u"].number_type == "uint32"
    assert prof[".r[]"].number_type == "uint64"           # 1e300 is integral
    assert {(r.value, r.n) for r in enums.collect() if r.path == ".n"} == {("-5", 1), ("300", 1)}


def test_summary_lines(spark):
    prof_map, _, typed = _profile(spark, ['{"b":true,"n":2,"s":"x","z":null}'])
    lines = [tuple(r) for r in profile.profile_summary(profile.json_profile(typed)).collect()]
    assert lines == [(".b", "true:1;false:0"), (".n", "uint8;2;2"), (".s", "enum;1;"),
                     (".z", "empty")]


def test_nested_depth(spark):
    prof, _, _ = _profile(spark, ['{"a":{"b":{"c":[[{"d":1}]]}}}', '[1,[2]]'])
    assert set(prof) == {".a.b.c[][].d", "[]", "[][]"}


def test_brackets_inside_strings_do_not_count(spark):
    prof, _, _ = _profile(spark, ['{"a":"x[{\\"y]]]]"}', '{"b":[{"c":"]]"}]}'])
    assert set(prof) == {".a", ".b[].c"}


def test_summary_lines_with_enum_entries(spark):
    df = spark.createDataFrame([(x,) for x in ['{"n":2,"s":"b","f":0.5}', '{"n":10,"s":"a","f":1.5}',
                                               '{"n":2,"s":"a"}']], "j string")
    typed = profile.typed_leaves(profile.json_leaves(profile.parse_documents(df, "j")))
    prof, enums = profile.profile_parts(typed)
    lines = dict(tuple(r) for r in profile.profile_summary(prof, enums).collect())
    assert lines[".n"] == "uint8;2;10;2:2;10:1;"          # numeric order, not text order
    assert lines[".s"] == "enum;2;a:2;b:1;"
    assert lines[".f"] == "float32;0.500000;1.500000;0.500000:1;1.500000:1;"


def _nested(levels, leaf):
    return "".join('{"a":' if k % 2 else "[" for k in range(levels)) + leaf + "".join(
        "}" if k % 2 else "]" for k in reversed(range(levels)))


def test_any_depth(spark):
    """200 levels, beside shallow documents, empty containers and the bounds of the plans."""
    lines = [_nested(200, "7"), _nested(200, '"x"'), '{"s":1}', "[]", "5"]
    lines += [_nested(k, '{"e":{},"v":[true,null]}') for k in
              (profile.LEVELS - 2, profile.LEVELS - 1, profile.LEVELS, profile.LEVELS + 1,
               profile.LEVELS + profile.FURTHER_LEVELS)]
    want = {}

    def walk(path, node):
        if isinstance(node, dict):
            for k, v in node.items():
                walk(f"{path}.{k}", v)
        elif isinstance(node, list):
            for v in node:
                walk(f"{path}[]", v)
        else:
            want[path] = want.get(path, 0) + 1

    for line in lines:
        walk("", json.loads(line))
    docs = profile.parse_documents(spark.createDataFrame([(x,) for x in lines], "j string"), "j")
    prof, _ = profile.document_parts(docs)
    assert {r.path: r.n_leaves for r in prof.collect()} == want
    assert {r.path: r["count"] for r in profile.json_leaves(docs).groupBy("path").count()
            .collect()} == want
    stats = profile.document_statistics(docs)[0]
    deep = [r for r in profile.statistics_conflicts(stats).collect()]
    assert [(r.n_types, r.types) for r in deep] == [(2, "number,string")]


def test_shallow_documents_have_no_frontier(spark):
    docs = profile.parse_documents(spark.createDataFrame([('{"a":[1,{"b":"x"}]}',)], "j string"),
                                   "j")
    assert profile.deeper_leaves(docs) is None
    stats, _, digested = profile.document_statistics(docs)
    assert stats.where("n_containers > 0").isEmpty() and not digested


def test_histograms_are_exact_or_absent(spark):
    """Value counts around the limit, far beyond what the sketch tracks, and long strings."""
    import random

    rng = random.Random(4)
    rows = []
    for k in range(6000):
        rows.append(json.dumps({
            "twenty": rng.randrange(20), "more": rng.randrange(21), "many": rng.randrange(70),
            "free": f"v{k}", "late": k if k > 5900 else "same",
            "long": ("long text " * 60) + str(k % 3), "marked": "\u0001sha256:" + str(k % 2)}))
    df = spark.createDataFrame([(x,) for x in rows], "j string").repartition(7)
    prof, enums = profile.document_parts(profile.parse_documents(df, "j"))
    sizes = {r.path: r.n_values for r in prof.collect()}
    assert sizes == {".twenty": 20, ".more": None, ".many": None, ".free": None, ".late": None,
                     ".long": 3, ".marked": 2}
    want = {}
    for x in rows:
        for k, v in json.loads(x).items():
            if k in ("twenty", "long", "marked"):
                want[f".{k}", str(v)] = want.get((f".{k}", str(v)), 0) + 1
    assert {(r.path, r.value): r.n for r in enums.collect()} == want
