"""The pipeline against a brute-force version, stage by stage."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import decontaminate, language, queries, simhash

TOKENIZER = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def brute_near(rows):
    fps = np.array([simhash.fingerprint(r["text"]) for r in rows], "<u8")
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[:i]) <= 4):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [r for k, r in enumerate(rows) if find(k) == k]


def brute_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_clean(rows, items):
    windows = set()
    for text in items:
        w = brute_words(text)
        n = min(13, len(w))
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    sizes, out = {len(w) for w in windows}, []
    for r in rows:
        w = brute_words(r["text"])
        hit = {p for n in sizes for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows
               for p in range(k, k + n)}
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def brute_mix(rows):
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    total = {}
    for r in rows:
        total[r["source"]] = total.get(r["source"], 0) + size(r)
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    capped = set()
    while True:
        level = ((sum(total.values()) - sum(3 * total[s] for s in capped))
                 / sum(weight[s] for s in names if s not in capped))
        more = {s for s in names if 3 * total[s] < level * weight[s]}
        if more == capped:
            break
        capped = more
    out = []
    for r in rows:
        s = r["source"]
        target = float(3 * total[s]) if s in capped else level * weight[s]
        rate = target / total[s] if total[s] else 0.0
        draw = int(hashlib.md5(f"20:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2.0 ** 52
        out += [r] * (int(rate) + (draw < rate - int(rate)))
    return out


def test_pipeline_equals_brute_force(spark, corpus):
    import corpus_pipeline
    from tokenizers import Tokenizer

    table = spark.read.parquet(f"{corpus}/documents.parquet")
    rejected = {r["id"] for r in language.predict(table, language.fit(table)).where("rejected")
                .collect()}
    rows = sorted((r for r in table.collect() if r["doc_id"] not in rejected),
                  key=lambda r: r["doc_id"])
    items = [r["text"] for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    rows = brute_mix(brute_clean(brute_near(rows), items))
    whole, start, expected = Tokenizer.from_file(TOKENIZER), 0, []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, corpus)
    assert sorted(map(tuple, got.collect())) == expected


def test_stages_keep_the_columns_and_take_odd_rows(spark, tmp_path, documents):
    import corpus_pipeline

    spark.createDataFrame([(1, None), (None, "a b")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    docs = documents([(None, "some words here", None, None), (1, None, "en", "s"), (2, "", "en", "s"),
                      (3, "the end of the thing " * 5, "en", "s"), (3, "the end of the thing " * 5,
                                                                     "en", "s")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 5


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert decontaminate.SPAN_WORDS == 13


def test_results_do_not_depend_on_the_partitioning(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    many = docs.repartition(13, F.col("n_chars"))
    for found in (simhash.near_duplicates, language_of):
        assert sorted(map(tuple, found(docs).collect())) == sorted(
            map(tuple, found(many).collect()))


def language_of(docs):
    return language.predict(docs, language.fit(docs)).select(
        "id", "lang_pred", F.round("score", 5))
