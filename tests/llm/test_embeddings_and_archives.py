"""WARC archives, centroid clustering and whitening against plain versions of their contracts."""

import base64
import hashlib
import io
import math

import numpy as np
import pytest
import zstandard

from citeweave.llm import centroids, warc, whitening
from citeweave.session import scratch_path

PAGES = "page_id long, url string, html string"


# ---------------------------------------------------------------- WARC

def expected_pages(rows, min_bytes=0):
    """One tuple per row, by the contract."""
    out, groups = [], {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    for page, _, html in rows:
        data = (html or "").encode()
        known = [p for p in groups[html or ""] if p is not None]
        first = max(known) if known and len(data) >= min_bytes else page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if page == first else "revisit", None if page == first else first))
    return sorted(out, key=repr)


def roundtrip(spark, rows, schema=PAGES, **options):
    out = warc.archive_folder(spark)
    archives = warc.write_archives(spark.createDataFrame(rows, schema), out, **options)
    return archives, warc.read_archives(archives, out, with_payload=True).collect(), out


def as_tuples(found):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                    r["refers_to"]) for r in found), key=repr)


ODD_PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, "u", "<p>same</p>"),
    (3, "http://a/\r\nWARC-Type: x", "café \U0001F600\r\n\r\nWARC/1.1\r\n"), (4, None, None),
    (5, "", ""), (None, "http://n", "<p>same</p>"), (None, "http://n", "alone"),
    (6, "http://b", "x" * 9_000_000), (7, "http://b", "x" * 9_000_000), (8, "d", "twice"),
    (8, "d", "twice"), (-3, "neg", "neg"), (10, "http://c", "\x00\x01"),
]


def test_archives_give_back_every_page(spark):
    archives, found, _ = roundtrip(spark, ODD_PAGES)
    assert as_tuples(found) == expected_pages(ODD_PAGES)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in found if r["record_type"] == "response"}
    assert payloads[3].decode() == ODD_PAGES[3][2] and payloads[7] == b"x" * 9_000_000
    assert sum(r["n_records"] for r in archives.collect()) == len(ODD_PAGES)
    # A url cannot break out of its header.
    assert {r["target"] for r in found if r["page_id"] == 3} == {"http://a/%0D%0AWARC-Type:%20x"}


def test_short_payloads_are_not_deduplicated(spark):
    _, found, _ = roundtrip(spark, ODD_PAGES, min_bytes=6)
    assert as_tuples(found) == expected_pages(ODD_PAGES, 6)


def test_pages_as_given(spark, corpus):
    rows = [tuple(r) for r in spark.read.parquet(f"{corpus}/pages.parquet")
            .select("page_id", "url", "html").collect()]
    _, found, _ = roundtrip(spark, rows)
    assert as_tuples(found) == expected_pages(rows)


def test_archives_of_empty_tables_and_clashing_columns(spark):
    archives, found, _ = roundtrip(spark, [])
    assert archives.count() == 0 and found == []
    clash = [(1, "u", "a", "k", 5, 7), (2, "u", "a", "k", 5, 7)]
    _, found, _ = roundtrip(spark, clash, PAGES + ", key string, first long, copies long")
    assert as_tuples(found) == expected_pages([r[:3] for r in clash])


def test_one_record_is_read_alone_with_the_leading_dictionary(spark):
    rows = [(k, f"http://h/{k}", f"<html><body>page number {k} of a common layout</body></html>")
            for k in range(400)]
    archives, _, _ = roundtrip(spark, rows)
    path = archives.first()["path"]
    data = open(path, "rb").read()
    magic, length = np.frombuffer(data[:8], "<u4")
    assert magic == 0x184D2A5D and length > 0
    dictionary = zstandard.ZstdCompressionDict(data[8:8 + int(length)])
    at = 8 + int(length)
    frames = []
    while at < len(data):
        end = warc.frame_end(data, at)
        frames.append(data[at:end])
        at = end
    one = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(frames[-1])
    assert one.startswith(b"WARC/1.1\r\nWARC-Type: response")
    # The dictionary pays: without one the same record is larger.
    assert len(frames[-1]) < len(zstandard.compress(one)) / 2


def test_damage_is_noticed(spark):
    dictionary = warc.build_dictionary([b"some sample text %d" % k for k in range(50)])
    codec = warc._compressor(dictionary)
    good = warc.dictionary_frame(dictionary) + b"".join(
        codec.compress(warc.page_record(k, "u", b"payload %d" % k)) for k in range(3))
    assert [warc.parse_record(r)["page_id"] for r in warc.read_records(io.BytesIO(good))] == [
        0, 1, 2]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(good[:-3])))
    wrong = warc.page_record(1, "u", b"payload").replace(b"payload\r\n", b"pAyload\r\n")
    with pytest.raises(ValueError):
        warc.parse_record(wrong)


def test_frame_ends_agree_with_the_decompressor():
    rng = np.random.default_rng(3)
    frames = [zstandard.ZstdCompressor(level=level, write_checksum=checksum).compress(body)
              for level in (1, 3) for checksum in (False, True)
              for body in (b"", b"a", b"ab" * 100_000, rng.bytes(300_000), b"\0" * 500_000)]
    data, at = b"".join(frames), 0
    for frame in frames:
        assert warc.frame_end(data, at) == at + len(frame)
        for cut in {1, 5, len(frame) // 2, len(frame) - 1} - {len(frame)}:
            assert warc.frame_end(data[:at + cut], at) is None
        at += len(frame)


# ---------------------------------------------------------------- centroids

VECTORS = "vec_id long, embedding array<float>"


def brute_clusters(rows, k, rounds, seed, dim):
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dim
            and all(c is not None and math.isfinite(c) for c in v)]
    ranked = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(
        f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [x for _, x in ranked[:k]]

    def nearest(x):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
        return min(range(len(far)), key=lambda j: (far[j], j)), min(far)

    for _ in range(rounds):
        mine = [nearest(x)[0] for _, x in kept]
        for j in range(len(centres)):
            own = [x for (_, x), m in zip(kept, mine) if m == j]
            if own:
                centres[j] = [sum(col) // len(own) for col in zip(*own)]
    return sorted(((i, *nearest(x)) for i, x in kept), key=repr), centres


def same_clusters(spark, rows, **options):
    full = {"k": 8, "rounds": 10, "seed": 3, "dim": 64} | options
    got, centres = centroids.cluster(spark.createDataFrame(rows, VECTORS), **options)
    want, want_centres = brute_clusters(rows, *(full[n] for n in ("k", "rounds", "seed", "dim")))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert centres == want_centres


def test_clusters_of_the_given_table(spark, corpus):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{corpus}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    same_clusters(spark, rows)


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_clusters_with_ties_repeats_and_unusable_rows(spark, bits):
    rng = np.random.default_rng(bits)
    rows = [(k, [float(np.float32(x)) for x in rng.integers(-2, 3, 3) / 4]) for k in range(120)]
    rows += [(k, [0.5, 0.5, 0.5]) for k in range(200, 280)] + rows[:10]
    rows += [(300, None), (301, [1.0]), (302, [1.0, None, 2.0]), (303, [1.0, float("nan"), 0.0]),
             (304, [float("inf"), 0.0, 0.0]), (None, [0.25, 0.0, 0.0]), (305, [])]
    rows += [(306, [3000.0, -900.0, 0.0])]  # far outside the marks
    same_clusters(spark, rows, dim=3, k=5, rounds=6, cell_bits=bits)


def test_few_or_no_vectors(spark):
    same_clusters(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])], dim=2)
    got, centres = centroids.cluster(spark.createDataFrame([(1, None)], VECTORS))
    assert got.columns == ["vec_id", "cluster", "distance"] and got.count() == 0 and not centres


def test_cluster_query_ignores_clashing_columns_and_leaves_no_files(spark):
    import os

    rows = [(k, [k / 7, 1.0], 1, "f") for k in range(30)]
    frame = spark.createDataFrame(rows, VECTORS + ", cluster int, file string")
    before = set(os.listdir(scratch_path(spark, "")))
    got, _ = centroids.cluster(frame, dim=2, k=3)
    assert got.count() == 30
    new = set(os.listdir(scratch_path(spark, ""))) - before
    assert len(new) == 1  # the result


# ---------------------------------------------------------------- whitening

def check_whitening(spark, rows, n_components=8):
    frame = spark.createDataFrame(rows, VECTORS)
    got = whitening.whiten(frame, n_components).toPandas()
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([[float(np.float32(c)) for c in v] for _, v in kept])) + 100_000
    n = len(x)
    centred = x - x.mean(0)
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    rank = int((values > 1e-9 * values[0]).sum())
    assert len(got) == n * min(rank, n_components)
    sums = [int(s) for s in x.sum(0)]
    deviation = {i: sum((n * int(c) - s) ** 2 for c, s in zip(row, sums))
                 for (i, _), row in zip(kept, x)}
    assert all(int(d) == deviation[i] for i, d in zip(got["vec_id"], got["deviation"]))
    assert (got["n"] == n).all() and got["identity_error"].nunique() == 1
    assert got["identity_error"].iloc[0] < 1e-9
    place = {i: k for k, (i, _) in enumerate(kept)}
    for c, part in got.groupby("component"):
        np.testing.assert_allclose(part["explained"], values[c - 1] / values.sum(), rtol=1e-9)
        w = np.empty(n)
        w[[place[i] for i in part["vec_id"]]] = part["whitened"]
        # The component itself: the covariance maps it to its eigenvalue times itself.
        component = centred.T @ w / n / np.sqrt(values[c - 1])
        np.testing.assert_allclose(cov @ component, values[c - 1] * component,
                                   atol=1e-9 * values[0])
        np.testing.assert_allclose(centred @ component / np.sqrt(values[c - 1]), w, atol=1e-9)


def test_whitening_of_the_given_table(spark, corpus):
    check_whitening(spark, [(r[0], r[1]) for r in spark.read.parquet(f"{corpus}/embeddings.parquet")
                            .select("vec_id", "embedding").collect()])


def test_whitening_of_low_rank_and_unusable_rows(spark):
    rng = np.random.default_rng(5)
    flat = rng.integers(-8, 8, (40, 2)) @ rng.integers(-3, 4, (2, 6)) / 4.0
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(flat)]
    rows += [(100, None), (101, [1.0, None] + [0.0] * 4), (102, [float("nan")] * 6), (103, [])]
    rows += [(104, [float("-inf")] + [0.0] * 5)]
    check_whitening(spark, rows)


def test_whitening_without_variance_or_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert found.count() == 0 and "identity_error" in found.columns


def test_whitening_of_large_entries_repeated_rows_and_null_ids(spark):
    rows = [(1, [1e15, 0.0, 3.0]), (1, [1e15, 0.0, 3.0]), (None, [-1e15, 2.0, 0.0]),
            (2, [0.0, 5.0, 1e30]), (3, [1.0, 2.0])]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS), 2).collect()
    assert len(found) == 8 and sum(r["vec_id"] is None for r in found) == 2
    assert all(math.isfinite(r["whitened"]) for r in found)


def test_factorization_keeps_small_eigenvalues():
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    for values in (10.0 ** -np.arange(12), np.ones(12), np.r_[np.ones(6), np.zeros(6)]):
        v = (q * values) @ q.T
        found, vectors = whitening.one_sided_jacobi(whitening.pivoted_cholesky((v + v.T) / 2))
        np.testing.assert_allclose(found, values[values > 0][:len(found)], rtol=1e-4)
        np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
