"""Exact dedup, language, SimHash, line dedup, shards and personal data: small cases, brute force,
round trips and held-out accuracy."""

import hashlib
import io
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import exact_dedup, language, line_dedup, pii, simhash, token_shards
from citeweave.llm.common import collapse_space

# ------------------------------------------------------------------ exact dedup


def groups(docs, **options):
    return exact_dedup.exact_groups(docs, "doc_id", collapse_space(F.col("text")), **options)


def test_exact_groups_equal_brute_force(documents):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab \n") for _ in range(n)) for n in (1, 5, 70, 300, 5000)]
    texts = [None, "", " ", "a  b", "a\tb"]
    for t in base:
        texts += [t, t, t + "x", t[:-1] + "y", "y" + t[1:], t[:len(t) // 2] + "z" + t[len(t) // 2:]]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    norm = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, t in rows}
    members = defaultdict(list)
    for k, t in norm.items():
        members[t].append(k)
    expected = {k: (min(members[t]), len(members[t]), k == min(members[t]),
                    hashlib.sha256(t.encode()).hexdigest()) for k, t in norm.items()}
    # Small blocks: many rounds, and groups that split late.
    got = {r["id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
           for r in groups(documents(rows), first_block=4, growth=2).collect()}
    assert got == expected


def test_exact_groups_of_repeated_and_null_ids(documents):
    rows = groups(documents([(1, "t"), (1, "t"), (None, "t"), (None, "u"), (None, "u"), (2, "v")]))
    got = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows.collect()),
                 key=str)
    assert sum(kept for *_, kept in got) == 3
    assert [g[:3] for g in got if g[0] == 1] == [(1, 1, 3)] * 2
    assert (None, 1, 3, False) in got and [g[2] for g in got if g[1] is None] == [2, 2]
    assert groups(documents([])).count() == 0


def test_drop_exact_duplicates_keeps_columns(documents):
    docs = documents([(1, "t"), (2, "t"), (3, None)])
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 3]


# ------------------------------------------------------------------ language


def test_language_on_held_out_rows(spark, corpus):
    docs = spark.read.parquet(corpus.replace("sf0.001", "sf0.01") + "/documents.parquet")
    model = language.fit(docs)
    rows = (language.predict(docs, model).join(
        docs.select(F.col("doc_id").alias("id"), "lang", "text"), "id")
        .withColumn("held", language.held_out(F.col("id"))).collect())
    held = [r for r in rows if r["held"] and r["lang"] and len(r["text"] or "") > 100]
    assert len(held) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert np.mean([r["rejected"] for r in rows]) < 0.02
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(documents):
    docs = documents([(k, t, lang, "s") for k, (t, lang) in enumerate(
        [("the end of the thing " * 9, "en"), ("der hund und die katze " * 9, "de")] * 40)])
    model = language.fit(docs)
    odd = documents([(1, None), (2, ""), (3, "123 !?"), (4, "the thing"), (4, "the thing"),
                     (None, "und die katze"), (5, "the end of " * 100_000)])
    got = [(r["id"], r["lang_pred"], r["rejected"]) for r in language.predict(odd, model).collect()]
    assert [g[1] for g in got] == ["und"] * 3 + ["en", "en", "de", "en"]
    assert [g[2] for g in got[:3]] == [True] * 3
    left = language.identified(docs.union(odd))
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.where("length(text) < 8").collect()} == set()
    assert language.predict(documents([]), model).count() == 0


def test_language_without_labels(documents):
    docs = documents([(1, "text", None, "s")])
    assert language.fit(docs) is None
    assert [r["lang_pred"] for r in language.predict(docs, None).collect()] == ["und"]


def test_language_slices_do_not_change_scores(monkeypatch):
    texts = ["the end of the thing " * 9, "der hund und die katze " * 9] * 30
    model = language.train(texts, ["en", "de"] * 30)
    data = [np.frombuffer(t.encode(), np.uint8) for t in ["the katze der end " * 50, "of", texts[1]]]
    whole = model.probabilities(data)
    monkeypatch.setattr(language, "SLICE_BYTES", 37)
    assert np.allclose(model.probabilities(data), whole, atol=1e-6)
    assert np.allclose(model.probabilities(data[:1]), whole[:1], atol=1e-6)


# ------------------------------------------------------------------ SimHash


def brute_fingerprint(text):
    import xxhash

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "É é \x0b É x y z z z z z z z",
                                  "w " * 5000, "the quick brown fox jumps over the lazy dog"])
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def brute_components(values, bits=4):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(values))]


@pytest.mark.parametrize("block", [4, 4096])
def test_links_connect_what_brute_force_connects(spark, block):
    rng = random.Random(5)
    values = [0]
    for _ in range(12):
        centre = rng.getrandbits(64)
        values += [centre] + [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))
                              for _ in range(12)]
    values = list(dict.fromkeys(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(
        simhash.near_links(fps, block=block)).collect()}
    names = [roots.get(v, v) for v in signed]
    expected = brute_components(values)
    pairs = {(a, b) for a, b in zip(names, expected)}
    assert len(pairs) == len(set(names)) == len(set(expected))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)],
                                  "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_near_duplicates_and_the_one_that_stays(documents):
    text = " ".join(f"w{k}" for k in range(400))
    docs = documents([(7, text), (3, text + " more"), (9, text), (1, "other words " * 9), (4, None),
                      (5, ""), (None, text), (2, "x")])
    got = {r["id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got[7] == got[9] == got[3] == got[None] == 3 and got[4] == got[5] == 4 and got[1] == 1
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {3, 1, 4, None, 2}
    assert simhash.near_duplicates(documents([])).count() == 0


# ------------------------------------------------------------------ line dedup


def test_patience_alignment():
    assert line_dedup.aligned_blocks([0, 1, 2, 5, 6], [4, 5, 6, 0, 1]) == [(0, 2)]
    assert line_dedup.aligned_blocks([0, 1, 3], [0, 1, 3]) == [(0, 1), (2, 2)]
    assert line_dedup.aligned_blocks([], []) == []


def test_repeated_blocks_go_from_later_documents(documents):
    block = "\n".join(" ".join(f"b{k}{j}" for j in range(6)) for k in range(5))
    short = "only a short line"
    long = " ".join(f"l{k}" for k in range(60))
    docs = documents([
        (1, f"start one\n{block}\nend one"), (2, f"{short}\nstart two\n{block}\n\nend two"),
        (3, f"{block}\n{block}"), (4, f"{short}\nfour"), (5, None), (6, ""), (7, long), (8, long),
        (8, long), (None, f"null id\n{long}"), (9, f"x\n{long}  \ny")])
    got = defaultdict(list)
    for r in line_dedup.without_repeated_lines(docs).collect():
        got[r["doc_id"]].append(r["text"])
    assert got[1] == [f"start one\n{block}\nend one"]
    assert got[2] == [f"{short}\nstart two\n\nend two"]
    # The second occurrence in one document is its own: only the first has a partner.
    assert got[3] == [block]
    assert got[4] == [f"{short}\nfour"] and got[5] == [None] and got[6] == [""]
    assert got[7] == [long] and got[8] == ["", ""] and got[None] == ["null id"]
    assert got[9] == ["x\ny"]
    assert line_dedup.repeated_lines(documents([])).count() == 0


def passage(name, n):
    return " ".join(f"{name}{k}" for k in range(n))


def test_shared_run_goes_though_its_first_line_stands_elsewhere_too(documents):
    hot, rest = passage("h", 9), passage("r", 12)
    docs = documents([(1, f"{hot}\nown one\n{hot}\n{rest}"), (2, f"own two\n{hot}\n{rest}"),
                      (3, f"{hot}\nown three\n{hot}\nand\n{hot}\n{rest}\nend")])
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got[1] == f"{hot}\nown one\n{hot}\n{rest}" and got[2] == "own two"
    assert rest not in got[3] and got[3].endswith("and\nend")


def test_passages_in_another_order_go_too(documents):
    a, b = (f"{passage(n + 'x', 15)}\n{passage(n + 'y', 15)}" for n in "ab")
    short1, short2, long = passage("s", 4), passage("t", 4), passage("l", 60)
    docs = documents([(1, f"{a}\nown one\n{b}"), (2, f"{b}\nown two\n{a}"),
                      (3, f"{long}\n{short1}\n{short2}"), (4, f"{short1}\n{short2}\nown\n{long}")])
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got[1] == f"{a}\nown one\n{b}" and got[2] == "own two"
    assert got[3] == f"{long}\n{short1}\n{short2}" and got[4] == f"{short1}\n{short2}\nown"


def test_shortest_spans_cover_every_block():
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.randrange(1, 30) for _ in range(rng.randrange(12))]
        spans = line_dedup.shortest_spans(words, 20)
        for first in range(len(words)):
            for last in range(first, len(words)):
                inside = {k for a, b in spans if first <= a and b <= last
                          for k in range(a, b + 1)}
                enough = sum(words[first:last + 1]) >= 20
                assert inside == (set(range(first, last + 1)) if enough else set())


def test_line_dedup_of_a_large_group_pairs_with_the_first_only(documents):
    block = " ".join(f"w{k}" for k in range(30))
    rows = line_dedup.repeated_lines(documents([(k, f"own {k}\n{block}") for k in range(200)]))
    assert {r["id"] for r in rows.collect()} == set(range(1, 200))


# ------------------------------------------------------------------ token shards

TOKENIZER = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
ODD_TEXTS = ["", " ", "a  b", "a\n\n b\t\tc ", "it's we'll 'tis", "<|endoftext|> x<|endoftext|>",
             "é😀 über\xa0x　y", "tab\tx \x00 nul \x1c\x85", "12 3.4, end.\nNext !!! ... line",
             "x" * 5000, "trailing \n", "\n", "word. word, word! word"]


def test_pieces_encode_like_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    whole, encoder = Tokenizer.from_file(TOKENIZER), token_shards.PieceEncoder(TOKENIZER)
    rng = random.Random(2)
    alphabet = ["a", "Zé", " ", " ", "\n", "\t", ".", "!", "'s", "7", "\xa0", "\x00", "\x1c", "ß"]
    texts = ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(300)]
    for batch in [[t] for t in texts] + [texts]:
        ids, lengths = encoder.encode(pa.array(batch))
        expected = [whole.encode(t, add_special_tokens=False).ids for t in batch]
        assert lengths.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]


def test_texts_over_a_slice_encode_like_whole_texts(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_shards, "SLICE_BYTES", 7)
    whole, encoder = Tokenizer.from_file(TOKENIZER), token_shards.PieceEncoder(TOKENIZER)
    rng = random.Random(5)
    alphabet = ["a", "Zé", " ", " ", "\n", "\t", ".", "!", "'s", "7", "\xa0", "\x00", "ß"]
    for text in ODD_TEXTS + ["".join(rng.choices(alphabet, k=60)) for _ in range(200)]:
        assert "".join(token_shards._cut(text)) == text
        ids, lengths = token_shards._encode_slice(encoder, pa.array([text]))
        expected = whole.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected and lengths.tolist() == [len(expected)]


def test_shard_reads_only_frames_of_a_document():
    sink = io.BytesIO()
    writer = token_shards.ShardWriter(sink, frame_ids=10)
    rows = [np.arange(n, dtype="<u4") + 7 * n for n in (3, 0, 25, 10, 1)]
    writer.add([5, None, 7, 8, 9], np.concatenate(rows), np.array([len(r) for r in rows]))
    writer.close()
    data = sink.getvalue()
    reader = token_shards.ShardReader(io.BytesIO(data), len(data))
    assert reader.doc_ids == [5, None, 7, 8, 9] and reader.n_data == 4
    assert all((reader.ids(k) == rows[k]).all() for k in range(5))
    # A broken byte in frame 0 is found there and nowhere else.
    broken = bytearray(data)
    broken[9] ^= 255
    reader = token_shards.ShardReader(io.BytesIO(bytes(broken)), len(data))
    assert (reader.ids(4) == rows[4]).all()
    with pytest.raises(Exception):
        reader.ids(0)


def test_shards_round_trip(spark, documents, tmp_path):
    from tokenizers import Tokenizer

    rows = [(k * 3, t) for k, t in enumerate(ODD_TEXTS)] + [(4, None), (6, "a  b"), (None, "n")]
    out = f"file://{tmp_path}/shards"
    shards = token_shards.write_token_shards(documents(rows), TOKENIZER, out, frame_ids=16)
    got = token_shards.read_token_shards(shards, out, with_ids=True).collect()
    whole, start = Tokenizer.from_file(TOKENIZER), 0
    by_text = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [i for i, _ in by_text]
    expected = defaultdict(list)
    for i, t in rows:
        expected[i].append(whole.encode(t or "", add_special_tokens=False).ids + [2])
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["ids"] in expected[r["doc_id"]] and r["start"] == start
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    assert shards.agg(F.sum("n_ids")).first()[0] == start
    empty = token_shards.write_token_shards(documents([]), TOKENIZER, f"{out}-empty")
    assert token_shards.read_token_shards(empty, f"{out}-empty").count() == 0


# ------------------------------------------------------------------ personal data


def brute_pii(text):
    def luhn(digits):
        total = 0
        for k, c in enumerate(reversed(digits)):
            n = int(c) * (1 + k % 2)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_detection_equals_brute_force():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice("a1+@.- ()9A%") for _ in range(60))
        assert pii.detect(text) == brute_pii(text), text
    for n in (12, 16, 19):
        for _ in range(200):
            text = "".join(rng.choice("0123456789") for _ in range(n))
            assert pii.detect(text) == brute_pii(text), text


@pytest.mark.parametrize("text, kind, source", [
    ("mail joe at example dot com now", 0, "joe at example dot com"),
    ("mail joe [at] example (dot) com now", 0, "joe [at] example (dot) com"),
    ("jоe@exаmple.com", 0, "jоe@exаmple.com"),
    ("joe​@exam​ple.com", 0, "joe​@exam​ple.com"),
    ("one nine two dot one six eight dot one dot one x", 1,
     "one nine two dot one six eight dot one dot one"),
    ("x four one one one 1 1 1 1 1 1 1 1 1 1 1 one", 2, "four one one one 1 1 1 1 1 1 1 1 1 1 1 one"),
    ("call plus four one five five five two one two zero zero nine ok", 3,
     "plus four one five five five two one two zero zero nine"),
    ("＋１ (243) 555－5526", 3, "＋１ (243) 555－5526"),
])
def test_disguises_map_back_to_their_source(text, kind, source):
    base, added = pii.personal_data(text)
    assert base == [] and [(k, text[a:b]) for a, k, b in added] == [(kind, source)]


@pytest.mark.parametrize("text, partial, whole", [
    ("jоe@example.com", "e@example.com", "jоe@example.com"),
    ("user@mail.exаmple.com", "user@mail.ex", "user@mail.exаmple.com"),
    ("joe@mail.example (dot) com", "joe@mail.example", "joe@mail.example (dot) com"),
])
def test_whole_spans_stand_beside_partial_base_spans(text, partial, whole):
    base, added = pii.personal_data(f"to {text} now")
    assert [f"to {text} now"[a:b] for a, _, b in base] == [partial]
    assert [f"to {text} now"[a:b] for a, _, b in added] == [whole]
    assert pii.masked(f"to {text} now", base + added) == "to <email> now"


@pytest.mark.parametrize("source", [
    "joe at example dot com", "joe at example punkt de", "joe ät mail punkt example punkt de",
    "joe arroba example punto com", "joe arobase example point fr", "joe (at) example point fr"])
def test_bare_disguises_in_four_languages(source):
    text = f"mail {source}, ok"
    assert [text[a:b] for a, _, b in pii.personal_data(text)[1]] == [source]
    for clean in ("arrive at this point in time", "le point de vue", "en punto y aparte"):
        assert pii.personal_data(clean) == ([], [])


def test_added_spans_inside_base_spans_are_dropped():
    text = "joe@example.com and ann (at) mail.example and 1.2.3.4"
    assert [text[a:b] for a, _, b in pii.personal_data(text)[1]] == ["ann (at) mail.example"]


@pytest.mark.parametrize("text", ["look at example.com now", "one two three", "he is at home dot",
                                  "uno dos tres cuatro", "plain", "", None])
def test_clean_texts_stay_clean(text):
    assert pii.personal_data(text) == ([], [])


def test_find_personal_data(documents):
    text = "a@b.c 1.2.3.4 x (at) y.z"
    rows = pii.find_personal_data(documents([(1, text), (1, text), (2, None), (3, "")])).collect()
    assert len(rows) == 4 and [tuple(s) for s in rows[0]["base"]] == pii.detect(text)
    assert [tuple(s) for s in rows[0]["added"]] == [(14, 0, len(text))]
    assert pii.masked(text, pii.personal_data(text)[0]) == "<email> <ip> x (at) y.z"
    assert pii.find_personal_data(documents([])).count() == 0
