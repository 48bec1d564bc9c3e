"""Decontamination, mixing, licenses and secrets on small cases and against brute force."""

import hashlib
import random
import re

import pytest

from citeweave.llm import decontaminate, licenses, mixing, secrets

PASSAGE = " ".join(f"w{k}" for k in range(20))


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, bench, **options):
    rows = decontaminate.contamination(docs, bench, **options).collect()
    return {r["id"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in rows}


DOCS = [(1, f"before {PASSAGE} after"), (2, "nothing shared here"), (3, None), (4, ""),
        (5, "W0 W1! w2, w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (6, " ".join(f"w{k}" for k in range(12))),
        (7, "x short notice y"), (8, "x " * 300 + PASSAGE), (8, "x " * 300 + PASSAGE)]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, -1])
def test_contamination_cases(spark, documents, limit):
    bench = items(spark, [(10, PASSAGE), (2, PASSAGE), (7, "short notice"), (8, None), (9, "...")])
    docs = documents(DOCS).withColumn("item_id", decontaminate.F.lit("clash"))
    rows = decontaminate.contamination(docs, bench, broadcast_bytes=limit).collect()
    by_id = {r["id"]: r for r in rows}
    assert len(rows) == len(DOCS)
    assert (by_id[1]["n_hit"], by_id[1]["item_ids"]) == (20, ["10", "2"])
    assert by_id[1]["contaminated"] and by_id[1]["n_words"] == 22
    assert [by_id[k]["n_hit"] for k in (2, 3, 4, 5, 6, 7, 8)] == [0, 0, 0, 13, 0, 2, 20]
    assert by_id[3]["n_words"] == 0 and not by_id[3]["contaminated"]
    assert by_id[7]["item_ids"] == ["7"] and by_id[8]["contaminated"]


def test_contamination_needs_a_share_of_the_words(spark, documents):
    bench = items(spark, [(1, PASSAGE)])
    got = found(documents([(1, "x " * 380 + PASSAGE), (2, "x " * 381 + PASSAGE)]), bench)
    assert got[1][3] and not got[2][3]


def test_contamination_of_empty_tables(spark, documents):
    assert found(documents([]), items(spark, [(1, PASSAGE)])) == {}
    assert found(documents([(1, PASSAGE)]), items(spark, [])) == {1: (20, 0, [], False)}


def test_decontaminated_keeps_columns_and_clean_rows(spark, documents):
    docs = documents(DOCS)
    left = decontaminate.decontaminated(docs, items(spark, [(1, PASSAGE)]))
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 6, 7]


# ------------------------------------------------------------------ mixing

def test_targets_reshare_what_a_capped_source_cannot_take(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 300), ("c", 0)],
                                  "source string, source_size long")
    got = {r["source"]: r for r in mixing.source_targets(sizes).collect()}
    # Order a, b, c, null: weights 5, 2, 1, 5. a stops at 30 and c at 0; null at 900 (5/7 of 1280).
    assert {k: r["weight"] for k, r in got.items()} == {"a": 5, "b": 2, "c": 1, None: 5}
    assert got["a"]["target"] == 30 and got["c"]["target"] == 0 and got[None]["target"] == 900
    assert got["b"]["target"] == pytest.approx(1310 - 930)
    assert got["c"]["rate"] == 0


def test_mix_takes_floor_or_one_more_and_comes_near_the_target(spark, documents):
    docs = documents([(k, "a b c d", "en", f"s{k % 3}") for k in range(3000)])
    plan = mixing.mix_plan(docs).collect()
    again = mixing.mix_plan(docs.repartition(7)).collect()
    assert {(r["doc_id"], r["mix_copies"]) for r in plan} == {
        (r["doc_id"], r["mix_copies"]) for r in again}
    for source in ("s0", "s1", "s2"):
        rows = [r for r in plan if r["source"] == source]
        rate = rows[0]["mix_target"] / rows[0]["mix_source_size"]
        assert {r["mix_copies"] for r in rows} <= {int(rate), int(rate) + 1}
        assert sum(r["mix_copies"] * 4 for r in rows) == pytest.approx(rows[0]["mix_target"], rel=.1)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r["mix_copies"] for r in plan)


def test_mix_of_nulls_and_empty_tables(spark, documents):
    docs = documents([(None, None, "en", None), (1, "", "en", None), (2, " \t", "en", "s")])
    assert [r["mix_copies"] for r in mixing.mix_plan(docs).collect()] == [0, 0, 0]
    assert mixing.mixed(documents([])).count() == 0


# ------------------------------------------------------------------ licenses

def test_license_windows(spark, documents):
    filler = "lorem ipsum dolor sit amet " * 40
    docs = documents([
        (1, "Released under the MIT License."), (2, filler + "This work is licensed under the GNU "
         "General Public License, version 3. " + filler),
        (3, filler + "permission is hereby granted free of charge to any person obtaining a copy "
         "of that software"), (4, filler), (5, None), (6, "four words are few"),
        (7, "licensed under the apache license version 1 0"),
        (8, filler + "Licensed under the Apache License, Version 2.0. " * 3)])
    got = {(r["id"], r["license"]): r["containment"] for r in licenses.scan(docs).collect()}
    assert got.pop((3, "MIT notice")) == pytest.approx(10 / 12)
    assert got == {(1, "MIT"): 1.0, (2, "GPL-3.0"): 1.0, (8, "Apache-2.0"): 1.0}
    assert licenses.scan(documents([])).count() == 0


def test_windows_are_compared_with_the_templates_they_meet(documents):
    """Random templates of one and of several size classes, planted whole, with words changed and
    cut: the rows are those of brute force over the same windows."""
    rnd = random.Random(6)
    vocabulary = [f"w{k}" for k in range(60)]
    templates = [(f"t{k}", " ".join(rnd.choices(vocabulary, k=rnd.randint(5, 90))))
                 for k in range(40)]
    texts = []
    for k in range(60):
        parts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 40))) for _ in range(3)]
        for at in (1, 2):
            found = rnd.choice(templates)[1].split()
            if rnd.random() < 0.5:
                found[rnd.randrange(len(found))] = "changed"
            parts[at] = " ".join(found[:len(found) - rnd.choice([0, 0, 3])] + [parts[at]])
        texts.append((k, " ".join(parts)))

    def shingles(text):
        w = text.split()
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]

    sets = {name: set(shingles(text)) for name, text in templates}
    sizes = {len(s) for s in sets.values()}
    expected = {}
    for k, text in texts:
        own = shingles(text)
        for name, t in sets.items():
            block = max(n for n in sizes if 6 * n <= 10 * len(t))
            width = 1 if block == 1 else 2 * block
            best = max((len(t & set(own[at:at + width])) / len(t)
                        for at in range(0, len(own), block)), default=0)
            if best >= licenses.CONTAINMENT:
                expected[k, name] = best
    got = {(r["id"], r["license"]): r["containment"]
           for r in licenses.scan(documents(texts), templates).collect()}
    assert got == expected and len(expected) > 60


def test_usual_license_sentences_are_found(documents):
    gnu = "it under the terms of the GNU General Public License as published by the Free Software"
    cases = [
        ("This tool is licensed under the MIT License", "MIT"),
        ("see the Apache License 2.0", "Apache-2.0"),
        ("images are under CC BY-SA 4.0", "CC-BY-SA-4.0"),
        ("available under CC BY 4.0", "CC-BY-4.0"),
        ("under the GNU Lesser General Public License v3", "LGPL-3.0"),
        ("the GNU Affero General Public License, version 3", "AGPL-3.0"),
        ("released under the ISC license", "ISC"),
        (f"{gnu} Foundation; either version 2 of the License, or any later version", "GPL-2.0"),
        (f"{gnu} Foundation, either version 3 of the License, or any later version", "GPL-3.0"),
    ]
    rows = licenses.scan(documents([(k, text) for k, (text, _) in enumerate(cases)])).collect()
    found = {(r["id"], r["license"].split()[0]) for r in rows}
    assert found == {(k, license) for k, (_, license) in enumerate(cases)}


def test_whole_license_texts_are_found_past_their_opening(spark, documents):
    filler = "lorem ipsum dolor sit amet " * 40
    texts = {name: text for name, text in licenses.TEMPLATES if name.endswith(" text")}
    # The last nine tenths of each text, so that no opening words help.
    docs = documents([(k, filler + " ".join(t.split()[len(t.split()) // 10:]) + " " + filler)
                      for k, t in enumerate(texts.values())])
    found = {(r["id"], r["license"]) for r in licenses.scan(docs).collect()}
    assert {(k, name) for k, name in enumerate(texts)} <= found
    assert len(licenses.TEMPLATES) == len({name for name, _ in licenses.TEMPLATES})


def test_every_alignment_of_a_template_is_retrieved(spark, documents):
    text = licenses.TEMPLATES[3][1]
    docs = documents([(k, "w " * k + text + " v" * (40 - k)) for k in range(41)])
    assert licenses.scan(docs).count() == 41


def test_bands_follow_from_the_miss_rate():
    n = licenses.bands_needed(8, 12)
    jaccard = 7 / (24 + 8 - 7)
    assert (1 - jaccard) ** n <= licenses.MISS < (1 - jaccard) ** (n - 1)


# ------------------------------------------------------------------ secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.A)


def brute_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


SECRET_TEXTS = [
    "é😀 token = \"ede43f42c939b6405768150e0411590525cf889e\" x", "AKIAABCDEFGHIJKLMN and AKIAAB",
    "password: token: abcdefghijklmnop", "PASSWD='short' apikey=0123456789abcdef", None, "",
    "secret=" * 3 + "abcdefghijkl", "token=short,secret : abcdefabcdefabcdef", "plain words only",
    "0123456789abcdef" * 9, "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop",
]


def test_base_spans_equal_brute_force(spark, documents):
    got = {r["id"]: [tuple(s) for s in r["base"]] for r in secrets.find_secrets(
        documents(list(enumerate(SECRET_TEXTS)))).collect()}
    assert got == {k: brute_base(t or "") for k, t in enumerate(SECRET_TEXTS)}


def test_weak_parts_need_complements_in_scope(spark, documents):
    weak, far = "aB3dE6gH9jK2mN5pQ8sT1v", "z " * 300
    docs = documents([
        (1, f"user = admin77 {weak}"), (2, weak), (3, "user = admin77"),
        (4, f"user = admin77 {far}{weak}"),
        (5, f"https://db.internal/x user = admin77 {weak}"), (6, f"https://db.internal/x {weak}"),
        (7, "https://db.internal/x user = admin77"), (8, f"{weak} " * 50 + "user = admin77")])
    rows = {r["id"]: [(secrets.KINDS[s["kind"]]) for s in r["linked"]]
            for r in secrets.find_secrets(docs).collect()}
    assert sorted(rows[1]) == ["identifier", "tokenlike"]
    assert rows[2] == rows[3] == rows[4] == rows[7] == []
    assert sorted(rows[5]) == ["endpoint", "identifier", "tokenlike"]
    assert rows[6] == ["tokenlike"]
    # Only tokens within the scope of the identifier.
    assert 1 < len(rows[8]) < 15


def test_linked_spans_leave_base_spans_alone(spark, documents):
    text = "user = admin77 token = aB3dE6gH9jK2mN5pQ8sT1v"
    row = secrets.find_secrets(documents([(1, text), (1, text)])).collect()
    assert len(row) == 2 and [secrets.KINDS[s["kind"]] for s in row[0]["base"]] == ["assign"]
    assert [secrets.KINDS[s["kind"]] for s in row[0]["linked"]] == ["identifier"]
    assert hashlib.sha256(b"").hexdigest() and secrets.find_secrets(documents([])).count() == 0


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_mixing", "op6_licenses",
                                  "op10_secrets"])
def test_native_operators_run_no_python(spark, corpus, name):
    from citeweave.llm.queries import QUERIES

    plan = QUERIES[name](spark, corpus)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow|CartesianProduct|NestedLoop", plan)
