"""Popularity, ranking and co-occurrence (FIXTURES.md F7) against brute force."""

import itertools
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from citeweave.operators import counts


def _brute_pairs(rows, stop, min_item, min_pair):
    owners = defaultdict(set)
    for o, i in rows:
        if i not in stop:
            owners[o].add(i)
    support = Counter(i for items in owners.values() for i in items)
    keep = {i for i, n in support.items() if n >= min_item}
    pairs = Counter()
    for items in owners.values():
        for a, b in itertools.combinations(sorted(items & keep), 2):
            pairs[(a, b)] += 1
    return {k: v for k, v in pairs.items() if v >= min_pair}, {
        i: n for i, n in support.items() if n >= min_item}


def test_edge_rows(spark):
    rows = [(1, "a"), (1, "b"), (1, "a"), (1, "b"),   # same pair twice in one owner: once
            (2, "a"), (2, "b"), (2, "script"), (2, "Script"),
            (3, "b"), (3, "a")]
    df = spark.createDataFrame(rows, "paper_id long, software_normalized string")
    sup = {r.software_normalized: r.n for r in counts.item_support(df, min_support=1).collect()}
    assert sup == {"a": 3, "b": 3, "Script": 1}          # 'script' stop-listed, 'Script' kept
    pairs = [tuple(r) for r in counts.co_occurrence_counts(
        df, min_item_support=1, min_pair_support=1).collect()]
    assert sorted(pairs) == [("Script", "a", 1), ("Script", "b", 1), ("a", "b", 3)]


def test_support_threshold(spark):
    rows = [(o, "x") for o in range(99)] + [(o, "y") for o in range(100)]
    df = spark.createDataFrame(rows, "paper_id long, software_normalized string")
    got = {r.software_normalized: r.n for r in counts.item_support(df).collect()}
    assert got == {"y": 100}                              # default threshold 100: 99 dropped


def test_top_ranked_short_result(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "item string, n long")
    top = counts.top_ranked(df, [F.desc("n"), F.asc("item")], 10).orderBy("rank").collect()
    assert [(r.rank, r.item) for r in top] == [(0, "a"), (1, "b"), (2, "c")]


def _random_rows(seed, n_owners, n_items, heavy):
    rnd = random.Random(seed)
    rows = [(o, f"s{rnd.randrange(n_items)}") for o in range(n_owners)
            for _ in range(rnd.randrange(1, 6))]
    for h in range(heavy):                                # owners holding almost every item
        rows += [(10_000 + h, f"s{i}") for i in range(n_items) if rnd.random() < 0.9]
    rows += [(o, "code") for o in range(50)]              # stop-listed name
    return rows


def test_co_occurrence_paths_match_brute_force(spark):
    # (heavy owners, pair threshold, block size) covering the three strategies:
    # no heavy owner; fewer heavy owners than the threshold (membership lift, no heavy pairs
    # formed); as many heavy owners as the threshold (blocked enumeration).
    for heavy, min_pair, block in ((0, 3, 2048), (2, 3, 8), (4, 3, 8), (1, 3, 8)):
        rows = _random_rows(7 + heavy, 300, 30, heavy)
        df = spark.createDataFrame(rows, "paper_id long, software_normalized string")
        want, _ = _brute_pairs(rows, {"code"}, 20, min_pair)
        got = {(r.item_a, r.item_b): r.n for r in counts.co_occurrence_counts(
            df, min_item_support=20, min_pair_support=min_pair, block_size=block).collect()}
        assert got == want, (heavy, min_pair, block)


def test_support_matches_brute_force(spark):
    rows = _random_rows(3, 300, 30, 1)
    df = spark.createDataFrame(rows, "paper_id long, software_normalized string")
    _, want_support = _brute_pairs(rows, {"code"}, 20, 1)
    got = {r.software_normalized: r.n for r in
           counts.item_support(df, min_support=20).collect()}
    assert got == want_support


def test_zero_filled_counts(spark):
    dim = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    facts = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    got = {r.k: r.n for r in counts.zero_filled_counts(dim, facts, "k").collect()}
    assert got == {1: 2, 2: 0, 3: 1}
