import itertools
import random
from collections import Counter

import pyarrow as pa
import pytest

from citeweave.operators import counts, pair_tiles


def _sets(seed, n_sets, n_codes):
    rnd = random.Random(seed)
    sets = [sorted(rnd.sample(range(n_codes), rnd.randrange(0, 9))) for _ in range(n_sets)]
    return sets + [list(range(n_codes))] * 2 + [[]]          # two that hold every code


def _wanted(sets, least):
    n = Counter(p for s in sets for p in itertools.combinations(s, 2))
    return {p: k for p, k in n.items() if k >= least}


@pytest.mark.parametrize("n_groups", [1, 3, 7])
@pytest.mark.parametrize("step", [3, 1 << 20])
def test_tiles_count_every_pair_once(monkeypatch, n_groups, step):
    monkeypatch.setattr(pair_tiles, "STEP", step)
    sets = _sets(n_groups, 60, 25)
    batches = [pa.RecordBatch.from_arrays([pa.array(s, pa.list_(pa.int32()))], ["codes"])
               for s in (sets[:20], sets[20:])]
    blocks = list(pair_tiles._dealt(batches, n_groups))
    for least in (1, 4):
        rows = [tuple(r.values()) for b in pair_tiles._counted(iter(blocks), n_groups, least,
                                                               ["x", "y", "n"])
                for r in b.to_pylist()]
        assert {(min(x, y), max(x, y)): n for x, y, n in rows} == _wanted(sets, least)
        assert len(rows) == len(_wanted(sets, least))


def test_groups_follow_codes_members_and_cores():
    assert pair_tiles.number_of_groups(0, 0, 0) == 1
    assert pair_tiles.number_of_groups(100, 100, 6) == 5
    assert pair_tiles.number_of_groups(100, 100, 10_000) == 12
    assert pair_tiles.number_of_groups(20 << 16, 100, 6) == 20
    assert pair_tiles.number_of_groups(100, 40 << 25, 6) == 40


def test_pairs_below_the_threshold_are_never_rows(spark):
    """Owners of many items, most pairs rare: what is written to shuffles grows with the rows, not
    with the pairs (about 600 pairs a row here)."""
    rows = spark.range(0, 40 * 1200).selectExpr(
        "id % 40 AS paper", "concat('w', id div 40 % 1200 * (1 + id % 40 % 7)) AS name")
    tiles = counts.co_occurrence_counts(rows, "paper", "name", None, 5, 38, left="a", right="b")
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [paper" not in plan and "HashAggregate(keys=[a" not in plan
    held = {}
    for r in rows.distinct().collect():
        held.setdefault(r.paper, set()).add(r.name)
    least = Counter(p for s in held.values() for p in itertools.combinations(sorted(s), 2))
    assert {(r.a, r.b): r.n for r in tiles.collect()} == {
        p: n for p, n in least.items() if n >= 38}


def test_null_and_repeated_owners(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "b"), (None, "a"), (None, "b"), (None, "c"), (2, "a"), (2, "b"), (1, "a"),
         (2, None), (3, "c"), (3, "a"), (None, None), (1, "d"), (1, "d")], "o long, w string")
    for support in (2, 3):
        got = [sorted(map(tuple, counts.co_occurrence_counts(
            rows, "o", "w", None, support, 1, encode=e).collect()))
            for e in (True, False)]
        assert got[0] == got[1] and got[0]
    assert not any("d" in r for r in got[0])                 # two rows, but one owner


def test_no_item_is_frequent(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "o long, w string")
    assert counts.co_occurrence_counts(rows, "o", "w", None, 2, 2).collect() == []
