"""Pair counts over sets of integer codes, tile by tile.

Codes are dealt into groups by ``code % n_groups``; a tile is a pair of groups. Every set sends its
members of both groups to the tile, as blocks of two bytes per member, and one task counts all
pairs of a tile, row by row, so a pair's count is whole where it is made and pairs below the
threshold never leave their task. What is shuffled grows with the members of the sets (times the
number of groups), not with their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Codes of a group (a code's place in it has two bytes), members that one task holds of each of its
# groups, and members dealt, members ordered or pairs gathered at a time.
GROUP_CODES = 1 << 16
GROUP_MEMBERS = 1 << 25
STEP = 1 << 20


def packed_sets(rows: DataFrame, owner: str, code: str) -> DataFrame:
    """One row per owner (null is one, too) with its distinct codes, sorted (``codes``). Rows are
    packed batch by batch before the shuffle, where the rows of an owner usually lie together."""
    schema = rows.select(owner).schema.add("codes", T.ArrayType(T.IntegerType()))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            owners = batch.column(0).dictionary_encode(null_encoding="encode")
            at = owners.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            keys = np.unique((at << 32) | batch.column(1).to_numpy(zero_copy_only=False))
            held, starts = np.unique(keys >> 32, return_index=True)
            ends = np.append(starts, len(keys)).astype(np.int32)
            codes = pa.ListArray.from_arrays(ends, pa.array((keys & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([owners.dictionary.take(pa.array(held)), codes],
                                             [owner, "codes"])

    packed = rows.select(owner, F.col(code).cast("int")).mapInArrow(pack, schema)
    return packed.groupBy(owner).agg(F.sort_array(F.array_distinct(F.flatten(
        F.collect_list("codes")))).alias("codes"))


def number_of_groups(n_codes: int, n_members: int, cores: int) -> int:
    """Enough groups for the bounds above, and for about two tiles a core (up to 12 groups)."""
    return max(min(math.ceil(math.sqrt(4 * cores)), 12), math.ceil(n_codes / GROUP_CODES),
               math.ceil(n_members / GROUP_MEMBERS), 1)


def _dealt(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Blocks of tiles: for each set with members of both groups, how many it has of either, and
    their places in the group (ascending). A tile of one group with itself has no second part."""
    for batch in batches:
        sets = batch.column(0)
        step = np.cumsum(sets.value_lengths().to_numpy()) // STEP
        starts = np.flatnonzero(np.diff(step, prepend=-1)).tolist()
        for x, y in zip(starts, [*starts[1:], len(sets)]):
            yield from _blocks(sets.slice(x, y - x), n)


def _blocks(sets: pa.ListArray, n: int) -> Iterator[pa.RecordBatch]:
    codes = sets.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(codes % n, kind="stable")
    group, places = (codes % n)[order], (codes // n)[order].astype(np.uint16)
    owner = np.repeat(np.arange(len(sets)), sets.value_lengths().to_numpy())[order]
    bounds = np.searchsorted(group, np.arange(n + 1))
    parts = [(owner[x:y], places[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]
    sizes = [np.bincount(held, minlength=len(sets)) for held, _ in parts]

    def cells(k: int, kept: np.ndarray) -> list[bytes]:
        held, at = parts[k]
        return [sizes[k][kept].astype(np.int32).tobytes(), at[kept[held]].tobytes()]

    for g in range(n):
        for h in range(g, n):
            kept = sizes[g] > 1 if g == h else (sizes[g] > 0) & (sizes[h] > 0)
            if kept.any():
                row = cells(g, kept) + ([b"", b""] if g == h else cells(h, kept))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g * n + h], pa.int32()), *(pa.array([c], pa.binary()) for c in row)],
                    ["tile", "n_a", "a", "n_b", "b"])


def _tile_counts(n_a: np.ndarray, a: np.ndarray, n_b: np.ndarray, b: np.ndarray, own: bool,
                 least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place in a, places in b, counts) of the pairs that at least ``least`` sets hold."""
    of = np.repeat(np.arange(len(n_a), dtype=np.int32), n_a)
    ends = np.cumsum(n_a if own else n_b)
    begins = ends - (n_a if own else n_b)
    width = int(b.max()) + 1 if len(b) else 0
    held = np.cumsum(np.bincount(a)) if len(a) else np.zeros(0, np.int64)
    low = 0
    while low < len(held):  # a range of places with about STEP members, or one place
        before = held[low - 1] if low else 0
        high = max(int(np.searchsorted(held, before + STEP, "right")), low + 1)
        at = np.flatnonzero((a >= low) & (a < high))
        at = at[np.argsort(a[at], kind="stable")]
        cut = np.searchsorted(a[at], np.arange(low, high + 1)).tolist()
        for place, first, last in zip(range(low, high), cut[:-1], cut[1:]):
            if last - first < least:
                continue
            order = at[first:last]
            x, y = order + 1 if own else begins[of[order]], ends[of[order]]
            total = np.cumsum(y - x)
            cuts = np.unique(np.searchsorted(total, np.arange(STEP, total[-1], STEP)))
            row = np.zeros(width, np.int64)
            for s, e in zip(np.r_[0, cuts], np.r_[cuts, len(x)]):
                if s < e:
                    row += np.bincount(np.concatenate([b[i:j] for i, j in zip(
                        x[s:e].tolist(), y[s:e].tolist())]), minlength=width)
            found = np.flatnonzero(row >= least)
            if len(found):
                yield place, found, row[found]
        low = high


def _counted(batches: Iterable[pa.RecordBatch], n: int, least: int,
             names: list[str]) -> Iterator[pa.RecordBatch]:
    tiles: dict[int, list[list[np.ndarray]]] = {}
    for batch in batches:
        columns = [batch.column(k) for k in range(5)]
        for row in range(batch.num_rows):
            kept = tiles.setdefault(columns[0][row].as_py(), [[], [], [], []])
            for k, kind in enumerate((np.int32, np.uint16, np.int32, np.uint16)):
                kept[k].append(np.frombuffer(columns[k + 1][row].as_py(), kind))
    while tiles:
        tile, parts = tiles.popitem()
        g, h = divmod(tile, n)
        n_a, a, n_b, b = (np.concatenate(p) for p in parts)
        parts.clear()
        out: list[list[np.ndarray]] = [[], [], []]
        size = 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names)

        for place, places, found in _tile_counts(n_a, a, n_b, a if g == h else b, g == h, least):
            out[0].append(np.full(len(places), place * n + g, np.int32))
            out[1].append((places * n + h).astype(np.int32))
            out[2].append(found)
            size += len(places)
            if size > 100_000:
                yield batch_of()
                out, size = [[], [], []], 0
        if size:
            yield batch_of()


def pair_counts(sets: DataFrame, n_codes: int, n_members: int, least: int, left: str, right: str,
                alias: str) -> DataFrame:
    """Number of sets (``codes``: distinct, ascending, from 0) that hold both codes, for every pair
    that at least ``least`` of them hold; either code of a pair may be the left one."""
    n = number_of_groups(n_codes, n_members, sets.sparkSession.sparkContext.defaultParallelism)
    names = [left, right, alias]
    blocks = sets.select("codes").mapInArrow(
        lambda batches: _dealt(batches, n), "tile int, n_a binary, a binary, n_b binary, b binary")
    # The tile's number among the n * (n + 1) / 2 tiles is its partition.
    g, h = F.floor(F.col("tile") / F.lit(n)), F.col("tile") % F.lit(n)
    number = (g * F.lit(n) - F.floor(g * (g - 1) / F.lit(2)) + h - g).cast("int")
    return blocks.repartitionById(n * (n + 1) // 2, number).mapInArrow(
        lambda batches: _counted(batches, n, max(least, 1), names),
        f"{left} int, {right} int, {alias} long")
