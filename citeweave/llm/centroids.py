"""Centroid clustering (Lloyd's rounds on integer vectors) over a vector-approximation file.

Full vectors are written once to vector files in the shared folder, one per task, as fixed-size
records. The approximation table has one small row per vector: where its record is, and for each
dimension the number of the cell that holds its component. In a round a lookup table per centroid
gives each cell's least and greatest squared difference, so the sums over dimensions bound the
distance to every centroid. Only where the intervals of several centroids overlap is the full vector
fetched (by offset, neighbouring records together) and compared exactly.

New centroids need sums of full vectors; these are kept up to date by fetching only the vectors that
changed cluster. All arithmetic is on 64-bit integers, so results do not depend on partitions.
Each round's assignment is a written table: a lost executor repeats its own tasks of one round.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import shared_folder
from citeweave.session import release_scratch, scratch_path, write_scratch

SCALE = 1024
CLUSTERS, ROUNDS, SEED, DIMENSIONS = 8, 10, 3, 64
CELL_BITS = 8
# Rows whose range sets the cells' marks; components beyond it lie in the outer cells.
MARK_ROWS = 4096
# Largest size of an integer component: squared distances then stay inside 64 bits.
REACH = 1 << 27
# Records closer than this are read in one piece.
GAP = 64
SLICE = 4096


def seed_hash(id_col: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def usable_vectors(embeddings: DataFrame, dim: int = DIMENSIONS, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (array<double>) of the vectors with ``dim`` components, none null
    or non-finite."""
    rows = embeddings.select(F.col(id_col).alias("vec_id"),
                             F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where((F.size("vector") == dim) & F.forall("vector", lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))


def _integers(lists: pa.ListArray, dim: int) -> np.ndarray:
    whole = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if np.abs(whole).max(initial=0) > REACH:
        raise ValueError(f"a component is beyond {REACH // SCALE}: squared distances would leave "
                         "64 bits")
    return whole.astype(np.int64).reshape(-1, dim)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


# ---------------------------------------------------------------- the two files

def _cells(vectors: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Cell numbers: cell i of a dimension holds marks[i - 1] <= component < marks[i]."""
    return np.stack([np.searchsorted(marks[:, j], vectors[:, j], "right")
                     for j in range(vectors.shape[1])], axis=1).astype(np.uint8)


def _write_files(folder: str, marks: np.ndarray):
    """Vectors to a file per task, approximation rows out. A task that is run again writes a file of
    another name; only the files of committed tasks are referred to."""
    dim = marks.shape[1]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_folder(folder)
        name, sink, at = uuid.uuid4().hex, None, 0
        for batch in _slices(batches):
            if not batch.num_rows:
                continue
            if sink is None:
                fs.create_dir(root, recursive=True)
                sink = fs.open_output_stream(f"{root}/{name}")
            vectors = _integers(batch.column(1), dim)
            sink.write(vectors.astype("<i4").tobytes())
            n = len(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([name] * n), pa.array(np.arange(at, at + n)),
                 pa.array([c.tobytes() for c in _cells(vectors, marks)], pa.binary()),
                 pa.array(np.full(n, -1), pa.int32()), pa.array(np.full(n, -1), pa.int32())],
                ["vec_id", "file", "at", "cells", "was", "cluster"])
            at += n
        if sink is not None:
            sink.close()

    return write


def _by_file(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Rows of a batch by the file that holds their vectors."""
    names = batch.column(batch.schema.get_field_index("file")).dictionary_encode()
    codes = names.indices.to_numpy()
    for k, name in enumerate(names.dictionary.to_pylist()):
        yield name, np.flatnonzero(codes == k)


def _fetch(source, at: np.ndarray, dim: int) -> np.ndarray:
    """Records ``at`` of an open vector file, neighbouring ones read together."""
    order = np.argsort(at, kind="stable")
    places, found = at[order], np.empty((len(at), dim), np.int64)
    cuts = np.flatnonzero(np.diff(places) > GAP) + 1
    for begin, end in zip([0, *cuts], [*cuts, len(places)]):
        first, last = int(places[begin]), int(places[end - 1])
        source.seek(first * 4 * dim)
        piece = np.frombuffer(source.read((last - first + 1) * 4 * dim), "<i4").reshape(-1, dim)
        found[order[begin:end]] = piece[places[begin:end] - first]
    return found


# ---------------------------------------------------------------- rounds

def _tables(centroids: np.ndarray, marks: np.ndarray):
    """Least and greatest squared difference of each (dimension, cell) to each centroid."""
    edge = np.full((1, marks.shape[1]), REACH)
    first = np.concatenate([-edge, marks])[:, :, None]
    last = np.concatenate([marks - 1, edge])[:, :, None]
    q = centroids.T[None]
    near, far = (first - q) ** 2, (last - q) ** 2
    least = np.where((first <= q) & (q <= last), 0, np.minimum(near, far))
    # Cells without values (equal marks) are never looked up.
    return least.transpose(1, 0, 2), np.maximum(near, far).transpose(1, 0, 2)


def _assign(folder: str, centroids: np.ndarray, marks: np.ndarray):
    """Approximation rows with the nearest centroid (ties: the smaller number) as ``cluster``."""
    dim = marks.shape[1]
    least, most = _tables(centroids, marks)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_folder(folder)
        for batch in _slices(batches):
            if not batch.num_rows:
                continue
            vec_id, name, at, cells, _, was = batch.columns
            coded = np.frombuffer(b"".join(cells.to_pylist()), np.uint8).reshape(-1, dim)
            lower = np.zeros((len(coded), len(centroids)), np.int64)
            upper = np.zeros_like(lower)
            for j in range(dim):
                lower += least[j][coded[:, j]]
                upper += most[j][coded[:, j]]
            open_ = lower <= upper.min(axis=1)[:, None]
            nearest = open_.argmax(axis=1)
            unclear = open_.sum(axis=1) > 1
            places = at.to_numpy()
            for file, rows in _by_file(batch):
                rows = rows[unclear[rows]]
                if len(rows):
                    with fs.open_input_file(f"{root}/{file}") as source:
                        vectors = _fetch(source, places[rows], dim)
                    exact = np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)
                    exact[~open_[rows]] = np.iinfo(np.int64).max
                    nearest[rows] = exact.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [vec_id, name, at, cells, was, pa.array(nearest.astype(np.int32))],
                ["vec_id", "file", "at", "cells", "was", "cluster"])

    return assign


def _moved_sums(folder: str, k: int, dim: int):
    """Per task: what the sums (place 0 .. dim - 1) and counts (place dim) of the clusters gain."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_folder(folder)
        gain = np.zeros((k, dim + 1), np.int64)
        for batch in _slices(batches):
            _, at, was, now = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for file, rows in _by_file(batch):
                with fs.open_input_file(f"{root}/{file}") as source:
                    vectors = _fetch(source, at[rows], dim)
                for c in range(k):
                    for sign, side in ((1, now), (-1, was)):
                        mine = vectors[side[rows] == c]
                        gain[c, :dim] += sign * mine.sum(axis=0)
                        gain[c, dim] += sign * len(mine)
        c, place = np.nonzero(gain)
        if len(c):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)), pa.array(place.astype(np.int64)),
                 pa.array(gain[c, place])], ["cluster", "place", "gain"])

    return sums


def _distances(folder: str, centroids: np.ndarray):
    """Exact squared distance of every vector to its centroid."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_folder(folder)
        for batch in _slices(batches):
            vec_id, _, at, cluster = batch.columns
            own, found = cluster.to_numpy(), np.zeros(batch.num_rows, np.int64)
            for file, rows in _by_file(batch):
                with fs.open_input_file(f"{root}/{file}") as source:
                    vectors = _fetch(source, at.to_numpy()[rows], centroids.shape[1])
                found[rows] = ((vectors - centroids[own[rows]]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([vec_id, cluster, pa.array(found)],
                                             ["vec_id", "cluster", "distance"])

    return measure


def cluster(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
            dim: int = DIMENSIONS, cell_bits: int = CELL_BITS, id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(one row per usable vector: ``vec_id``, ``cluster``, ``distance``; the final centroids).

    Usable vectors have exactly ``dim`` components, none null or non-finite; a component x counts
    as the integer floor(1024 * x). The start is the ``k`` vectors with the smallest hashes of seed
    and id (null ids last, equal hashes by components). Each round assigns every vector to the
    nearest centroid by squared distance (ties: the smaller number) and replaces every non-empty
    centroid by its vectors' componentwise floor of the mean; then vectors are assigned once more.
    Rounds that move no vector change nothing, so they end the loop.

    Fewer usable vectors than ``k`` give as many centroids; none gives no row. Repeated rows are
    vectors of their own. A component beyond 131,072 raises an error. Other columns are not read.
    """
    spark = embeddings.sparkSession
    id_type = embeddings.schema[id_col].dataType.simpleString()
    vectors = usable_vectors(embeddings, dim, id_col, vector_col)
    whole = lambda row: [int(np.floor(SCALE * c)) for c in row["vector"]]
    start = [whole(r) for r in vectors.orderBy(
        F.asc_nulls_last(seed_hash("vec_id", seed)), "vector").limit(k).collect()]
    if not start:
        return spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long"), []
    marked = _integers(pa.array([r["vector"] for r in vectors.orderBy(
        F.xxhash64("vec_id", "vector")).limit(MARK_ROWS).collect()], pa.list_(pa.float64())), dim)
    # Cells of equal width over the range of these rows; the outer cells have no
    # useful bound, so a vector with a component in one is fetched.
    marks = np.floor(np.linspace(marked.min(0), marked.max(0), (1 << cell_bits) + 1)[1:-1]
                     ).astype(np.int64)
    folder = scratch_path(spark, f"vector-files-{uuid.uuid4().hex}")
    schema = f"vec_id {id_type}, file string, at long, cells binary, was int, cluster int"
    state = write_scratch(vectors.mapInArrow(_write_files(folder, marks), schema), "vector-cells")
    centroids, totals = start, [[0] * (dim + 1) for _ in start]
    for turn in range(rounds + 1):
        path = write_scratch(spark.read.parquet(state).mapInArrow(
            _assign(folder, np.array(centroids, np.int64), marks), schema), "assigned")
        release_scratch(spark, state)
        state = path
        if turn == rounds:
            break
        moved = spark.read.parquet(state).where("was != cluster").select(
            "file", "at", "was", "cluster")
        gains = moved.mapInArrow(_moved_sums(folder, len(start), dim),
                                 "cluster long, place long, gain long")
        gains = gains.groupBy("cluster", "place").agg(F.sum("gain").alias("gain")).collect()
        for g in gains:
            totals[g["cluster"]][g["place"]] += g["gain"]
        if not gains:
            break
        centroids = [[s // t[dim] for s in t[:dim]] if t[dim] else c
                     for t, c in zip(totals, centroids)]
    final = write_scratch(spark.read.parquet(state).select("vec_id", "file", "at", "cluster")
                          .mapInArrow(_distances(folder, np.array(centroids, np.int64)),
                                      f"vec_id {id_type}, cluster int, distance long"),
                          "clusters")
    release_scratch(spark, state, folder)
    return spark.read.parquet(final), centroids


def centroid_sha256(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
