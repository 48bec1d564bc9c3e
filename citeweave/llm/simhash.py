"""SimHash near-duplicates: fingerprints, a grid range join of popcount vectors, components.

Fingerprints are embedded as vectors of bits set per segment (segments of two bits and of one). The
Manhattan distance of two vectors is a lower bound of the fingerprints' Hamming distance, so links
are found among pairs whose vectors are near. The coordinates form two parts, A over 34 bits and B
over 30. If all differences sum to at most 4, part A differs by at most 2 or part B by at most 1.
Both conditions are range joins on the integer grid of the part: vectors within 2 of each other have a grid cell within 1 of
both, and vectors within 1 of each other share a cell of odd coordinate sum that is the odd one
itself. So every fingerprint is listed in a few dozen cells, pairs are only looked for inside
cells, and the Hamming distance of each is verified.

Equal fingerprints are one node. A cell does not give all its pairs but a spanning star of each of
its linked parts (enough for components). A large cell is cut into blocks, and each pair of blocks
is a group of its own: a group's size is bounded and no link between blocks is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.session import release_scratch, write_scratch

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Members of one block of a grid cell; a group handed to a task holds at most about two blocks.
BLOCK = 4096
# Shingles whose bits are counted at once.
COUNT_AT_ONCE = 1 << 16
# The parts: bits, and how many two-bit segments lie at the low end (the others have one bit). More
# two-bit segments mean fewer coordinates, but more unrelated fingerprints in each cell.
_A_BITS, _A_WIDE = 34, 8
_B_BITS, _B_WIDE = 30, 7
_PAIRS = 0x5555555555555555


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text, as an unsigned integer; 0 without words."""
    from xxhash import xxh64_intdigest

    # bytes.lower changes A-Z only, and bytes.split cuts at ASCII white space only.
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(tokens) - shingle_words + 1)
    begin = (ends - lengths)[:n].tolist()
    end = (ends[shingle_words - 1:] if len(tokens) >= shingle_words else ends[-1:]).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, COUNT_AT_ONCE):
        hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(
            begin[at:at + COUNT_AT_ONCE], end[at:at + COUNT_AT_ONCE])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``id`` and ``fp`` (a signed long with the fingerprint's bits) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], "<u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view("<i8"))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        compute, f"id {kind}, fp long")


# ---------------------------------------------------------------- grid range join

def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _counts(part: Column, bits: int, wide: int) -> Column:
    """Bits set per segment, side by side in as many bits as the part has: for two-bit segments
    x - ((x >> 1) & 0101...01), and one-bit segments as they are."""
    low = (1 << 2 * wide) - 1
    pairs = part.bitwiseAND(_long(low))
    return (pairs - F.shiftrightunsigned(pairs, 1).bitwiseAND(_long(_PAIRS & low))
            + part.bitwiseAND(_long(((1 << bits) - 1) ^ low)))


def _neighbours(cell: Column, bits: int, wide: int) -> Column:
    """The cells at Manhattan distance 1: a two-bit segment's count (0 to 2) one up or one down, or
    a one-bit segment's the other way."""
    def moved(segment: Column) -> Column:
        # F.shiftleft takes a constant distance; powers of four (and two) do the same.
        unit = F.pow(F.lit(4.0), segment).cast("long")
        value = F.pmod(F.floor(cell / unit).cast("long"), F.lit(4))
        return F.filter(F.array(F.when(value < 2, cell + unit), F.when(value > 0, cell - unit)),
                        lambda c: c.isNotNull())

    return F.concat(
        F.flatten(F.transform(F.sequence(F.lit(0), F.lit(wide - 1)), moved)),
        F.transform(F.sequence(F.lit(2 * wide), F.lit(bits - 1)),
                    lambda b: cell.bitwiseXOR(F.pow(F.lit(2.0), b).cast("long"))))


def grid_cells(fps: DataFrame) -> DataFrame:
    """``fp`` with every grid cell (``cell``, a long that names the part and the coordinates)."""
    parts = fps.select(
        "fp", _counts(F.col("fp").bitwiseAND(_long((1 << _A_BITS) - 1)), _A_BITS, _A_WIDE)
        .alias("a"), _counts(F.shiftrightunsigned("fp", _A_BITS), _B_BITS, _B_WIDE).alias("b"))
    # The parity of the coordinate sum of part B: that of the low bits of its counts (2 is even).
    low = (1 << 2 * _B_WIDE) - 1
    ones = _PAIRS & low | ((1 << _B_BITS) - 1) ^ low
    odd = F.pmod(F.bit_count(F.col("b").bitwiseAND(_long(ones))), F.lit(2)) == 1
    b_cells = F.when(odd, F.array("b")).otherwise(_neighbours(F.col("b"), _B_BITS, _B_WIDE))
    a_cells = F.concat(F.array("a"), _neighbours(F.col("a"), _A_BITS, _A_WIDE))
    name = lambda part: lambda c: c * 2 + part
    return parts.select("fp", F.explode(F.concat(
        F.transform(a_cells, name(0)), F.transform(b_cells, name(1)))).alias("cell"))


def _stars(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, centre) that join the members of a group which ``max_bits`` links connect.
    Each member is compared with those not yet reached, so a dense part is used up quickly."""
    left, out, centres = np.unique(fps), [], []
    while len(left) > 1:
        centre, left = left[0], left[1:]
        queue = [centre]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                out.append(found)
                centres.append(np.full(len(found), centre))
    none = np.zeros(0, "<u8")
    return np.concatenate([none, *out]), np.concatenate([none, *centres])


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (``u``, ``v``) among distinct fingerprints (``fp``) that connect exactly those which
    chains of pairs at ``max_bits`` or fewer differing bits connect. The grid is laid out for
    max_bits <= 4."""
    if max_bits > 4:
        raise ValueError("the grid finds links of at most 4 bits")
    spark = fps.sparkSession
    # Each fingerprint has some 45 cells: few read tasks must not write them all.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = grid_cells(fps.repartition(parts, "fp"))
    shared = write_scratch(cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1"),
        "simhash-cells")
    # Most shared cells hold two fingerprints that met by chance: these are compared as they are.
    differing = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    pairs = spark.read.parquet(shared).where((F.col("n") == 2) & (differing <= max_bits)).select(
        "u", "v")
    crowded = spark.read.parquet(shared).where("n > 2").select("cell", "n")
    members = (cells.join(crowded.hint("merge"), "cell")
               .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
               .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    groups = members.groupBy("cell", F.least("own", "other").alias("i"),
                             F.greatest("own", "other").alias("j")).agg(
        F.collect_list("fp").alias("fps")).select("fps")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values = column.values.to_numpy().view("<u8")
            bounds = column.offsets.to_numpy()
            found = [_stars(values[a:b], max_bits) for a, b in zip(bounds[:-1], bounds[1:])]
            u, v = (np.concatenate([f[k] for f in found] or [np.zeros(0, "<u8")]).view("<i8")
                    for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    links = write_scratch(groups.mapInArrow(link, "u long, v long").unionByName(pairs).distinct(),
                          "simhash-links")
    release_scratch(spark, shared)
    return spark.read.parquet(links)


# ---------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of an undirected graph of long nodes (``u``, ``v``); the
    root is the smallest node that can be reached.

    Alternating large-star and small-star rounds: each round points nodes at smaller neighbours,
    only minima are aggregated (never a list of neighbours), the links of each round are written
    to shared storage, and rounds end when a round changes nothing.
    """
    spark = links.sparkSession
    path = write_scratch(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .where("u != v").distinct(), "component-links")

    def state(p: str):
        return spark.read.parquet(p).agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    before = state(path)
    while before[0]:
        e = spark.read.parquet(path)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Minima are written before they are joined: a join that shares the aggregate's shuffle
        # could not split the links of a node that very many nodes point to.
        least_path = write_scratch(both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")), "component-least")
        least = spark.read.parquet(least_path)
        large_path = write_scratch(
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "component-large")
        large = spark.read.parquet(large_path)
        nearest_path = write_scratch(large.groupBy("u").agg(F.min("v").alias("m")),
                                     "component-nearest")
        least = spark.read.parquet(nearest_path)
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"),
                                                               F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u != v").distinct())
        after_path = write_scratch(small, "component-links")
        release_scratch(spark, path, large_path, least_path, nearest_path)
        path, after = after_path, state(after_path)
        if after == before:
            break
        before = after
    roots = spark.read.parquet(path)
    return (roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
                         .distinct()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    block: int = BLOCK) -> DataFrame:
    """One row per document row: ``id``, ``fp`` and ``component_id``, the smallest id that can be
    reached over links of ``max_bits`` or fewer differing bits (its own included).

    Null, empty and blank texts have fingerprint zero and are linked like any other. Null ids take
    part and never are a component's id unless it has no other; rows that repeat an id are all
    returned. An empty table gives none; other columns are not looked at.
    """
    spark = docs.sparkSession
    prints = spark.read.parquet(write_scratch(
        fingerprints(docs, id_col, text_col, shingle_words), "simhash-fingerprints"))
    classes = spark.read.parquet(write_scratch(
        prints.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-classes"))
    roots = components(near_links(classes.select("fp"), max_bits, block))
    rooted = (classes.join(roots, classes["fp"] == roots["node"], "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = spark.read.parquet(write_scratch(
        rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-smallest"))
    named = spark.read.parquet(write_scratch(
        rooted.join(smallest, "root").select(F.col("fp").alias("class_fp"), "component_id"),
        "simhash-components"))
    return (prints.join(named.hint("merge"), prints["fp"] == named["class_fp"])
            .select("id", "fp", "component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """``docs`` (all columns) with one document of each component: the one whose id names it.
    Rows of a null id stay, since no id names them; rows of one repeated id stay or go together."""
    gone = (near_duplicates(docs, id_col, text_col, **options)
            .where(F.col("id").isNotNull() & (F.col("id") != F.col("component_id")))
            .select(F.col("id").alias("gone_id")))
    # A sort-merge join at every size: a list of ids may be a large part of the table.
    return docs.join(gone.hint("merge"), docs[id_col] == gone["gone_id"], "left_anti")
