"""Line deduplication by pairwise alignment.

Documents overlap when they share a rare line. A line of ``min_words`` words or more counts as
rare by itself; a shorter one is joined with the lines behind it, and with those in front of it,
until the run has that many, so every common block that may be deleted is covered by such runs,
however frequent its lines are. A run is counted by its content and occurrence (the k-th copy in a
document is another run than the first). Of all holders of a run each later document is paired with
the earliest one only: the number of pairs grows with the lines, not with the square of a group,
and no frequency cap is needed.

A pair is aligned by patience diff, seeded with the runs they share: a run is matched by content and
occurrence (the k-th copy in one document with the k-th in the other), so matches are unique. An
alignment is a chain of matches that rises in both documents, and what one alignment leaves - blocks
that stand in another order - is aligned again until no shared run is left: patience piles give all
these chains in one pass. The blocks of each alignment are deleted from the later document. A
document keeps the k-th copy of a run that no earlier document holds k times; the earliest document
that holds a block always keeps it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import free_name
from citeweave.session import write_scratch

MIN_WORDS = 20


def line_keys(text: str | None, min_words: int = MIN_WORDS) -> tuple[list, ...]:
    """For the lines of a text that are not blank: line numbers (from 0), keys (hash of the line
    with white space collapsed, and of its occurrence) and words; then the runs (hash of the lines,
    and of the run's occurrence) with their first and last index into the lines."""
    from xxhash import xxh64_intdigest

    numbers, lines, words = [], [], []
    for k, line in enumerate((text or "").split("\n")):
        tokens = line.encode("utf-8", "replace").split()
        if tokens:
            numbers.append(k)
            lines.append(b" ".join(tokens))
            words.append(len(tokens))
    seen: dict[bytes | int, int] = {}
    keys, runs = [], []
    for line in lines:
        seen[line] = nth = seen.get(line, 0) + 1
        keys.append(xxh64_intdigest(line, nth))
    spans = shortest_spans(words, min_words)
    for first, last in spans:
        run = xxh64_intdigest(b"\n".join(lines[first:last + 1]))
        seen[run] = nth = seen.get(run, 0) + 1
        runs.append(run if nth == 1 else xxh64_intdigest(run.to_bytes(8, "little"), nth))
    return numbers, keys, words, runs, [a for a, _ in spans], [b for _, b in spans]


def shortest_spans(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Spans of lines (first, last) with ``min_words`` words that are shortest from their first
    line on or up to their last one. Every block of so many words is covered by those inside it,
    and whether a span is listed depends on its own lines only."""
    spans = set()
    end, total = 0, 0
    for start in range(len(words)):
        while total < min_words and end < len(words):
            total += words[end]
            end += 1
        if total < min_words:
            break
        spans.add((start, end - 1))
        total -= words[start]
    start, total = 0, 0
    for end in range(len(words)):
        total += words[end]
        while total - words[start] >= min_words:
            total -= words[start]
            start += 1
        if total >= min_words:
            spans.add((start, end))
    return sorted(spans)


def aligned_blocks(later: list[int], earlier: list[int]) -> list[tuple[int, int]]:
    """Blocks (first, last index into the lists) of the patience alignment of unique matches,
    given as positions in the later document (ascending) and in the earlier one."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(earlier)
    for k, position in enumerate(earlier):
        pile = bisect_left(tops, position)
        back[k] = at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(position)
            at.append(k)
        else:
            tops[pile], at[pile] = position, k
    chain, k = [], at[-1] if at else -1
    while k >= 0:
        chain.append(k)
        k = back[k]
    blocks: list[tuple[int, int]] = []
    for k in reversed(chain):
        if blocks and later[k] == later[blocks[-1][1]] + 1 and (
                earlier[k] == earlier[blocks[-1][1]] + 1) and k == blocks[-1][1] + 1:
            blocks[-1] = (blocks[-1][0], k)
        else:
            blocks.append((k, k))
    return blocks


def alignments(earlier: list[int]) -> list[list[int]]:
    """Matches, given by their position in the earlier document in the order of the later one, as
    the fewest chains that rise in both: each match goes behind the chain whose end is the nearest
    below it."""
    ends: list[int] = []
    order: list[int] = []  # numbers of the chains by their ends
    chains: list[list[int]] = []
    for k, position in enumerate(earlier):
        place = bisect_left(ends, position) - 1
        if place < 0:
            ends.insert(0, position)
            order.insert(0, len(chains))
            chains.append([k])
        else:
            ends[place] = position
            chains[order[place]].append(k)
    return chains


def aligned_lines(seeds: list[tuple[int, int, int]]) -> list[int]:
    """Lines of the later document that the alignments of a pair delete; a seed is a shared run:
    its first and last line there, and its first line in the earlier document."""
    seeds = sorted(set(seeds))
    lines: set[int] = set()
    for chain in alignments([e for _, _, e in seeds]):
        mine = [seeds[k] for k in chain]
        for first, last in aligned_blocks([f for f, _, _ in mine], [e for _, _, e in mine]):
            lines.update(range(mine[first][0], mine[last][1] + 1))
    return sorted(lines)


def _doc(id_: Column | str, text_hash: Column | str) -> Column:
    """Order of documents: by id, null ids last, then by text."""
    id_ = F.col(id_) if isinstance(id_, str) else id_
    return F.struct(id_.isNull().alias("unknown"), id_.alias("id"),
                    (F.col(text_hash) if isinstance(text_hash, str) else text_hash).alias("hash"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """Lines to delete: one row per document (id and text) that loses any: ``id``, ``text_hash``,
    ``lines`` (line numbers from 0, ascending) and ``words`` (their number of words).

    The earlier of two documents is the one with the smaller id (null ids come last; equal ids go
    by a hash of the text). Rows that agree in id and text are one document and never delete from
    each other. Null, empty and blank texts have no lines. An empty table gives no row; other
    columns are not looked at.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_keys(t.as_py(), min_words) for t in batch.column(2)]
            signed = lambda k: pa.array(
                [np.array(f[k], "<u8").view("<i8").tolist() for f in found], pa.list_(pa.int64()))
            counts = lambda k: pa.array([f[k] for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), counts(0), signed(1), counts(2), signed(3),
                 counts(4), counts(5)],
                ["id", "text_hash", "numbers", "keys", "words", "runs", "firsts", "lasts"])

    lines = spark.read.parquet(write_scratch(
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                    F.col(text_col).alias("text"))
        .mapInArrow(cut, f"id {id_type}, text_hash long, numbers array<int>, keys array<long>, "
                         "words array<int>, runs array<long>, firsts array<int>, lasts array<int>"),
        "dedup-lines"))
    runs = lines.select(
        _doc("id", "text_hash").alias("doc"),
        F.explode(F.arrays_zip("runs", "firsts", "lasts")).alias("run")).select(
        "doc", F.col("run.runs").alias("run"), F.col("run.firsts").alias("first"),
        F.col("run.lasts").alias("last"))
    # A run's earliest holder; runs with one holder end here.
    earliest = spark.read.parquet(write_scratch(
        runs.groupBy("run").agg(F.min(F.struct("doc", "first")).alias("holder"),
                                F.max("doc").alias("latest"))
        .where("holder.doc != latest").select(
            "run", F.col("holder.doc").alias("earlier"), F.col("holder.first").alias("start")),
        "dedup-runs"))
    seeds = (runs.join(earliest.hint("merge"), "run").where("doc != earlier")
             .groupBy("doc", "earlier")
             .agg(F.collect_set(F.struct("first", "last", "start")).alias("seeds")))
    # Rows that repeat a document give its lines again; the lines are listed once per document.
    own = lines.select(_doc("id", "text_hash").alias("doc"), "numbers", "words")
    pairs = own.join(seeds.hint("merge"), "doc").select("doc", "seeds", "numbers", "words")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, numbers, counts = [], [], []
            for k in range(batch.num_rows):
                found, number, words = (batch.column(c)[k].as_py() for c in range(1, 4))
                for at in aligned_lines([(s["first"], s["last"], s["start"]) for s in found]):
                    docs_.append(k)
                    numbers.append(number[at])
                    counts.append(words[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(docs_, pa.int32())),
                 pa.array(numbers, pa.int32()), pa.array(counts, pa.int32())],
                ["doc", "line", "words"])

    deleted = f"doc struct<unknown:boolean,id:{id_type},hash:long>, line int, words int"
    return (pairs.mapInArrow(align, deleted).distinct()
            .groupBy("doc").agg(F.array_sort(F.collect_list("line")).alias("lines"),
                                F.sum("words").alias("words"))
            .select("doc.id", F.col("doc.hash").alias("text_hash"), "lines", "words"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (all columns) with the repeated lines deleted from the text, and ``lines_deleted``
    and ``words_deleted`` added (columns of ``docs`` that have these names are replaced). A document
    that loses all its lines has an empty text."""
    id_name, hash_name, lines_name, words_name = names = [
        free_name(n, docs.columns) for n in ("gone_id", "gone_hash", "gone_lines", "gone_words")]
    gone = repeated_lines(docs, id_col, text_col, min_words).toDF(*names)
    left = F.filter(F.split(F.col(text_col), "\n", -1),
                    lambda line, k: ~F.array_contains(lines_name, k))
    # Deleted lines may be many; texts are joined by sort-merge at every size.
    return (docs.join(gone.hint("merge"), docs[id_col].eqNullSafe(F.col(id_name))
                      & F.xxhash64(docs[text_col]).eqNullSafe(F.col(hash_name)), "left")
            .withColumn(text_col, F.when(F.col(lines_name).isNull(), F.col(text_col))
                        .otherwise(F.array_join(left, "\n")))
            .withColumn("lines_deleted", F.coalesce(F.size(lines_name), F.lit(0)).cast("long"))
            .withColumn("words_deleted", F.coalesce(words_name, F.lit(0)).cast("long"))
            .drop(*names))
