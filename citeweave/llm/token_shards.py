"""Token-id shards: independent zstandard frames, a trailing seek table, per-frame checksums.

Layout of one shard file (all integers little-endian):

    frame 0 .. k-1   token ids (uint32), cut every FRAME_IDS ids; each frame is a complete
                     zstandard frame with its own content checksum
    frame k          the document index: n (uint64), then n rows (int64 doc_id, uint8 doc_id known,
                     uint64 first id in the shard, uint64 number of ids), column by column
    seek table       a zstandard skippable frame (magic 0x184D2A5E): for each frame the compressed
                     size, the decompressed size and the CRC-32 of its content (uint32 each), then
                     the number of frames (uint32), a descriptor byte (0x80: checksums present) and
                     the magic 0x8F92EAB1 (uint32)

Any zstandard tool decompresses a shard; a reader of some documents loads the seek table and the
index frame and decompresses only the frames that hold them.

A shard is written under a temporary name and renamed, so a task that is run again (lost executor,
speculation) replaces a file by an equal one and readers never see half a file.
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.session import scratch_path, write_scratch

SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
FRAME_IDS = 1 << 18
# Text handled at once inside a task, and pieces remembered per Python worker.
SLICE_BYTES, CACHE_PIECES = 4 << 20, 600_000
PUNCTUATION = ".,!?&%$*#|;:"
# White space as the pre-tokenizer has it; cuts go in front of it, behind anything else.
BLANKS = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
CUT = re.compile(f"(?<=[^{BLANKS}])(?=[{BLANKS}])")
NEEDS_CUT = f"\\x00|[{BLANKS}][ \n]"


# ---------------------------------------------------------------- tokenizing

def _ragged(flat: np.ndarray, lengths: np.ndarray, index: np.ndarray):
    """The lists ``index`` of a list column (``flat``, ``lengths``), one after another, and their
    lengths."""
    first, per = np.cumsum(lengths) - lengths, lengths[index]
    ends = np.cumsum(per)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(first[index] - (ends - per), per) + np.arange(total)], per


class PieceEncoder:
    """Encodes texts with a byte-level BPE tokenizer, each distinct piece once.

    The pre-tokenizer of the byte-level tokenizers never joins a non-space character with white
    space that follows it, so a text may be cut in front of every white-space run and the pieces
    encoded alone. A letter run ends in front of punctuation in the same way, so a piece is its
    core and its tail of punctuation. Cores repeat, and most of them are looked up. Two
    generations of learned cores are kept; the older is dropped when the younger is full, and what
    is used again moves to the younger. Results do not depend on what is remembered.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.newline = np.frombuffer(self._ids("\n"), "<u4")

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                        "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces. Those of letters (and one blank in front) go in one call, joined by
        line breaks: a line break between two such pieces is one token and starts no other."""
        known = self.young
        plain = [p for p in pieces if p.isalpha() or p[:1] == " " and p[1:].isalpha()
                 ] if len(self.newline) == 1 else []
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast(
                ["\n".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.newline[0])
            if len(cuts) == len(plain) - 1:
                raw, ends = ids.tobytes(), [*(cuts * 4).tolist(), len(ids) * 4]
                begins = [0, *(cuts * 4 + 4).tolist()]
                known.update(zip(plain, [raw[a:b] for a, b in zip(begins, ends)]))
        for piece in pieces:
            if piece not in known:
                known[piece] = self._ids(piece)

    def _lookup(self, pieces: list[str]) -> list[bytes]:
        if len(self.young) > CACHE_PIECES // 2:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = [p for p in pieces if p not in young]
        if missing:
            young.update([(p, old[p]) for p in missing if p in old])
            self._learn([p for p in missing if p not in old])
        return [young[p] for p in pieces]

    def _pieces(self, texts: pa.Array) -> pa.ListArray:
        if pc.any(pc.match_substring_regex(texts, NEEDS_CUT)).as_py():
            return pa.array([CUT.split(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n")
        return pc.split_pattern(marked, "\x00")

    def _columns(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        values = self._lookup(pieces)
        return (np.frombuffer(b"".join(values), "<u4"),
                np.fromiter(map(len, values), np.int64, len(values)) // 4)

    def _encode_distinct(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces one after another, and how many each has."""
        core = pc.utf8_rtrim(pieces, PUNCTUATION)
        size = pc.binary_length(pieces).to_numpy()
        tail = size - pc.binary_length(core).to_numpy()
        # Only behind a letter does punctuation start a token; and tails are packed in 7 bytes.
        cut = pc.match_substring_regex(core, r"\pL$").to_numpy(zero_copy_only=False) & (tail <= 7)
        core, tail = pc.if_else(pa.array(cut), core, pieces), np.where(cut, tail, 0)
        ends = np.frombuffer(pieces.buffers()[1], "<i4")[pieces.offset + 1:][:len(pieces)]
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        packed = np.zeros(len(pieces), np.int64)
        for k in range(1, int(tail.max(initial=0)) + 1):
            here = tail >= k
            packed[here] = packed[here] << 8 | data[ends[here] - tail[here] + k - 1]
        tails, tail_index = np.unique(packed, return_inverse=True)
        cores = core.dictionary_encode()
        core_ids, core_sizes = self._columns(cores.dictionary.to_pylist())
        tail_ids, tail_sizes = self._columns(
            [int(t).to_bytes(8, "big").lstrip(b"\0").decode() for t in tails])
        both = np.empty(2 * len(pieces), np.int64)
        both[::2], both[1::2] = cores.indices.to_numpy(), tail_index + len(core_sizes)
        ids, per = _ragged(np.concatenate([core_ids, tail_ids]),
                           np.concatenate([core_sizes, tail_sizes]), both)
        return ids, per[::2] + per[1::2]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each text."""
        lists = self._pieces(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        flat, lengths = self._encode_distinct(coded.dictionary)
        ids, per_piece = _ragged(flat, lengths, coded.indices.to_numpy())
        bounds = np.concatenate([[0], np.cumsum(per_piece)])[offsets - offsets[0]]
        return ids, np.diff(bounds)


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_file: str) -> PieceEncoder:
    """One encoder per Python worker: what a task has learned serves the worker's next tasks."""
    return PieceEncoder(tokenizer_file)


def _cut(text: str) -> Iterator[str]:
    """A text in parts of about SLICE_BYTES characters, cut where no piece goes across."""
    begin = 0
    while found := CUT.search(text, begin + SLICE_BYTES):
        yield text[begin:found.start()]
        begin = found.start()
    yield text[begin:]


def _encode_slice(encoder: PieceEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``encoder.encode`` of a slice; a text longer than a slice is encoded part by part."""
    if len(texts) > 1 or pc.binary_length(texts)[0].as_py() <= SLICE_BYTES:
        return encoder.encode(texts)
    ids = np.concatenate([encoder.encode(pa.array([part]))[0] for part in _cut(texts[0].as_py())])
    return ids, np.array([len(ids)])


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of whole texts of about SLICE_BYTES."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


# ---------------------------------------------------------------- the file format

class ShardWriter:
    """Writes one shard; holds one unfinished frame and the document index."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS, level: int = 3):
        self.sink, self.frame_ids, self.entries = sink, frame_ids, []
        self.index, self.n_documents = ([], [], []), 0  # doc ids, whether known, numbers of ids
        self.parts, self.held, self.n_ids = [], 0, 0
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True,
                                             write_content_size=True)

    def _frame(self, content: bytes) -> None:
        packed = self.zstd.compress(content)
        self.sink.write(packed)
        self.entries.append((len(packed), len(content), zlib.crc32(content)))

    def add(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents in order: their ids one after another and the number of ids of each."""
        for column, values in zip(self.index, (
                np.array([d or 0 for d in doc_ids], "<i8"),
                np.array([d is not None for d in doc_ids], "u1"), lengths.astype("<u8"))):
            column.append(values)
        self.n_documents += len(doc_ids)
        self.n_ids += int(lengths.sum())
        self.parts.append(ids.astype("<u4", copy=False))
        self.held += len(ids)
        if self.held >= self.frame_ids:
            held = np.concatenate(self.parts)
            whole = len(held) - len(held) % self.frame_ids
            for at in range(0, whole, self.frame_ids):
                self._frame(held[at:at + self.frame_ids].tobytes())
            self.parts, self.held = [held[whole:]], len(held) - whole

    def close(self) -> None:
        if self.held:
            self._frame(np.concatenate(self.parts).tobytes())
        doc_ids, known, lengths = (np.concatenate([np.zeros(0, kind), *column]).astype(kind)
                                   for kind, column in zip(("<i8", "u1", "<u8"), self.index))
        starts = np.cumsum(lengths, dtype="<u8") - lengths
        self._frame(struct.pack("<Q", len(doc_ids)) + doc_ids.tobytes() + known.tobytes()
                    + starts.tobytes() + lengths.tobytes())
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), 0x80, SEEK_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class ShardReader:
    """Random access to one shard; ``source`` is a seekable binary file of ``size`` bytes."""

    def __init__(self, source, size: int):
        self.source = source
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or descriptor != 0x80:
            raise ValueError("not a token shard: no seek table at its end")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.sizes, self.crcs = table[:, 1].astype(np.int64), table[:, 2]
        self.packed = np.concatenate([[0], np.cumsum(table[:, 0].astype(np.int64))])
        self.plain = np.concatenate([[0], np.cumsum(self.sizes)])
        self.zstd = zstandard.ZstdDecompressor()
        index = self._frame(n - 1)
        k = struct.unpack_from("<Q", index)[0]
        ids = np.frombuffer(index, "<i8", k, 8)
        known = np.frombuffer(index, "u1", k, 8 + 8 * k)
        self.starts = np.frombuffer(index, "<u8", k, 8 + 9 * k).astype(np.int64)
        self.lengths = np.frombuffer(index, "<u8", k, 8 + 17 * k).astype(np.int64)
        self.doc_ids = [i if ok else None for i, ok in zip(ids.tolist(), known.tolist())]
        self.n_data, self.last = n - 1, (-1, b"")

    def _at(self, position: int, length: int) -> bytes:
        self.source.seek(int(position))
        return self.source.read(int(length))

    def _frame(self, k: int) -> bytes:
        content = self.zstd.decompress(self._at(self.packed[k], self.packed[k + 1]
                                                - self.packed[k]))
        if zlib.crc32(content) != int(self.crcs[k]):
            raise ValueError(f"frame {k}: checksum mismatch")
        return content

    def pieces(self, row: int) -> Iterator[bytes]:
        """The bytes of one document's ids, frame by frame; only its frames are decompressed."""
        begin = int(self.starts[row]) * 4
        end = begin + int(self.lengths[row]) * 4
        k = int(np.searchsorted(self.plain, begin, "right")) - 1
        while begin < end:
            if self.last[0] != k:
                self.last = (k, self._frame(k))
            here = int(self.plain[k])
            yield self.last[1][begin - here:min(end, here + int(self.sizes[k])) - here]
            begin, k = here + int(self.sizes[k]), k + 1

    def ids(self, row: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.pieces(row)), "<u4")


# ---------------------------------------------------------------- Spark

def write_token_shards(docs: DataFrame, tokenizer_file: str, out_dir: str, end_id: int = 2,
                       id_col: str = "doc_id", text_col: str = "text",
                       frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode every text (null: empty), append ``end_id`` and write shards to ``out_dir``.

    ``out_dir`` is a folder shared by all executors: a path or any URI that Arrow opens. Documents
    are ordered by id over all shards (null ids first, equal ids by text); shard k holds the
    documents before those of shard k + 1. Returns one row per shard (``shard``, ``path``,
    ``n_documents``, ``n_ids``), read from a written table: shards are complete when it returns.
    Rows of repeated ids are all written. An empty table writes no shard.
    """
    keys = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Repeated ids (copies of a mix) must not pin one range: the text's hash breaks ties.
    ordered = (keys.withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(F.asc_nulls_first("doc_id"), "tie")
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie", "text")
               .select("doc_id", "text"))
    schema = "shard int, path string, n_documents long, n_ids long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["RAYON_NUM_THREADS"] = "1"  # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pa.set_cpu_count(1)
        shard = TaskContext.get().partitionId()
        fs, folder = pafs.FileSystem.from_uri(out_dir) if "://" in out_dir or out_dir.startswith(
            "file:") else (pafs.LocalFileSystem(), out_dir)
        name = f"{folder}/shard-{shard:06d}.tok"
        draft = f"{folder}/.draft-{shard:06d}-{uuid.uuid4().hex}"
        writer = encoder = sink = None
        for batch in batches:
            if batch.num_rows and writer is None:
                fs.create_dir(folder, recursive=True)
                sink = fs.open_output_stream(draft)
                writer, encoder = ShardWriter(sink, frame_ids), _encoder(tokenizer_file)
            doc_ids, at, some = batch.column(0).to_pylist(), 0, None
            for some in _slices(batch.column(1).cast(pa.string())):
                ids, lengths = _encode_slice(encoder, some)
                # One end id behind each document.
                ends = np.cumsum(lengths)
                writer.add(doc_ids[at:at + len(some)], np.insert(ids, ends, end_id), lengths + 1)
                at += len(some)
            # The pool would keep the batch's pages for the rest of the worker's life.
            del batch, some
            pa.default_memory_pool().release_unused()
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(draft, name)
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": name, "n_documents": writer.n_documents,
                  "n_ids": writer.n_ids}],
                pa.schema([("shard", pa.int32()), ("path", pa.string()),
                           ("n_documents", pa.int64()), ("n_ids", pa.int64())]))

    return docs.sparkSession.read.parquet(
        write_scratch(ordered.mapInArrow(write, schema), "token-shards"))


def read_token_shards(shards: DataFrame, out_dir: str, with_ids: bool = False) -> DataFrame:
    """Every document of the shards, read back from the files (one task reads whole shards).

    Returns ``doc_id``, ``start`` (ids of all documents before it, over all shards), ``n_tokens``,
    ``ids_crc32`` and, if asked for, ``ids`` (array<long>). Checksums of all frames are verified.
    """
    spark = shards.sparkSession
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file of tens of megabytes: the running total is over shards, not documents.
    listed = shards.select("shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0))
                           .cast("long").alias("base"))
    n = max(1, shards.count())
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
             ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids
    schema = ("doc_id long, start long, n_tokens long, ids_crc32 long"
              + ", ids array<long>" * with_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = pafs.FileSystem.from_uri(out_dir)[0] if "://" in out_dir or out_dir.startswith(
            "file:") else pafs.LocalFileSystem()
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(row["path"]) as source:
                    reader = ShardReader(source, source.size())
                    for begin in range(0, len(reader.doc_ids), 2000):
                        rows = range(begin, min(begin + 2000, len(reader.doc_ids)))
                        crcs = []
                        for k in rows:
                            crc = 0
                            for piece in reader.pieces(k):
                                crc = zlib.crc32(piece, crc)
                            crcs.append(crc)
                        columns = [reader.doc_ids[rows.start:rows.stop],
                                   (reader.starts[rows.start:rows.stop] + row["base"]).tolist(),
                                   reader.lengths[rows.start:rows.stop].tolist(), crcs]
                        if with_ids:
                            columns.append([reader.ids(k).tolist() for k in rows])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, (_, k) in zip(columns, kinds)],
                            [name for name, _ in kinds])

    return listed.repartitionByRange(n, "shard").mapInArrow(read, schema)


def shard_folder(spark: SparkSession) -> str:
    """A new folder for shards in the shared scratch space."""
    return scratch_path(spark, f"token-shards-{uuid.uuid4().hex}")
