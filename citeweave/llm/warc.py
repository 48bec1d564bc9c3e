"""WARC archives of pages, compressed record by record with one Zstandard dictionary.

Layout of an archive (the .warc.zst convention):

    frame 0     a skippable frame (magic 0x184D2A5D) that holds the dictionary
    frame 1     a warcinfo record
    frame 2 ..  one WARC/1.1 record each, an independent Zstandard frame that uses the dictionary

The dictionary is trained on a bounded sample of the pages' own records. Every archive carries it,
so each can be read alone; a record is read by decompressing its frame only.

Pages whose payload (the html) equals another's are written as ``revisit`` records without payload,
referring to the page with the largest id of the group. Which pages are equal is found by grouping
digests; payloads move only where a page of a repeated payload must meet its group.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.common import shared_folder
from citeweave.session import scratch_path, write_scratch

DICTIONARY_MAGIC = 0x184D2A5D
# The bound of the dictionary: rows and bytes of a row that it is built from, and its own size.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8192, 112_640
LEVEL = 3
# The archive is fixed by its pages: reruns write equal files.
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 4 << 20
PAGE_URI = "urn:x-page:"
UNSAFE = re.compile(r"[\x00-\x20\x7f<>]")


# ---------------------------------------------------------------- records

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id) -> str:
    return f"<{PAGE_URI}{'' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    held = uri[len(PAGE_URI) + 1:-1]
    return int(held) if held else None


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False,
                date: str = DATE) -> bytes:
    """A response record, or a revisit record: the HTTP head alone, with the payload's length."""
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    # Control characters, blanks and angle brackets could break out of the header.
    target = UNSAFE.sub(lambda m: quote(m[0], safe=""), url or "") or _uri(page_id)[1:-1]
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", date),
               ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _uri(refers_to))]
    return _record([*headers, ("Content-Type", "application/http;msgtype=response")],
                   head if revisit else head + payload)


def info_record(date: str = DATE) -> bytes:
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x-archive>"),
                    ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
                   b"format: WARC File Format 1.1\r\n")


def _head(raw: bytes, first: str) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and what follows the blank line."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith(first):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}, rest


def parse_record(raw: bytes) -> dict | None:
    """A page from its record, checked against its digest; None of a warcinfo record."""
    fields, rest = _head(raw, "WARC/")
    block = rest[:int(fields["content-length"])]
    if len(rest) != len(block) + 4 or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length does not match its Content-Length")
    if fields["warc-type"] == "warcinfo":
        return None
    http, payload = _head(block, "HTTP/")
    revisit = fields["warc-type"] == "revisit"
    length, held = int(http["content-length"]), fields["warc-payload-digest"].split(":", 1)[1]
    if not revisit and (len(payload), digest(payload)) != (length, held):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {"page_id": _page(fields["warc-record-id"]), "target": fields["warc-target-uri"],
            "payload_bytes": length, "payload_digest": held, "record_type": fields["warc-type"],
            "refers_to": _page(fields["warc-refers-to"]) if revisit else None,
            "payload": None if revisit else payload}


# ---------------------------------------------------------------- the dictionary and the frames

def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary from sample records; empty if there is nothing to learn from. Few or
    short samples are too little for the trainer: they are given to it several times over, for a
    smaller dictionary."""
    total = sum(map(len, samples))
    if not total:
        return b""
    size = min(size, max(256, total // 8))
    for times in (1, 4, 16, 64):
        try:
            return zstandard.train_dictionary(size, samples * times).as_bytes()
        except zstandard.ZstdError:
            continue
    return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    prepared = None
    if dictionary:
        prepared = zstandard.ZstdCompressionDict(dictionary)
        prepared.precompute_compress(level=LEVEL)  # once, not for each record
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=prepared, write_checksum=True,
                                    write_content_size=True)


def frame_end(data: bytes, at: int) -> int | None:
    """Where the Zstandard frame that begins at ``at`` ends, None if ``data`` ends before. Walks the
    block headers; nothing is decompressed."""
    head = data[at:at + 18]  # the longest frame header
    try:
        place = at + zstandard.frame_header_size(head)
        checksum = zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError:
        if len(head) < 18:
            return None
        raise
    last = False
    while not last:
        if place + 3 > len(data):
            return None
        block = int.from_bytes(data[place:place + 3], "little")
        last, kind = bool(block & 1), block >> 1 & 3  # kind 1: one byte, repeated
        place += 3 + (1 if kind == 1 else block >> 3)
    place += 4 * checksum
    return place if place <= len(data) else None


def read_records(source) -> Iterator[bytes]:
    """Records of an archive, one after another; at most a piece of the file and one record are
    held."""
    data, at, ended = b"", 0, False

    def more() -> bool:
        nonlocal data, at, ended
        piece = source.read(READ_BYTES)
        data, at, ended = data[at:] + piece, 0, not piece
        return not ended

    while len(data) < 8 and more():
        pass
    dictionary = b""
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        length = struct.unpack_from("<I", data, 4)[0]
        while len(data) < 8 + length:
            if not more():
                raise ValueError("the archive ends inside its dictionary")
        dictionary, at = data[8:8 + length], 8 + length
    codec = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    while True:
        end = frame_end(data, at) if at < len(data) else None
        if end is None:
            if more():
                continue
            if at < len(data):
                raise ValueError("the archive ends inside a record")
            return
        yield codec.decompress(data[at:end])
        at = end


# ---------------------------------------------------------------- Spark

def with_groups(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, payload_col: str
                ) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (null: empty) and ``first``: the largest id among the pages
    of an equal payload, where there are several pages and the payload has ``min_bytes``."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    repeated = (keyed.where(F.octet_length("payload") >= min_bytes).groupBy("key")
                .agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
                .where("copies > 1").select("key", "first"))
    # Only repeated payloads have a row here, so a common payload is one key on a large left side:
    # it is broadcast where small, and else split by adaptive execution.
    return keyed.join(repeated, "key", "left").drop("key")


def sample_dictionary(pages: DataFrame, id_col: str, url_col: str, payload_col: str,
                      rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> bytes:
    """A dictionary from the records of at most ``rows`` pages, chosen by the smallest hashes of
    their ids and payloads' lengths, at most ``max_bytes`` of each. Hashes are ranked first, so
    only chosen payloads leave the scan."""
    rank = F.xxhash64(F.col(id_col), F.octet_length(payload_col), F.lit("warc dictionary"))
    cut = pages.select(rank.alias("rank")).orderBy("rank").limit(rows).agg(F.max("rank")).first()[0]
    if cut is None:
        return b""
    chosen = pages.where(rank <= F.lit(cut)).select(
        rank.alias("rank"), F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
        F.substring(F.coalesce(F.col(payload_col), F.lit("")).cast("binary"), 1, max_bytes)
        .alias("payload")).orderBy("rank", "id", "url", "payload").limit(rows).collect()
    return build_dictionary([page_record(r["id"], r["url"], bytes(r["payload"]))[:max_bytes]
                             for r in chosen])


def write_archives(pages: DataFrame, out_dir: str, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html", date: str = DATE) -> DataFrame:
    """Write a record per row to archives in ``out_dir``, a folder shared by all executors (a path
    or any URI that Arrow opens): one archive per task.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the largest id is a
    response and the others revisit it; shorter payloads are all responses. Rows that share the
    largest id (repeated rows) are all responses; null ids count as smallest, and a group of null
    ids only is all responses. A null payload is empty; a null or empty url is replaced by the
    record's own URI. Other columns are not read. An empty table writes no archive.

    Returns one row per archive (``path``, ``n_records``, ``n_bytes``), read from a written table:
    archives are complete when it returns. A task that is run again writes an archive of another
    name; only committed ones are listed.
    """
    dictionary = sample_dictionary(pages, id_col, url_col, payload_col)
    rows = with_groups(pages, min_bytes, id_col, url_col, payload_col)
    names = rows.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_folder(out_dir)
        path = f"{root}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        codec = _compressor(dictionary)
        sink, n, size = None, 0, 0
        for batch in batches:
            if batch.num_rows and sink is None:
                fs.create_dir(root, recursive=True)
                sink = fs.open_output_stream(path, compression=None)
                start = dictionary_frame(dictionary) + codec.compress(info_record(date))
                sink.write(start)
                size = len(start)
            ids, urls, payloads, firsts = (batch.column(names.index(c)) for c in (
                "page_id", "url", "payload", "first"))
            for k in range(batch.num_rows):
                page, first = ids[k].as_py(), firsts[k].as_py()
                frame = codec.compress(page_record(
                    page, urls[k].as_py(), payloads[k].as_py(), first,
                    first is not None and page != first, date))
                sink.write(frame)
                n, size = n + 1, size + len(frame)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "n_records": n, "n_bytes": size}],
                pa.schema([("path", pa.string()), ("n_records", pa.int64()),
                           ("n_bytes", pa.int64())]))

    return pages.sparkSession.read.parquet(write_scratch(
        rows.mapInArrow(write, "path string, n_records long, n_bytes long"), "warc-archives"))


def read_archives(archives: DataFrame, out_dir: str, with_payload: bool = False) -> DataFrame:
    """Every page record of the archives, read back from the files (a task reads whole archives).

    Returns ``page_id``, ``payload_bytes``, ``payload_digest`` (base32 SHA-1; both of the full
    payload, also for revisits), ``record_type``, ``refers_to`` and, if asked for, ``target`` and
    ``payload`` (null for revisits). Lengths, digests and frame checksums are verified.
    """
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()),
             ("refers_to", pa.int64())]
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long")
    if with_payload:
        kinds += [("target", pa.string()), ("payload", pa.binary())]
        schema += ", target string, payload binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = shared_folder(out_dir)[0]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(path, compression=None) as source:
                    held, size = [], 0
                    for raw in read_records(source):
                        page = parse_record(raw)
                        if page is not None:
                            held.append(page)
                            size += len(raw) if with_payload else 100
                        if size > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(held, pa.schema(kinds))
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, pa.schema(kinds))

    n = max(1, archives.count())
    return archives.select("path").repartitionByRange(n, "path").mapInArrow(read, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared scratch space."""
    return scratch_path(spark, f"warc-{uuid.uuid4().hex}")
