"""Registered queries of jobs that read a tree of raw files, write reports, or keep state between
runs: each builds its input files from the driver's tables under the shared scratch folder, runs the
job, and returns what it left behind."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.operators import counts, registry
from citeweave.operators.keys import dense_ids
from citeweave.plans import analogues as A
from citeweave.plans import jobs
from citeweave.schemas import PARSE_SUFFIXES
from citeweave.session import scratch_path, write_scratch
from citeweave.sources import jsonl


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def write_files(rows: DataFrame, root: str) -> None:
    """One file per row (``path`` under ``root``, ``text``): fixtures for the jobs below. Spark's
    own writers choose their file names."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remote = "://" in root or root.startswith("file:")
        fs, base = pafs.FileSystem.from_uri(root) if remote else (pafs.LocalFileSystem(), root)
        for batch in batches:
            paths, texts = (batch.column(k).to_pylist() for k in (0, 1))
            for path, text in zip(paths, texts):
                fs.create_dir(f"{base}/{path.rpartition('/')[0]}", recursive=True)
                with fs.open_output_stream(f"{base}/{path}") as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(paths)])], ["n"])

    write_scratch(rows.select("path", "text").mapInArrow(write, "n long"), "files-written")


def _in_file_order(lines: DataFrame, position: str) -> DataFrame:
    """The lines of a written report (``value``) with their numbers in file order."""
    placed = lines.select("value", F.col("_metadata.file_name").alias("name"),
                          F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("at"))
    return dense_ids(placed, ["name", "block", "at"], id_col=position).select(position, "value")


def _page_tree(spark, d) -> str:
    """Every page as a JSON file in the folder of its bucket; the names have all kinds."""
    pages = A.table(spark, d, "pages").select("page_id", "url", "html")
    named = pages.join(A._page_file_names(spark, d), "page_id")
    root = _folder(spark, "raw-tree")
    write_files(named.select(
        F.concat_ws("/", F.substring(A._uuid_of(F.col("url")), 1, 2), "page_id", "name")
        .alias("path"), F.to_json(F.struct("page_id", "html")).alias("text")), root)
    return root


def collated_tree(spark, d):
    """Every classified file of a raw tree, collated and read back by parse type."""
    out = _folder(spark, "collection")
    jobs.collate_tree(spark, _page_tree(spark, d), out, prefixes_per_job=64)
    schema = T.StructType.fromDDL("page_id long, html string, file string")
    parts = [jsonl.read_collated(spark, out, schema, t)
             .withColumn("parse_type", F.lit(t))
             for t in sorted({t for t, _ in PARSE_SUFFIXES})]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.select("parse_type", "bucket", "file", "page_id", F.md5("html").alias("html_md5"))


def collation_ledger(spark, d):
    """What the ledger says of that tree when the job is done."""
    out = _folder(spark, "collection")
    jobs.collate_tree(spark, _page_tree(spark, d), out, prefixes_per_job=64)
    return jobs.collation_ledger(spark, out)


def residual_tree(spark, d):
    """Files of a raw tree that no parse type takes, found group by group."""
    found = jobs.residual_report(spark, _page_tree(spark, d), _folder(spark, "residuals"),
                                 prefixes_per_job=64)
    return found.select(F.element_at(F.split("path", "/"), -2).cast("long").alias("page_id"),
                        "name", "length")


def converted_mentions(spark, d):
    """Mention files of a raw tree → slim table → written ranking of names, read in file order."""
    lines = A._documents_as_records(spark, d)
    mention = F.transform("lines", lambda x: F.struct(F.struct(
        x.alias("normalizedForm")).alias("software-name")))
    root, out, report = (_folder(spark, n) for n in ("raw-tree", "slim", "report"))
    own = A._uuid_of(F.col("doc_id"))
    write_files(lines.select(
        F.concat(F.substring(own, 1, 1), F.lit("/"), own, F.lit(".software.json")).alias("path"),
        F.to_json(F.struct(mention.alias("mentions"))).alias("text")), root)
    jobs.mentions_convert(spark, root, out, prefixes_per_job=8, counts_out=report)
    ranked = _in_file_order(spark.read.text(report), "rank")
    n = F.substring_index("value", ";", -1)
    return ranked.select("rank", F.expr("left(value, length(value) - length(substring_index("
                                        "value, ';', -1)) - 1)").alias("normalized_form"),
                         n.cast("long").alias("n"))


def profile_report(spark, d):
    """JSON lines in files, profiled by the job; the written report in file order."""
    src, report = _folder(spark, "json-lines"), _folder(spark, "report")
    docs = A._json_documents(spark, d).select(
        F.regexp_replace("j", MIXED_VALUE, '"mixed":0').alias("value"))
    docs.write.text(src)
    jobs.json_stats(spark, src, report)
    return _in_file_order(spark.read.text(report), "line_number").select(
        "line_number", F.col("value").alias("line"))


def licence_report(spark, d):
    """Identifier records → typed table → written licence ranking in file order."""
    src, typed, report = (_folder(spark, n) for n in ("identifiers", "typed", "report"))
    A._identifier_records(spark, d).drop("page_id").write.json(src)
    jobs.paper_id_convert(spark, f"{src}/*.json", typed)
    jobs.license_count(spark, typed, report)
    return _in_file_order(spark.read.text(report), "rank").select(
        "rank", F.col("value").alias("line"))


def registered_ids(spark, d):
    """Orders registered in three appends, each with the earlier ones among them: ids stay."""
    root = _folder(spark, "registry")
    orders = A.table(spark, d, "orders").select(A._uuid_of(F.col("o_orderkey"))
                                                .alias("source_uuid"), "o_orderdate")
    for last in APPENDS:
        part = orders if last is None else orders.where(F.col("o_orderdate") < F.lit(last).cast("date"))
        held = registry.append_keys(part, root)
    return held


def rejected_files(spark, d):
    """A tree with files that are not one JSON object: what a lenient collation leaves out."""
    pages = A.table(spark, d, "pages").select("page_id", "url", "html")
    text = (F.when(F.col("page_id") % 5 == 0, F.lit('{"page_id":'))
            .when(F.col("page_id") % 5 == 1, F.lit("[1, 2]"))
            .otherwise(F.to_json(F.struct("page_id", "html"))))
    root, out = _folder(spark, "raw-tree"), _folder(spark, "collection")
    write_files(pages.join(A._page_file_names(spark, d), "page_id").select(
        F.concat_ws("/", F.substring(A._uuid_of(F.col("url")), 1, 1), "page_id", "name")
        .alias("path"), text.alias("text")), root)
    jobs.collate_tree(spark, root, out, strict=False)
    return jobs.rejected_files(spark, out).select("folder", "parse_type", "file", "reason")


def rejected_lines(spark, d):
    """Lines that a lenient sort leaves out."""
    src, out, bad = (_folder(spark, n) for n in ("lines", "sorted", "rejected"))
    docs = A.table(spark, d, "documents").select("doc_id", A._uuid_of(F.col("doc_id")).alias("u"))
    docs.select(F.concat(
        F.lit('{"doc_id":'), F.col("doc_id").cast("string"), F.lit(',"file":'),
        F.when(F.col("doc_id") % 4 == 0, F.lit('"none"}')).when(F.col("doc_id") % 4 == 1, F.lit(""))
        .otherwise(F.concat(F.lit('"'), "u", F.lit('.json"}')))).alias("value")).write.text(src)
    jobs.sort_jsonl(spark, src, out, rejected=bad)
    kept = spark.read.text(out).select(F.get_json_object("value", "$.doc_id").cast("long")
                                       .alias("doc_id"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(spark.read.parquet(bad).select(
        F.regexp_extract("value", "[0-9]+", 0).cast("long").alias("doc_id"), "reason"))


def last_lines(spark, d):
    """The last record of each UUID over two folders of JSON lines, in order."""
    src, out = _folder(spark, "lines"), _folder(spark, "sorted")
    docs = A.table(spark, d, "documents").select("doc_id", "lang", "text", F.concat(
        A._uuid_of(F.col("doc_id")), F.lit(".json")).alias("file"))
    docs.write.json(f"{src}/a")
    docs.where("lang = 'en'").withColumn("text", F.md5("text")).write.json(f"{src}/b")
    jobs.sort_jsonl(spark, src, out, last_only=True)
    lines = spark.read.text(out).select(
        F.col("_metadata.file_name").alias("name"), F.monotonically_increasing_id().alias("at"),
        F.from_json("value", "doc_id long, text string").alias("r"))
    # gzip files are read whole, each in one task: its rows count up in the order of its lines.
    return dense_ids(lines.select("name", "at", "r.doc_id", F.md5("r.text").alias("text_md5")),
                     ["name", "at"], id_col="position").select("position", "doc_id", "text_md5")


def co_words(spark, d):
    """Pairs of words (texts as items, so encoded) that share enough documents."""
    words = A.table(spark, d, "documents").select(
        "doc_id", F.explode(F.split("text", " ")).alias("word")).where("word != ''")
    return counts.co_occurrence_counts(words, "doc_id", "word", None, WORD_SUPPORT, WORD_SUPPORT,
                                       left="word_a", right="word_b")


# The value of the key whose type differs between documents (the strict job would stop there).
MIXED_VALUE = '"mixed":("[a-z]*"|[0-9]+)'
WORD_SUPPORT = 250
APPENDS = ("1997-01-01", "1999-06-01", None)

QUERIES = {f.__name__: f for f in (
    collated_tree, collation_ledger, residual_tree, converted_mentions, profile_report,
    licence_report, registered_ids, rejected_files, rejected_lines, last_lines, co_words)}


def oracle(base: dict[str, str]) -> dict[str, str]:
    from citeweave.plans import oracle as O

    kind, bucket = O._classify("name"), f"substr({O._uuid_sql('url')}, 1, 2)"
    named = (f"SELECT p.page_id, p.url, p.html, f.name, {kind} AS parse_type, {bucket} AS folder "
             f"FROM pages p JOIN ({O._FILE_NAMES}) f USING (page_id)")
    profile_docs = f"""(SELECT regexp_replace(j, {O._q(MIXED_VALUE)}, '"mixed":0') AS j
                        FROM ({O._JSON_DOCS})) docs"""
    report = base["json_report"].replace(f"({O._JSON_DOCS}) docs", profile_docs)
    order = f"{O._uuid_sql('o_orderkey')}"
    generation = " ".join(f"WHEN o_orderdate < DATE '{day}' THEN {k}"
                          for k, day in enumerate(APPENDS[:-1], 1))
    return {
        "collated_tree": f"""
            SELECT parse_type, folder AS bucket, name AS file, page_id, md5(html) AS html_md5
            FROM ({named}) WHERE parse_type IS NOT NULL""",
        "collation_ledger": f"""
            WITH n AS ({named}),
                 f AS (SELECT folder, count(*) FILTER (WHERE name LIKE '%.json') AS n_files
                       FROM n GROUP BY 1),
                 r AS (SELECT folder, parse_type, count(*) AS n_records FROM n
                       WHERE parse_type IS NOT NULL GROUP BY 1, 2)
            SELECT folder, parse_type, coalesce(n_records, 0) AS n_records, n_files
            FROM f LEFT JOIN r USING (folder)""",
        "residual_tree": f"""
            SELECT page_id, name, strlen('{{"page_id":' || page_id || ',"html":' || to_json(html)
                                         || '}}')::BIGINT AS length
            FROM ({named}) WHERE parse_type IS NULL""",
        "converted_mentions": f"""
            SELECT row_number() OVER (ORDER BY n DESC, normalized_form) AS rank, normalized_form, n
            FROM ({base['slim_name_counts']})""",
        "profile_report": f"""
            SELECT row_number() OVER (ORDER BY path) AS line_number, path || ';' || summary AS line
            FROM ({report})""",
        "licence_report": f"""
            {O._ID_RECORDS},
            c AS (SELECT t.licence_name, count(r.page_id) AS n FROM {O._CANON}
                  LEFT JOIN recs r ON r.code = t.license GROUP BY 1)
            SELECT row_number() OVER (ORDER BY n DESC, licence_name) AS rank,
                   licence_name || ';' || n AS line FROM c""",
        "rejected_files": f"""
            SELECT substr(folder, 1, 1) AS folder, parse_type, name AS file,
                   CASE page_id % 5 WHEN 0 THEN 'malformed JSON' ELSE 'not a JSON object' END
                     AS reason
            FROM ({named}) WHERE parse_type IS NOT NULL AND page_id % 5 < 2""",
        "rejected_lines": """
            SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'no UUID in file'
                                WHEN 1 THEN 'malformed JSON' END AS reason FROM documents""",
        "last_lines": f"""
            SELECT row_number() OVER (ORDER BY {O._uuid_sql('doc_id')}) AS position, doc_id,
                   md5(CASE WHEN lang = 'en' THEN md5(text) ELSE text END) AS text_md5
            FROM documents""",
        "co_words": f"""
            WITH p AS (SELECT DISTINCT doc_id, unnest(string_split(text, ' ')) AS w FROM documents),
                 s AS (SELECT * FROM p WHERE w IN (
                           SELECT w FROM p WHERE w <> '' GROUP BY w
                           HAVING count(*) >= {WORD_SUPPORT}))
            SELECT a.w AS word_a, b.w AS word_b, count(*) AS n
            FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.w < b.w
            GROUP BY 1, 2 HAVING count(*) >= {WORD_SUPPORT}""",
        "registered_ids": f"""
            SELECT source_uuid, row_number() OVER (ORDER BY generation, source_uuid) AS paper_id,
                   generation
            FROM (SELECT {order} AS source_uuid,
                         CASE {generation} ELSE {len(APPENDS)} END AS generation FROM orders)""",
    }
