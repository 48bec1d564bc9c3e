"""Registered queries of sources, sinks and jobs: each writes the driver's tables in one of the
library's formats under the shared scratch folder, runs the job or reader, and returns what it
reads back, so the whole path is compared with SQL over the original tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.operators import collate, tables
from citeweave.operators.keys import dense_ids
from citeweave.plans import analogues as A
from citeweave.plans import jobs
from citeweave.session import materialize, scratch_path, scratch_scope
from citeweave.sinks import writers
from citeweave.sources import jsonl
from citeweave.sources import tables as table_sources


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _write_collection(spark: SparkSession, records: DataFrame, out: str, mode: str,
                      bucket_width: int = 2) -> None:
    """Records with a ``file`` name as a collated collection: objects copied, bucket by UUID."""
    fields = [c for c in records.columns if c not in ("file", "bucket")]
    text = records.select("file", F.to_json(F.struct(*fields)).alias("text"))
    tagged = collate.collate_records(text, "file", bucket_width=bucket_width)
    lines = tagged.withColumn("line", collate.copied_object("text", "file")).drop("text", "file")
    with scratch_scope(spark):
        writers.write_collection(materialize(lines, "collection-lines"), out, mode)


def collection_roundtrip(spark, d):
    docs = A.table(spark, d, "documents")
    name = F.concat(A._uuid_of(F.col("doc_id")), F.lit(".json"))
    out = _folder(spark, "collection")
    _write_collection(spark, docs.select(name.alias("file"), "doc_id", "text", "lang", "n_chars"),
                      out, "overwrite")
    schema = T.StructType.fromDDL("doc_id long, text string, lang string, n_chars long, "
                                  "file string")
    return jsonl.read_collated(spark, out, schema, "paper")


def _extracted(spark, d) -> str:
    """Papers and mentions of the built analogues as a collection, and the job's tables."""
    coll, out = _folder(spark, "collection"), _folder(spark, "tables")
    _write_collection(spark, A._paper_records(spark, d), coll, "overwrite", 1)
    _write_collection(spark, A._mention_records(spark, d), coll, "overwrite", 1)
    jobs.extract_tables(spark, coll, out, "pdf")
    return out


def extracted_papers(spark, d):
    return table_sources.read_tables(spark, _extracted(spark, d), "pdf")[0]


def extracted_mentions(spark, d):
    return table_sources.read_tables(spark, _extracted(spark, d), "pdf")[1]


def extracted_assessments(spark, d):
    return table_sources.read_tables(spark, _extracted(spark, d), "pdf")[2]


def subsampled_children(spark, d):
    """Orders as papers and their lines as mentions and assessments, sampled by the job."""
    folder, out = _folder(spark, "tables"), _folder(spark, "samples")
    writers.write_table(A._eligible_orders(spark, d).select(
        F.col("o_orderkey").alias("paper_id"), F.col("has_lines").alias("has_mentions")),
        f"{folder}/papers.parquet")
    lines = A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper_id"),
                                                 "l_linenumber", "l_partkey")
    for name in ("mentions", "purpose_assessments"):
        writers.write_table(lines, f"{folder}/{name}.pdf.parquet")
    jobs.subsample(spark, folder, out, A.SEED, A.FRACTIONS)
    return spark.read.parquet(f"{out}/mentions.pdf").select(
        F.col("paper_id").alias("l_orderkey"), "l_linenumber", "l_partkey", "sample")


def sorted_lines(spark, d):
    """Documents as JSON lines, sorted by the job; the position of each line in the output."""
    src, out = _folder(spark, "lines"), _folder(spark, "sorted")
    docs = A.table(spark, d, "documents").select("doc_id", "text", F.concat(
        A._uuid_of(F.col("doc_id")), F.lit(".json")).alias("file"))
    docs.write.json(src)
    jobs.sort_jsonl(spark, src, out)
    lines = spark.read.text(out).select(
        F.col("_metadata.file_name").alias("name"), F.monotonically_increasing_id().alias("at"),
        F.from_json("value", "doc_id long, text string, file string").alias("r"))
    # gzip files are read whole, each in one task: its rows count up in the order of its lines.
    return dense_ids(lines.select("name", "at", "r.doc_id", F.md5("r.text").alias("text_md5")),
                     ["name", "at"], id_col="position").select("position", "doc_id", "text_md5")


def reported_top_items(spark, d):
    """The counting job over order lines: its ranking."""
    return jobs.mentions_count(
        A._order_parts(spark, d), owner="l_orderkey", item="l_partkey", stop_list=A.STOP_PARTS,
        min_support=A.MIN_ITEM_SUPPORT, top_items=A.TOP_ITEMS)["top_items"]


def ranking_lines(spark, d):
    """A ranking report as text lines, read back."""
    out = _folder(spark, "report")
    top = A.top_items(spark, d).select("rank", "l_partkey", "n").orderBy("rank")
    writers.write_report(top, out)
    return spark.read.text(out).select(F.col("value").alias("line"))


def converted_ids(spark, d):
    """Identifier records as JSON lines, converted by the job without the optional column."""
    src, out = _folder(spark, "identifiers"), _folder(spark, "typed")
    A._identifier_records(spark, d).drop("page_id").write.json(src)
    jobs.paper_id_convert(spark, f"{src}/*.json", out, keep_oa_link=False)
    typed = spark.read.parquet(out)
    return typed.select(F.hex("id").alias("id_hex"), "pmid", F.col("pmcid.id").alias("pmcid_id"),
                        F.hex("istex_id").alias("istex_hex"),
                        F.array_join("resources", ",").alias("resource_codes"), "license",
                        F.col("oa_link").isNull().alias("no_link"))


def id_map_roundtrip(spark, d):
    out = _folder(spark, "id-map")
    writers.write_id_map(A.built_papers(spark, d), out)
    return table_sources.read_id_map(spark, out)


def listed_keys_flag(spark, d):
    """Orders flagged by a written list of the keys that have lines (SRC-6)."""
    out = _folder(spark, "uuid-list")
    lines = A.table(spark, d, "lineitem").select(A._uuid_of(F.col("l_orderkey")).alias("value"))
    lines.distinct().write.text(out)
    orders = A.table(spark, d, "orders").select("o_orderkey", A._uuid_of(F.col("o_orderkey"))
                                                .alias("source_uuid"))
    return tables.existence_flag(orders, table_sources.read_uuid_list(spark, out), "source_uuid",
                                 "listed").select("o_orderkey", "listed")


def dense_ids_payload(spark, d):
    """Ids over rows with columns that are not part of the order."""
    orders = A.table(spark, d, "orders").select("o_orderdate", "o_orderkey", "o_custkey",
                                                "o_totalprice")
    return dense_ids(orders, ["o_orderdate", "o_orderkey"], id_col="order_id")


QUERIES = {f.__name__: f for f in (
    collection_roundtrip, extracted_papers, extracted_mentions, extracted_assessments,
    subsampled_children, sorted_lines, reported_top_items, ranking_lines,
    converted_ids, id_map_roundtrip, listed_keys_flag, dense_ids_payload)}


def oracle(base: dict[str, str]) -> dict[str, str]:
    """SQL of the queries; those that only take another way to a known result reuse its SQL."""
    digits = "md5(CAST(doc_id AS VARCHAR))"
    hexed = (f"substr({digits},1,8) || '-' || substr({digits},9,4) || '-' || substr({digits},13,4)"
             f" || '-' || substr({digits},17,4) || '-' || substr({digits},21,12)")
    return {
        "collection_roundtrip": f"""
            SELECT doc_id, text, lang, n_chars, {hexed} || '.json' AS file,
                   substr({digits}, 1, 2) AS bucket FROM documents""",
        "extracted_papers": base["built_papers"],
        "extracted_mentions": base["built_mentions"],
        "extracted_assessments": base["built_assessments"],
        "subsampled_children": base["sampled_children"],
        "sorted_lines": f"""
            SELECT row_number() OVER (ORDER BY {hexed}) AS position, doc_id, md5(text) AS text_md5
            FROM documents""",
        "reported_top_items": base["top_items"],
        "ranking_lines": f"""
            SELECT rank || ';' || l_partkey || ';' || n AS line FROM ({base["top_items"]})""",
        "converted_ids": f"""
            SELECT id_hex, pmid, pmcid_id, istex_hex, resource_codes, license, true AS no_link
            FROM ({base["typed_ids"]})""",
        "id_map_roundtrip": f"SELECT paper_id, source_uuid FROM ({base['built_papers']})",
        "listed_keys_flag": """
            SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS listed
            FROM orders""",
        "dense_ids_payload": """
            SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id, o_orderdate,
                   o_orderkey, o_custkey, o_totalprice FROM orders""",
    }
