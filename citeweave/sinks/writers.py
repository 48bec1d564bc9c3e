"""Writers: collated JSONL buckets, tables, per-sample splits, reports, sorted JSONL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


TABLE_COMMENT = "table_comment"
# Writer options: gzip files are read by any tool whatever the effort spent on them, and the default
# effort takes more time than all else that is done to a row of a table or collection.
FAST_GZIP = {"zlib.compress.level": "BEST_SPEED"}


def write_collection(collated: DataFrame, out: str, mode: str = "overwrite",
                     num_partitions: int | None = None) -> None:
    """gzip JSONL under ``parse_type=<t>/prefix=<p>/``, rows in UUID order.

    Rows are range-partitioned on (parse_type, prefix, uuid) and sorted inside each task, so every
    output file holds a contiguous UUID range of one bucket, and a bucket holding a large share of
    the rows is split over several tasks (several files, in name order) instead of one. The range
    partitioner reads its input twice; give it a written table where the input is costly. Only the
    buckets that are written are replaced, by an option of this one write (the session is not
    changed), so a resumed run leaves finished buckets untouched. ``collated`` has ``parse_type``,
    ``prefix``, ``uuid`` and either ``line`` (the JSON line as it is) or the record's columns.
    """
    n = num_partitions or int(collated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["parse_type", "prefix", "uuid"]
    ordered = collated.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("uuid")
    if "line" in collated.columns:
        ordered = ordered.select("line", "parse_type", "prefix")
    writer = (ordered.write.mode(mode).partitionBy("parse_type", "prefix")
              .options(**FAST_GZIP).option("partitionOverwriteMode", "dynamic")
              .option("compression", "gzip"))
    (writer.text if "line" in collated.columns else writer.json)(out)


def write_table(df: DataFrame, out: str, partition_by: list[str] | None = None,
                compression: str = "gzip", mode: str = "overwrite",
                max_records_per_file: int | None = None) -> None:
    """Parquet table; gzip by default for parity with the published files."""
    writer = df.write.mode(mode).options(**FAST_GZIP).option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)


def write_bucketed_table(df: DataFrame, name: str, path: str, key: str = "paper_id",
                         num_buckets: int = 1024, compression: str = "gzip",
                         mode: str = "overwrite") -> None:
    """Catalog table at ``path`` bucketed and sorted by ``key``.

    Tables written with the same key and bucket count (papers, mentions, assessments by
    ``paper_id``) are joined on that key without a shuffle on either side, and an aggregation
    grouped by a superset of the key reuses the bucketing too.
    """
    (df.write.mode(mode).option("compression", compression).option("path", path)
     .bucketBy(num_buckets, key).sortBy(key).saveAsTable(name))
    comment = comment_of_table(df)
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{text}'")


def write_samples(sampled: DataFrame, out: str, sample_col: str = "sample",
                  mode: str = "overwrite") -> None:
    """One folder per sample (``sample=0``, ``sample=1``, ...), in a single pass over the rows.
    An overwrite removes the samples of earlier runs, whatever the session's overwrite mode."""
    (sampled.write.mode(mode).partitionBy(sample_col).option("partitionOverwriteMode", "static")
     .option("compression", "gzip").parquet(out))


def write_report(df: DataFrame, out: str, sep: str = ";", mode: str = "overwrite") -> None:
    """``a;b;c`` text lines, fields joined as they are (no CSV quoting, so a summary that itself
    contains ``;`` is printed as is). A globally sorted frame is written as range partitions, so
    the part files in name order hold the lines in order (no single-task funnel)."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(out)


def read_report_lines(spark, out: str) -> list[str]:
    """The lines of a small report in order (for tests and command-line printing); read by Spark,
    so ``out`` may be on any storage."""
    lines = spark.read.text(out).select(
        "value", F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    return [r["value"] for r in lines.orderBy("file", "block", "at").collect()]


def write_id_map(papers: DataFrame, out: str) -> None:
    """(paper_id, uuid) CSV for interchange; not needed inside one Spark job."""
    (papers.select("paper_id", "source_uuid").write.mode("overwrite")
     .option("header", False).csv(out))


def table_comment(df: DataFrame, column: str) -> str | None:
    """The comment stored on a column, if any."""
    meta = df.schema[column].metadata
    return meta.get("comment") if meta else None


def with_table_comment(df: DataFrame, comment: str) -> DataFrame:
    """Attach a comment on the whole table. Spark keeps metadata by field only, so it is stored with
    the first one, beside that column's own comment; it survives Parquet."""
    first = df.schema.fields[0]
    meta = {**(first.metadata or {}), TABLE_COMMENT: comment}
    return df.select(F.col(first.name).alias(first.name, metadata=meta),
                     *[F.col(c) for c in df.columns[1:]])


def comment_of_table(df: DataFrame) -> str | None:
    """The comment that :func:`with_table_comment` has stored, if any."""
    return (df.schema.fields[0].metadata or {}).get(TABLE_COMMENT) if df.columns else None


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments (kept in the Parquet schema metadata)."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments
                       else F.col(c) for c in df.columns])
