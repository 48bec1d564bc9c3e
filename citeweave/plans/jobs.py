"""One function per command of the original tool set, composed from operators, sources and sinks.

Every job takes a session and paths, builds one declarative plan (or a few), and writes with
the Spark writers. No job collects data-sized results to the driver.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave import storage
from citeweave.operators import (analyses, collate, counts, identifiers, profile, quarantine,
                                 registry, sampling, slim, tables)
from citeweave.operators.keys import dense_ids
from citeweave.schemas import (DEFAULT_MIN_SUPPORT, DEFAULT_SAMPLE_FRACTIONS, GENERIC_SOFTWARE_NAMES,
                               MENTION_JSON, PAPER_JSON, TABLE_COMMENTS)
from citeweave.sinks import writers
from citeweave.sources import jsonl, raw_tree
from citeweave.sources import tables as table_sources
from citeweave.session import materialize, scratch_scope, write_scratch


def _folder_groups(spark: SparkSession, raw_root: str, size: int) -> list[list[str]]:
    """Top-level folders of the raw tree, whatever their names, in groups of ``size``."""
    dirs = [n for n, is_dir in storage.entries(spark, raw_root) if is_dir]
    return [dirs[i:i + size] for i in range(0, len(dirs), size)]


def _raw_texts(spark: SparkSession, raw_root: str, folders: Sequence[str], glob: str,
               open_cost_bytes: int = 64 * 1024) -> DataFrame:
    """Whole texts of the files in these folders; Spark lists a storage only it can open."""
    if raw_tree.can_walk(spark, raw_root):
        return raw_tree.read_walked_text(spark, raw_root, folders, glob, open_cost_bytes)
    return raw_tree.read_raw_text(spark, [os.path.join(raw_root, f) for f in folders], glob,
                                  folder_of=raw_root)


# JOB-1 -----------------------------------------------------------------------------------------

LEDGER, REJECTED = "_ledger", "_rejected"


def collation_ledger(spark: SparkSession, out: str) -> DataFrame:
    """What is finished in a collection: one row per folder and parse type (``folder``,
    ``parse_type``, ``n_records``, ``n_files``: all ``.json`` files of the folder, whatever their
    type). A folder without any classified file has one row with a null parse type."""
    schema = "folder string, parse_type string, n_records long, n_files long"
    if LEDGER not in storage.children(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out}/{LEDGER}")


def _ledger_rows(tagged: DataFrame, folders: Sequence[str]) -> DataFrame:
    """Ledger rows of the folders just collated, from their written lines."""
    spark = tagged.sparkSession
    files = tagged.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_files"))
    records = tagged.where("parse_type IS NOT NULL").groupBy("prefix", "parse_type").agg(
        F.count(F.lit(1)).alias("n_records"))
    listed = spark.createDataFrame([(f,) for f in folders], "prefix string")
    return listed.join(files, "prefix", "left").join(records, "prefix", "left").select(
        F.col("prefix").alias("folder"), "parse_type",
        F.coalesce("n_records", F.lit(0)).cast("long").alias("n_records"),
        F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"))


def _buckets(spark: SparkSession, out: str, folders: Sequence[str]) -> list[str]:
    """Paths of the buckets that a collection holds of these folders."""
    return [f"{out}/{t}/{p}" for t in storage.children(spark, out) if t.startswith("parse_type=")
            for p in storage.children(spark, f"{out}/{t}")
            if unquote(p.removeprefix("prefix=")) in folders] + [
        f"{out}/{REJECTED}/{p}" for p in storage.children(spark, f"{out}/{REJECTED}")
        if unquote(p.removeprefix("folder=")) in folders]


def collate_tree(spark: SparkSession, raw_root: str, out: str, resume: bool = True,
                 prefixes_per_job: int = 8, open_cost_bytes: int = 64 * 1024,
                 strict: bool = True) -> list[str]:
    """Raw tree → JSONL partitioned by parse type and top-level folder; returns the folders
    processed.

    Every top-level folder is taken, and its name is the bucket of its files. Objects are copied as
    they are (see ``collate.copied_object``); a file that is not one JSON object is an error, or,
    with ``strict=False``, a row of the folder's rejected files (:func:`rejected_files`).
    Pending folders are collated ``prefixes_per_job`` at a time; tasks list and read the ~100 M
    files (``raw_tree.read_walked_text``), so no listing goes through the driver. A group is entered in the ledger (:func:`collation_ledger`) once all
    its buckets are committed; with ``resume`` only folders that are not in the ledger are pending.
    So a run that broke between two buckets is redone for its whole group, and a folder that lacks
    some parse type, or holds nothing to collate, is done all the same. Buckets of a pending folder
    that an earlier run left behind are removed first. Raw files are a few KB each;
    ``open_cost_bytes`` is lowered for this read so a task packs thousands of files. Each file is
    read once.
    """
    folders = [n for n, is_dir in storage.entries(spark, raw_root) if is_dir]
    if resume:
        done = {r["folder"] for r in collation_ledger(spark, out).select("folder").distinct()
                .collect()}
        folders = [f for f in folders if f not in done]
    else:
        storage.delete(spark, f"{out}/{LEDGER}")
    with raw_tree.many_small_files(spark, open_cost_bytes):
        for start in range(0, len(folders), prefixes_per_job):
            group = folders[start:start + prefixes_per_job]
            storage.delete(spark, *_buckets(spark, out, group))
            # Written once, so that the range partitioner's two passes do not open raw files twice.
            with scratch_scope(spark):
                records = _raw_texts(spark, raw_root, group, "*.json", open_cost_bytes)
                tagged = collate.tagged_records(records, "_file_name", "_folder").drop("_folder")
                if strict:
                    written = materialize(_collated_lines(tagged), "collated-lines")
                    taken = written.where("parse_type IS NOT NULL")
                else:
                    parts = quarantine.split(tagged, F.when(
                        F.col("parse_type").isNotNull(), quarantine.not_an_object(F.col("text"))),
                        "collation")
                    written = parts.accepted
                    taken = _collated_lines(written.where("parse_type IS NOT NULL"))
                    if parts.n_rejected:
                        parts.rejected.withColumnRenamed("prefix", "folder").select(
                            "folder", "parse_type", "file", "text", "reason").write.mode(
                            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                            "folder").parquet(f"{out}/{REJECTED}")
                writers.write_collection(taken, out)
                _ledger_rows(written, group).write.mode("append").parquet(f"{out}/{LEDGER}")
    return folders


def _collated_lines(tagged: DataFrame) -> DataFrame:
    return tagged.withColumn("line", F.when(
        F.col("parse_type").isNotNull(), collate.copied_object("text", "file"))).drop("text", "file")


def rejected_files(spark: SparkSession, out: str) -> DataFrame:
    """Files that collations with ``strict=False`` left out: ``folder``, ``parse_type``, ``file``,
    ``text``, ``reason``. The ledger counts accepted files only."""
    schema = "parse_type string, file string, text string, reason string, folder string"
    if REJECTED not in storage.children(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out}/{REJECTED}")


# JOB-2, JOB-3 ----------------------------------------------------------------------------------

def _collection(spark: SparkSession, collection: str, schema, parse_type: str,
                repartition: int | None) -> DataFrame:
    """Records of one parse type from what ``collate_tree`` wrote (``parse_type=…/prefix=…``) or
    from ``<bucket><suffix>.jsonl[.gz]`` files. No matching file is an error."""
    if any(name.startswith("parse_type=") for name in storage.children(spark, collection)):
        stored = {"papers": "paper"}.get(parse_type, parse_type)
        if f"parse_type={stored}" not in storage.children(spark, collection):
            raise FileNotFoundError(f"no {parse_type} records in {collection}")
        df = jsonl.read_collated(spark, collection, schema, stored)
        return df.repartition(repartition) if repartition else df
    df = jsonl.read_collection(spark, collection, schema, parse_type, repartition=repartition)
    if not df.inputFiles():
        raise FileNotFoundError(f"no {parse_type} files in {collection}")
    return df


def extract_tables(spark: SparkSession, collection: str, out: str,
                   source_type: str | Sequence[str] = "pdf", strict: bool = True,
                   repartition: int | None = None, table_prefix: str | None = None,
                   num_buckets: int = 1024, id_registry: str | None = None) -> None:
    """Collated JSONL → papers.parquet, and mentions.<type>.parquet and
    purpose_assessments.<type>.parquet for each source type.

    ``has_mentions`` says whether any of the given types has a mention of the paper. The projected
    paper rows, then the papers with their dense ids, are written once to the shared checkpoint
    folder; the mention records of a type are scanned once, exploded against those ids and written
    once as a flat intermediate; the tables are derived from the intermediates, which are deleted
    at the end. With ``strict=False`` rejected rows do not stop the job: they are written to
    ``<out>/rejected.papers`` and ``<out>/rejected.mentions.<type>``.
    With ``table_prefix`` the tables are also registered in the catalog as ``<prefix>papers`` etc.,
    bucketed and sorted by ``paper_id`` (``num_buckets``), so later joins on ``paper_id`` need no
    shuffle (of several source types the names carry the type).
    With ``id_registry`` (a folder) papers keep the ids of earlier runs and new papers are numbered
    behind them (``operators.registry``); a UUID that several paper records share is then an error,
    or, with ``strict=False``, one record stays and the others are among the rejected rows.
    """
    types = [source_type] if isinstance(source_type, str) else list(source_type)
    papers_in = _collection(spark, collection, PAPER_JSON, "papers", repartition)
    mentions_in = {t: _collection(spark, collection, MENTION_JSON, t, repartition) for t in types}

    def write(df: DataFrame, name: str, path: str) -> None:
        df = writers.with_table_comment(df, next(c for t, c in TABLE_COMMENTS.items()
                                                 if name.startswith(t)))
        if table_prefix:
            writers.write_bucketed_table(df, f"{table_prefix}{name}", path,
                                         num_buckets=num_buckets)
        else:
            writers.write_table(df, path)

    with scratch_scope(spark):
        if not strict:
            rejected = tables.paper_violations(papers_in)
            writers.write_table(rejected, f"{out}/rejected.papers")
            papers_in = papers_in.where((F.length("id") == 36)
                                        & tables.is_valid_date_text("published_date"))
        # The range partitioning behind the ids reads its input twice (sampling, then shuffle):
        # give it the projected rows as Parquet rather than the gzip JSON.
        rows = spark.read.parquet(write_scratch(tables.paper_rows(papers_in, strict),
                                                "paper-rows"))
        if id_registry:
            rows, repeated = tables.one_row_per_uuid(rows, strict)
            if not strict:
                writers.write_table(repeated, f"{out}/rejected.repeated_papers")
            rows = materialize(rows, "papers-by-uuid")
            held = registry.append_keys(rows, id_registry, order=["bucket", "source_uuid"])
            with_ids = rows.join(held.drop("generation"), "source_uuid")
        else:
            with_ids = tables.paper_ids(rows)
        core = spark.read.parquet(write_scratch(with_ids, "papers-with-ids"))
        ids = core.select("source_uuid", "paper_id")
        holders = None
        for t in types:
            if not strict:
                keyed = mentions_in[t].withColumn("source_uuid", F.substring("file", 1, 36))
                writers.write_table(tables.lookup_violations(keyed, ids, "source_uuid"),
                                    f"{out}/rejected.mentions.{t}")
            # Both mention tables come from one flat intermediate, so the mention JSON scan, the
            # id lookup join and the explode run once.
            flat = spark.read.parquet(write_scratch(tables.flat_mention_rows(
                tables.mention_rows(mentions_in[t], ids, t, strict)), "mention-rows"))
            named = f"_{t}" if len(types) > 1 else ""
            write(tables.mentions_from_flat(flat), f"mentions{named}", f"{out}/mentions.{t}.parquet")
            write(tables.assessments_from_flat(flat), f"purpose_assessments{named}",
                  f"{out}/purpose_assessments.{t}.parquet")
            found = flat.select("paper_id")
            holders = found if holders is None else holders.unionByName(found)
        write(tables.papers_from_mentions(core, holders), "papers", f"{out}/papers.parquet")


# JOB-4 -----------------------------------------------------------------------------------------

def json_stats(spark: SparkSession, path: str, out: str | None = None,
               name_pattern: str | None = None, mode: str = "FAILFAST",
               rejected: str | None = None) -> DataFrame:
    """Profile of every leaf path in JSONL files, as ``path;summary`` lines sorted by path.

    Folders are read recursively; ``name_pattern`` is a regular expression on file names; a
    malformed line is an error unless ``mode`` is "PERMISSIVE". With ``out`` the report is written
    and the returned frame reads it back, so no scratch table stays; without it the frame reads
    scratch tables that belong to the caller (``session.scratch_scope``).
    With ``rejected`` (a folder) nothing stops the job: malformed lines (``file``, ``value``,
    ``reason``) go to ``<rejected>/lines``, and paths with more than one type to
    ``<rejected>/conflicts``; the report has neither.
    """
    def build() -> DataFrame:
        if rejected is None:
            docs = jsonl.read_variant_lines(spark, path, "v", name_pattern, mode)
            prof, enums = profile.document_parts(docs)
            return profile.profile_summary(profile.raise_on_conflicts(prof), enums)
        lines = jsonl.read_text_lines(spark, path, name_pattern).select(
            F.col("_metadata.file_name").alias("file"), "value")
        parts = quarantine.split(lines, F.when(F.try_parse_json("value").isNull(),
                                               F.lit("malformed JSON")), "profile")
        writers.write_table(parts.rejected, f"{rejected}/lines")
        stats, typed, digested = profile.document_statistics(
            profile.parse_documents(parts.accepted, "value"))
        writers.write_table(profile.statistics_conflicts(stats), f"{rejected}/conflicts")
        prof, enums = profile.statistics_parts(stats, typed, digested)
        return profile.profile_summary(prof.where("kind != 'conflict'"), enums)

    if not out:
        return build()
    with scratch_scope(spark):
        report = build()
        names = report.columns
        writers.write_report(report, out)
    first = F.substring_index("value", ";", 1)
    return spark.read.text(out).select(first.alias(names[0]), F.substring(
        F.col("value"), F.length(first) + 2, F.length("value")).alias(names[1])).orderBy(names[0])


# JOB-5 -----------------------------------------------------------------------------------------

def mentions_count(mentions: DataFrame, owner: str = "paper_id",
                   item: str = "software_normalized",
                   stop_list: Sequence[str] = tuple(GENERIC_SOFTWARE_NAMES),
                   min_support: int = DEFAULT_MIN_SUPPORT, top_items: int = 10,
                   top_pairs: int = 20, out: str | None = None) -> dict[str, DataFrame]:
    """Number of supported items, the top items with rank, and the top co-mentioned pairs.

    With ``out`` the three reports are also written as ``<out>/n_items``, ``<out>/top_items``
    (``rank;name;count``) and ``<out>/top_pairs`` (``rank;name;name;count``). The results are a
    few rows each by their definition (a total and two top lists); they are computed here, and the
    scratch tables behind them are deleted.
    """
    spark = mentions.sparkSession
    with scratch_scope(spark):
        result = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in _counts(
            mentions, owner, item, stop_list, min_support, top_items, top_pairs).items()}
    if out:
        for name, df in result.items():
            writers.write_report(df.orderBy("rank") if "rank" in df.columns else df,
                                 f"{out}/{name}")
    return result


def _counts(mentions: DataFrame, owner: str, item: str, stop_list: Sequence[str],
            min_support: int, top_items: int, top_pairs: int) -> dict[str, DataFrame]:
    support = counts.item_support(mentions, owner, item, stop_list, min_support)
    pairs = counts.co_occurrence_counts(mentions, owner, item, stop_list, min_support,
                                        min_support)
    return {
        "n_items": counts.supported_item_total(support),
        "top_items": counts.top_ranked(support, [F.desc("n"), F.asc(item)], top_items)
        .select("rank", item, "n"),
        "top_pairs": counts.top_ranked(pairs, [F.desc("n"), F.asc("item_a"), F.asc("item_b")],
                                       top_pairs).select("rank", "item_a", "item_b", "n"),
    }


# JOB-6 -----------------------------------------------------------------------------------------

def subsample(spark: SparkSession, folder: str, out: str, seed: int,
              fractions: Sequence[float] = DEFAULT_SAMPLE_FRACTIONS,
              source_type: str = "pdf") -> DataFrame:
    """Write ``out/<table>/sample=<i>`` for the three tables; returns the sample sizes.

    A paper's sample is a hash of (seed, paper_id). Mentions and assessments are routed by
    recomputing it, and semi-joined with the sampled papers, so rows of a paper that is not
    eligible (``has_mentions`` is false although it has rows) stay out. Samples of an earlier run
    are removed.
    """
    papers, mentions, purposes = table_sources.read_tables(spark, folder, source_type)
    sampled = sampling.assign_samples(papers, "paper_id", seed, fractions, "has_mentions")
    writers.write_samples(sampled, f"{out}/papers")
    eligible = spark.read.parquet(f"{out}/papers").select("paper_id")
    for name, df in ((f"mentions.{source_type}", mentions),
                     (f"purpose_assessments.{source_type}", purposes)):
        writers.write_samples(sampling.route_children(df, "paper_id", seed, fractions, eligible),
                              f"{out}/{name}")
    return sampling.sample_sizes(spark.read.parquet(f"{out}/papers"))


# JOB-7, JOB-8 ----------------------------------------------------------------------------------

def paper_id_convert(spark: SparkSession, path: str, out: str, keep_oa_link: bool = True,
                     validate: bool = False, rejected: str | None = None) -> DataFrame | None:
    """Identifier JSONL → typed Parquet; with ``validate`` returns the round-trip violations.
    With ``rejected`` (a folder) records that do not convert are written there with the failing
    field as ``reason``, instead of stopping the job."""
    records = jsonl.read_identifiers(spark, path)
    with scratch_scope(spark):
        if rejected is not None:
            parts = quarantine.split(records, identifiers.violation_reason(), "identifiers")
            writers.write_table(parts.rejected, rejected)
            records = parts.accepted
        writers.write_table(identifiers.typed_identifiers(records, keep_oa_link), out,
                            compression="snappy")
    if rejected is not None:
        records = jsonl.read_identifiers(spark, path).where(
            identifiers.violation_reason().isNull())
    if validate:
        keyed = records.withColumn("row_key", F.monotonically_increasing_id())
        return identifiers.roundtrip_violations(keyed)
    return None


def license_count(spark: SparkSession, typed_path: str, out: str | None = None) -> DataFrame:
    """Papers per licence (all 17 codes), count descending; with ``out`` also the
    ``licence;count`` report."""
    dist = counts.ranked_counts(identifiers.licence_distribution(spark.read.parquet(typed_path)),
                                "licence_name")
    if out:
        writers.write_report(dist.select("licence_name", "n"), out)
    return dist


# JOB-9 -----------------------------------------------------------------------------------------

def mentions_convert(spark: SparkSession, raw_root: str, out: str,
                     parse_suffix: str = ".software.json",
                     prefixes_per_job: int = 8, counts_out: str | None = None) -> DataFrame:
    """Per-paper mention files → slim mention table; returns name occurrence counts (desc).

    The tree is read one group of prefix folders per job, listed in tasks; each group appends its
    part of the table. With ``counts_out`` the ``name;count`` report is written too.
    """
    mode = "overwrite"
    with raw_tree.many_small_files(spark):
        for group in _folder_groups(spark, raw_root, prefixes_per_job):
            with scratch_scope(spark):
                texts = _raw_texts(spark, raw_root, group, "*" + parse_suffix)
                texts = texts.where(F.col("_file_name").endswith(parse_suffix)
                                    & (F.length(F.col("_file_name")) == 36 + len(parse_suffix)))
                # As the file reader does: a byte order mark is no text, an array is many records.
                objects = F.from_json(F.regexp_replace("text", "^\ufeff", ""),
                                      T.ArrayType(MENTION_JSON), {"mode": "FAILFAST"})
                records = texts.select("_file_name", F.inline(objects))
                writers.write_table(slim.slim_mentions(records), out, compression="snappy",
                                    mode=mode)
            mode = "append"
    ranked = counts.ranked_counts(slim.name_occurrences(spark.read.parquet(out)),
                                  "normalized_form")
    if counts_out:
        writers.write_report(ranked, counts_out)
    return ranked


# JOB-10 ----------------------------------------------------------------------------------------

def sort_jsonl(spark: SparkSession, path: str, out: str, last_only: bool = False,
               rejected: str | None = None) -> None:
    """Sort JSONL records by the UUID in ``file``; optionally keep only the last record per UUID.

    Records of one UUID are ordered by file path, then by their place in the file (its block, and
    the running number inside the block's task). A malformed line, or a record without a UUID, is an
    error, or, with ``rejected`` (a folder), written there with its reason. Keyed lines are written
    to scratch once: sorting, and looking for last records, read them twice.
    """
    lines = jsonl.read_text_lines(spark, path).select(
        "value", F.col("_metadata.file_path").alias("_src"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"))
    with scratch_scope(spark):
        if rejected is not None:
            value = F.try_parse_json("value")
            key = collate.uuid_sort_key(F.try_variant_get(value, "$.file", "string"), strict=False)
            parts = quarantine.split(lines, F.when(value.isNull(), F.lit("malformed JSON")).when(
                key.isNull(), F.lit("no UUID in file")), "sort")
            writers.write_table(parts.rejected.select(F.col("_src").alias("path"), "value",
                                                      "reason"), rejected)
            lines = parts.accepted
        parsed = lines.select(F.parse_json("value").alias("v"), "_src", "_block", "_pos")
        keyed = materialize(parsed.select(
            collate.uuid_sort_key(F.variant_get("v", "$.file", "string")).alias("_key"),
            F.to_json("v").alias("line"), "_src", "_block", "_pos"), "keyed-lines")
        place = ["_src", "_block", "_pos"]
        if last_only:
            # One number for the place: the file's rank, the block's start and the row number.
            ranks = dense_ids(keyed.select("_src").distinct(), ["_src"], "_rank")
            parts = [F.col(c).cast("decimal(38,0)") for c in ("_rank", "_block", "_pos")]
            at = (parts[0] * F.lit(1 << 40) + parts[1]) * F.lit(1 << 50) + F.pmod(
                parts[2], F.lit(1 << 33))
            keyed = collate.last_at(keyed.join(ranks, "_src").withColumn(
                "_at", at.cast("decimal(38,0)")), "_key", "_at")
        ordered = keyed.orderBy("_key", *place).select(F.col("line").alias("value"))
        ordered.write.mode("overwrite").option("compression", "gzip").text(out)


# JOB-11 ----------------------------------------------------------------------------------------

def residual_report(spark: SparkSession, raw_root: str, out: str | None = None,
                    prefixes_per_job: int = 8) -> DataFrame:
    """Files under the raw tree that match no parse pattern (listing only; nothing is deleted).

    Without ``out`` the tree is listed in one job (small trees). With ``out`` each group of prefix
    folders is listed by its own jobs, in tasks, and appended to ``out`` as (path, name, length), so
    the driver never holds a listing; files directly under the root come from the root
    listing (their length is not read).
    """
    if out is None:
        return collate.residual_files(raw_tree.list_files(spark, raw_root), "name")
    mode = "overwrite"
    for group in _folder_groups(spark, raw_root, prefixes_per_job):
        with scratch_scope(spark):
            if raw_tree.can_walk(spark, raw_root):
                listing = raw_tree.walked_files(spark, raw_root, group).select(
                    F.concat(F.lit(f"{storage.qualified(spark, raw_root).rstrip('/')}/"), "rel")
                    .alias("path"), F.substring_index("rel", "/", -1).alias("name"), "length")
            else:
                listing = raw_tree.list_files(spark, [os.path.join(raw_root, p) for p in group])
            collate.residual_files(listing, "name").write.mode(mode).parquet(out)
        mode = "append"
    loose = [(os.path.join(raw_root, n), n) for n, is_dir in storage.entries(spark, raw_root)
             if not is_dir]
    if loose:
        files = (spark.createDataFrame(loose, "path string, name string")
                 .withColumn("length", F.lit(None).cast("long")))
        collate.residual_files(files, "name").write.mode(mode).parquet(out)
    return spark.read.parquet(out)


# JOB-12 .. JOB-14 ------------------------------------------------------------------------------

def readme_analyses(spark: SparkSession, folder: str, source_type: str = "pdf"):
    """The three documented analyses over a table folder."""
    papers, mentions, purposes = table_sources.read_tables(spark, folder, source_type)
    return {
        "papers_mentioning_openstreetmap": analyses.distinct_owner_count(mentions),
        "stata_papers_per_year": analyses.yearly_counts(mentions, papers).orderBy(
            "published_year"),
        "popular_used_since_2020": analyses.popular_used_since(papers, mentions, purposes)
        .orderBy(F.desc("n"), "software_normalized"),
    }
