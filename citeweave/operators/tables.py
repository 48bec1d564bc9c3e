"""Nested JSON records → the papers, mentions and purpose-assessment tables.

One plan builds all three tables with no side files: paper ids come first (dense ids over the
paper records), mentions look their paper id up with a strict join, and ``has_mentions`` is an
existence flag over the mention records with a non-empty list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.keys import mention_id, uuid_of_name
from citeweave.functions.text import (empty_to_null, is_valid_date_text, keep_empty,
                                     lenient_date, strict_date, zero_to_null)
from citeweave.operators.keys import dense_ids
from citeweave.schemas import PAPERS, MENTIONS, PURPOSE_ASSESSMENTS, PURPOSES, SCOPES


def _with_comments(df: DataFrame, schema) -> DataFrame:
    """Select the declared columns in order, carrying each field's comment as metadata."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
                       for f in schema.fields])


# ---------------------------------------------------------------------------------------------
# Checks shared by the strict (raising) and quarantine (violations) forms
# ---------------------------------------------------------------------------------------------

def require(cond: Column, message: Column | str) -> Column:
    """A NULL-typed column that raises ``message`` on a row where ``cond`` is false."""
    msg = F.lit(message) if isinstance(message, str) else message
    return F.when(~cond, F.raise_error(msg))


def existence_flag(df: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``flag`` is true when ``key`` occurs in ``keys``, false otherwise (never NULL).

    The keys are made distinct before the join, so the join cannot multiply rows; Spark
    pre-aggregates the distinct in each task.
    """
    marks = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return (df.join(marks, key, "left")
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def strict_lookup(probe: DataFrame, mapping: DataFrame, key: str, value: str,
                  strict: bool = True) -> DataFrame:
    """Attach ``mapping[value]`` to each probe row by ``key``; a missing key is an error.

    A key that the mapping repeats has the last (largest) value, so the join never multiplies
    rows; :func:`repeated_keys` reports them. A left join keeps missing keys visible; strict mode then raises on the first one, otherwise
    the rows are dropped here and reported by :func:`lookup_violations`. The mapping is not forced
    into a broadcast: the planner and AQE pick broadcast or shuffle from its measured size.
    """
    last = mapping.groupBy(key).agg(F.max(value).alias(value))
    joined = probe.join(last, key, "left")
    if strict:
        check = require(F.col(value).isNotNull(),
                        F.concat(F.lit(f"missing {value} for {key} "), F.col(key).cast("string")))
        return joined.withColumn(value, F.coalesce(F.col(value), check.cast(
            mapping.schema[value].dataType)))
    return joined.where(F.col(value).isNotNull())


def repeated_keys(mapping: DataFrame, key: str) -> DataFrame:
    """Keys that a mapping holds more than once, with their number of rows ``n``."""
    return mapping.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def lookup_violations(probe: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Probe rows whose key has no mapping (the quarantine form of :func:`strict_lookup`)."""
    return probe.join(mapping.select(key), key, "left_anti")


# ---------------------------------------------------------------------------------------------
# Papers
# ---------------------------------------------------------------------------------------------

def paper_rows(records: DataFrame, strict: bool = True) -> DataFrame:
    """Project paper JSON records (``PAPER_JSON`` + ``bucket``) to typed paper columns.

    '' becomes NULL for text fields except ``doi`` (kept as ''), a year of 0 becomes NULL and the
    date must be ``yyyy-MM-dd``. The ``id`` must be 36 characters.
    """
    date = strict_date("published_date") if strict else lenient_date("published_date")
    out = records.select(
        F.col("bucket"),
        F.col("id").alias("source_uuid"),
        empty_to_null("title").alias("title"),
        zero_to_null("year").alias("published_year"),
        date.alias("published_date"),
        empty_to_null("journal_name").alias("publication_venue"),
        empty_to_null("publisher").alias("publisher_name"),
        keep_empty("doi").alias("doi"),
        empty_to_null("pmcid").alias("pmcid"),
        empty_to_null("pmid").alias("pmid"),
        empty_to_null("genre").alias("genre"),
        empty_to_null("license").alias("license_type"),
    )
    if strict:
        check = require(F.coalesce(F.length("source_uuid") == 36, F.lit(False)),
                        F.concat(F.lit("paper id is not 36 characters: "),
                                 F.coalesce(F.col("source_uuid"), F.lit("NULL"))))
        out = out.withColumn("source_uuid", F.coalesce(check.cast("string"), F.col("source_uuid")))
    return out


def paper_violations(records: DataFrame) -> DataFrame:
    """Paper records that strict mode would reject, with the reason."""
    reason = (F.when(F.coalesce(F.length("id") != 36, F.lit(True)), F.lit("id length"))
              .when(~is_valid_date_text("published_date"), F.lit("published_date")))
    return records.withColumn("reason", reason).where(F.col("reason").isNotNull())


def paper_ids(papers: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Dense 1-based ``paper_id`` in file order: bucket (file prefix) order, then UUID order.

    The special trailing bucket sorts after the hex prefixes because the bucket name is compared
    as text ('gg' > 'ff'). Rows repeating a UUID are ordered by all their other columns, so the
    ids never depend on shuffle order.
    """
    order = ["bucket", "source_uuid"] + [c for c in papers.columns
                                         if c not in ("bucket", "source_uuid")]
    return dense_ids(papers, order, id_col="paper_id", num_partitions=num_partitions)


def one_row_per_uuid(rows: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows with one per ``source_uuid``, the other rows) where ids belong to UUIDs.

    In strict mode a repeated UUID raises; else the row that is last by all its other columns
    stays. Exact copies of that row are dropped without a report: they say nothing else.
    """
    others = [c for c in rows.columns if c != "source_uuid"]
    last = rows.groupBy("source_uuid").agg(F.max(F.struct(*others)).alias("_last"),
                                           F.count(F.lit(1)).alias("_n"))
    if strict:
        check = require(F.col("_n") == 1, F.concat(F.lit("repeated paper id: "),
                                                   F.col("source_uuid")))
        last = last.withColumn("source_uuid", F.coalesce(check.cast("string"),
                                                         F.col("source_uuid")))
    kept = last.select("source_uuid", *[F.col("_last")[c].alias(c) for c in others])
    again = rows.join(last.where("_n > 1").select("source_uuid", "_last"), "source_uuid")
    return kept.select(rows.columns), again.where(
        ~F.struct(*others).eqNullSafe(F.col("_last"))).select(rows.columns)


def papers_table(paper_records: DataFrame, mention_records: DataFrame | None = None,
                 strict: bool = True, num_partitions: int | None = None) -> DataFrame:
    """The papers table with ``has_mentions`` from mention records with a non-empty list."""
    papers = paper_ids(paper_rows(paper_records, strict), num_partitions)
    if mention_records is None:
        papers = papers.withColumn("has_mentions", F.lit(False))
    else:
        holders = (mention_records.where(F.size("mentions") > 0)
                   .select(uuid_of_name("file").alias("source_uuid")))
        papers = existence_flag(papers, holders, "source_uuid", "has_mentions")
    return _with_comments(papers, PAPERS)


# ---------------------------------------------------------------------------------------------
# Mentions and assessments
# ---------------------------------------------------------------------------------------------

def mention_rows(mention_records: DataFrame, papers: DataFrame, source_type: str,
                 strict: bool = True) -> DataFrame:
    """Explode mention records to one row per mention, keyed to its paper.

    The paper UUID is the first 36 characters of ``file``; the paper id comes from a strict
    lookup in ``papers``. ``posexplode`` gives the 0-based ``mention_index`` (an empty list yields
    no rows).
    """
    keyed = mention_records.select(uuid_of_name("file").alias("source_uuid"), "mentions")
    keyed = strict_lookup(keyed, papers, "source_uuid", "paper_id", strict=strict)
    return keyed.select(
        "paper_id", F.lit(source_type).alias("source_file_type"),
        F.posexplode("mentions").alias("mention_index", "m"))


def _mention_columns(m: Column) -> list[Column]:
    """The mention table's columns from a row of :func:`mention_rows` ('' → NULL except names)."""
    return [
        mention_id("paper_id", "source_file_type", "mention_index").alias("software_mention_id"),
        F.col("paper_id"), F.col("source_file_type"), F.col("mention_index"),
        keep_empty(m["software-name"]["rawForm"]).alias("software_raw"),
        keep_empty(m["software-name"]["normalizedForm"]).alias("software_normalized"),
        *[empty_to_null(m[src][form]).alias(f"{src}_{kind}")
          for src in ("version", "publisher", "language", "url")
          for form, kind in (("rawForm", "raw"), ("normalizedForm", "normalized"))],
        empty_to_null(m["context"]).alias("context_full_text"),
    ]


def _score_columns(m: Column) -> list[Column]:
    """The six scores as ``<scope>_<purpose>``: document ← documentContextAttributes, local ← the
    mention's own attributes."""
    sources = {SCOPES[0]: m["documentContextAttributes"], SCOPES[1]: m["mentionContextAttributes"]}
    return [sources[scope][p]["score"].alias(f"{scope}_{p}") for scope in SCOPES for p in PURPOSES]


def flat_mention_rows(rows: DataFrame) -> DataFrame:
    """Mention columns plus the six scores, the nested record dropped: everything both tables
    need, so a job can write it once and derive both tables from it."""
    m = F.col("m")
    return rows.select(*_mention_columns(m), *_score_columns(m))


def mentions_from_flat(flat: DataFrame) -> DataFrame:
    return _with_comments(flat, MENTIONS)


def unpivot_scores(rows: DataFrame, keys: Sequence[str],
                   cells: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One output row per (scope, purpose, score) cell, in the given order.

    A missing score becomes 0.0, so every key always has ``len(cells)`` rows. ``inline`` over a
    literal array of structs is one Generate node inside the scan's stage: no shuffle.
    """
    structs = [F.struct(F.lit(scope).alias("scope"), F.lit(purpose).alias("purpose"),
                        F.coalesce(score.cast("double"), F.lit(0.0)).alias("certainty_score"))
               for scope, purpose, score in cells]
    return rows.select(*keys, F.inline(F.array(*structs)))


def assessments_from_flat(flat: DataFrame) -> DataFrame:
    """Six assessments per mention, scope-major: document (created, shared, used), then local."""
    cells = [(scope, p, F.col(f"{scope}_{p}")) for scope in SCOPES for p in PURPOSES]
    out = unpivot_scores(flat, ["software_mention_id", "paper_id", "source_file_type",
                                "mention_index"], cells)
    return _with_comments(out, PURPOSE_ASSESSMENTS)


def mentions_table(rows: DataFrame) -> DataFrame:
    """Typed mention columns from :func:`mention_rows`."""
    return mentions_from_flat(flat_mention_rows(rows))


def assessments_table(rows: DataFrame) -> DataFrame:
    """Purpose assessments from :func:`mention_rows`."""
    return assessments_from_flat(flat_mention_rows(rows))


def build_tables(paper_records: DataFrame, mention_records: DataFrame, source_type: str = "pdf",
                 strict: bool = True, num_partitions: int | None = None):
    """(papers, mentions, purpose_assessments) from paper and mention JSON records.

    Paper ids come first; the mention records are exploded once against them; ``has_mentions`` is
    then the existence of an exploded row for the paper (a non-empty list gives at least one), so
    the mention records are read once for all three tables.
    """
    core = paper_ids(paper_rows(paper_records, strict), num_partitions)
    rows = mention_rows(mention_records, core.select("source_uuid", "paper_id"), source_type,
                        strict)
    flat = flat_mention_rows(rows)
    return papers_from_mentions(core, flat), mentions_from_flat(flat), assessments_from_flat(flat)


def papers_from_mentions(core: DataFrame, flat: DataFrame) -> DataFrame:
    """Papers with ids plus ``has_mentions`` from the exploded mention rows."""
    return _with_comments(existence_flag(core, flat.select("paper_id"), "paper_id",
                                         "has_mentions"), PAPERS)
