"""Raw per-paper files → prefix-bucketed collections; UUID sort; last value per key; residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.keys import prefix_bucket, uuid_of_name
from citeweave.functions.text import col
from citeweave.schemas import PARSE_SUFFIXES, UUID_PATTERN


def _suffix_regex(suffix: str) -> str:
    return "^" + UUID_PATTERN + suffix.replace(".", r"\.") + "$"


def classify_name(name: Column | str) -> Column:
    """Parse type of a raw file name, or NULL when it matches no known pattern.

    Patterns are anchored and dots escaped, so 'x.software.json' (no UUID) and 'notes.txt' are
    unclassified. Longer suffixes are tested first ('.jats.software.json' before
    '.software.json').
    """
    name = col(name)
    ordered = sorted(PARSE_SUFFIXES, key=lambda p: -len(p[1]))
    expr = None
    for parse_type, suffix in ordered:
        cond = name.rlike(_suffix_regex(suffix))
        expr = F.when(cond, F.lit(parse_type)) if expr is None else expr.when(cond, F.lit(parse_type))
    return expr


def tagged_records(records: DataFrame, file_name: Column | str = "_file_name",
                   prefix: Column | str | None = None, bucket_width: int = 2) -> DataFrame:
    """:func:`collate_records` with unclassified files left in (their parse type is NULL)."""
    name = col(file_name)
    tagged = (records.withColumn("file", name)
              .withColumn("parse_type", classify_name(name))
              .withColumn("uuid", F.lower(uuid_of_name(name))))
    tagged = tagged.withColumn("prefix", prefix_bucket("uuid", bucket_width) if prefix is None
                               else col(prefix))
    if isinstance(file_name, str) and file_name != "file":
        tagged = tagged.drop(file_name)
    return tagged


def collate_records(records: DataFrame, file_name: Column | str = "_file_name",
                    prefix: Column | str | None = None, bucket_width: int = 2) -> DataFrame:
    """Tag raw records for collation: ``file`` (base name, overwriting any such key), UUID,
    bucket and parse type. Unclassified files are left out (see :func:`residual_files`).

    The bucket (``prefix``) is the top-level folder a file came from; a caller that has no folders
    may leave it out, which takes the first characters of the UUID.
    """
    return tagged_records(records, file_name, prefix, bucket_width).where(
        F.col("parse_type").isNotNull())


def copied_object(text: Column | str, file_name: Column | str) -> Column:
    """The JSON object in ``text`` with its ``file`` key set, as one JSON line.

    Every other key keeps its value and type (VARIANT): nulls stay, nothing is widened to what
    another file holds. Text that is not one JSON object raises.
    """
    fields = F.from_json(col(text), "map<string,variant>", {"mode": "FAILFAST"})
    fields = F.coalesce(fields, F.raise_error(F.concat(
        F.lit("not a JSON object: "), col(file_name))).cast("map<string,variant>"))
    own = F.parse_json(F.to_json(F.struct(col(file_name).alias("file"))))
    value = F.variant_get(own, "$.file", "variant")
    return F.to_json(F.map_concat(F.map_filter(fields, lambda k, _: k != "file"),
                                  F.create_map(F.lit("file"), value)))


def residual_files(listing: DataFrame, name: Column | str = "name") -> DataFrame:
    """Files that match no parse pattern (what a merge would leave behind)."""
    return listing.where(classify_name(name).isNull())


def bucket_summary(collated: DataFrame, size_col: str | None = None) -> DataFrame:
    """Rows and total size per (parse type, prefix) bucket: what each output file will hold."""
    aggs = [F.count(F.lit(1)).alias("n_records")]
    if size_col:
        aggs.append(F.sum(size_col).cast("long").alias("total_size"))
    return collated.groupBy("parse_type", "prefix").agg(*aggs)


def uuid_sort_key(file_col: Column | str = "file", strict: bool = True) -> Column:
    """Lower-case UUID text from ``file``; its text order equals unsigned 128-bit order.

    Strict mode raises when ``file`` is missing or does not start with a UUID.
    """
    key = F.substring(col(file_col), 1, 36)
    valid = F.coalesce(key.rlike("^" + UUID_PATTERN + "$"), F.lit(False))
    if strict:
        check = F.when(~valid, F.raise_error(F.concat(
            F.lit("record has no UUID key in file: "),
            F.coalesce(col(file_col).cast("string"), F.lit("NULL")))))
        return F.coalesce(check.cast("string"), F.lower(key))
    return F.when(valid, F.lower(key))


def sort_by_uuid(records: DataFrame, file_col: str = "file",
                 tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    """Global sort by UUID (range-partitioned, so each task sorts one key range)."""
    return records.orderBy(uuid_sort_key(file_col), *tiebreak)


def last_at(records: DataFrame, key: str, position: str) -> DataFrame:
    """The record of each key that has its greatest ``position``, a number no two records of a key
    share. Two phases: the greatest position per key is a hash aggregate of two narrow columns, then
    records are joined on key and position, so a very common key is spread by its positions and no
    whole record is ever aggregated. ``records`` is read twice: give it a written table."""
    last = records.groupBy(key).agg(F.max(position).alias(position))
    return records.join(last, [key, position])


def last_by_key(records: DataFrame, key: Column | str, position: Column | str | Sequence[str],
                alias: str = "key") -> DataFrame:
    """The last record of each key by ``position`` (later reads win).

    ``position`` is one column, or several that are compared in turn. The latest position is
    aggregated partially in every task before the shuffle, so a key with very many records is
    reduced map-side instead of being gathered in one task. Where several records share a
    key's last position, one of them stays.
    """
    fields = list(records.columns)
    if isinstance(position, (list, tuple)):
        position = F.struct(*[col(p) for p in position])
    latest = records.groupBy(col(key).alias(alias)).agg(
        F.max_by(F.struct(*fields), col(position)).alias("_r"))
    return latest.select(alias, *[F.col("_r")[c].alias(c) for c in fields if c != alias])
