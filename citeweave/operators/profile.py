"""Profile schemaless JSON: per leaf path, its type, counts, numeric range and small enums.

Paths: an object key appends ``.key``, an array element appends ``[]``; the root path is ''.
An empty object or array yields nothing; JSON null is a leaf. Leaves are found level by level
with ``LATERAL variant_explode_outer``. The plan reaches a fixed number of levels; where a document
goes deeper, its remaining containers (the frontier) are written to scratch and the walk goes on
from there, so any depth is profiled and usual documents need one pass.

Everything the profile reports comes from one aggregation per path. Histograms are part of it: a
frequent-items sketch is exact as long as it has seen no more values than it tracks, which is
several times the largest enum; the distinct count and the total of its counts show whether it was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.numeric import is_float32, is_integral, narrowest_type
from citeweave.schemas import MAX_ENUM_VALUES
from citeweave.session import materialize

# Levels of one plan, and of each further plan over a frontier.
LEVELS, FURTHER_LEVELS = 6, 16
# Strings longer than this enter the histogram by their digest, so a sketch stays small.
LONG_VALUE = 256
# Marks a digest; short strings that begin with it are digested too.
DIGEST_MARK = "\u0001sha256:"


def parse_documents(df: DataFrame, json_col: str, strict: bool = True) -> DataFrame:
    """One VARIANT per row; malformed JSON raises in strict mode and is dropped otherwise."""
    if strict:
        return df.select(F.parse_json(F.col(json_col)).alias("v"))
    return (df.select(F.try_parse_json(F.col(json_col)).alias("v"))
            .where(F.col("v").isNotNull()))


def container_depth(json_text: Column) -> Column:
    """Deepest nesting of objects/arrays in a JSON text (0 for a scalar), as a JVM expression.

    String literals are removed first (so brackets inside strings do not count); the running
    count of opening minus closing brackets is then folded with ``aggregate`` and its maximum kept.
    """
    no_strings = F.regexp_replace(json_text, r'"(?:[^"\\]|\\.)*"', "")
    brackets = F.regexp_replace(no_strings, r"[^\[\]{}]", "")
    return F.aggregate(
        F.split(brackets, ""),
        F.struct(F.lit(0).alias("c"), F.lit(0).alias("m")),
        lambda acc, ch: F.struct(
            (acc["c"] + F.when(ch.isin("[", "{"), 1).otherwise(-1)).alias("c"),
            F.greatest(acc["m"], acc["c"] + F.when(ch.isin("[", "{"), 1).otherwise(-1))
            .alias("m")),
        lambda acc: acc["m"])


def _descend(nodes: DataFrame, levels: int) -> DataFrame:
    """(path, v) after replacing every container by its children ``levels`` times.

    A leaf passes through unchanged (``variant_explode_outer`` yields one all-NULL row for a
    scalar, which keeps it); an empty object or array yields nothing.
    """
    for _ in range(levels):
        nodes = nodes.sparkSession.sql(
            "SELECT CASE WHEN e.pos IS NULL THEN t.path "
            "            WHEN e.key IS NULL THEN concat(t.path, '[]') "
            "            ELSE concat(t.path, '.', e.key) END AS path, "
            "       CASE WHEN e.pos IS NULL THEN t.v ELSE e.value END AS v "
            "FROM {t} AS t, LATERAL variant_explode_outer(t.v) AS e "
            "WHERE e.pos IS NOT NULL OR NOT (to_json(t.v) IN ('{{}}', '[]'))",
            t=nodes)
    return nodes


def _is_container(v: Column) -> Column:
    return F.substring(F.to_json(v), 1, 1).isin("{", "[")


def first_levels(docs: DataFrame, variant_col: str = "v", levels: int = LEVELS) -> DataFrame:
    """(path, v) of the first ``levels`` levels: leaves, and containers that are left there. No
    job runs."""
    return _descend(docs.select(F.lit("").alias("path"), F.col(variant_col).alias("v")), levels)


def deeper_leaves(docs: DataFrame, variant_col: str = "v", levels: int = LEVELS,
                  further: int = FURTHER_LEVELS) -> DataFrame | None:
    """(path, v) of the leaves below the first ``levels`` levels; None if there are none.

    The frontier is written as (path, JSON text) and read again as the next plan's input, until no
    container is left. Each plan's leaves are read from the same written table.
    """
    top = first_levels(docs, variant_col, levels).where(_is_container(F.col("v")))
    frontier, found = materialize(top.select("path", F.to_json("v").alias("text")),
                                  "json-frontier"), []
    while not frontier.isEmpty():
        nodes = _descend(frontier.select("path", F.parse_json("text").alias("v")), further)
        written = materialize(nodes.select("path", F.to_json("v").alias("text"),
                                           _is_container(F.col("v")).alias("open")),
                              "json-frontier")
        found.append(written.where("not open").select("path", F.parse_json("text").alias("v")))
        frontier = written.where("open")
    return reduce(DataFrame.unionAll, found) if found else None


def json_leaves(docs: DataFrame, variant_col: str = "v", levels: int = LEVELS) -> DataFrame:
    """(path, value) for every leaf of every document at any depth; ``value`` is a VARIANT.

    Looks for containers below the first ``levels`` levels (one pass over the documents) and walks
    them to the end; see :func:`document_parts` for a profile that needs that pass only when it
    meets such containers.
    """
    leaves = first_levels(docs, variant_col, levels)
    deeper = deeper_leaves(docs, variant_col, levels)
    if deeper is None:
        return leaves
    return leaves.where(~_is_container(F.col("v"))).unionAll(deeper)


def typed_leaves(leaves: DataFrame) -> DataFrame:
    """Add the atomic class (null, boolean, number, string) and typed values of each leaf; what is
    not a leaf yet has the class ``container``."""
    kind = F.schema_of_variant(F.col("v"))
    cls = (F.when(kind == "VOID", F.lit("null"))
           .when(kind == "BOOLEAN", F.lit("boolean"))
           .when(kind == "STRING", F.lit("string"))
           .when(kind.isin("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
                 | kind.startswith("DECIMAL"), F.lit("number"))
           .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit("container"))
           .otherwise(kind))
    return leaves.select(
        "path", cls.alias("cls"),
        F.when(cls == "boolean", F.variant_get("v", "$", "boolean")).alias("b"),
        F.when(cls == "number", F.variant_get("v", "$", "double")).alias("x"),
        F.when(cls == "string", F.variant_get("v", "$", "string")).alias("s"))


def enum_value_text(cls: Column, s: Column, x: Column) -> Column:
    """The value a histogram is keyed by: the string, or the number (integral numbers without
    a fraction)."""
    return (F.when(cls == "string", s)
            .when((cls == "number") & is_integral(x) & (F.abs(x) < F.lit(1e18)),
                  x.cast("long").cast("string"))
            .when(cls == "number", x.cast("string")))


def _histogram_key(typed: DataFrame) -> DataFrame:
    value = enum_value_text(F.col("cls"), F.col("s"), F.col("x"))
    plain = (F.length(value) <= LONG_VALUE) & ~value.startswith(DIGEST_MARK)
    return typed.withColumn("_key", F.when(plain, value).otherwise(
        F.concat(F.lit(DIGEST_MARK), F.sha2(value, 256))))


def path_statistics(typed: DataFrame, max_values: int = MAX_ENUM_VALUES) -> DataFrame:
    """One row per path: classes seen, boolean counts, numeric range and flags, and ``values``, the
    histogram (array of (item, count)) of a path with at most ``max_values`` values, else NULL.

    One aggregation with partial aggregation per task. The sketch behind ``values`` tracks three
    times ``max_values`` items at least and counts exactly up to there. It is taken as exact if its
    counts add up to the number of values and the approximate distinct count is at most twice
    ``max_values``: beyond the tracked number that estimate would have to be wrong by a third, where
    its error is a few per cent.
    """
    # Flags per class instead of a collected set.
    known = ("boolean", "number", "string")
    seen = [F.when(F.bool_or(F.col("cls") == c), F.lit(c)) for c in known]
    other = F.max(F.when(~F.col("cls").isin(*known, "null", "container"), F.col("cls")))
    tracked = max(64, 3 * max_values)
    leaf = F.col("cls") != "container"
    stats = _histogram_key(typed).groupBy("path").agg(
        F.array_sort(F.array_compact(F.array(*seen, other))).alias("classes"),
        F.count_if(leaf).alias("n_leaves"),
        F.count_if(~leaf).alias("n_containers"),
        F.count_if(F.col("b")).alias("n_true"),
        F.count_if(~F.col("b")).alias("n_false"),
        F.bool_and(F.when(F.col("x").isNotNull(), is_integral("x"))).alias("integral"),
        F.bool_and(F.when(F.col("x").isNotNull(), is_float32("x"))).alias("float32"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.count("_key").alias("_n_keys"),
        F.approx_count_distinct("_key").alias("_approx"),
        F.expr(f"approx_top_k(_key, {max_values + 1}, {tracked}) "
               "FILTER (WHERE _key IS NOT NULL)").alias("_top"))
    total = F.aggregate("_top", F.lit(0).cast("long"), lambda a, e: a + e["count"])
    exact = ((F.col("_n_keys") > 0) & (F.size("_top") <= max_values)
             & (F.col("_approx") <= 2 * max_values) & (total == F.col("_n_keys")))
    return stats.withColumn("values", F.when(exact, F.col("_top"))).drop(
        "_n_keys", "_approx", "_top")


def _open_ends(stats: DataFrame) -> tuple[bool, bool]:
    """Whether written statistics met containers below the first levels, and digested values."""
    row = stats.agg(
        F.coalesce(F.bool_or(F.col("n_containers") > 0), F.lit(False)).alias("deeper"),
        F.coalesce(F.bool_or(F.exists("values", lambda e: e["item"].startswith(DIGEST_MARK))),
                   F.lit(False)).alias("digested")).first()
    return row["deeper"], row["digested"]


def _histograms(stats: DataFrame, typed: DataFrame, digested: bool) -> DataFrame:
    """(path, value, n) of the enums; digested values get their text back from the leaves, which
    are read again only if there are such values."""
    rows = stats.where("size(classes) = 1 AND values IS NOT NULL").select(
        "path", F.inline("values").alias("value", "n"))
    if not digested:
        return rows
    texts = (_histogram_key(typed).where(F.col("_key").startswith(DIGEST_MARK))
             .join(rows.select("path", F.col("value").alias("_key")), ["path", "_key"],
                   "left_semi").groupBy("path", F.col("_key").alias("value"))
             .agg(F.any_value("s").alias("_text")))
    return rows.join(texts, ["path", "value"], "left").select(
        "path", F.coalesce("_text", "value").alias("value"), "n")


def statistics_parts(stats: DataFrame, typed: DataFrame, digested: bool,
                     max_only_signed_rule: bool = False) -> tuple[DataFrame, DataFrame]:
    """(profile, histograms) from written per-path statistics; ``typed`` are their leaves, and
    ``digested`` says whether a histogram holds digests."""
    kind = (F.when(F.size("classes") == 0, F.lit("empty"))
            .when(F.size("classes") > 1, F.lit("conflict"))
            .otherwise(F.element_at("classes", 1)))
    number_type = narrowest_type(F.col("integral"), F.col("float32"), F.col("min"), F.col("max"),
                                 max_only=max_only_signed_rule)
    leaves = stats.where("n_leaves > 0")
    prof = leaves.select(
        "path", kind.alias("kind"), "n_leaves",
        F.when(kind == "boolean", F.col("n_true")).alias("n_true"),
        F.when(kind == "boolean", F.col("n_false")).alias("n_false"),
        F.when(kind == "number", number_type).alias("number_type"),
        F.when(kind == "number", F.col("min")).alias("min"),
        F.when(kind == "number", F.col("max")).alias("max"),
        F.when(kind.isin("number", "string") & F.col("values").isNotNull(),
               F.size("values").cast("long")).alias("n_values"))
    return prof, _histograms(leaves, typed, digested)


def profile_parts(typed: DataFrame, max_values: int = MAX_ENUM_VALUES,
                  max_only_signed_rule: bool = False) -> tuple[DataFrame, DataFrame]:
    """(profile, histograms) sharing one aggregation of the leaves."""
    stats = written_statistics(typed, max_values)
    return statistics_parts(stats, typed, _open_ends(stats)[1], max_only_signed_rule)


def written_statistics(typed: DataFrame, max_values: int = MAX_ENUM_VALUES) -> DataFrame:
    """The per-path statistics (one row per path) in the shared checkpoint folder, so the leaves are
    aggregated once even though several later steps read the result."""
    return materialize(path_statistics(typed, max_values), "json-path-statistics")


def document_statistics(docs: DataFrame, variant_col: str = "v",
                        max_values: int = MAX_ENUM_VALUES) -> tuple[DataFrame, DataFrame, bool]:
    """(written per-path statistics, typed leaves, whether a histogram holds digests) of documents
    of any depth: one pass where no document goes below the first levels, which the statistics
    themselves show."""
    typed = typed_leaves(first_levels(docs, variant_col))
    stats = written_statistics(typed, max_values)
    deeper, digested = _open_ends(stats)
    if not deeper:
        return stats, typed, digested
    typed = typed.where("cls != 'container'").unionAll(
        typed_leaves(deeper_leaves(docs, variant_col)))
    stats = written_statistics(typed, max_values)
    return stats, typed, _open_ends(stats)[1]


def document_parts(docs: DataFrame, variant_col: str = "v", max_values: int = MAX_ENUM_VALUES,
                   max_only_signed_rule: bool = False) -> tuple[DataFrame, DataFrame]:
    """(profile, histograms) of documents of any depth."""
    return statistics_parts(*document_statistics(docs, variant_col, max_values),
                            max_only_signed_rule)


def statistics_conflicts(stats: DataFrame) -> DataFrame:
    """:func:`type_conflicts` from the per-path statistics, without another pass."""
    return stats.where("size(classes) > 1").select(
        "path", F.size("classes").cast("long").alias("n_types"),
        F.array_join("classes", ",").alias("types"))


def json_profile(typed: DataFrame, max_values: int = MAX_ENUM_VALUES,
                 max_only_signed_rule: bool = False) -> DataFrame:
    """Per path: ``kind`` (empty, boolean, number, string, conflict), counts and number type.

    ``number_type`` is the narrowest integer type holding min and max (``max_only_signed_rule``
    reproduces the original tool, which looked at the maximum only), else float32/float64.
    ``n_values`` is the exact number of distinct values when it is at most ``max_values``
    (the path is then an enum), else NULL.
    """
    return profile_parts(typed, max_values, max_only_signed_rule)[0]


def json_enums(typed: DataFrame, max_values: int = MAX_ENUM_VALUES) -> DataFrame:
    """(path, value, n) histograms of enum paths (strings or numbers, no type conflict)."""
    return profile_parts(typed, max_values)[1]


def profile_summary(profile: DataFrame, enums: DataFrame | None = None) -> DataFrame:
    """``path;summary`` report lines, sorted by path.

    boolean ``true:T;false:F``; number ``<type>;<min>;<max>`` (integers as ``%d``, others as
    ``%f``); string ``enum;<n>;`` or ``string;``; ``empty``. With ``enums`` each enum's values
    follow as ``value:count;`` in value order (at most 20 per path, gathered per path), numbers
    formatted like their min and max. A ``;`` always separates max from the first entry.
    """
    num = (F.when(F.col("number_type").startswith("float"),
                  F.format_string("%s;%f;%f", "number_type", "min", "max"))
           .otherwise(F.format_string("%s;%d;%d", F.col("number_type"),
                                      F.col("min").cast("long"), F.col("max").cast("long"))))
    summary = (F.when(F.col("kind") == "empty", F.lit("empty"))
               .when(F.col("kind") == "boolean",
                     F.format_string("true:%d;false:%d", "n_true", "n_false"))
               .when(F.col("kind") == "number", num)
               .when((F.col("kind") == "string") & F.col("n_values").isNotNull(),
                     F.format_string("enum;%d;", "n_values"))
               .when(F.col("kind") == "string", F.lit("string;"))
               .otherwise(F.col("kind")))
    if enums is None:
        return profile.select("path", summary.alias("summary")).orderBy("path")
    kinds = profile.select("path", "kind", "number_type")
    entry_text = (F.when((F.col("kind") == "number") & F.col("number_type").startswith("float"),
                         F.format_string("%f", F.col("value").cast("double")))
                  .otherwise(F.col("value")))
    entries = (enums.join(kinds, "path")
               .select("path", F.struct(
                   F.when(F.col("kind") == "number", F.col("value").cast("double")).alias("x"),
                   F.col("value").alias("v"),
                   F.concat(entry_text, F.lit(":"), F.col("n").cast("string"), F.lit(";"))
                   .alias("e")).alias("_e"))
               .groupBy("path").agg(F.array_sort(F.collect_list("_e")).alias("_es"))
               .select("path", F.array_join(F.col("_es.e"), "").alias("_entries")))
    sep = F.when(F.col("kind") == "number", F.lit(";")).otherwise(F.lit(""))
    lines = (profile.join(entries, "path", "left")
             .select("path", F.when(F.col("_entries").isNotNull(),
                                    F.concat(summary, sep, F.col("_entries")))
                     .otherwise(summary).alias("summary")))
    return lines.orderBy("path")


def empty_paths(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("kind") == "empty").select("path", "n_leaves")


def type_conflicts(typed: DataFrame) -> DataFrame:
    """Paths holding more than one atomic type (null is compatible with every type)."""
    return (typed.where(F.col("cls") != "null").groupBy("path")
            .agg(F.count_distinct("cls").alias("n_types"),
                 F.array_join(F.array_sort(F.collect_set("cls")), ",").alias("types"))
            .where(F.col("n_types") > 1))


def assert_no_conflicts(typed: DataFrame) -> DataFrame:
    """Strict form: the leaves pass through, and a conflicting path raises at action time."""
    bad = type_conflicts(typed).select("path", F.lit(True).alias("_bad"))
    check = F.when(F.col("_bad"), F.raise_error(F.concat(F.lit("type conflict at "),
                                                         F.col("path")))).cast("string")
    return (typed.join(bad, "path", "left")
            .withColumn("path", F.coalesce(check, F.col("path"))).drop("_bad"))


def raise_on_conflicts(profile: DataFrame) -> DataFrame:
    """Strict form over a finished profile: a path of kind ``conflict`` raises at action time.

    The per-path statistics already hold every path's classes, so no second pass over the
    leaves is needed (unlike :func:`assert_no_conflicts`, which checks the leaves themselves).
    """
    check = F.when(F.col("kind") == "conflict", F.raise_error(
        F.concat(F.lit("type conflict at "), F.col("path")))).cast("string")
    return profile.withColumn("kind", F.coalesce(check, F.col("kind")))
