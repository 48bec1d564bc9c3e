"""Secret scanning with multipart credential linking, in DataFrame functions only.

Strong candidates (assignments, access keys, long hexadecimal runs) are reported as they are. Weak
candidates - identifiers, endpoints and token-like strings that say little alone - are reported
only where complementary parts of a credential co-occur in one scope: the text within
``scope`` characters. Parts are interval-joined on scope-wide buckets. Each bucket carries only the
first start and the last end of a role, which decides exactly whether a part of that role lies
within reach, so no pairs of parts are formed, however many parts a document holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import let
from citeweave.session import write_scratch

SCOPE = 200

# Strong kinds: (kind, pattern, captured group that must reach the length, that length, role).
STRONG = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 2, 12, "secret"),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, "identifier"),
    ("hex", r"[0-9a-f]+", 0, 16, "secret"),
)
# Weak kinds: (kind, pattern, role). Token-like: 20 or more characters with capitals, small
# letters and digits.
WEAK = (
    ("identifier", r"""(?i:(?:user(?:name)?|login|account|client_?id|key_?id))["']?\x20*[:=]\x20*"""
                   r"""["']?[A-Za-z0-9_.@-]{3,}""", "identifier"),
    ("endpoint", r"(?:https?|ftp|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqps?)"
                 r"://[A-Za-z0-9_.:@/?&=%-]{4,}", "endpoint"),
    ("tokenlike", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])"
                  r"(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}", "secret"),
)
KINDS = [k[0] for k in STRONG] + [k[0] for k in WEAK]
_SPANS = "array<struct<start:bigint,end:bigint>>"
# Matches folded together: a list grows by copying, so it is kept short and lists are joined once.
BLOCK = 256


def _spans(text: Column, pattern: str, group: int = 0, at_least: int = 0) -> Column:
    """Code-point spans of the leftmost, non-overlapping matches; those whose ``group`` is shorter
    than ``at_least`` are dropped without a retry. Matches and the pieces between them come from
    the same pattern, so their lengths add up to positions: inside blocks of matches first, then
    over the blocks, so the work grows with the text however many matches it has."""
    regex = F.lit(pattern)
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("value"))
    zero = F.lit(0).cast("bigint").alias("at")

    def in_block(matches: Column) -> Column:
        return F.aggregate(
            matches, F.struct(zero, F.array().cast(_SPANS).alias("found")),
            lambda done, m: let(
                F.struct((done["at"] + F.length(m["gap"])).alias("start"),
                         (done["at"] + F.length(m["gap"]) + F.length(m["match"])).alias("end")),
                lambda s: F.struct(
                    F.coalesce(s["end"], s["start"]).alias("at"),
                    F.when(F.length(m["value"]) >= at_least, F.concat(done["found"], F.array(s)))
                    .otherwise(done["found"]).alias("found"))))

    def moved(spans: Column, by: Column) -> Column:
        return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"),
                                                     (s["end"] + by).alias("end")))

    blocks = let(zipped, lambda z: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(z) - 1) / BLOCK).cast("int")),
        lambda k: in_block(F.slice(z, k * BLOCK + 1, BLOCK))))
    joined = F.aggregate(
        blocks, F.struct(zero, F.array().cast(f"array<{_SPANS}>").alias("parts")),
        lambda done, b: F.struct(
            (done["at"] + b["at"]).alias("at"),
            F.concat(done["parts"], F.array(moved(b["found"], done["at"]))).alias("parts")))
    return F.when(F.rlike(text, F.lit(pattern if group else _bounded(pattern, at_least))),
                  F.flatten(joined["parts"])).otherwise(F.array().cast(_SPANS))


def _bounded(pattern: str, at_least: int) -> str:
    """A cheap test that some match may reach the length: only used to skip texts without any.
    For a trailing run ``[...]+`` of the whole pattern, the run must be long enough."""
    if not at_least or not pattern.endswith("]+"):
        return pattern
    fixed = pattern[:pattern.rindex("[")]
    return f"{pattern[:-1]}{{{max(1, at_least - len(fixed))},}}"


def _tag(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _by_start(spans: Column) -> Column:
    """Sorted by start, then kind."""
    flat = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return flat


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 scope: int = SCOPE) -> DataFrame:
    """Secrets of every whole text.

    One row per document row: ``id``, ``base`` (strong spans) and ``linked`` (weak spans that
    complementary parts support), each an array of (start, kind, end) in code points, end
    exclusive, sorted by start and kind (an index into ``KINDS``).

    A weak identifier needs a secret within ``scope`` characters; a weak secret an identifier or
    an endpoint; an endpoint an identifier and a secret. Strong parts support weak ones. A weak
    span that overlaps a strong span is not listed. Null counts as empty; rows that agree in id
    and text get equal rows; an empty table gives none; other columns are not looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    strong = F.concat(*[_tag(_spans(text, pattern, group, least), kind)
                        for kind, pattern, group, least, _ in STRONG])
    weak = F.concat(*[_tag(_spans(text, pattern), kind) for kind, pattern, _ in WEAK])
    found = spark.read.parquet(write_scratch(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
        strong.alias("strong"), weak.alias("weak")), "secret-parts"))

    # Parts of documents that have a weak candidate and any other part.
    roles = F.array(*[F.lit(r) for *_, r in (*STRONG, *WEAK)])
    parts = (found.where((F.size("weak") > 0) & (F.size("weak") + F.size("strong") > 1))
             .dropDuplicates(["id", "text_hash"])
             .select("id", "text_hash", F.explode(F.concat("strong", "weak")).alias("part"))
             .select("id", "text_hash", "part.*",
                     F.get(roles, F.col("part.kind")).alias("role"),
                     F.floor(F.col("part.start") / scope).alias("bucket"))
             .withColumn("end_bucket", F.floor(F.col("end") / scope)))
    # What lies in each bucket: parts are listed in every bucket they touch.
    # Strong spans of a kind do not overlap and have a least length, so few touch one bucket.
    cover = (parts.withColumn("bucket", F.explode(F.sequence("bucket", "end_bucket")))
             .groupBy("id", "text_hash", "role", "bucket")
             .agg(F.min("start").alias("first"), F.max("end").alias("last"),
                  F.collect_set(F.when(F.col("kind") < len(STRONG), F.struct("start", "end")))
                  .alias("strong_spans")))
    near = cover.select(F.col("id").alias("c_id"), F.col("text_hash").alias("c_hash"),
                        F.col("role").alias("c_role"), "first", "last", "strong_spans",
                        F.explode(F.sequence(F.col("bucket") - 1, F.col("bucket") + 1))
                        .alias("c_bucket"))
    asked = (parts.where(F.col("kind") >= len(STRONG))
             .withColumn("bucket", F.explode(F.sequence("bucket", "end_bucket"))))
    supported = (asked.join(near, F.col("id").eqNullSafe(F.col("c_id"))
                            & (F.col("text_hash") == F.col("c_hash"))
                            & (F.col("bucket") == F.col("c_bucket"))
                            & (F.col("first") <= F.col("end") + scope)
                            & (F.col("last") >= F.col("start") - scope), "left")
                 .groupBy("id", "text_hash", "kind", "role", "start", "end")
                 .agg(F.collect_set(F.when(F.col("role") != F.col("c_role"), F.col("c_role")))
                      .alias("others"),
                      F.coalesce(F.bool_or(F.exists("strong_spans", lambda s: (
                          s["start"] < F.col("end")) & (F.col("start") < s["end"]))), F.lit(False))
                      .alias("covered")))
    has = lambda role: F.array_contains("others", role)
    linked = (supported.where(~F.col("covered")).where(
        F.when(F.col("role") == "identifier", has("secret"))
        .when(F.col("role") == "secret", has("identifier") | has("endpoint"))
        .otherwise(has("identifier") & has("secret")))
        .groupBy(F.col("id").alias("l_id"), F.col("text_hash").alias("l_hash"))
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("candidates")))
    return (found.join(linked, F.col("id").eqNullSafe(F.col("l_id"))
                       & (F.col("text_hash") == F.col("l_hash")), "left")
            .select("id", _by_start(F.col("strong")).alias("base"),
                    F.coalesce(F.array_sort("candidates"),
                               F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
                    .alias("linked")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
