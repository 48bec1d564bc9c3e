"""Registered queries: every operator run over the driver's tables.

The driver's tables are not bibliographic, so each operator runs on an analogue with the same
shape (an owner with items, a record with a nested list, a key to sample by, ...). Every query
reads whole tables; nothing is subset, capped or sampled except where that is the operator
(top-k reports, the subsampler).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions import identifiers as ids
from citeweave.functions.keys import mention_id, prefix_bucket, uuid_from_hex32
from citeweave.functions.text import empty_to_null, strict_date, zero_to_null
from citeweave.operators import (analyses, collate, counts, identifiers, profile, sampling, slim,
                                 tables)
from citeweave.operators.keys import dense_ids
from citeweave.schemas import PARSE_SUFFIXES, RESOURCE_CODES

# Parameters of the analogues (the operators' own defaults are the reference's values).
PURCHASE = "purchase"
RETURNED = "R"
YEARS = (1996, 2000)
RECENT_FROM = "1998-01-01"
MIN_DISCOUNT = 0.05
STOP_PARTS = (1, 2, 3, 4, 5, 6, 7, 8)
MIN_ITEM_SUPPORT = 35
MIN_PAIR_SUPPORT = 2
TOP_ITEMS = 10
TOP_PAIRS = 20
SEED = 42
FRACTIONS = (0.01, 0.05)
# Suffixes used to give synthetic file names to pages: the known parse suffixes plus two that
# match nothing (a note file and a software file without a UUID prefix).
FILE_SUFFIXES = [s for _, s in PARSE_SUFFIXES] + [".txt", ".software.json"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _uuid_of(c: Column) -> Column:
    return uuid_from_hex32(F.md5(c.cast("string")))


# ---------------------------------------------------------------------------------------------
# README analyses
# ---------------------------------------------------------------------------------------------

def distinct_key_count(spark, d):
    events = table(spark, d, "events")
    return analyses.distinct_owner_count(events, item_col="event_type", item=PURCHASE,
                                         owner_col="user_id")


def yearly_counts_for_item(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                                "l_returnflag")
    lo, hi = YEARS
    orders = (table(spark, d, "orders")
              .where((F.col("o_orderdate") >= F.lit(f"{lo}-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderdate") < F.lit(f"{hi + 1}-01-01").cast("timestamp_ntz")))
              .select("o_orderkey", F.year("o_orderdate").alias("order_year")))
    return analyses.yearly_counts(lines, orders, item_col="l_returnflag", item=RETURNED,
                                  owner_col="o_orderkey", year_col="order_year",
                                  year_from=lo, year_to=hi)


def popular_items_by_distinct_owner(spark, d):
    """orders(recent) ⋈ lineitem(judged) ⋈ part → distinct (customer, brand) → count by brand."""
    recent = (table(spark, d, "orders")
              .where(F.col("o_orderdate") >= F.lit(RECENT_FROM).cast("timestamp_ntz"))
              .select("o_orderkey", "o_custkey"))
    judged = (table(spark, d, "lineitem").where(F.col("l_discount") > MIN_DISCOUNT)
              .select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey")))
    brands = table(spark, d, "part").select("p_partkey", "p_brand")
    facts = recent.join(judged, "o_orderkey").join(brands, "p_partkey")
    return analyses.distinct_pair_counts(facts, owner_col="o_custkey", item_col="p_brand")


# ---------------------------------------------------------------------------------------------
# Popularity and co-occurrence
# ---------------------------------------------------------------------------------------------

def _order_parts(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey")


def item_support(spark, d):
    return counts.item_support(_order_parts(spark, d), owner="l_orderkey", item="l_partkey",
                               stop_list=STOP_PARTS, min_support=MIN_ITEM_SUPPORT)


def item_support_total(spark, d):
    return counts.supported_item_total(item_support(spark, d))


def top_items(spark, d):
    return counts.top_ranked(item_support(spark, d), [F.desc("n"), F.asc("l_partkey")], TOP_ITEMS)


def co_items(spark, d):
    return counts.co_occurrence_counts(_order_parts(spark, d), owner="l_orderkey",
                                       item="l_partkey", stop_list=STOP_PARTS,
                                       min_item_support=MIN_ITEM_SUPPORT,
                                       min_pair_support=MIN_PAIR_SUPPORT)


def top_co_items(spark, d):
    return counts.top_ranked(co_items(spark, d),
                             [F.desc("n"), F.asc("item_a"), F.asc("item_b")], TOP_PAIRS)


def category_counts_zero_filled(spark, d):
    """Orders of every customer; a third of the customers naturally have none."""
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return counts.zero_filled_counts(customers, orders, "c_custkey")


def occurrence_counts(spark, d):
    """Lines per part name. Lines are counted per part key first (map-side), so only one row per
    part crosses the join; the name count then sums those."""
    per_part = counts.occurrence_counts(table(spark, d, "lineitem"), "l_partkey", alias="_n")
    names = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return (per_part.join(names, "l_partkey")
            .groupBy("p_name").agg(F.sum("_n").cast("long").alias("n")))


# ---------------------------------------------------------------------------------------------
# Nested records → rows
# ---------------------------------------------------------------------------------------------

def _documents_as_records(spark, d):
    """A document is a record with a nested list: its lines."""
    return table(spark, d, "documents").select("doc_id", "lang",
                                               F.split("text", "\n").alias("lines"))


def exploded_children(spark, d):
    rows = _documents_as_records(spark, d).select(
        "doc_id", "lang", F.posexplode("lines").alias("line_index", "line"))
    return rows.select(mention_id("doc_id", "lang", "line_index").alias("child_id"), "doc_id",
                       F.col("line_index").cast("int").alias("line_index"),
                       empty_to_null("line").alias("line"))


def six_assessments(spark, d):
    """Per line: local scores are the line's own values, document scores the order's means."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                               "l_discount", "l_tax")
    means = lines.groupBy("l_orderkey").agg(
        F.avg("l_quantity").alias("d_quantity"), F.avg("l_discount").alias("d_discount"),
        F.avg("l_tax").alias("d_tax"))
    rows = lines.join(means, "l_orderkey")
    cells = [(scope, p, F.round(F.col(f"{prefix}{p}"), 6))
             for scope, prefix in (("document", "d_"), ("local", "l_"))
             for p in ("quantity", "discount", "tax")]
    return tables.unpivot_scores(rows, ["l_orderkey", "l_linenumber"], cells)


def children_exist_flag(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.existence_flag(orders, lines, "o_orderkey", "has_lines")


def strict_lookup(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                               "l_linenumber", "l_partkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return tables.strict_lookup(lines, orders, "o_orderkey", "o_custkey", strict=True)


def lookup_violations(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.lookup_violations(orders, lines, "o_orderkey")


def clean_rows(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(
        "o_orderkey",
        empty_to_null("o_orderstatus").alias("order_status"),
        empty_to_null(F.split_part("o_orderpriority", F.lit("-"), F.lit(2))).alias("priority"),
        strict_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        zero_to_null(F.year("o_orderdate") - F.lit(1995)).alias("year_offset"),
    )


# ---------------------------------------------------------------------------------------------
# Keys and sampling
# ---------------------------------------------------------------------------------------------

def dense_ids_query(spark, d):
    pages = table(spark, d, "pages").select("page_id", _uuid_of(F.col("url")).alias("uuid"))
    keyed = pages.withColumn("bucket", prefix_bucket("uuid"))
    return dense_ids(keyed, ["bucket", "uuid", "page_id"], id_col="paper_id").select(
        "page_id", "uuid", "paper_id")


def _eligible_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.existence_flag(orders, lines, "o_orderkey", "has_lines")


def sample_assignment(spark, d):
    return sampling.assign_samples(_eligible_orders(spark, d), "o_orderkey", SEED, FRACTIONS,
                                   eligible="has_lines").select("o_orderkey", "sample")


def sample_sizes(spark, d):
    return sampling.sample_sizes(sample_assignment(spark, d))


def sampled_children(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return sampling.route_children(lines, "l_orderkey", SEED, FRACTIONS)


# ---------------------------------------------------------------------------------------------
# JSON profile
# ---------------------------------------------------------------------------------------------

def _json_documents(spark, d):
    """Event properties plus one JSON document per text document, built from its columns.

    The document JSON holds a nested object, an array of booleans or nulls (labels cover only
    some documents), a non-integral number, an always-null key and a key whose type depends on
    the document (number for even ids, string for odd ones).
    """
    events = table(spark, d, "events").select(F.col("props").alias("j"))
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")

    def flag(c):
        return F.coalesce(F.when(F.col(c) == 1, F.lit("true")).when(F.col(c).isNotNull(),
                                                                      F.lit("false")),
                          F.lit("null"))

    mixed = F.when(F.col("doc_id") % 2 == 0, (F.col("n_chars") % 7).cast("string")).otherwise(
        F.concat(F.lit('"'), F.col("lang"), F.lit('"')))
    text = F.concat(
        F.lit('{"doc":{"lang":"'), F.col("lang"), F.lit('","source":"'), F.col("source"),
        F.lit('","chars":'), F.col("n_chars").cast("string"),
        F.lit('},"flags":['), flag("quality"), F.lit(","), flag("toxic"),
        F.lit('],"ratio":'), F.format_string("%.3f", F.col("n_chars") / F.lit(8.0)),
        F.lit(',"mixed":'), mixed, F.lit(',"none":null,"empty":[]}'))
    return events.unionByName(docs.join(labels, "doc_id", "left").select(text.alias("j")))


def _json_parts(spark, d):
    return profile.document_parts(profile.parse_documents(_json_documents(spark, d), "j"))


def json_profile(spark, d):
    return _json_parts(spark, d)[0]


def json_enums(spark, d):
    return _json_parts(spark, d)[1]


def json_empty_paths(spark, d):
    return profile.empty_paths(json_profile(spark, d))


def json_report(spark, d):
    return profile.profile_summary(*_json_parts(spark, d))


def json_type_conflicts(spark, d):
    return profile.statistics_conflicts(profile.document_statistics(
        profile.parse_documents(_json_documents(spark, d), "j"))[0])


# ---------------------------------------------------------------------------------------------
# Identifiers and licences
# ---------------------------------------------------------------------------------------------

def _resource_names_from_bits(key: Column) -> Column:
    """Resource names whose bit is set in ``key`` (bit i selects the i-th kind)."""
    return F.array_compact(F.array(*[
        F.when(F.shiftright(key, i).bitwiseAND(F.lit(1)) == 1, F.lit(n))
        for i, (n, _) in enumerate(RESOURCE_CODES)]))


def _identifier_records(spark, d):
    """Identifier records made from pages: every field derived from the page's own columns."""
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    h = F.md5(F.col("url"))
    istex = F.concat(h, F.substring(F.md5(F.col("html")), 1, 8))
    spellings = identifiers.spelling_dimension(spark)
    recs = pages.select(
        "page_id",
        uuid_from_hex32(h).alias("id"),
        F.concat(F.lit("10.1000/"), F.substring(h, 1, 10)).alias("doi"),
        F.lit(None).cast("string").alias("arxiv"),
        F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("00"), F.col("page_id").cast("string")))
        .otherwise(F.col("page_id").cast("string")).alias("pmid"),
        F.concat(F.lit("PMC"), (F.col("page_id") + 1000).cast("string")).alias("pmcid"),
        F.when(F.col("page_id") % 5 == 0, istex).otherwise(F.upper(istex)).alias("istexId"),
        _resource_names_from_bits(F.col("page_id")).alias("resources"),
        (F.col("page_id") % 24).cast("int").alias("spelling_index"),
        F.col("url").alias("oa_link"))
    return (recs.join(F.broadcast(spellings.select("spelling_index", "spelling")),
                      "spelling_index")
            .withColumnRenamed("spelling", "license").drop("spelling_index"))


def typed_ids(spark, d):
    typed = identifiers.typed_identifiers(_identifier_records(spark, d), strict=True,
                                          keep=["page_id"])
    return typed.select(
        "page_id", F.hex("id").alias("id_hex"), "pmid", F.col("pmcid.id").alias("pmcid_id"),
        F.hex("istex_id").alias("istex_hex"),
        F.array_join("resources", ",").alias("resource_codes"), "license")


def id_roundtrip_violations(spark, d):
    recs = _identifier_records(spark, d)
    return identifiers.roundtrip_violations(recs, key="page_id")


def licence_codes(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", (F.col("doc_id") % 24).cast("int").alias("spelling_index"))
    spellings = identifiers.spelling_dimension(spark)
    return (docs.join(F.broadcast(spellings), "spelling_index")
            .select("doc_id", "spelling", "license",
                    ids.licence_name(F.col("license")).alias("licence_name")))


def licence_distribution(spark, d):
    return identifiers.licence_distribution(licence_codes(spark, d).select("license"))


def resource_codes(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    names = _resource_names_from_bits(F.col("doc_id"))
    codes = ids.resource_codes(names)
    return docs.select("doc_id", F.array_join(names, ",").alias("resources"),
                       F.array_join(codes, ",").alias("codes"),
                       F.array_join(ids.resource_names(codes), ",").alias("names_back"))


# ---------------------------------------------------------------------------------------------
# Collation, sort and residual files
# ---------------------------------------------------------------------------------------------

def _page_file_names(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    suffixes = F.array(*[F.lit(s) for s in FILE_SUFFIXES])
    idx = (F.col("page_id") % len(FILE_SUFFIXES)).cast("int")
    stem = F.when(idx == len(FILE_SUFFIXES) - 1, F.lit("x")).otherwise(_uuid_of(F.col("url")))
    return pages.select("page_id", F.concat(stem, F.element_at(suffixes, idx + 1)).alias("name"))


def file_classes(spark, d):
    names = _page_file_names(spark, d)
    return names.select("page_id", "name", collate.classify_name("name").alias("parse_type"))


def residual_files(spark, d):
    return collate.residual_files(_page_file_names(spark, d), "name")


def bucket_collation(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    named = docs.select(F.concat(_uuid_of(F.col("doc_id")), F.lit(".software.json")).alias("name"),
                        "n_chars")
    collated = collate.collate_records(named, "name")
    return collate.bucket_summary(collated, "n_chars").select(
        "prefix", "n_records", F.col("total_size").alias("total_chars"))


def uuid_order(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", F.concat(_uuid_of(F.col("doc_id")), F.lit(".software.json")).alias("file"))
    keyed = docs.withColumn("uuid", collate.uuid_sort_key("file"))
    return dense_ids(keyed, ["uuid", "doc_id"], id_col="position").select("position", "doc_id",
                                                                           "uuid")


def last_by_key(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return collate.last_by_key(events, "user_id", "event_id", alias="user_id")


def _slim_records(spark, d):
    """Documents as per-paper mention files: the file is named by the document's UUID and each
    line is a mention whose software name is the whole line. Every document has a second file
    whose name holds no UUID; none of its mentions may come through."""
    recs = _documents_as_records(spark, d)
    names = F.array(_uuid_of(F.col("doc_id")), F.concat(F.lit("draft-"), F.col("doc_id")))
    return slim.slim_mentions(recs.select(
        F.explode(F.transform(names, lambda n: F.concat(n, F.lit(".software.json"))))
        .alias("_file_name"),
        F.transform("lines", lambda ln: F.struct(F.struct(
            ln.alias("normalizedForm"),
            F.lit(None).cast("string").alias("wikidataId")).alias("software-name")))
        .alias("mentions")))


def slim_children(spark, d):
    return _slim_records(spark, d).select(
        F.hex("id").alias("id_hex"), F.size("mentions").alias("n_items"),
        F.array_join(F.transform("mentions", lambda s: s["normalized_form"]), "|").alias("names"))


def slim_name_counts(spark, d):
    return slim.name_occurrences(_slim_records(spark, d))


# ---------------------------------------------------------------------------------------------
# Whole table build: documents as papers, their lines as mentions
# ---------------------------------------------------------------------------------------------

def _paper_records(spark, d):
    """Paper JSON records (``PAPER_JSON`` shape) derived from documents."""
    docs = table(spark, d, "documents")
    uuid = _uuid_of(F.col("doc_id"))
    year = F.when(F.col("doc_id") % 10 == 0, F.lit(0)).otherwise(2000 + F.col("doc_id") % 21)
    date = F.when(year == 0, F.lit("")).otherwise(F.format_string(
        "%d-%02d-%02d", year, (F.col("doc_id") % 12 + 1).cast("int"),
        (F.col("doc_id") % 28 + 1).cast("int")))
    return docs.select(
        uuid.alias("id"), F.concat(uuid, F.lit(".json")).alias("file"),
        F.substring_index("text", "\n", 1).alias("title"),
        year.cast("long").alias("year"), date.alias("published_date"),
        F.col("source").alias("journal_name"), F.col("lang").alias("publisher"),
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("10.1000/"), F.col("doc_id").cast("string")))
        .alias("doi"),
        F.lit("").alias("pmcid"), F.lit(None).cast("string").alias("pmid"),
        F.lit("journal-article").alias("genre"), F.lit("").alias("license"),
        F.substring(uuid, 1, 2).alias("bucket"))


def _score(x: Column) -> Column:
    return F.struct(x.alias("score"), F.lit(None).cast("boolean").alias("value"))


def _mention_records(spark, d):
    """Mention JSON records (``MENTION_JSON`` shape): one per document, listing its lines.

    Software name and version are the line's first and second words; scores are derived from the
    line length; documents with an odd id carry no document-level attributes (scores 0.0).
    Each line's length and words are computed once, then the mention structs are built from them.
    """
    docs = table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    no_forms = F.lit(None).cast("struct<normalizedForm:string,rawForm:string>")
    measured = F.transform(
        "lines",
        lambda ln: F.struct(ln.alias("line"), F.length(ln).alias("n"),
                            F.split(ln, " ", 3).alias("w")))

    def word(x, i):
        return F.coalesce(F.get(x["w"], i), F.lit(""))

    def mention(x):
        n = x["n"]
        local = F.struct(_score((n % 10) / 10.0).alias("created"),
                         _score((n % 7) / 10.0).alias("shared"),
                         _score((n % 3) / 10.0).alias("used"))
        doc = F.when(F.col("doc_id") % 2 == 0, F.struct(
            _score((n % 4) / 10.0).alias("created"), _score((n % 5) / 10.0).alias("shared"),
            _score((n % 6) / 10.0).alias("used")))
        return F.struct(
            F.struct(word(x, 0).alias("normalizedForm"), word(x, 1).alias("rawForm"),
                     F.lit(None).cast("string").alias("wikidataId")).alias("software-name"),
            F.struct(word(x, 1).alias("normalizedForm"), F.lit("").alias("rawForm"))
            .alias("version"),
            no_forms.alias("publisher"), no_forms.alias("language"), no_forms.alias("url"),
            x["line"].alias("context"),
            local.alias("mentionContextAttributes"), doc.alias("documentContextAttributes"))

    return docs.select(
        F.concat(_uuid_of(F.col("doc_id")), F.lit(".software.json")).alias("file"),
        F.transform(measured, mention).alias("mentions"))


def _built(spark, d):
    return tables.build_tables(_paper_records(spark, d), _mention_records(spark, d), "pdf")


def built_papers(spark, d):
    return _built(spark, d)[0]


def built_mentions(spark, d):
    return _built(spark, d)[1]


def built_assessments(spark, d):
    return _built(spark, d)[2]


# The three documented analyses, run by their own functions on the built tables.
BUILT_ITEM = "The"
BUILT_SINCE = 2010
BUILT_MIN_SCORE = 0.25


def built_papers_mentioning(spark, d):
    return analyses.distinct_owner_count(built_mentions(spark, d), item=BUILT_ITEM)


def built_yearly_counts(spark, d):
    papers, mentions, _ = _built(spark, d)
    return analyses.yearly_counts(mentions, papers, item=BUILT_ITEM)


def built_popular_used_since(spark, d):
    papers, mentions, purposes = _built(spark, d)
    return analyses.popular_used_since(papers, mentions, purposes, since_year=BUILT_SINCE,
                                       min_score=BUILT_MIN_SCORE)


QUERIES = {
    "distinct_key_count": distinct_key_count,
    "yearly_counts_for_item": yearly_counts_for_item,
    "popular_items_by_distinct_owner": popular_items_by_distinct_owner,
    "item_support": item_support,
    "item_support_total": item_support_total,
    "top_items": top_items,
    "co_items": co_items,
    "top_co_items": top_co_items,
    "category_counts_zero_filled": category_counts_zero_filled,
    "occurrence_counts": occurrence_counts,
    "exploded_children": exploded_children,
    "six_assessments": six_assessments,
    "children_exist_flag": children_exist_flag,
    "strict_lookup": strict_lookup,
    "lookup_violations": lookup_violations,
    "clean_rows": clean_rows,
    "dense_ids": dense_ids_query,
    "sample_assignment": sample_assignment,
    "sample_sizes": sample_sizes,
    "sampled_children": sampled_children,
    "json_profile": json_profile,
    "json_enums": json_enums,
    "json_empty_paths": json_empty_paths,
    "json_type_conflicts": json_type_conflicts,
    "json_report": json_report,
    "typed_ids": typed_ids,
    "id_roundtrip_violations": id_roundtrip_violations,
    "licence_codes": licence_codes,
    "licence_distribution": licence_distribution,
    "resource_codes": resource_codes,
    "file_classes": file_classes,
    "residual_files": residual_files,
    "bucket_collation": bucket_collation,
    "uuid_order": uuid_order,
    "last_by_key": last_by_key,
    "slim_children": slim_children,
    "slim_name_counts": slim_name_counts,
    "built_papers": built_papers,
    "built_mentions": built_mentions,
    "built_assessments": built_assessments,
    "built_papers_mentioning": built_papers_mentioning,
    "built_yearly_counts": built_yearly_counts,
    "built_popular_used_since": built_popular_used_since,
}
