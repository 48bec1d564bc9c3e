"""Declared schemas of the three relational tables, the JSON inputs, and the fixed enum domains.

Column comments are stored as Spark field metadata (``{"comment": ...}``); they survive a
Parquet round trip and show in ``DESCRIBE``.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, nullable: bool, comment: str) -> T.StructField:
    return T.StructField(name, dtype, nullable, metadata={"comment": comment})


# ---------------------------------------------------------------------------------------------
# Relational tables
# ---------------------------------------------------------------------------------------------

PAPERS_COMMENT = "One row per paper (source document) with bibliographic metadata."
TABLE_COMMENTS = {
    "papers": PAPERS_COMMENT,
    "mentions": "One row per mention of software in a paper.",
    "purpose_assessments": "Six rows per mention: how certain each purpose is, in each scope.",
}

PAPERS = T.StructType([
    _f("paper_id", T.LongType(), False, "Dense sequential id of the paper, starting at 1."),
    _f("source_uuid", T.StringType(), False, "36-character UUID of the paper in the source dump."),
    _f("title", T.StringType(), True, "Title of the paper."),
    _f("published_year", T.IntegerType(), True, "Year of publication."),
    _f("published_date", T.DateType(), True, "Date of publication."),
    _f("publication_venue", T.StringType(), True, "Journal or venue name."),
    _f("publisher_name", T.StringType(), True, "Name of the publisher."),
    _f("doi", T.StringType(), False, "DOI; empty string when absent."),
    _f("pmcid", T.StringType(), True, "PubMed Central id."),
    _f("pmid", T.StringType(), True, "PubMed id."),
    _f("genre", T.StringType(), True, "Kind of publication (journal-article, preprint, ...)."),
    _f("license_type", T.StringType(), True, "Licence spelling as found in the source."),
    _f("has_mentions", T.BooleanType(), False, "True when the paper has at least one mention."),
])

MENTIONS = T.StructType([
    _f("software_mention_id", T.StringType(), False,
       "Composite id: paper_id space-padded to 10, source type, index zero-padded to 5."),
    _f("paper_id", T.LongType(), False, "Paper containing the mention."),
    _f("source_file_type", T.StringType(), False, "Parse type the mention came from."),
    _f("mention_index", T.IntegerType(), False, "0-based position of the mention in its paper."),
    _f("software_raw", T.StringType(), False, "Software name as written."),
    _f("software_normalized", T.StringType(), False, "Normalized software name."),
    _f("version_raw", T.StringType(), True, "Version as written."),
    _f("version_normalized", T.StringType(), True, "Normalized version."),
    _f("publisher_raw", T.StringType(), True, "Software publisher as written."),
    _f("publisher_normalized", T.StringType(), True, "Normalized software publisher."),
    _f("language_raw", T.StringType(), True, "Programming language as written."),
    _f("language_normalized", T.StringType(), True, "Normalized programming language."),
    _f("url_raw", T.StringType(), True, "URL as written."),
    _f("url_normalized", T.StringType(), True, "Normalized URL."),
    _f("context_full_text", T.StringType(), True, "Text snippet around the mention."),
])

PURPOSE_ASSESSMENTS = T.StructType([
    _f("software_mention_id", T.StringType(), False, "Mention the assessment belongs to."),
    _f("paper_id", T.LongType(), False, "Paper containing the mention."),
    _f("source_file_type", T.StringType(), False, "Parse type the mention came from."),
    _f("mention_index", T.IntegerType(), False, "0-based position of the mention in its paper."),
    _f("scope", T.StringType(), False, "document: all mentions of the paper; local: this mention."),
    _f("purpose", T.StringType(), False, "created, shared or used."),
    _f("certainty_score", T.DoubleType(), False, "Model certainty in 0..1."),
])

# ---------------------------------------------------------------------------------------------
# JSON inputs (declared subsets; undeclared keys are ignored by the reader)
# ---------------------------------------------------------------------------------------------

PAPER_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("year", T.LongType()),
    T.StructField("published_date", T.StringType()),
    T.StructField("journal_name", T.StringType()),
    T.StructField("publisher", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("pmcid", T.StringType()),
    T.StructField("pmid", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("license", T.StringType()),
])

_FORMS = T.StructType([
    T.StructField("normalizedForm", T.StringType()),
    T.StructField("rawForm", T.StringType()),
])

_SCORE = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("value", T.BooleanType()),
])

_ATTRIBUTES = T.StructType([
    T.StructField("created", _SCORE),
    T.StructField("shared", _SCORE),
    T.StructField("used", _SCORE),
])

MENTION_ITEM_JSON = T.StructType([
    T.StructField("software-name", T.StructType([
        T.StructField("normalizedForm", T.StringType()),
        T.StructField("rawForm", T.StringType()),
        T.StructField("wikidataId", T.StringType()),
    ])),
    T.StructField("version", _FORMS),
    T.StructField("publisher", _FORMS),
    T.StructField("language", _FORMS),
    T.StructField("url", _FORMS),
    T.StructField("context", T.StringType()),
    T.StructField("mentionContextAttributes", _ATTRIBUTES),
    T.StructField("documentContextAttributes", _ATTRIBUTES),
])

MENTION_JSON = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("mentions", T.ArrayType(MENTION_ITEM_JSON)),
])

IDENTIFIER_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("arxiv", T.StringType()),
    T.StructField("pmid", T.StringType()),
    T.StructField("pmcid", T.StringType()),
    T.StructField("istexId", T.StringType()),
    T.StructField("resources", T.ArrayType(T.StringType())),
    T.StructField("license", T.StringType()),
    T.StructField("oa_link", T.StringType()),
])

TYPED_IDENTIFIER = T.StructType([
    T.StructField("id", T.BinaryType(), False),
    T.StructField("doi", T.StringType()),
    T.StructField("arxiv", T.StringType()),
    T.StructField("pmid", T.LongType()),
    T.StructField("pmcid", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("version", T.LongType()),
    ])),
    T.StructField("istex_id", T.BinaryType()),
    T.StructField("resources", T.ArrayType(T.IntegerType())),
    T.StructField("license", T.IntegerType()),
    T.StructField("oa_link", T.StringType()),
])

SLIM_MENTIONS = T.StructType([
    T.StructField("id", T.BinaryType(), False),
    T.StructField("mentions", T.ArrayType(T.StructType([
        T.StructField("normalized_form", T.StringType()),
        T.StructField("wikidata_id", T.StringType()),
    ]))),
])

# ---------------------------------------------------------------------------------------------
# Fixed values. These must equal the source data's vocabulary for results to be right.
# ---------------------------------------------------------------------------------------------

# Licence codes and their canonical spellings, code 0 .. 16 in order.
LICENCE_CANONICAL = [
    (0, ""),
    (1, "cc-by"),
    (2, "cc-by-nc-nd"),
    (3, "cc-by-nc"),
    (4, "arXiv"),
    (5, "cc-by-nc-sa"),
    (6, "cc-by-sa"),
    (7, "cc0"),
    (8, "elsevier-specific: oa user license"),
    (9, "implied-oa"),
    (10, "pd"),
    (11, "NO-CC CODE"),
    (12, "cc-by-nd"),
    (13, "publisher-specific license"),
    (14, "publisher-specific, author manuscript"),
    (15, "acs-specific: authorchoice/editors choice usage agreement"),
    (16, "Open Government Licence - Canada"),
]

# The seven licences that also have an upper-case spelling ("CC BY" for "cc-by").
LICENCE_UPPER_ALIASES = [
    ("CC BY", 1),
    ("CC BY-NC-ND", 2),
    ("CC BY-NC", 3),
    ("CC BY-NC-SA", 5),
    ("CC BY-SA", 6),
    ("CC0", 7),
    ("CC BY-ND", 12),
]

# All 24 accepted spellings: the 17 canonical ones followed by the 7 aliases.
LICENCE_SPELLINGS = [(name, code) for code, name in LICENCE_CANONICAL] + LICENCE_UPPER_ALIASES

# Resource kinds and their codes.
RESOURCE_CODES = [("json", 1), ("pdf", 2), ("latex", 3), ("xml", 4)]

# Generic names dropped before popularity counts (case-sensitive).
GENERIC_SOFTWARE_NAMES = [
    "script", "code", "scripts", "survival", "library", "software", "interface", "program",
]

# Scopes and purposes of an assessment, in output order.
SCOPES = ["document", "local"]
PURPOSES = ["created", "shared", "used"]

# Parse types and the file-name suffix each one uses in the raw tree.
PARSE_SUFFIXES = [
    ("paper", ".json"),
    ("pdf", ".software.json"),
    ("jats", ".jats.software.json"),
    ("pub2tei", ".pub2tei.tei.json"),
    ("pub2tei", ".pub2tei.tei.software.json"),
    ("latex", ".latex.tei.software.json"),
    ("grobid", ".grobid.tei.software.json"),
]

UUID_PATTERN = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"

MAX_ENUM_VALUES = 20
DEFAULT_MIN_SUPPORT = 100
DEFAULT_SAMPLE_FRACTIONS = (0.01, 0.05)
