"""Bibliographic identifier codecs as column expressions (text <-> typed form).

Each ``parse_*`` returns NULL for input it cannot parse and has a matching ``valid_*`` predicate,
so that strict callers can raise and quarantine callers can split rows on the same rule.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.functions.text import col, empty_to_null
from citeweave.schemas import LICENCE_CANONICAL, LICENCE_SPELLINGS, RESOURCE_CODES

_UUID_TEXT = r"^(?i)[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}$"
_DIGITS = r"^[0-9]{1,10}$"
_PMCID = r"^PMC([0-9]{1,10})(?:\.([0-9]{1,10}))?$"
_UINT32_MAX = 4294967295


def _literal_map(pairs) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs))


# UUID --------------------------------------------------------------------------------------

def valid_uuid(text: Column | str) -> Column:
    return F.coalesce(col(text).rlike(_UUID_TEXT), F.lit(False))


def parse_uuid(text: Column | str) -> Column:
    """Canonical (or undashed) UUID text to 16 bytes."""
    t = col(text)
    return F.when(valid_uuid(t), F.unhex(F.replace(t, F.lit("-"), F.lit(""))))


def format_uuid(raw: Column | str) -> Column:
    """16 bytes to the canonical lower-case 8-4-4-4-12 text."""
    h = F.lower(F.hex(col(raw)))
    return F.when(F.length(col(raw)) == 16, F.regexp_replace(
        h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


# PMID --------------------------------------------------------------------------------------

def valid_pmid(text: Column | str) -> Column:
    t = empty_to_null(text)
    return t.isNull() | (t.rlike(_DIGITS) & (t.cast("long") <= _UINT32_MAX))


def parse_pmid(text: Column | str) -> Column:
    """Decimal digits to a number; '' gives NULL."""
    t = empty_to_null(text)
    return F.when(t.rlike(_DIGITS) & (t.try_cast("long") <= _UINT32_MAX), t.cast("long"))


def format_pmid(n: Column | str) -> Column:
    return F.coalesce(col(n).cast("string"), F.lit(""))


# PMCID -------------------------------------------------------------------------------------

def _pmcid_in_range(t: Column) -> Column:
    """The pattern holds and number and version fit 32 unsigned bits, as PMIDs must."""
    number = F.regexp_extract(t, _PMCID, 1).try_cast("long")
    version = F.nullif(F.regexp_extract(t, _PMCID, 2), F.lit(""))
    return (t.rlike(_PMCID) & F.coalesce(number <= _UINT32_MAX, F.lit(False))
            & (version.isNull() | F.coalesce(version.try_cast("long") <= _UINT32_MAX,
                                             F.lit(False))))


def valid_pmcid(text: Column | str) -> Column:
    t = empty_to_null(text)
    return t.isNull() | F.coalesce(_pmcid_in_range(t), F.lit(False))


def parse_pmcid(text: Column | str) -> Column:
    """``PMC<n>[.<version>]`` to struct<id, version>; '' gives NULL."""
    t = empty_to_null(text)
    number = F.regexp_extract(t, _PMCID, 1)
    version = F.regexp_extract(t, _PMCID, 2)
    return F.when(_pmcid_in_range(t), F.struct(
        number.try_cast("long").alias("id"),
        F.nullif(version, F.lit("")).try_cast("long").alias("version")))


def format_pmcid(s: Column | str) -> Column:
    s = col(s)
    return F.when(s.isNull(), F.lit("")).otherwise(F.concat(
        F.lit("PMC"), s["id"].cast("string"),
        F.when(s["version"].isNotNull(), F.concat(F.lit("."), s["version"].cast("string")))
        .otherwise(F.lit(""))))


# ISTEX -------------------------------------------------------------------------------------

def valid_istex(text: Column | str) -> Column:
    t = empty_to_null(text)
    return t.isNull() | t.rlike(r"^[0-9a-fA-F]{40}$")


def parse_istex(text: Column | str) -> Column:
    """40 hex digits to 20 bytes; '' gives NULL."""
    t = empty_to_null(text)
    return F.when(t.rlike(r"^[0-9a-fA-F]{40}$"), F.unhex(t))


def format_istex(raw: Column | str) -> Column:
    """20 bytes to upper-case hex; NULL gives ''."""
    return F.coalesce(F.upper(F.hex(col(raw))), F.lit(""))


# Licence -----------------------------------------------------------------------------------

def licence_code(text: Column | str) -> Column:
    """Accepted licence spelling to its code (NULL for an unknown spelling, 0 for '' or NULL)."""
    return F.try_element_at(_literal_map(LICENCE_SPELLINGS), F.coalesce(col(text), F.lit("")))


def licence_name(code: Column | str) -> Column:
    """Code to the canonical spelling (case of the input spelling is not preserved)."""
    return F.try_element_at(_literal_map((c, n) for c, n in LICENCE_CANONICAL), col(code))


# Resources ---------------------------------------------------------------------------------

def resource_codes(arr: Column | str) -> Column:
    """array<string> of resource names to array<int> codes; an unknown name maps to NULL."""
    m = _literal_map(RESOURCE_CODES)
    return F.transform(col(arr), lambda r: F.try_element_at(m, r))


def resource_names(arr: Column | str) -> Column:
    m = _literal_map((code, name) for name, code in RESOURCE_CODES)
    return F.transform(col(arr), lambda c: F.try_element_at(m, c))


def all_known(arr: Column) -> Column:
    """True when no element of a looked-up array is NULL (NULL arrays count as known)."""
    return F.coalesce(F.forall(arr, lambda x: x.isNotNull()), F.lit(True))
