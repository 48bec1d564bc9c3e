"""Key construction: composite mention ids, UUIDs from file names, prefix buckets, unit hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.functions.text import col


def mention_id(paper_id: Column | str, source_type: Column | str, index: Column | str) -> Column:
    """``%10d.%s.%05d``: paper id space-padded to 10, type, 0-based index zero-padded to 5."""
    return F.format_string("%10d.%s.%05d", col(paper_id).cast("long"), col(source_type),
                           col(index).cast("int"))


def uuid_of_name(name: Column | str) -> Column:
    """The first 36 characters of a file name or ``file`` field are the paper UUID."""
    return F.substring(col(name), 1, 36)


def first_dotted_part(name: Column | str) -> Column:
    return F.substring_index(col(name), ".", 1)


def prefix_bucket(uuid: Column | str, width: int = 2) -> Column:
    """Top-level directory of the raw tree: the first characters of the UUID."""
    return F.lower(F.substring(col(uuid), 1, width))


def uuid_from_hex32(hex32: Column | str) -> Column:
    """Format 32 hex digits as a canonical 8-4-4-4-12 lower-case UUID."""
    h = F.lower(col(hex32))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def unit_hash(seed: int, key: Column | str) -> Column:
    """A uniform draw in [0, 1) that depends only on (seed, key).

    The first 32 bits of ``md5('<seed>:<key>')`` divided by 2^32. Being a pure function of the key,
    it gives the same draw for a key in every table and for any partitioning of the input.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
