"""License scans by MinHash bands over overlapping text windows, in DataFrame functions only.

Templates (license sentences, notices and whole texts, see ``license_templates``) and texts are cut
into five-word shingles. Templates of similar size form a class with its own window: two
neighbouring blocks of S shingles, S being the largest template of which a member has at least six
tenths, so every occurrence lies whole in some window. A window and a template meet when
any of b MinHash values agree (bands of one row). b follows from the smallest Jaccard similarity
that a window holding a match can have, so that such a pair is retrieved with probability at least
1 - MISS. A window is compared with the templates it met and no others: each such pair is verified
by exact containment of the template's shingles.

A window's minimum in a band equals the template's only if the window holds the very shingle at
which the template takes it. Shingles are therefore screened against those few first, and minima
are computed for the windows around them: the retrieved pairs are the same.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.common import let
from citeweave.llm.decontaminate import words
from citeweave.llm.license_templates import TEMPLATES

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
MISS = 1e-4
# The templates are a parameter, not data: their number is bounded.
MAX_TEMPLATES = 2000


def bands_needed(smallest: int, block: int, containment: float = CONTAINMENT,
                 miss: float = MISS) -> int:
    """Bands of one row with which a window that holds a match of a template of ``smallest``
    shingles is missed with probability ``miss`` at most."""
    if block == 1:
        return 1  # the window is the shingle itself
    shared = math.ceil(containment * smallest)
    jaccard = shared / (2 * block + smallest - shared)
    return math.ceil(math.log(miss) / math.log(1 - jaccard))


def _shingle_hashes(tokens: Column) -> Column:
    n = F.size(tokens) - (SHINGLE_WORDS - 1)
    return F.when(n >= 1, let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - SHINGLE_WORDS),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE_WORDS)])))).otherwise(
        F.array().cast("array<bigint>"))


def _salts(spark: SparkSession, n: int) -> list[int]:
    """One 64-bit constant per band; xor with it permutes the hashes."""
    return [r[0] for r in spark.range(n).select(F.xxhash64("id", F.lit("band"))).collect()]


def _minima(hashes: Column, salts: Sequence[int]) -> Column:
    return F.transform(_literal(salts), lambda salt: F.array_min(
        F.transform(hashes, lambda x: x.bitwiseXOR(salt))))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
         id_col: str = "doc_id", text_col: str = "text",
         containment: float = CONTAINMENT) -> DataFrame:
    """License templates found in every whole text.

    One row per document row (id and text) and template that some window contains to at least
    ``containment``: ``id``, ``text_hash``, ``license``, ``containment`` (the largest) and
    ``first_word`` (where the first such window begins). Texts and templates of fewer than five
    words, null texts and empty tables match nothing; rows that agree in id and text count as one;
    templates may repeat a name; other columns are not looked at.
    """
    spark = docs.sparkSession
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    listed = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(templates)],
                                   "k int, license string, text string")
    known = [(r["license"], sorted(set(r["hashes"]))) for r in listed.select(
        "k", "license", _shingle_hashes(words(F.col("text"))).alias("hashes")).orderBy("k")
        .collect() if r["hashes"]]
    # Classes of templates of similar size, by their block.
    sizes = {len(hashes) for _, hashes in known}
    classes: dict[int, list[tuple[str, list[int]]]] = defaultdict(list)
    for item in known:
        classes[max(n for n in sizes if 6 * n <= 10 * len(item[1]))].append(item)
    bands = {block: bands_needed(min(len(t) for _, t in members), block, containment)
             for block, members in classes.items()}
    salts = _salts(spark, max(bands.values(), default=0))
    # The shingle at which each template takes its minimum, by class, template and band.
    least = {block: [[int(t[np.argmin(t ^ np.int64(salt))]) for salt in salts[:bands[block]]]
                     for t in (np.array(hashes, np.int64) for _, hashes in members)]
             for block, members in classes.items()}

    def met(window: Column, block: int) -> Column:
        """Members of the class that agree with the window in a band, by their place in it."""
        use = salts[:bands[block]]
        minima = [[value ^ salt for value, salt in zip(row, use)] for row in least[block]]
        flat = _literal(list(chain.from_iterable(minima)))
        return let(_minima(window, use), lambda own: F.when(
            F.arrays_overlap(own, flat),
            F.filter(_places(len(minima)), lambda m: F.exists(
                F.zip_with(own, F.slice(flat, m * len(use) + 1, len(use)), lambda x, y: x == y),
                lambda same: same))))

    def candidates(hashes: Column, screened: Column, block: int) -> Column:
        """Where the windows begin that hold a shingle at which the class takes a minimum."""
        hits = F.filter(screened, lambda i: F.array_contains(
            _literal(sorted(set(chain.from_iterable(least[block])))), F.get(hashes, i)))
        if block > 1:
            blocks = F.array_distinct(F.transform(hits, lambda i: F.floor(i / block).cast("int")))
            hits = F.transform(F.array_distinct(F.flatten(F.transform(blocks, lambda k: F.array(
                F.greatest(k - 1, F.lit(0)), k)))), lambda k: k * block)
        return hits

    def verified(hashes: Column, screened: Column, block: int) -> Column:
        """Containment of each template that a window met, in that window."""
        width, members = 1 if block == 1 else 2 * block, classes[block]
        names = F.array(*[F.lit(name) for name, _ in members])
        flat = _literal(list(chain.from_iterable(t for _, t in members)))
        ends = list(accumulate(len(t) for _, t in members))
        starts, lengths = (_literal([0, *ends[:-1]]), _literal([len(t) for _, t in members]))

        def contained(m: Column, window: Column, at: Column) -> Column:
            n = F.get(lengths, m)
            shingles = F.slice(flat, (F.get(starts, m) + 1).cast("int"), n.cast("int"))
            return F.struct(F.get(names, m).alias("license"), at.alias("at"),
                            (F.size(F.array_intersect(shingles, window)) / n.cast("double"))
                            .alias("containment"))

        return F.flatten(F.filter(F.transform(
            candidates(hashes, screened, block), lambda at: let(
                F.slice(hashes, at + 1, width), lambda window: F.transform(
                    met(window, block), lambda m: contained(m, window, at)))),
            lambda found: found.isNotNull()))

    # One test for all classes finds the few positions at which any template takes a minimum.
    every = sorted({value for rows in least.values() for row in rows for value in row})

    def all_classes(hashes: Column) -> Column:
        return let(F.filter(F.sequence(F.lit(0), F.size(hashes) - 1),
                            lambda i: F.get(hashes, i).isin(every)),
                   lambda screened: F.concat(F.array().cast(kind), *[
                       verified(hashes, screened, block).cast(kind) for block in classes]))

    kind = "array<struct<license:string,at:int,containment:double>>"
    found = let(_shingle_hashes(words(F.col(text_col))), lambda hashes: F.when(
        F.size(hashes) > 0, all_classes(hashes)))
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                        F.explode(F.filter(found, lambda m: m["containment"] >= containment))
                        .alias("match"))
            .groupBy("id", "text_hash", F.col("match.license").alias("license"))
            .agg(F.max("match.containment").alias("containment"),
                 F.min("match.at").cast("long").alias("first_word")))


def _places(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _literal(hashes: Sequence[int]) -> Column:
    """A constant array; the optimizer folds it, and it takes one call however long it is."""
    return F.split(F.lit(",".join(map(str, hashes))), ",").cast("array<bigint>")
