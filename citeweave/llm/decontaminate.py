"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text is hashed word by word, words are combined to k-grams, and every window of ``span`` words
keeps the smallest of its k-gram hashes as its fingerprint (span = k + w - 1 for winnows of w
k-grams). Equal windows have equal fingerprints, so joining the fingerprints of documents and
benchmark items finds every shared span of ``span`` words or more: nothing shared is missed. The
few windows that share a fingerprint are then compared word by word with the benchmark's windows,
and the union of neighbouring equal windows extends each hit to the whole shared passage.

Items shorter than ``span`` words are one window of their own length; each such length that occurs
(at most span - 1) is winnowed with its own w in the same pass over the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import ascii_lower, let
from citeweave.session import write_scratch

SPAN_WORDS = 13
GRAM_WORDS = 4
# The benchmark side (texts of its distinct windows and their item ids) is broadcast up to this
# size; beyond it the documents' fingerprints are shuffled instead.
BROADCAST_BYTES = 32 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: runs of digits, letters a-z (A-Z lower-cased) and characters from U+0080
    on. Null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _each(n: Column, make) -> Column:
    """[make(1), ..., make(n)]; empty for n < 1."""
    return (F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), make))
            .otherwise(F.transform(F.array().cast("array<int>"), make)))


def _classes(words_: Column, lengths: list[int], gram_words: int) -> Column:
    """For each window length L an entry (length, fingerprints of all its windows)."""
    grams = sorted({min(gram_words, n) for n in lengths})

    def gram_hashes(hashes: Column, k: int) -> Column:
        return _each(F.size(hashes) - (k - 1), lambda i: F.xxhash64(
            *[F.get(hashes, i + (j - 1)) for j in range(k)]))

    def prints(by_size: Column, n: Column, length: int) -> Column:
        k = min(gram_words, length)
        own = F.get(by_size, F.lit(grams.index(k)))
        if length == k:
            return own
        return let(own, lambda g: _each(n - (length - 1), lambda i: F.array_min(
            F.slice(g, i, length - k + 1))))

    return let(F.transform(words_, lambda w: F.xxhash64(w)), lambda hashes: let(
        F.array(*[gram_hashes(hashes, k) for k in grams]), lambda by_size: F.array(*[
            F.struct(F.lit(length).alias("length"),
                     prints(by_size, F.size(hashes), length).alias("prints"))
            for length in lengths])))


def _windows(rows: DataFrame, classes: Column, *keep: str) -> DataFrame:
    """One row per window: its length, position (from 0) and fingerprint. The fingerprints are an
    expression, not a column: of an exploded column the optimizer infers a filter, which would
    compute them again."""
    return (rows.select(*keep, "words", F.explode(classes).alias("class"))
            .select(*keep, "words", F.col("class.length").alias("length"),
                    F.posexplode("class.prints").alias("at", "print")))


def _content() -> Column:
    return F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", span_words: int = SPAN_WORDS,
                  gram_words: int = GRAM_WORDS, min_share: int = 20,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """How much of each document is covered by windows that occur in a benchmark item.

    One row per document row: ``id``, ``text_hash`` (of the text; with the id it names the row),
    ``n_words``, ``n_hit`` (words inside any occurrence of an item's window), ``n_items``,
    ``item_ids`` (distinct, sorted as strings), ``windows`` (the matched windows as word ranges by
    start, end exclusive; null if none) and ``contaminated`` (n_hit > 0 and min_share * n_hit >= n_words).

    Null and empty texts have no words and no hits; an item without words has no window; items
    with a null id count for hits but are not listed; repeated item ids are listed once. Document
    rows that agree in id and text get equal rows. With an empty table on either side there are
    no hits. Other columns are not looked at.
    """
    spark = docs.sparkSession
    # The benchmark: distinct windows with the ids of their items.
    item_rows = (items.select(F.col(item_id_col).cast("string").alias("item_id"),
                              words(F.col(item_text_col)).alias("words"))
                 .where(F.size("words") > 0))
    lengths = sorted(r[0] for r in item_rows.select(
        F.least(F.size("words"), F.lit(span_words)).alias("n")).distinct().collect())
    base = docs.select(F.col(id_col).alias("id"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"),
                       words(F.col(text_col)).alias("words"))
    counted = base.select("id", "text_hash", F.size("words").cast("long").alias("n_words"))
    if not lengths:
        lengths = [span_words]
    # An item takes part in the class of its own length or of the full span, never in a shorter.
    own = F.least(F.size("words"), F.lit(span_words))
    classes = _classes(F.col("words"), lengths, gram_words)
    # One row per window and item: a prompt that many items share makes many rows, no long list.
    window = ["length", "print", "content"]
    bench_items = spark.read.parquet(write_scratch(
        _windows(item_rows.withColumn("own", own), classes, "item_id", "own")
        .where("length = own").select("length", "print", _content().alias("content"), "item_id")
        .distinct(), "benchmark-items"))
    bench_windows = spark.read.parquet(write_scratch(
        bench_items.select(*window).distinct()
        .withColumn("window_id", F.monotonically_increasing_id()), "benchmark-windows"))
    items_of = bench_items.where("item_id IS NOT NULL").join(bench_windows, window).select(
        "window_id", "item_id")
    size = bench_windows.agg(F.sum(F.octet_length("content") + 64)).first()
    small = (size[0] or 0) <= broadcast_bytes
    prints = bench_windows.select("length", "print").distinct()

    if small:
        # Both sides of the match stay in the scan's tasks: no text is shuffled.
        near = (_windows(base, classes, "id", "text_hash")
                .join(F.broadcast(prints), ["length", "print"], "left_semi")
                .select("id", "text_hash", "length", "at", "print", _content().alias("content")))
        matched = near.join(F.broadcast(bench_windows), ["length", "print", "content"])
    else:
        # A large benchmark: shuffle the distinct fingerprints, and texts of candidates only.
        narrow = (base.select("id", "text_hash", F.explode(classes).alias("class"))
                  .select("id", "text_hash", F.col("class.length").alias("length"),
                          F.explode(F.array_distinct("class.prints")).alias("print")))
        found = (narrow.join(prints, ["length", "print"], "left_semi")
                 .select(F.col("id").alias("found_id"), F.col("text_hash").alias("found_hash"))
                 .distinct())
        candidates = base.join(found, F.col("id").eqNullSafe(F.col("found_id"))
                               & F.col("text_hash").eqNullSafe(F.col("found_hash")), "left_semi")
        near = (_windows(candidates, classes, "id", "text_hash")
                .select("id", "text_hash", "length", "at", "print", _content().alias("content")))
        matched = near.join(bench_windows, ["length", "print", "content"])

    hits = spark.read.parquet(write_scratch(
        matched.select("id", "text_hash", "at", "length", "window_id"), "benchmark-hits"))
    spans = hits.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(F.struct(
        F.col("at").alias("start"), (F.col("at") + F.col("length")).alias("end"))))
        .alias("windows"))
    listed = (hits.select("id", "text_hash", "window_id").distinct().join(items_of, "window_id")
              .select(F.col("id").alias("i_id"), F.col("text_hash").alias("i_hash"), "item_id")
              .distinct().groupBy("i_id", "i_hash")
              .agg(F.array_sort(F.collect_list("item_id")).alias("item_ids")))
    per_doc = spans.join(listed, F.col("id").eqNullSafe(F.col("i_id"))
                         & F.col("text_hash").eqNullSafe(F.col("i_hash")), "left").select(
        F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "windows", "item_ids")
    out = counted.join(per_doc, F.col("id").eqNullSafe(F.col("hit_id"))
                       & F.col("text_hash").eqNullSafe(F.col("hit_hash")), "left")
    # The length of the union of the windows, which are sorted by their start.
    union = F.aggregate(
        "windows", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda done, w: F.struct(
            (done["n"] + F.greatest(F.lit(0), w["end"] - F.greatest(done["end"], w["start"])))
            .alias("n"), F.greatest(done["end"], w["end"]).alias("end")))["n"]
    return (out.withColumn("n_hit", F.coalesce(union, F.lit(0)).cast("long"))
            .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
            .select("id", "text_hash", "n_words", "n_hit",
                    F.size("item_ids").cast("long").alias("n_items"), "item_ids", "windows",
                    ((F.col("n_hit") > 0) & (F.col("n_hit") * min_share >= F.col("n_words")))
                    .alias("contaminated")))


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """``docs`` (all columns) without the contaminated documents."""
    bad = (contamination(docs, items, id_col, text_col, **options).where("contaminated")
           .select(F.col("id").alias("bad_id"), F.col("text_hash").alias("bad_hash")))
    # A sort-merge join at every size: the list of documents grows with the corpus.
    return docs.join(bad.hint("merge"), docs[id_col].eqNullSafe(bad["bad_id"])
                     & F.xxhash64(docs[text_col]).eqNullSafe(bad["bad_hash"]), "left_anti")
