"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are byte n-grams inside words (with their boundary), hashed to buckets. A text is the mean
of its subwords' embeddings; embeddings and the softmax layer are trained together by stochastic
gradient descent in numpy on a bounded sample of labelled rows. Part of the sample is kept back to
set a temperature (so scores are calibrated probabilities) and the score below which a prediction
is rejected. Prediction reads whole texts of any length, in slices of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
DIMENSION = 16
# The bound of the training sample: rows, and bytes of a row's text (longer texts give a slice).
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 32768
EPOCHS, BATCH, RATE = 6, 32, 0.4
CALIBRATION_SHARE = 0.2
# At most this share of right predictions may be rejected (on the calibration rows), and nothing
# at or above CERTAIN ever is.
FALSE_REJECTIONS, CERTAIN = 0.001, 0.5
SLICE_BYTES = 1 << 20

# Bytes as the n-grams see them: letters in lower case, multi-byte characters as they are, all
# else one blank.
_SEEN = np.full(256, 32, np.uint8)
_SEEN[0x80:] = np.arange(0x80, 0x100)
_SEEN[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SEEN[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def _subwords(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of the n-gram at every position, and whether it counts: blanks
    may only stand at its ends, and not alone."""
    blank = data == 32
    wide = data.astype(np.uint32)
    value = wide
    for n in range(2, max(ORDERS) + 1):
        value = value[:-1] * np.uint32(0x01000193) + wide[n - 1:] if len(data) >= n else value[:0]
        if n in ORDERS:
            size = max(0, len(data) - n + 1)
            inner = np.zeros(size, bool)
            for k in range(1, n - 1):
                inner |= blank[k:k + size]
            if n == 2:
                inner |= blank[:size] & blank[1:1 + size]
            mixed = value * np.uint32(2654435761) + np.uint32(n)
            yield (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)), ~inner


@dataclass
class Model:
    """``weights``: for each bucket its part of the class scores (embedding times softmax layer,
    which is linear) or its embedding when there are more classes than dimensions."""

    languages: list[str]
    weights: np.ndarray
    layer: np.ndarray | None
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def sums(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Summed bucket weights and the number of subwords of each text (arrays of bytes)."""
        totals = np.zeros((len(texts), self.weights.shape[1]))
        counts = np.zeros(len(texts), np.int64)
        reach = max(ORDERS) - 1
        # Long texts in slices that overlap by the longest n-gram less one byte; short ones joined.
        pieces, size = [], 0
        for k, text in enumerate(texts):
            for at in range(0, len(text), SLICE_BYTES):
                piece = text[at:at + SLICE_BYTES + reach]
                pieces.append((k, piece, at == 0, min(SLICE_BYTES, len(text) - at)))
                size += len(piece)
                if size >= SLICE_BYTES:
                    self._add(pieces, totals, counts)
                    pieces, size = [], 0
        if pieces:
            self._add(pieces, totals, counts)
        return totals, counts

    def _add(self, pieces, totals, counts) -> None:
        # Blanks around each piece mark word boundaries and separate texts.
        lengths = np.array([len(p[1]) + 2 for p in pieces])
        data = np.full(int(lengths.sum()), 32, np.uint8)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        for (_, piece, _, _), start in zip(pieces, starts):
            data[start + 1:start + 1 + len(piece)] = piece
        data = _SEEN[data]
        owner = np.array([p[0] for p in pieces])
        # n-grams start in the slice itself (the overlap only completes its last ones), or at the
        # blank in front of a text's first slice.
        own_end = starts + 1 + np.array([p[3] for p in pieces])
        later = starts[~np.array([p[2] for p in pieces])]
        for buckets, counted in _subwords(data):
            counted = counted.copy()
            counted[later[later < len(counted)]] = False
            for own, end in zip(own_end, ends):
                counted[own:end] = False
            before = np.concatenate([[0], np.cumsum(counted)])
            cut = before[np.minimum(np.append(starts, len(counted)), len(counted))]
            chosen = self.weights[buckets[counted]]
            full = np.flatnonzero(np.diff(cut) > 0)
            if len(full):
                np.add.at(totals, owner[full], np.add.reduceat(chosen, cut[:-1][full], axis=0))
                np.add.at(counts, owner[full], np.diff(cut)[full])

    def probabilities(self, texts: list[np.ndarray]) -> np.ndarray:
        totals, counts = self.sums(texts)
        mean = totals / np.maximum(counts, 1)[:, None]
        scores = (mean if self.layer is None else mean @ self.layer) + self.bias
        return _softmax(scores / self.temperature)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 1) -> Model | None:
    """Fit a model on the given rows; None without any label."""
    languages = sorted(set(labels))
    if not languages:
        return None
    target = np.array([languages.index(x) for x in labels])
    rows = []
    for text in texts:
        # Blanks around the text, as in prediction.
        data = _SEEN[np.frombuffer(b" " + text.encode("utf-8", "replace") + b" ", np.uint8)]
        found = np.concatenate([b[ok] for b, ok in _subwords(data)])
        rows.append(np.unique(found, return_counts=True))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    n_held = int(len(rows) * CALIBRATION_SHARE)
    held, learn = order[:n_held], order[n_held:]
    embeddings = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype("f4")
    layer = np.zeros((DIMENSION, len(languages)), "f4")
    bias = np.zeros(len(languages), "f4")

    def gather(batch):
        parts = [rows[k] for k in batch]
        sizes = np.array([len(i) for i, _ in parts])
        index = np.concatenate([i for i, _ in parts])
        counts = np.concatenate([c for _, c in parts]).astype("f4")
        where = np.repeat(np.arange(len(batch)), sizes)
        total = np.bincount(where, counts, len(batch)).astype("f4")
        share = counts / np.maximum(total, 1)[where]
        mean = np.zeros((len(batch), DIMENSION), "f4")
        full = sizes > 0
        if full.any():
            mean[full] = np.add.reduceat(embeddings[index] * share[:, None],
                                         (np.cumsum(sizes) - sizes)[full], axis=0)
        return index, share, where, mean

    steps, step = EPOCHS * max(1, -(-len(learn) // BATCH)), 0
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            batch = learn[at:at + BATCH]
            rate, step = RATE * (1 - step / steps), step + 1
            index, share, where, mean = gather(batch)
            error = _softmax(mean @ layer + bias)
            error[np.arange(len(batch)), target[batch]] -= 1
            error = error.astype("f4")
            back = error @ layer.T
            layer -= rate * (mean.T @ error)
            bias -= rate * error.mean(axis=0)
            # The embeddings' step: one row per distinct bucket of the batch.
            used, place = np.unique(index, return_inverse=True)
            change = np.zeros((len(used), DIMENSION), "f4")
            np.add.at(change, place, back[where] * share[:, None])
            embeddings[used] -= rate * len(learn) ** 0.5 * change
    few = len(languages) <= DIMENSION
    model = Model(languages, embeddings @ layer if few else embeddings, None if few else layer,
                  bias)
    if len(held):
        scores = np.concatenate([gather(held[at:at + BATCH])[3] @ layer + bias
                                 for at in range(0, len(held), BATCH)])
        right = target[held]
        best = min(np.geomspace(0.05, 20, 61), key=lambda t: -np.log(
            _softmax(scores / t)[np.arange(len(held)), right] + 1e-12).mean())
        found = _softmax(scores / best)
        sure = found.max(axis=1)[found.argmax(axis=1) == right]
        model.temperature = float(best)
        model.threshold = float(min(CERTAIN, np.quantile(sure, FALSE_REJECTIONS))
                                if len(sure) else 0.0)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that must not be learned from: crc32 of the id's text modulo 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2,
                      F.lit(False))


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", rows: int = SAMPLE_ROWS,
                    max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``rows`` labelled rows that are not held out, chosen by the smallest hashes of their
    ids (a uniform sample that does not depend on the partitioning). Of a text of more than
    ``max_bytes`` a slice of a quarter as many characters, at a place that the hash gives, is
    learned from. Ids are ranked first, so only chosen texts leave the scan."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                        & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    rank = F.xxhash64(F.col(id_col), F.lit("language sample"))
    ranked = usable.select(rank.alias("rank"))
    cut = ranked.orderBy("rank").limit(rows).agg(F.max("rank")).first()[0]
    # A character has four bytes at most.
    part = max_bytes // 4
    room = F.greatest(F.length(text_col) - part, F.lit(0)) + 1
    cut_text = F.when(F.octet_length(text_col) <= max_bytes, F.col(text_col)).otherwise(
        F.substr(F.col(text_col), F.pmod(rank, room).cast("int") + 1, F.lit(part)))
    return (usable.where(rank <= F.lit(cut))
            .select(rank.alias("rank"), cut_text.alias("text"),
                    F.col(lang_col).alias("lang")).orderBy("rank", "text", "lang").limit(rows))


def fit(docs: DataFrame, **columns) -> Model | None:
    """A model from the bounded sample, trained on the driver."""
    sample = training_sample(docs, **columns).collect()
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document row: ``id``, ``lang_pred``, ``score`` (calibrated probability of the
    prediction) and ``rejected``.

    The text alone decides. A null text or one without a letter is ``und`` with score 0 and is
    rejected, as is everything when there was nothing to learn from. A prediction below the
    model's threshold is given but marked rejected.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs, scores, out = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            known = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            if known and model is not None:
                p = model.probabilities([np.frombuffer(texts[k].encode("utf-8", "replace"),
                                                       np.uint8) for k in known])
                for k, best, top in zip(known, p.argmax(axis=1), p.max(axis=1)):
                    langs[k], scores[k] = model.languages[best], float(min(1.0, top))
                    out[k] = bool(top < model.threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs), pa.array(scores, pa.float64()),
                 pa.array(out)], ["id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """``docs`` (all columns) without the documents that language identification rejects. Rows
    are filtered where they are: nothing is shuffled."""
    model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    schema = docs.schema
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            known = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            stays = np.zeros(len(texts), bool)
            if known and model is not None:
                p = model.probabilities([np.frombuffer(texts[k].encode("utf-8", "replace"),
                                                       np.uint8) for k in known])
                stays[known] = p.max(axis=1) >= model.threshold
            yield batch.filter(pa.array(stays))

    return docs.mapInArrow(keep, schema)
