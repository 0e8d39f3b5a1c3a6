"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader (dealt operator 3).

A text is read as words and as word shapes (runs of capitals, letters, digits and each other character). Unigrams and
bigrams of both, and a mark where a word repeats the one before it, are hashed into a fixed number of slots; a slot's
value is how often it occurs per word. The model is one weight per slot, so a score is a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm import words as W
from tasklens.llm.resident import vacate

SLOTS = 1 << 18
# Labelled rows that training may read, those with the smallest hash of their id.
TRAINING_ROWS = 16_000
# Models trained side by side on a share of the rows each, and averaged.
SHARES = 6
EPOCHS = 4
SCALE = 8.0
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.001, 0.001
THRESHOLD = 0.3

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = 65
_CLASS[97:123] = 97
_CLASS[128:] = 97
_CLASS[48:58] = 48


def _shapes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A hash of the shape of every word: its character classes, equal neighbours taken once."""
    data, offsets = W.text_buffers(column)
    out, row, rows = [], 0, len(offsets) - 1
    for row, end in W.row_slices(column, 1 << 20):
        part = data[offsets[row] : offsets[end]]
        if len(part) > W.SLICE_BYTES:
            out += [_shape_slice(part[a:b], np.array([0, b - a])) for a, b in W.stretches(part, W.SLICE_BYTES)]
        else:
            out.append(_shape_slice(part, offsets[row : end + 1] - offsets[row]))
    return np.concatenate(out) if rows and out else np.zeros(0, np.uint64)


def _shape_slice(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    inside = W._IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[offsets < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64)
    classes = _CLASS[data]
    fresh = inside.copy()
    fresh[1:] &= (classes[1:] != classes[:-1]) | begins[1:]
    place = np.cumsum(fresh) - 1
    powers, inverse = W._power_tables(len(data))
    terms = np.where(fresh, W._BYTE[classes], np.uint64(0)) * powers[np.maximum(place, 0)]
    return W.mix(np.add.reduceat(terms, starts) * inverse[place[starts]] + np.uint64(77))


def features(column: pa.Array | pa.ChunkedArray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each feature, text of each feature, words of each text), features in the order of the texts.

    Each word brings five features; what has no word before it is paired with a fixed beginning.
    """
    words = W.hash_words(column)
    shapes = _shapes(column)
    n = len(words)
    before = np.zeros(n, np.uint64)
    shape_before = np.zeros(n, np.uint64)
    if n:
        before[1:], shape_before[1:] = words.hash[:-1], shapes[:-1]
        begin = words.first[:-1][words.counts > 0]
        before[begin], shape_before[begin] = 1, 1
    again = np.where(words.hash == before, np.uint64(11), np.uint64(12))
    step = np.uint64(0x9E3779B97F4A7C15)
    kinds = (words.hash, before * step + words.hash, shapes, shape_before * step + shapes, again)
    stacked = np.stack([W.mix(k + np.uint64(1000 + i)) for i, k in enumerate(kinds)], axis=1)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    return (stacked & np.uint64(slots - 1)).astype(np.int64), text, words.counts


def _sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]], slots: int, epochs: int = EPOCHS,
    alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2,
) -> np.ndarray:
    """Weights, the bias last, from (slots, values, label) examples seen one after the other, ``epochs`` times."""
    z, n = np.zeros(slots + 1), np.zeros(slots + 1)
    for _ in range(epochs):
        for index, value, label in examples:
            zi, ni = z[index], n[index]
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))
            g = (_sigmoid(float(w @ value)) - label) * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[index] = zi + g - sigma * w
            n[index] = ni + g * g
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def _examples(table: pa.Table, slots: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    out = []
    labels = table["label"].to_pylist()
    column = table["text"].combine_chunks()
    for row, end in W.row_slices(column, 4 << 20):
        index, text, counts = features(column.slice(row, end - row), slots)
        edges = np.searchsorted(text, np.arange(end - row + 1))
        for i in range(end - row):
            own, count = np.unique(index[edges[i] : edges[i + 1]], return_counts=True)
            value = np.append(SCALE * count / max(1, counts[i]), 1.0)
            out.append((np.append(own, slots), value, labels[row + i]))
    return out


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    rows: int = TRAINING_ROWS, slots: int = SLOTS, shares: int = SHARES,
) -> np.ndarray:
    """Weights learnt from the texts of labelled documents, the bias last.

    At most ``rows`` labelled ids are used, those whose hash is smallest. Each share of them is one pass of the
    online learner in a task of its own; the shares' weights are averaged. An id with several labels counts as the least
    of them; null labels, labels without a document and documents without a label teach nothing. Without any
    example all weights are zero. What reaches the driver is one fixed-size vector per share.
    """
    chosen = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    dealt = texts.select(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(shares)).cast("int").alias("share"), "_id", "text", "label")

    def learn(table: pa.Table) -> pa.Table:
        vacate()
        order = table.sort_by([("_id", "ascending"), ("text", "ascending")])
        examples = _examples(order, slots)
        shuffled = np.random.default_rng(7).permutation(len(examples))
        weights = ftrl([examples[i] for i in shuffled], slots)
        return pa.table({"weights": pa.array([weights.astype(np.float64).tobytes()], pa.binary())})

    models = [np.frombuffer(r[0], np.float64) for r in dealt.groupBy("share").applyInArrow(learn, "weights binary").collect()]
    return np.mean(models, axis=0) if models else np.zeros(slots + 1)


def score_texts(column: pa.Array | pa.ChunkedArray, weights: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text."""
    slots = len(weights) - 1
    out = np.zeros(len(column))
    for row, end in W.row_slices(column, 1 << 20):
        index, text, counts = features(column.slice(row, end - row), slots)
        sums = np.bincount(text, weights[index].sum(axis=1), end - row)
        out[row:end] = _sigmoid(SCALE * sums / np.maximum(1, counts) + weights[-1])
    return out


def score_quality(docs: DataFrame, weights: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score``, the probability of good quality, and ``predicted``, 1 where it reaches ``threshold``.

    Null and empty texts get the score of the bias alone. Rows stay where they are. Columns of those names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    # The text travels once, as the column it is.
    ordered = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)])
    place = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        own = sent.value
        for batch in batches:
            scores = pa.array(score_texts(batch.column(place), own), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "score"])

    types = dict(docs.dtypes)
    schema = ", ".join([*[f"_{i} {types[c]}" for i, c in enumerate(kept)], "score double"])
    out = ordered.mapInArrow(run, schema).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], "score")
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
