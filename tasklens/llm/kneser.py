"""Interpolated modified Kneser-Ney bigram model over a corpus, and its use for scoring texts (dealt operator 1).

Counts are made in Spark and stored as sorted hash arrays: for every bucket of hashes one file of sorted 64-bit hashes
and files of their values, in the shared folder. Workers map the files into memory and look up the sorted hashes of a
slice of text at a time, so they read the arrays in order and keep nothing but what the system caches.

Nothing is pruned: the arrays grow with the corpus. How often a bigram occurs gives, on a second pass, the distinct
continuations of every word: each of c occurrences adds 1/c of its type.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm import words as W
from tasklens.llm.storage import stored
from tasklens.session import new_folder

BUCKET_BYTES = 16 * 1024 * 1024
MIN_BUCKETS = 16
SLICE_BYTES = 4 << 20
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543211)
_PIECE = "bucket int, n int, keys binary, values binary"
_FILES = "bucket int, n long, path string, sums array<double>"


@dataclass(frozen=True)
class Table:
    """Sorted hash arrays: the file of each bucket, and the number of values that stand by each hash."""

    paths: tuple[str | None, ...]
    kind: str
    width: int


@dataclass(frozen=True)
class Model:
    bigrams: Table
    words: Table
    tokens: int
    distinct: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    # Distinct bigrams, and of the words how many have one, two, and more distinct words before them.
    types: int
    continuations: tuple[int, int, int]


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """The three discounts from the counts of counts; where a count is missing, the middle of what is possible."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        d = k - (k + 1) * y * b / a if a and y else k / 2
        found.append(min(max(d, 0.0), float(k)))
    return tuple(found)


def _local(path: str) -> str | None:
    """The path as this machine's files have it, if the shared folder is one of them."""
    return path.removeprefix("file://") if path.startswith("file:") or ":" not in path else None


def _write(path: str, parts: list[np.ndarray]) -> None:
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    system.create_dir(base.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(base, compression=None) as out:
        for part in parts:
            out.write(part.tobytes())


@lru_cache(maxsize=4096)
def _mapped(path: str, kind: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, values) of one file, mapped into memory; a remote file is fetched into an unnamed one first."""
    local = _local(path)
    if local is None:
        import shutil
        import tempfile

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(path)
        with tempfile.TemporaryFile() as copy, system.open_input_stream(base, compression=None) as source:
            shutil.copyfileobj(source, copy, 1 << 20)
            copy.flush()
            body = np.memmap(copy, np.uint8, "r")
    else:
        body = np.memmap(local, np.uint8, "r")
    n = len(body) // (8 + width * np.dtype(kind).itemsize)
    return body[: 8 * n].view(np.uint64), body[8 * n :].view(kind).reshape(width, n)


def look_up(table: Table, keys: np.ndarray) -> np.ndarray:
    """The values of sorted, distinct hashes; zeros for those that are not in the table."""
    out = np.zeros((table.width, len(keys)), table.kind)
    buckets = len(table.paths)
    edges = np.searchsorted(W.bucket_of(keys, buckets), np.arange(buckets + 1))
    for b, path in enumerate(table.paths):
        low, high = edges[b], edges[b + 1]
        if path is None or low == high:
            continue
        hashes, values = _mapped(path, table.kind, table.width)
        at = np.searchsorted(hashes, keys[low:high])
        at[at == len(hashes)] = 0
        hit = np.flatnonzero(hashes[at] == keys[low:high])
        out[:, low + hit] = values[:, at[hit]]
    return out


class Tokens:
    """The tokens of some texts, each with the token before it; every text has one end token."""

    def __init__(self, column: pa.Array):
        words = W.hash_words(column, lower=True)
        texts = len(words.counts)
        self.first = words.first + np.arange(texts + 1)
        self.hash = np.full(len(words) + texts, END, np.uint64)
        self.hash[np.arange(len(words)) + np.repeat(np.arange(texts), words.counts)] = words.hash
        self.before = np.full(len(self.hash), BEGIN, np.uint64)
        self.before[1:] = self.hash[:-1]
        self.before[self.first[:-1]] = BEGIN
        self.pair = W.mix(self.before * W._STEP + self.hash)

    def sums(self, values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return np.add.reduceat(values, self.first[:-1]) if len(values) else running[self.first[1:]]


def _slices(column: pa.Array) -> Iterator[tuple[int, int, Tokens]]:
    for row, end in W.row_slices(column, SLICE_BYTES):
        yield row, end, Tokens(column.slice(row, end - row))


def _pieces(keys: np.ndarray, values: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Sorted distinct hashes and their values (one row each), packed by bucket."""
    edges = np.searchsorted(W.bucket_of(keys, buckets), np.arange(buckets + 1))
    rows = [(b, low, high) for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False)) if high > low]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([b for b, _, _ in rows], pa.int32()),
            pa.array([h - lo for _, lo, h in rows], pa.int32()),
            pa.array([keys[lo:h].tobytes() for _, lo, h in rows], pa.binary()),
            pa.array([np.ascontiguousarray(values[:, lo:h]).tobytes() for _, lo, h in rows], pa.binary()),
        ],
        names=["bucket", "n", "keys", "values"],
    )


def _gathered(table: pa.Table, sent_kind: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of a bucket, sorted, and the sums of their values."""
    keys = np.concatenate([np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()])
    values = np.concatenate(
        [np.frombuffer(b, sent_kind).reshape(width, -1) for b in table["values"].to_pylist()], axis=1
    ).astype(np.float64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], np.add.reduceat(values[:, order], start, axis=1)


def _saved(pieces: DataFrame, folder: str, sent_kind: str, width: int, kind: str, facts) -> tuple[list, int]:
    """Write every bucket's arrays; a row per bucket with what ``facts`` says of its values."""

    def save(table: pa.Table) -> pa.Table:
        keys, values = _gathered(table, sent_kind, width)
        path = f"{folder}/{uuid.uuid4().hex}"
        rounded = np.rint(values).astype(kind)
        _write(path, [keys, rounded])
        return pa.table(
            [table["bucket"][:1], pa.array([len(keys)], pa.int64()), pa.array([path]), pa.array([facts(rounded)], pa.list_(pa.float64()))],
            names=["bucket", "n", "path", "sums"],
        )

    # A row per bucket: names of files and a few sums.
    return stored(pieces.groupBy("bucket").applyInArrow(save, _FILES), "arrays").collect()


def learn(texts: DataFrame, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> Model:
    """A model of all texts of a table. Words are folded A-Z; a null text is an empty one. No rows make an empty model."""
    texts = texts.select(F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, math.ceil(size / bucket_bytes))
    folder = new_folder(texts.sparkSession, "ngrams")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, tokens in _slices(batch.column(0)):
                keys, counts = np.unique(tokens.pair, return_counts=True)
                yield _pieces(keys, counts[None].astype(np.uint32), buckets)

    def pair_facts(values: np.ndarray) -> list[float]:
        return [float((values[0] == k).sum()) for k in (1, 2, 3, 4)]

    rows = _saved(texts.mapInArrow(count_pairs, _PIECE), folder, "uint32", 1, "uint32", pair_facts)
    bigrams = _table(rows, buckets, "uint32", 1)
    types = sum(r["n"] for r in rows)
    of_pairs = [sum(r["sums"][k] for r in rows) for k in range(4)]

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, tokens in _slices(batch.column(0)):
                keys, index = np.unique(tokens.pair, return_inverse=True)
                count = look_up(bigrams, keys)[0].astype(np.float64)[index]
                share = 1.0 / count
                # As a token: occurrences and words before it; as a context: types after it by how often they occur.
                names, own = np.unique(np.concatenate([tokens.hash, tokens.before]), return_inverse=True)
                half = len(tokens.hash)
                values = np.zeros((6, len(names)), np.float32)
                values[0] = np.bincount(own[:half], minlength=len(names))
                values[1] = np.bincount(own[:half], share, len(names))
                values[2] = np.bincount(own[half:], minlength=len(names))
                for row, hit in ((3, count == 1), (4, count == 2), (5, count >= 3)):
                    values[row] = np.bincount(own[half:][hit], share[hit], len(names))
                yield _pieces(names, values, buckets)

    def word_facts(values: np.ndarray) -> list[float]:
        held = values[0] > 0
        exact = [float((values[1][held] == k).sum()) for k in (1, 2, 3, 4)]
        return [float(values[0].sum()), float(held.sum()), *exact, float((values[1][held] >= 3).sum())]

    rows = _saved(texts.mapInArrow(count_words, _PIECE), folder, "float32", 6, "uint32", word_facts)
    sums = [sum(r["sums"][k] for r in rows) for k in range(7)]
    return Model(
        bigrams, _table(rows, buckets, "uint32", 6), int(sums[0]), int(sums[1]), discounts(*of_pairs),
        discounts(*sums[2:6]), types, (int(sums[2]), int(sums[3]), int(sums[6])),
    )


def _table(rows: list, buckets: int, kind: str, width: int) -> Table:
    paths: list[str | None] = [None] * buckets
    for row in rows:
        paths[row["bucket"]] = row["path"]
    return Table(tuple(paths), kind, width)


def _discount(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(count <= 0, 0.0, np.choose(np.clip(count, 1, 3).astype(np.int64) - 1, d))


def probabilities(model: Model, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(model's probability, training count) of each token."""
    names, own = np.unique(np.concatenate([tokens.hash, tokens.before]), return_inverse=True)
    values = look_up(model.words, names).astype(np.float64)
    half = len(tokens.hash)
    count, before = values[0][own[:half]], values[1][own[:half]]
    context = values[2:][:, own[half:]]
    keys, index = np.unique(tokens.pair, return_inverse=True)
    pair = look_up(model.bigrams, keys)[0].astype(np.float64)[index]
    one, two, more = model.continuations
    d = model.word_discounts
    types = max(1, model.types)
    spare = (d[0] * one + d[1] * two + d[2] * more) / types if model.types else 1.0
    lower = np.maximum(before - _discount(before, d), 0.0) / types + spare / (model.distinct + 1)
    d = model.pair_discounts
    total = np.maximum(context[0], 1.0)
    kept = (d[0] * context[1] + d[1] * context[2] + d[2] * context[3]) / total
    upper = np.maximum(pair - _discount(pair, d), 0.0) / total + kept * lower
    return np.where(context[0] > 0, upper, lower), count


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity``.

    ``score`` is the log10 probability of a text's words and its one end token; ``base_score`` that of independent words
    with one added to every count; ``perplexity`` is per token. Null and empty texts consist of the end token. All rows
    stay where they are; columns of those names are replaced.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    kept = [c for c in docs.columns if c not in added]
    ordered = docs.select(F.col(text_col).alias("_scored_text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, tokens in _slices(batch.column(0)):
                p, count = probabilities(model, tokens)
                base = np.log10((count + 1) / (model.tokens + model.distinct + 1))
                n = np.diff(tokens.first)
                total = tokens.sums(np.log10(p))
                part = batch.slice(row, end - row)
                columns = [
                    *part.columns[1:], pa.array(n), pa.array(tokens.sums((count > 0).astype(np.int64))),
                    pa.array(np.full(end - row, model.tokens, np.int64)), pa.array(tokens.sums(base)), pa.array(total),
                    pa.array(10 ** np.minimum(300, -total / n)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], *added])

    types = dict(docs.dtypes)
    schema = ", ".join(
        [*[f"_{i} {types[c]}" for i, c in enumerate(kept)], "n_tokens long, n_known long, train_tokens long"]
        + ["base_score double, score double, perplexity double"]
    )
    out = ordered.mapInArrow(run, schema)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], *added)
