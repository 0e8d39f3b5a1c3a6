"""Language identification by rank-order profiles (dealt operator 8).

A profile lists the most frequent letter n-grams (one to three characters, words padded by a blank) of a language by
rank. A document's own list is compared with each: an n-gram costs the distance of its two ranks, or the length of the
profile if the language does not list it. The language with the least sum is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

PROFILE = 400
NO_LANGUAGE = "und"
# Profiles of more languages than these would not be a small model any more.
MAX_LANGUAGES = 2_000
_PAD = 32
# Characters of text that are read together.
SLICE_CHARS = 1 << 19
# Alphabets up to this size number their n-grams directly; larger ones sort them.
DIRECT = 128


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """The n-grams of some texts: ``of(i)`` are those of text i as indices into ``codes``, which is sorted.

    A code holds up to three characters, 21 bits each, so the order of codes is the order of the n-grams. Texts are
    lower-cased; every character that is no letter is a blank, and an n-gram is a letter, two neighbours of which one
    is a letter, or a letter between its neighbours.
    """

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        edges = np.cumsum([1, *[len(t) + 1 for t in lowered]])
        self._from, self._to = edges[:-1], edges[1:] - 1
        points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "replace"), np.uint32)
        points = np.where(_letters()[points], points, np.uint32(_PAD))
        present = np.zeros(0x110000, bool)
        present[points] = True
        present[_PAD] = False
        alphabet = np.concatenate([[_PAD], np.flatnonzero(present)])
        number = np.zeros(0x110000, np.int32)
        number[alphabet] = np.arange(len(alphabet))
        x = number[points].astype(np.int64)
        base = len(alphabet)
        left, right = np.concatenate([[0], x[:-1]]), np.concatenate([x[1:], [0]])
        ids = np.stack([x, base + x * base + right, base + base * base + (left * base + x) * base + right])
        self._held = np.stack([x > 0, (x > 0) | (right > 0), x > 0])
        self._held[1, -1] = False
        if base <= DIRECT:
            used = np.zeros(base + base**2 + base**3, bool)
            used[ids[self._held]] = True
            found = np.flatnonzero(used)
            compact = np.zeros(len(used), np.int32)
            compact[found] = np.arange(len(found))
            self._ids = compact[ids]
        else:
            found, inverse = np.unique(ids, return_inverse=True)
            self._ids = inverse.reshape(ids.shape)
        self.codes = self._decoded(found, alphabet, base)
        order = np.argsort(self.codes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.codes = self.codes[order]
        self._ids = place[self._ids] if len(place) else self._ids.astype(np.int64)

    @staticmethod
    def _decoded(found: np.ndarray, alphabet: np.ndarray, base: int) -> np.ndarray:
        two, three = found >= base, found >= base + base * base
        rest = found - base * two - base * base * three
        last = np.where(two, alphabet[rest % base], 0)
        first = np.where(three, rest // (base * base), np.where(two, rest // base, rest % base))
        middle = np.where(three, alphabet[rest // base % base], last)
        return (alphabet[first] << 42) | (middle << 21) | np.where(three, last, 0)

    def of(self, i: int) -> np.ndarray:
        part = slice(self._from[i] - 1, self._to[i])
        return self._ids[:, part][self._held[:, part]]


def gram_slices(texts: list[str | None]) -> Iterator[tuple[int, int, Grams]]:
    """(from, to, n-grams) of consecutive texts, as many at a time as make a slice; a longer text is one by itself."""
    row = 0
    while row < len(texts):
        end, held = row, 0
        while end < len(texts) and (end == row or held + len(texts[end] or "") <= SLICE_CHARS):
            held += len(texts[end] or "")
            end += 1
        yield row, end, Grams([t or "" for t in texts[row:end]])
        row = end


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """The ``size`` most frequent n-grams of each language: ``lang, gram, rank`` from 1.

    Counts cover every row with a language; ties go to the smaller n-gram. Rows without a text teach nothing. Counts are
    added up before the shuffle in each task and each batch, and the rank is cut per task as well, so no task holds a
    language whole.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            held: dict[str, tuple[list, list]] = {}
            for row, end, grams in gram_slices(batch.column(0).to_pylist()):
                totals: dict[str, np.ndarray] = {}
                for i in range(row, end):
                    own = np.bincount(grams.of(i - row), minlength=len(grams.codes))
                    totals[langs[i]] = own + totals[langs[i]] if langs[i] in totals else own
                for lang, total in totals.items():
                    some = np.flatnonzero(total)
                    codes, counts = held.setdefault(lang, ([], []))
                    codes.append(grams.codes[some])
                    counts.append(total[some])
            for lang, (codes, counts) in held.items():
                distinct, inverse = np.unique(np.concatenate(codes), return_inverse=True)
                sums = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(distinct), pa.string()), pa.array(distinct, pa.int64()), pa.array(sums)],
                    names=["lang", "gram", "n"],
                )

    known = docs.filter(F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string"))
    counted = known.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Win.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size).drop("n")


class _Ranker:
    """Ranks the n-grams of texts and compares them with the profiles."""

    def __init__(self, profiles: dict[str, dict[int, int]], size: int):
        self.languages = sorted(profiles)
        self.size = size
        self.known = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        ranks = [[profiles[lang].get(int(g), 0) for lang in self.languages] for g in self.known]
        # A last row for the n-grams that no profile lists.
        self.ranks = np.array([*ranks, [0] * len(self.languages)], np.int64).reshape(len(self.known) + 1, len(self.languages))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for row, end, grams in gram_slices(texts):
            at = np.searchsorted(self.known, grams.codes)
            listed = np.append(self.known, -1)[at] == grams.codes
            ranks = self.ranks[np.where(listed, at, len(self.known))]
            out += [self._one(grams.of(i), ranks) for i in range(end - row)]
        return out

    def _one(self, ids: np.ndarray, ranks: np.ndarray) -> tuple[str, float]:
        if not len(ids) or not self.languages:
            return NO_LANGUAGE, 0.0
        counts = np.bincount(ids)
        held = np.flatnonzero(counts)
        # Most frequent first, then the smaller n-gram: one number says both.
        order = (counts.max() - counts[held]) * len(counts) + held
        if len(order) > self.size:
            order = np.partition(order, self.size)[: self.size]
        top = np.sort(order) % len(counts)
        theirs = ranks[top]
        own = np.arange(1, len(top) + 1)[:, None]
        distance = np.where(theirs > 0, np.abs(theirs - own), self.size).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (self.size * len(top))


def predict_language(docs: DataFrame, profiles: DataFrame, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1, the share of the greatest possible distance that is missing).

    ``und`` with score 0 is for texts that are null or hold no letter, and for all if there are no profiles. Equal
    distances go to the language that sorts first. Texts are read whole. Columns of those names are replaced. The
    profiles, ``size`` rows a language, are sent to the workers after their number has been checked.
    """
    rows = profiles.limit(MAX_LANGUAGES * size + 1).collect()
    if len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"profiles of more than {MAX_LANGUAGES} languages; give fewer or smaller ones")
    model: dict[str, dict[int, int]] = {}
    for row in rows:
        model.setdefault(row["lang"], {})[row["gram"]] = row["rank"]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    ordered = docs.select(F.col(text_col).alias("_read_text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = _Ranker(sent.value, size)
        for batch in batches:
            found = ranker.predict(batch.column(0).to_pylist())
            columns = [
                *batch.columns[1:],
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], "lang_pred", "score"])

    types = dict(docs.dtypes)
    schema = ", ".join([*[f"_{i} {types[c]}" for i, c in enumerate(kept)], "lang_pred string, score double"])
    out = ordered.mapInArrow(run, schema)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], "lang_pred", "score")
