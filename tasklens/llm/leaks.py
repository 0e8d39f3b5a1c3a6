"""Benchmark decontamination by spaced seeds (dealt operator 7).

A seed is the hash of the words that a fixed mask picks from a span of consecutive words; the words it skips may differ.
Seeds of all benchmark items meet seeds of all documents in a join. A fixed-size Bloom filter of the benchmark's seeds
keeps the other seeds of the documents, nearly all, from being shuffled, however large either side is. Every hit
fixes how an item and a document are aligned; the words around it are then compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm import words as W
from tasklens.llm.storage import stored

SPAN = 10
# Words that a mask skips at least.
SKIPPED = 4
# A leak: so many consecutive words of an item (or all, if it has fewer), of which this share is equal.
WINDOW = 12
SHARE = 0.8
FILTER_BITS = 1 << 25
_PROBES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def allowed(window: int, share: float) -> int:
    """How many other words the best span of a leaking window may hold at most."""
    most = 0
    for size in range(SPAN, max(window, SPAN) + 1):
        others = size - int(np.ceil(share * size - 1e-9))
        most = max(most, others // (size // SPAN))
    return most


@cache
def masks(others: int) -> tuple[str, ...]:
    """Masks of a span such that any ``others`` words of it are all skipped by one of them."""
    if others >= SPAN:
        raise ValueError("a share that leaves no word of a span")
    skips = [frozenset(c) for c in combinations(range(SPAN), min(SPAN - 1, max(SKIPPED, others + 2)))]
    left = {frozenset(c) for c in combinations(range(SPAN), others)}
    chosen = []
    while left:
        best = max(skips, key=lambda s: sum(c <= s for c in left))
        left = {c for c in left if not c <= best}
        chosen.append("".join("0" if j in best else "1" for j in range(SPAN)))
    return tuple(chosen)


def _masked(words: W.Words, mask: str, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Seed hashes by start, and which starts have the whole span inside one text."""
    size, span = len(words), len(mask)
    out = np.zeros(size, np.uint64)
    if size >= span:
        total = np.full(size - span + 1, seed, np.uint64)
        for j, bit in enumerate(mask):
            if bit == "1":
                total *= W._STEP
                total += words.hash[j : size - span + 1 + j]
        out[: size - span + 1] = W.mix(total)
    return out, words.left() >= span


def _seeds(words: W.Words, short: list[int], patterns: tuple[str, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, seed) of every mask, and of the whole-item seeds of items shorter than the span."""
    for i, mask in enumerate(patterns):
        hashes, whole = _masked(words, mask, 1000 + i)
        at = np.flatnonzero(whole)
        yield at, hashes[at]
    for n in short:
        hashes, whole = _masked(words, "1" * n, 2000 + n)
        at = np.flatnonzero(whole)
        yield at, hashes[at]


def _bits(seeds: np.ndarray) -> list[np.ndarray]:
    return [W.mix(seeds * p) & np.uint64(FILTER_BITS - 1) for p in _PROBES]


def benchmark_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, tokens`` (word hashes, A-Z lower-cased) of every item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = W.hash_words(batch.column(1), lower=True)
            tokens = pa.ListArray.from_arrays(pa.array(words.first.astype(np.int32)), pa.array(words.hash.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), tokens], names=["item_id", "tokens"])

    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "item_id long, tokens array<long>").filter(F.size("tokens") > 0)


def _item_seeds(items: DataFrame, patterns: tuple[str, ...]) -> DataFrame:
    """``seed, item_id, pos`` of every item: all masks, or one seed of all words if it is shorter than the span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds, owners, places = [], [], []
            for item, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.array(tokens.as_py(), np.int64).view(np.uint64)
                words = W.Words(np.array([0, len(own)]), own)
                short = len(own) < SPAN
                for at, found in [_whole_seed(words)] if short else _seeds(words, [], patterns):
                    seeds.append(found)
                    places.append(at)
                    owners += [item] * len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(seeds).view(np.int64) if seeds else np.zeros(0, np.int64)),
                    pa.array(owners, pa.int64()),
                    pa.array((np.concatenate(places) if places else np.zeros(0)).astype(np.int64)),
                ],
                names=["seed", "item_id", "pos"],
            )

    return items.mapInArrow(run, "seed long, item_id long, pos long")


def _whole_seed(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    n = len(words)
    return np.zeros(1, np.int64), _masked(words, "1" * n, 2000 + n)[0][:1]


def _bloom(seeds: DataFrame) -> np.ndarray:
    """The filter as 64-bit words; at most ``FILTER_BITS / 64`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(np.concatenate(_bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
            slot = (bits >> np.uint64(6)).astype(np.int32)
            value = (np.uint64(1) << (bits & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(value)], names=["slot", "bits"])

    words = np.zeros(FILTER_BITS // 64, np.uint64)
    merged = seeds.select("seed").mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    for slot, bits in merged.toLocalIterator():
        words[slot] = bits % 2**64
    return words


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, share: float = SHARE,
) -> DataFrame:
    """The places where documents hold benchmark items: ``doc_id, text_key, item_id, first_word, n_words, n_equal``.

    One row per document and item: the words of the document from ``first_word`` (from 0) on, ``n_words`` of them, cover
    all leaking windows of the best alignment, and ``n_equal`` of them equal the item's. Texts are read whole, A-Z
    lower-cased. A window of ``window`` words of an item, or the whole of a shorter item, leaks if at least ``share`` of
    it stands in the document in place; an item shorter than the seeds' span must stand there whole and unchanged.
    ``text_key`` is a hash of the text that tells rows without an id, or with a repeated one, apart. Null or
    empty texts hold nothing, and items without words are held by nothing. Empty tables give an empty table.
    """
    patterns = masks(allowed(window, share))
    items = stored(benchmark_items(benchmark, item_col, item_text), "items")
    seeds = stored(_item_seeds(items, patterns), "item-seeds")
    short = [r[0] for r in items.select(F.size("tokens").alias("n")).filter(F.col("n") < SPAN).distinct().collect()]
    sent = docs.sparkSession.sparkContext.broadcast(_bloom(seeds))
    reach = max(window, SPAN)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = sent.value
        for batch in batches:
            for row, end in W.row_slices(batch.column(2), 1 << 20):
                part = batch.slice(row, end - row)
                yield _regions(part, short, patterns, bloom, reach)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("t")
    )
    schema = "doc_id long, text_key long, start long, tokens array<long>, seeds array<long>, places array<long>"
    regions = stored(
        rows.mapInArrow(probe, schema).withColumn("region", F.xxhash64("doc_id", "text_key", "start")), "regions"
    )
    hits = regions.select("region", F.explode(F.arrays_zip("seeds", "places")).alias("h"))
    hits = hits.select("region", F.col("h.seeds").alias("seed"), F.col("h.places").alias("place"))
    aligned = hits.join(seeds, "seed").select("region", "item_id", (F.col("place") - F.col("pos")).alias("shift")).distinct()
    held = aligned.join(regions.select("region", "doc_id", "text_key", "start", "tokens"), "region")
    compared = held.join(items.select("item_id", F.col("tokens").alias("item")), "item_id")
    out = "doc_id long, text_key long, item_id long, first_word long, n_words long, n_equal long"

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _verified(batch, window, share)

    found = compared.select("doc_id", "text_key", "start", "tokens", "item_id", "item", "shift").mapInArrow(verify, out)
    best = F.max(F.struct("n_equal", (-F.col("first_word")).alias("f"), "n_words"))
    whole = found.groupBy("doc_id", "text_key", "item_id").agg(best.alias("b"))
    return whole.select(
        "doc_id", "text_key", "item_id", (-F.col("b.f")).alias("first_word"), F.col("b.n_words").alias("n_words"),
        F.col("b.n_equal").alias("n_equal"),
    )


def _regions(
    batch: pa.RecordBatch, short: list[int], patterns: tuple[str, ...], bloom: np.ndarray, reach: int
) -> pa.RecordBatch:
    """Stretches of the texts around seeds that pass the filter; seeds near each other share a stretch."""
    words = W.hash_words(batch.column(2), lower=True)
    places, seeds = [], []
    for at, found in _seeds(words, short, patterns):
        keep = np.ones(len(at), bool)
        for bits in _bits(found):
            keep &= (bloom[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) == 1
        places.append(at[keep])
        seeds.append(found[keep])
    place, seed = np.concatenate(places), np.concatenate(seeds)
    order = np.argsort(place, kind="stable")
    place, seed = place[order], seed[order]
    text = np.searchsorted(words.first, place, side="right") - 1
    cut = np.ones(len(place), bool)
    cut[1:] = (text[1:] != text[:-1]) | (np.diff(place) > 2 * reach + SPAN)
    begin = np.flatnonzero(cut)
    after = np.append(begin, len(place))[1:]
    rows: dict[str, list] = {n: [] for n in ("row", "start", "tokens", "seeds", "places")}
    for b, e in zip(begin, after, strict=True):
        t = text[b]
        low = max(words.first[t], place[b] - reach)
        high = min(words.first[t + 1], place[e - 1] + SPAN + reach)
        rows["row"].append(int(t))
        rows["start"].append(int(low - words.first[t]))
        rows["tokens"].append(words.hash[low:high].view(np.int64))
        rows["seeds"].append(seed[b:e].view(np.int64))
        rows["places"].append(place[b:e] - words.first[t])
    taken = pa.array(rows["row"], pa.int64())
    lists = [pa.array(rows[n], pa.list_(pa.int64())) for n in ("tokens", "seeds", "places")]
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(rows["start"], pa.int64()), *lists],
        names=["doc_id", "text_key", "start", "tokens", "seeds", "places"],
    )


def _verified(batch: pa.RecordBatch, window: int, share: float) -> pa.RecordBatch:
    columns = {n: batch.column(n) for n in batch.schema.names}
    kept, first, length, equal = [], [], [], []
    for i in range(batch.num_rows):
        tokens = columns["tokens"][i].values.to_numpy(zero_copy_only=False)
        item = columns["item"][i].values.to_numpy(zero_copy_only=False)
        # Where the item would begin within the stretch.
        at = columns["shift"][i].as_py() - columns["start"][i].as_py()
        low, high = max(0, -at), min(len(item), len(tokens) - at)
        same = np.zeros(len(item), np.int64)
        same[low:high] = tokens[at + low : at + high] == item[low:high]
        size = min(window, len(item))
        least = size if len(item) < SPAN else int(np.ceil(share * size - 1e-9))
        sums = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(sums[size:] - sums[:-size] >= least)
        if not len(good):
            continue
        cover = np.zeros(len(item) + 1, np.int64)
        np.add.at(cover, good, 1)
        np.add.at(cover, good + size, -1)
        inside = np.flatnonzero((np.cumsum(cover[:-1]) > 0) & (np.arange(len(item)) >= low) & (np.arange(len(item)) < high))
        kept.append(i)
        first.append(int(columns["shift"][i].as_py() + inside[0]))
        length.append(int(inside[-1] - inside[0] + 1))
        equal.append(int(same[inside].sum()))
    index = pa.array(kept, pa.int64())
    named = [columns[n].take(index) for n in ("doc_id", "text_key", "item_id")]
    counts = [pa.array(v, pa.int64()) for v in (first, length, equal)]
    return pa.RecordBatch.from_arrays(
        [*named, *counts], names=["doc_id", "text_key", "item_id", "first_word", "n_words", "n_equal"]
    )
