"""SimHash near-duplicates by a hierarchical index in Gray order (dealt operator 13).

Every text gets a 64-bit fingerprint; texts whose fingerprints differ in few bits link, and links are followed to the end.

* Equal fingerprints are one node, however many documents hold them.
* Spark deals the distinct fingerprints into groups: fingerprints within ``radius`` bits agree on one of
  ``radius + 1`` bands of the 64 bits, and a group holds those with one value of one band. A group above ``GROUP_LIMIT`` is
  dealt again by bands of the bits that its members do not share yet, and so on: each round fixes more bits, so a group of the
  last round holds no more than ``2 ** (bits left)`` fingerprints.
* Within a group the fingerprints stand in the order of their Gray ranks, in which neighbours differ in few bits. Each run
  of ``FANOUT`` neighbours is a node that keeps the bits all of them share as a masked pattern; runs of nodes are nodes again.
  A node holds only what its parent does not, so a search adds up differences on its way down and leaves a whole node as soon
  as the sum passes the radius. At a leaf the sum is the exact distance.
* What leaves a task is a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.llm.near import components
from tasklens.llm.storage import stored

# The seed of every shingle's hash.
SEED = 42
# Fingerprints of one group before it is dealt again.
GROUP_LIMIT = 4096
FANOUT = 8
# Bytes of a text that are cut into words at a time.
SLICE_BYTES = 1 << 20
# Candidate places that one step of a search may hold.
FRONTIER = 1 << 21
# Shingles whose bits are counted at a time.
HASHES = 1 << 14

_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")
_ALL = 2**64 - 1


# --- Fingerprints ---------------------------------------------------------------


def _word_slices(data: memoryview, most: int) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; a cut lies at a separator."""
    start = 0
    while start < len(data):
        end = start + most
        if end < len(data):
            found = _SEPARATOR.search(data, end)
            end = found.start() if found else len(data)
        # Without arguments, bytes are split at exactly U+0020 and U+0009 to U+000D.
        yield bytes(data[start:end]).lower().split()
        start = end


def shingle_hashes(data: memoryview, size: int = 3, most: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a text, repeats included; of fewer words, that of the whole sequence."""
    from xxhash import xxh64_intdigest

    held: list[bytes] = []
    any_yet = False
    for words in _word_slices(data, most):
        held += words
        if len(held) < size:
            continue
        any_yet = True
        line = b" ".join(held)
        lengths = np.fromiter(map(len, held), np.int64, len(held)) + 1
        starts = np.concatenate([[0], np.cumsum(lengths)])
        last = len(held) - size + 1
        bounds = zip(starts[:last].tolist(), (starts[size : size + last] - 1).tolist(), strict=True)
        yield np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in bounds), np.uint64, last)
        held = held[1 - size :] if size > 1 else []
    if held and not any_yet:
        yield np.array([xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(data: memoryview, size: int = 3, most: int = SLICE_BYTES) -> int:
    """The bits that over half of the shingles' hashes set."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(data, size, most):
        total += len(hashes)
        for low in range(0, len(hashes), HASHES):
            part = hashes[low : low + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, fp`` of every row; a text that is null or without words has the fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            out = np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(texts):
                if text.is_valid and (body := text.as_buffer()):
                    out[i] = fingerprint(memoryview(body), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out.view(np.int64))], names=["id", "fp"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "id long, fp long")


def gray_rank(fp: Column) -> Column:
    """The rank of a 64-bit pattern in the Gray sequence, as a long whose order is that of the rank."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(2**63)))


# --- Groups ---------------------------------------------------------------------


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def bands(fixed: int, parts: int) -> list[int]:
    """The bits outside ``fixed`` as ``parts`` masks of nearly equal size."""
    free = [b for b in range(64) if not fixed >> b & 1]
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(free, parts)]


def _dealt(rows: DataFrame, masks: list[int], parts: int) -> tuple[DataFrame, list[int]]:
    """Each row of ``path, fp`` in the groups of one further band, and the fixed bits of every new path."""
    grown = [fixed | band for fixed in masks for band in bands(fixed, parts)]
    table = F.array(*[F.lit(_signed(m)) for m in grown])
    path = (F.col("path") * parts + F.col("band")).cast("int")
    out = rows.select("fp", "path", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("band"))
    out = out.select("fp", path.alias("path"))
    key = F.xxhash64("path", F.col("fp").bitwiseAND(F.element_at(table, F.col("path") + 1)))
    return out.withColumn("key", key), grown


def _groups(nodes: DataFrame, radius: int, limit: int) -> DataFrame:
    """``key, fp``: groups in which every pair within ``radius`` bits meets."""
    parts, masks = radius + 1, [0]
    rows, done = nodes.select("fp", F.lit(0).alias("path")), []
    while True:
        rows, masks = _dealt(rows, masks, parts)
        rows = stored(rows, "bands")
        hot = stored(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("key"), "hot-bands")
        # No more fingerprints than these fit in the bits left, so the loop ends.
        last = 2 ** max(64 - bin(m).count("1") for m in masks) <= 8 * limit
        if last or hot.isEmpty():
            done.append(rows.select("key", "fp"))
            return reduce(DataFrame.unionByName, done)
        done.append(rows.join(hot, "key", "left_anti").select("key", "fp"))
        rows = rows.join(hot, "key", "left_semi").select("fp", "path")


# --- Index ----------------------------------------------------------------------


class GrayIndex:
    """Nodes over runs of fingerprints that stand in Gray order, one tree per group.

    ``levels[0]`` are the fingerprints; a node of level k covers up to ``FANOUT`` nodes of level k - 1 of its own group. It
    has the ``mask`` of the bits in which all it covers agree, and their ``pattern``.
    """

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        self.levels = [{"group": group, "mask": np.full(len(fp), _ALL, np.uint64), "pattern": fp, "end": np.arange(1, len(fp) + 1)}]
        while len(below := self.levels[-1]["group"]) > len(np.unique(group)):
            low = self.levels[-1]
            start = np.flatnonzero(np.concatenate([[True], below[1:] != below[:-1]]))
            place = np.arange(len(below)) - np.repeat(start, np.diff(np.append(start, len(below))))
            first = np.flatnonzero(place % FANOUT == 0)
            ones = np.bitwise_and.reduceat(low["pattern"], first)
            some = np.bitwise_or.reduceat(low["pattern"], first)
            mask = np.bitwise_and.reduceat(low["mask"], first) & ~(ones ^ some)
            last = np.append(first[1:], len(below)) - 1
            self.levels.append({"group": below[first], "mask": mask, "pattern": ones & mask, "end": low["end"][last], "first": first, "last": last})
        self.root = np.searchsorted(self.levels[-1]["group"], group)

    def pairs(self, query: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, later fingerprint of its group) within ``radius`` bits."""
        top = self.levels[-1]
        node = self.root[query]
        apart = np.bitwise_count((fp[query] ^ top["pattern"][node]) & top["mask"][node]).astype(np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            above, low = self.levels[level], self.levels[level - 1]
            count = above["last"][node] - above["first"][node] + 1
            at = np.repeat(np.arange(len(node)), count)
            child = above["first"][node][at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            # What the parent knows has been counted; nodes of earlier fingerprints only have been searched by those.
            fresh = low["mask"][child] & ~above["mask"][node][at]
            apart = apart[at] + np.bitwise_count((fp[query[at]] ^ low["pattern"][child]) & fresh)
            keep = (apart <= radius) & (low["end"][child] > query[at] + 1)
            query, node, apart = query[at][keep], child[keep], apart[keep]
        later = node > query
        return query[later], node[later]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least index that each of ``n`` items reaches over the pairs ``a, b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (up := label[label] < label).any():
            label[up] = label[label][up]
        if (label == before).all():
            break
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def group_links(group: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of the fingerprints of some whole groups (each in Gray order), as trees."""
    index = GrayIndex(group, fp)
    ends = np.searchsorted(group, group, side="right")
    work = np.cumsum(ends - np.arange(len(fp)))
    low = 0
    while low < len(fp):
        done = work[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(work, done + FRONTIER, side="right")))
        a, b = index.pairs(np.arange(low, high), fp, radius)
        if len(a):
            label = forest(a, b, len(fp))
            tied = np.flatnonzero(label != np.arange(len(fp)))
            yield fp[tied], fp[label[tied]]
        low = high


def hamming_links(nodes: DataFrame, radius: int = 3, limit: int = GROUP_LIMIT) -> DataFrame:
    """Links ``a, b`` that connect all distinct values of ``fp`` within ``radius`` bits of each other."""
    groups = _groups(nodes, radius, limit).withColumn("rank", gray_rank(F.col("fp")))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.repartition(parts, "key").sortWithinPartitions("key", "rank").select("key", "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            # The last group may go on in the next batch.
            whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
            for a, b in group_links(key[:whole], fp[:whole], radius) if whole else ():
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
            key, fp = key[whole:], fp[whole:]
        for a, b in group_links(key, fp, radius) if len(key) else ():
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(search, "a long, b long")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``fp`` (the fingerprint's 64 bits as a long) and ``component_id``.

    Words are runs of bytes other than U+0020 and U+0009 to U+000D, with A-Z lower-cased; shingles are ``shingle`` words
    joined by a space, repeats counted, or all words of a shorter text. Rows link where their fingerprints differ in at most
    ``radius`` bits; the component is the least id that links reach. Null and empty texts have the fingerprint zero and link
    like others. Rows that repeat an id stay rows of their own. A row without an id links like others but gives no name: a
    component in which no row has an id is null. Columns beside the two named ones are not looked at. No rows give none.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    tied = components(hamming_links(nodes, radius, limit)).withColumnRenamed("id", "fp")
    placed = nodes.join(tied, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("id", "fp", "component_id")
