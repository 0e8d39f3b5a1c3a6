"""Exact n-gram Jaccard join by a size-aware heavy-light split (dealt operator 6).

Documents with equal sets of word shingles are one class; only one of each class is compared.

* Small (light) classes list fixed-size subsets of their set: for each size a partner may have, the overlap that
  the pair would need is a subset size, and linked sets share a subset of that size.
* Large (heavy) classes stand in inverted lists, each under its first shingles in one global order, rare ones first.
  Linked sets share one of those. The order comes from a fixed-size table of hashed shingle counts over all documents,
  so a shingle of every third document comes last and its list is not scanned.
* Where the split lies is chosen from the histogram of set sizes, by the entries either way would make.

Lists with the same members are one list. Lists of a few members come down to the pairs of fitting sizes that share as
many first shingles as linked sets must. In longer ones
the members' sets meet block by block, and intersections are counted as a matrix product; what leaves a block is a
spanning forest of its links, never its pairs.
Components come from alternating star operations on those links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.llm import words as W
from tasklens.llm.storage import stored
from tasklens.session import checkpointed

COUNT_SLOTS = 1 << 22
SEGMENT = 1 << 16
# No set larger than this is ever light: beyond, subsets grow faster than any list.
LIGHT_LIMIT = 24
# What an entry of an inverted list costs, in entries of the subset lists: scanning it meets unlinked sets.
LIST_COST = 4
# Members whose sets are compared in one task.
BLOCK = 1_500
# Lists up to this length are read as pairs of members.
SHORT = 24
# Linked sets of at least so many shingles share so many of their first ones, as those reach that much further.
SHARED, SHARED_FROM = 3, 10
BUCKET_BYTES = 16 * 1024 * 1024
MIN_BUCKETS = 32
# Bits of the table that tells which documents have to be compared; of fixed size, so it is broadcast at any.
MEMBER_BITS = 1 << 25
# Bits that one of Spark's bitmaps holds.
BITMAP_BITS = 1 << 15


class Threshold:
    """Jaccard at least ``percent`` hundredths, in whole numbers."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("a threshold from 50 to 100 hundredths")
        self.percent = percent

    def overlap(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def first(self, n: np.ndarray) -> np.ndarray:
        """How many shingles of a set of n stand in lists: linked sets share one, and of larger sets ``SHARED``."""
        return n - -(-self.percent * n // 100) + np.where(n >= SHARED_FROM, SHARED, n > 0)

    def partners(self, n: int) -> range:
        return range(-(-self.percent * n // 100), 100 * n // self.percent + 1)

    def subset_sizes(self, n: int) -> list[int]:
        return sorted({self.overlap(n, m) for m in self.partners(n)})

    def subsets(self, n: int) -> int:
        return sum(math.comb(n, size) for size in self.subset_sizes(n))

    def boundary(self, histogram: dict[int, int]) -> int:
        """The largest light size at the least cost."""
        best, cost = 0, 0
        least = 0
        for n in range(1, LIGHT_LIMIT + 1):
            cost += histogram.get(n, 0) * (self.subsets(n) - LIST_COST * self.prefix(n))
            if cost < least or (cost == least and best == n - 1 and self.subsets(n) <= LIST_COST * self.prefix(n)):
                best, least = n, cost
        return best


def shingle_sets(column: pa.Array | pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted: (first of each text, shingles).

    A text of fewer words is one shingle of all its words; a text without words has none.
    """
    words = W.hash_words(column, lower=True)
    hashes, whole = W.rolling(words, size)
    counts = words.counts
    text = np.repeat(np.arange(len(counts)), counts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    lone = []
    for n in np.unique(counts[short]):
        rows = short[counts[short] == n]
        lone.append((rows, W.rolling(words, int(n), seed=5)[0][words.first[rows]]))
    owner = np.concatenate([text[whole], *[r for r, _ in lone]])
    shingle = np.concatenate([hashes[whole], *[h for _, h in lone]])
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    owner, shingle = owner[fresh], shingle[fresh]
    return np.searchsorted(owner, np.arange(len(counts) + 1)), shingle


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for row, end in W.row_slices(batch.column("text"), 1 << 20):
        part = batch.slice(row, end - row)
        yield part, *shingle_sets(part.column("text"), size)


def _small(counts: np.ndarray) -> bytes:
    most = int(counts.max())
    return counts.astype("u1" if most < 256 else "u2" if most < 65536 else "u4" if most < 2**32 else "u8").tobytes()


def shingle_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How often shingles fall into each of a fixed number of slots, over all documents."""
    slots = np.uint64(COUNT_SLOTS - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNT_SLOTS, np.int64)
        for batch in batches:
            for _, _, shingles in _slices(batch, size):
                slot, n = np.unique(shingles & slots, return_counts=True)
                total[slot.astype(np.int64)] += n
        parts = total.reshape(-1, SEGMENT)
        held = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array([_small(parts[i]) for i in held], pa.binary())],
            names=["segment", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SEGMENT, np.int64)
        for body in table["counts"].to_pylist():
            total += np.frombuffer(body, f"u{len(body) // SEGMENT}")
        return pa.table({"segment": table["segment"][:1], "counts": pa.array([_small(total)], pa.binary())})

    parts = texts.select("text").mapInArrow(count, "segment int, counts binary")
    out = np.zeros((COUNT_SLOTS // SEGMENT, SEGMENT), np.uint32)
    for segment, body in parts.groupBy("segment").applyInArrow(add, "segment int, counts binary").collect():
        out[segment] = np.minimum(np.frombuffer(body, f"u{len(body) // SEGMENT}").astype(np.uint64), 2**32 - 1)
    return out.ravel()


def _described(texts: DataFrame, size: int, threshold: Threshold, counts: np.ndarray) -> DataFrame:
    """Per row: its set's size, a 128-bit digest of the set, its first shingles, and the whole set while it is small."""
    sent = texts.sparkSession.sparkContext.broadcast(counts)
    slots = np.uint64(COUNT_SLOTS - 1)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            for part, first, shingles in _slices(batch, size):
                rows = part.num_rows
                n = np.diff(first)
                owner = np.repeat(np.arange(rows), n)
                digests = []
                for seed in (101, 202):
                    sums = np.zeros(rows + 1, np.uint64)
                    running = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(shingles + np.uint64(seed)), dtype=np.uint64)])
                    sums = running[first[1:]] - running[first[:-1]]
                    digests.append(pa.array(sums.view(np.int64)))
                frequency = table[(shingles & slots).astype(np.int64)]
                ordered = shingles[np.lexsort((shingles, frequency, owner))]
                lengths = np.minimum(n, threshold.first(n))
                prefix, p_off = _cut(ordered, first, lengths)
                small, s_off = _cut(shingles, first, np.where(n <= LIGHT_LIMIT, n, 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n.astype(np.int64)), *digests, _lists(prefix, p_off), _lists(small, s_off)],
                    names=["id", "n", "d1", "d2", "prefix", "small"],
                )

    return texts.mapInArrow(describe, "id long, n long, d1 long, d2 long, prefix array<long>, small array<long>")


def _cut(values: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first ``lengths[i]`` values of every group, and the offsets of what is left."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first[:-1], lengths)
    return values[index], offsets


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _packed(shingles: np.ndarray, first: np.ndarray) -> pa.Array:
    """Each group's shingles by their low 48 bits, six bytes each."""
    body = np.ascontiguousarray(shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((6 * first).astype(np.int32)), pa.py_buffer(body)])


def _unpacked(bodies: list[bytes]) -> np.ndarray:
    flat = np.frombuffer(b"".join(bodies), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(flat), 8), np.uint8)
    wide[:, :6] = flat
    return wide.view("<u8").ravel()


def _subset_keys(shingles: np.ndarray, threshold: Threshold) -> np.ndarray:
    """The key of every fixed-size subset that a light set lists."""
    parts = W.mix(shingles.view(np.uint64))
    total = int(parts.sum())
    keys = []
    for size in threshold.subset_sizes(len(parts)):
        sums = [(total - sum(map(int, c))) % 2**64 for c in combinations(parts, len(parts) - size)]
        keys.append(W.mix((np.array(sums, np.uint64) + np.uint64(size)) ^ np.uint64(0xABCDEF)))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _slot() -> Column:
    """Where an id's bit stands, from 1 on."""
    return (F.pmod(F.xxhash64("id"), F.lit(MEMBER_BITS)) + 1).alias("slot")


def member_bits(ids: DataFrame) -> np.ndarray:
    """A table of ``MEMBER_BITS`` bits in which the slot of every id is set. The more ids, the more others are set with them."""
    slots = ids.select(_slot()).distinct()
    parts = slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = np.zeros((MEMBER_BITS // BITMAP_BITS, BITMAP_BITS // 8), np.uint8)
    for part, bits in parts.collect():
        out[part - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


_ASK, _PROBE, _KNOWN = 0, 1, 2


def _lists_of(reps: DataFrame, threshold: Threshold, boundary: int, buckets: int) -> DataFrame:
    """``key, id, n`` of every list entry whose key has another entry.

    Entries travel packed to the bucket of their key. Entries with a twin in their own batch are known to stay and are
    dealt by their id, so of a list, however long, a bucket gets one entry per batch to compare with.
    """
    # Light sets that a heavy one may link with stand in the inverted lists as well.
    border = -(-threshold.percent * (boundary + 1) // 100)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            prefixes = batch.column(2)
            lengths = np.diff(prefixes.offsets.to_numpy())
            owner = np.repeat(np.arange(len(ids)), lengths)
            heavy = sizes[owner] >= border
            keys = [prefixes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)[heavy]]
            owners = [owner[heavy]]
            for i in np.flatnonzero(sizes <= boundary):
                own = _subset_keys(batch.column(3)[int(i)].values.to_numpy(zero_copy_only=False), threshold)
                # One shared subset is enough; it counts as several shared shingles.
                own = np.concatenate([W.mix(own + np.uint64(k)) for k in range(SHARED)])
                keys.append(own)
                owners.append(np.full(len(own), i))
            key, own = np.concatenate(keys), np.concatenate(owners)
            twin, later = W.repeats(key)
            rows = []
            for kind, chosen in ((_ASK, ~twin), (_PROBE, twin & ~later), (_KNOWN, twin)):
                at = np.flatnonzero(chosen)
                by = W.mix(ids[own[at]].view(np.uint64)) if kind == _KNOWN else key[at]
                for bucket, i in W.split_by(W.bucket_of(by, buckets), buckets):
                    e = at[i]
                    body = (key[e].tobytes(), ids[own[e]].astype(np.int64).tobytes(), sizes[own[e]].astype(np.int64).tobytes())
                    rows.append((bucket, kind, *body))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bucket", "kind", "keys", "ids", "sizes"]
            )

    def meet(table: pa.Table) -> pa.Table:
        kind = np.array(table["kind"].to_pylist())
        key, own, size = (
            [np.frombuffer(b, t) for b in table[c].to_pylist()]
            for c, t in (("keys", np.uint64), ("ids", np.int64), ("sizes", np.int64))
        )
        kind = np.repeat(kind, [len(k) for k in key])
        key, own, size = np.concatenate(key), np.concatenate(own), np.concatenate(size)
        stays = kind == _KNOWN
        compared = np.flatnonzero(~stays)
        stays[compared] = W.repeats(key[compared])[0] & (kind[compared] == _ASK)
        return pa.table({"key": pa.array(key[stays].view(np.int64)), "id": pa.array(own[stays]), "n": pa.array(size[stays])})

    packed = "bucket int, kind int, keys binary, ids binary, sizes binary"
    dealt = reps.select("id", "n", "prefix", "small").mapInArrow(deal, packed)
    return dealt.groupBy("bucket").applyInArrow(meet, "key long, id long, n long")


def _links(table: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the links among the sets of one block pair, each member tied to the least of its tree."""
    table = table.sort_by("id")
    ids = table["id"].to_numpy()
    block = table["block"].to_numpy()
    bodies = table["shingles"].to_pylist()
    sizes = np.array([len(b) // 6 for b in bodies], np.int64)
    flat = _unpacked(bodies)
    owner = np.repeat(np.arange(len(ids)), sizes)
    # A shingle of one member alone adds to no intersection.
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    runs = np.diff(np.append(start, len(flat)))
    column = np.repeat(np.cumsum(runs > 1) - 1, runs)
    shared = np.repeat(runs > 1, runs)
    owner, column = owner[shared], column[shared]
    width = int(column.max()) + 1 if len(column) else 0
    inside = np.zeros((len(ids), len(ids)), np.float32)
    # Some columns at a time keep the matrix small.
    step = max(1, min(width, (16 << 20) // (4 * max(1, len(ids)))))
    for low in range(0, width, step):
        a, b = np.searchsorted(column, (low, min(width, low + step)))
        part = np.zeros((len(ids), step), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        inside += part @ part.T
    linked = 100 * inside.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :] - inside.astype(np.int64))
    if len(np.unique(block)) > 1:
        linked &= block[:, None] != block[None, :]
    parent = np.arange(len(ids))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(linked[i, :i]):
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    tops = np.array([root(i) for i in range(len(ids))], np.int64) if len(ids) else np.zeros(0, np.int64)
    tied = ids[tops] != ids if len(ids) else np.zeros(0, bool)
    return pa.table({"a": pa.array(ids[tied], pa.int64()), "b": pa.array(ids[tops][tied] if len(ids) else ids, pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id that an edge ``a, b`` names; a component is called by its least id.

    Alternating large and small stars, a few rounds for shallow groups, until the edges stop changing.
    """

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        both = pairs if small else pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = both.join(least, "a")
        moved = joined if small else joined.filter("b > a")
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if small:
            out = out.unionByName(least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    pairs = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = None
    while True:
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        pairs = checkpointed(star(star(pairs, False), True))
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_shingles`` (size of its set) and ``component_id``.

    Words are compared with A-Z lower-cased. Two documents link if their sets' Jaccard is at least ``percent``
    hundredths; the component is the least id that links reach, the document's own included. A document without words
    has no shingles and links with nothing. Rows that share an id count as one document; a row without an id links with
    nothing and has a null component. An empty table gives an empty table.
    """
    threshold = Threshold(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counts = shingle_counts(texts, shingle)
    # Rows that are alike in everything are told apart by a number of their own, fixed once it is written.
    numbered = _described(texts, shingle, threshold, counts).withColumn("row", F.monotonically_increasing_id())
    described = stored(numbered, "sets")
    named = described.filter("id is not null and n > 0")
    repeated = bool(named.groupBy("id").count().filter("count > 1").limit(1).count())
    least_row = F.min(F.struct("id", "row")).alias("r")
    classes = named.groupBy("n", "d1", "d2").agg(least_row).select("n", "d1", "d2", F.col("r.id").alias("rep"), F.col("r.row").alias("rep_row"))
    sizes = classes.filter(F.col("n") <= LIGHT_LIMIT).groupBy("n").count().collect()
    boundary = threshold.boundary({r["n"]: r["count"] for r in sizes})
    # One row of each class, however often its id and text are repeated.
    reps = named.join(classes, ["n", "d1", "d2"]).filter("row = rep_row").select("id", "n", "prefix", "small")
    entries = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, math.ceil(entries / BUCKET_BYTES))
    postings = stored(_lists_of(reps, threshold, boundary, buckets), "postings")

    lists = postings.groupBy("key").agg(
        F.count("*").alias("members"),
        # Sums, since an id of several texts may stand in a list more than once; of 40 bits, so that none overflows.
        F.sum(F.shiftright(F.xxhash64("id", "n"), 24)).alias("x1"),
        F.sum(F.shiftright(F.xxhash64("id", "n", F.lit(7)), 24)).alias("x2"),
    )
    lists = lists.groupBy("members", "x1", "x2").agg(F.min("key").alias("key"), F.count("*").alias("alike"))
    live = stored(postings.join(lists.select("key", "members", "alike"), "key"), "lists")
    # Short lists come down to the pairs whose sizes allow a link, each pair once.
    short = live.filter(F.col("members") <= SHORT).groupBy("key", "alike").agg(F.collect_list(F.struct("id", "n")).alias("m"))
    first = short.select(F.explode("m").alias("a"), "m", "alike")
    fits = 100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    couples = first.select("a", F.explode("m").alias("b"), "alike").filter((F.col("a.id") < F.col("b.id")) & fits)
    # A pair that shares a long list is compared there. One that does not shares all its lists here.
    least = F.when(F.least("a.n", "b.n") >= SHARED_FROM, SHARED).otherwise(1)
    couples = couples.groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b")).agg(F.sum("alike").alias("s"), F.min(least).alias("l"))
    couples = couples.filter("s >= l").withColumn("key", F.xxhash64("a", "b"))
    two = couples.select(
        "key", F.explode(F.array("a", "b")).alias("id"), F.lit(0).alias("block"), F.lit(0).alias("low"), F.lit(0).alias("high")
    )
    # A long list is cut into blocks by a hash; each pair of blocks is one group, each block alone as well.
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    long = live.filter(F.col("members") > SHORT)
    placed = long.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("id", "key"), blocks).cast("int")})
    many = placed.select(
        "key", "id", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "key", "id", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    met = two.unionByName(many)
    pairs = stored(met.distinct() if repeated else met, "groups")
    # Texts stay where they are; sets of the few others whose bit is set find no pair.
    needed = texts.sparkSession.sparkContext.broadcast(member_bits(pairs))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = needed.value
        for batch in batches:
            at = batch.column("slot").to_numpy() - 1
            batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7) & 1).astype(bool)))
            if batch.num_rows:
                for part, first, shingles in _slices(batch, shingle):
                    yield pa.RecordBatch.from_arrays([part.column("id"), _packed(shingles, first)], names=["id", "shingles"])

    members = texts.select("id", "text", _slot()).mapInArrow(sets, "id long, shingles binary")
    if repeated:
        members = members.distinct()
    grouped = pairs.join(members, "id").groupBy("key", "low", "high")
    edges = grouped.applyInArrow(lambda table: _links(table, percent), "a long, b long")
    if repeated:
        # An id with several texts ties their classes.
        owners = named.join(classes, ["n", "d1", "d2"]).select("id", "rep")
        several = owners.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
        bound = owners.join(several, "id", "left_semi").filter("id <> rep").distinct()
        edges = edges.unionByName(bound.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    tied = components(edges)
    named_classes = classes.join(tied, classes["rep"] == tied["id"], "left").select(
        F.col("n").alias("cn"), F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.coalesce("component", "rep").alias("component_id")
    )
    same = (F.col("n") == F.col("cn")) & (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2"))
    linked = described.select("id", "n", "d1", "d2").join(named_classes, same, "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return linked.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
