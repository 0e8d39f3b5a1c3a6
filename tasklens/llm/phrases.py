"""Phrase collocations by prefix-free parsing (dealt operator 12).

* Texts are cut into pieces at punctuation and line ends, pieces into words. A window of ``OVERLAP`` words whose hash is
  divisible by ``PERIOD`` starts a new chunk, as does a piece; a chunk also holds the ``OVERLAP`` words after it. Equal
  passages are cut alike wherever they stand, so the distinct chunks, each with how often the parse has it, are a dictionary
  of the corpus. No chunk is longer than ``LONGEST`` words: a cut is forced where no window asks for one.
* A phrase belongs to the chunk in which its first word is not part of the overlap with the next one (``owned`` words), and
  ends inside that chunk. So phrases are counted inside distinct chunks, weighted by their frequency, each occurrence once.
* A phrase is frequent only if both phrases without its last or first word are. Level by level, hashes of phrases are
  counted in buckets (four bytes a phrase on the way), and a table of bits of fixed size tells the next level which are
  frequent. As chunks are searched with such bits at last, few phrases travel as texts; those counts are exact. A full table
  of bits lets more phrases through and leaves the result the same.
* Scores, containment and ranks are joins and aggregates over the frequent phrases.

Whole blocks of phrases are told apart by 64-bit hashes within one block of a few MB; between blocks, by their texts.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasklens.llm import words as W
from tasklens.llm.storage import stored

LONGEST_PHRASE = 4
OVERLAP = LONGEST_PHRASE - 1
# One window in so many starts a chunk.
PERIOD = 20
# Words that a chunk owns at most.
LONGEST = 256
SLICE_BYTES = 1 << 20
# Text of chunks that is counted at a time, and entries held before they are sent.
BLOCK_BYTES = 4 << 20
HELD = 1 << 21
BUCKET_BYTES = 16 << 20
MIN_BUCKETS = 32
# Bits of the table of frequent phrases of one length; of fixed size, so it is broadcast at any.
BITS = 1 << 26
_BITMAP = 1 << 15

SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(SPACES)] = 1
_CLASS[list(BREAKS)] = 2
_CUT = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_AHEAD = re.compile(rb"(?:[ \t.,;:!?\n\x0b\x0c\r]*[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % OVERLAP)


# --- Parse ----------------------------------------------------------------------


def _hashed(line: np.ndarray) -> W.Words:
    """The words of one line of bytes."""
    offsets = pa.py_buffer(np.array([0, len(line)], np.int64))
    return W.hash_words(pa.LargeStringArray.from_buffers(1, offsets, pa.py_buffer(line)))


def chunks(raw: bytes, own: int) -> Iterator[tuple[bytes, int]]:
    """(chunk, owned words) of the words that begin in the first ``own`` bytes; those after them are overlap only."""
    data = np.frombuffer(raw + b"\n", np.uint8)
    kind = _CLASS[data]
    word = kind == 0
    before = np.concatenate([[False], word[:-1]])
    begins = np.flatnonzero(word & ~before)
    if not len(begins):
        return
    # Words with one space after each.
    line = np.where(word, data, 32).astype(np.uint8)[word | (~word & before)]
    ends = np.flatnonzero(line == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    piece = np.cumsum(kind == 2)[begins]
    n = len(begins)
    opens = np.ones(n, bool)
    opens[1:] = piece[1:] != piece[:-1]
    piece_end = np.append(np.flatnonzero(opens)[1:], n)[np.cumsum(opens) - 1]
    window, whole = W.rolling(_hashed(line), OVERLAP)
    asked = whole & (np.arange(n) + OVERLAP <= piece_end) & (window % np.uint64(PERIOD) == 0)
    cut = opens | asked
    since = np.arange(n) - np.flatnonzero(cut)[np.cumsum(cut) - 1]
    cut |= (since > 0) & (since % LONGEST == 0)
    owned = int(np.searchsorted(begins, own))
    first = np.flatnonzero(cut[:owned])
    if not len(first):
        return
    after = np.append(first[1:], owned)
    last = np.minimum(after + OVERLAP, piece_end[first]) - 1
    body = line.tobytes()
    for a, b, k in zip(starts[first].tolist(), ends[last].tolist(), (after - first).tolist(), strict=True):
        yield body[a:b], k


def parse(texts: list[bytes]) -> Iterator[tuple[bytes, int]]:
    """The chunks of some texts; short texts are parsed together, a long one slice by slice."""
    held, size = [], 0
    for text in texts:
        if len(text) <= SLICE_BYTES:
            held.append(text)
            size += len(text)
        else:
            start = 0
            while start < len(text):
                found = _CUT.search(text, start + SLICE_BYTES)
                end = found.start() if found else len(text)
                ahead = _AHEAD.match(text, end).end()
                yield from chunks(text[start:ahead].lower(), end - start)
                start = end
        if size >= SLICE_BYTES:
            line = b"\n".join(held).lower()
            yield from chunks(line, len(line))
            held, size = [], 0
    line = b"\n".join(held).lower()
    yield from chunks(line, len(line))


def dictionary(docs: DataFrame) -> DataFrame:
    """``lang, chunk, owned, freq``: the distinct chunks of ``lang, text`` and how often the parse has each."""

    def batch_of(lang: str, found: Counter) -> pa.RecordBatch:
        names, counts = zip(*found, strict=True), list(found.values())
        body, owned = names
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(body)), pa.array(body, pa.binary()).cast(pa.string()), pa.array(owned, pa.int32()), pa.array(counts, pa.int64())],
            names=["lang", "chunk", "owned", "freq"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for lang in batch.column("lang").unique().to_pylist():
                rows = texts.filter(pc.equal(batch.column("lang"), lang))
                found, size = Counter(), 0
                for item in parse([t.as_py() for t in rows]):
                    found[item] += 1
                    size += len(item[0])
                    if size > 2 * BLOCK_BYTES:
                        yield batch_of(lang, found)
                        found, size = Counter(), 0
                if found:
                    yield batch_of(lang, found)

    known = docs.filter("text is not null")
    parsed = known.mapInArrow(run, "lang string, chunk string, owned int, freq long")
    return parsed.groupBy("lang", "chunk", "owned").agg(F.sum("freq").alias("freq"))


# --- Counts inside chunks -------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BLOCK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Block:
    """The words of some chunks, with the weight of their chunk and whether they belong to it."""

    def __init__(self, table: pa.Table):
        self.column = table["chunk"]
        self.words = W.hash_words(self.column)
        counts = self.words.counts
        langs = table["lang"].combine_chunks().dictionary_encode()
        langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
        self.langs = langs.dictionary.to_pylist()
        codes = [int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in self.langs]
        code = langs.indices.to_numpy()
        self.code = np.repeat(code, counts)
        self.salt = np.array(codes, np.uint64)[self.code]
        self.freq = np.repeat(table["freq"].to_numpy(), counts)
        self.owned = self.words.place() < np.repeat(table["owned"].to_numpy(), counts)

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the ``n`` words from each word on, and where so many are left in the chunk."""
        hashes, whole = W.rolling(self.words, n)
        return W.mix(hashes ^ self.salt), whole

    def bounds(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The bytes of all chunks, and where each word begins and ends."""
        data, offsets = W.text_buffers(self.column)
        word = data != 32
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        begins[offsets[:-1]] = True
        ends[:-1] &= ~word[1:]
        ends[offsets[1:] - 1] = True
        return data.tobytes(), np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _slots(bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (W.mix((bucket.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)) & np.uint64(BITS - 1)).astype(np.int64)


class Sieve:
    """Tables of bits by phrase length: a phrase whose bit is not set is not frequent."""

    def __init__(self, buckets: int):
        self.buckets, self.bits = buckets, {}

    def passes(self, n: int, hashes: np.ndarray) -> np.ndarray:
        at = _slots(W.bucket_of(hashes, self.buckets), hashes & np.uint64(2**32 - 1))
        return (self.bits[n].value[at >> 3] >> (at & 7) & 1).astype(bool)

    def candidates(self, block: Block, n: int) -> np.ndarray:
        """Where phrases of ``n`` words begin whose two shorter phrases may be frequent."""
        hashes, whole = block.phrases(n)
        fits = whole & block.owned
        if n > 1:
            shorter, there = block.phrases(n - 1)
            may = np.zeros(len(fits), bool)
            may[there] = self.passes(n - 1, shorter[there])
            fits[:-1] &= may[:-1] & may[1:]
        at = np.flatnonzero(fits)
        return at, hashes[at]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def _frequent_bits(chunks_: DataFrame, sieve: Sieve, n: int, least: int) -> np.ndarray:
    """The bits of the phrases of ``n`` words whose hashes occur ``least`` times and more."""
    buckets = sieve.buckets

    def packed(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        bucket = W.bucket_of(hashes, buckets)
        low = hashes.astype(np.uint32)
        held, start = np.unique(bucket, return_index=True)
        rows = []
        for b, lo, hi in zip(held.tolist(), start, np.append(start, len(low))[1:], strict=True):
            # Most phrases occur once; those need no count.
            once = counts[lo:hi] == 1
            rows.append((b, low[lo:hi][once].tobytes(), low[lo:hi][~once].tobytes(), counts[lo:hi][~once].tobytes()))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bucket", "once", "keys", "counts"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for table in _blocks(batches):
            block = Block(table)
            at, found = sieve.candidates(block, n)
            hashes, counts = _summed(np.concatenate([hashes, found]), np.concatenate([counts, block.freq[at]]))
            if len(hashes) >= HELD:
                yield packed(hashes, counts)
                hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield packed(hashes, counts)

    def meet(table: pa.Table) -> pa.Table:
        def read(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        once = read("once", np.uint32)
        keys = np.concatenate([once, read("keys", np.uint32)])
        keys, counts = _summed(keys, np.concatenate([np.ones(len(once), np.int64), read("counts", np.int64)]))
        keys = keys[counts >= least]
        bucket = np.full(len(keys), table["bucket"][0].as_py())
        # Spark's bitmaps count from one.
        return pa.table({"slot": pa.array(np.unique(_slots(bucket, keys)) + 1)})

    dealt = chunks_.mapInArrow(deal, "bucket int, once binary, keys binary, counts binary")
    slots = dealt.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(meet, "slot long")
    parts = slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = np.zeros((BITS // _BITMAP, _BITMAP // 8), np.uint8)
    for part, bits in parts.collect():
        out[part - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def frequent_phrases(chunks_: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, n_words, f`` of every phrase of up to ``LONGEST_PHRASE`` words that occurs ``least`` times."""
    context = chunks_.sparkSession.sparkContext
    size = chunks_.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0
    sieve = Sieve(max(MIN_BUCKETS, math.ceil(size / BUCKET_BYTES)))
    for n in range(1, LONGEST_PHRASE + 1):
        sieve.bits[n] = context.broadcast(_frequent_bits(chunks_, sieve, n, least))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            block = Block(table)
            body, starts, ends = block.bounds()
            for n in range(1, LONGEST_PHRASE + 1):
                at, hashes = sieve.candidates(block, n)
                kept = sieve.passes(n, hashes)
                at, hashes = at[kept], hashes[kept]
                _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
                total = np.zeros(len(first), np.int64)
                np.add.at(total, place, block.freq[at])
                one = at[first]
                texts = [body[a:b] for a, b in zip(starts[one].tolist(), ends[one + n - 1].tolist(), strict=True)]
                langs = pa.DictionaryArray.from_arrays(pa.array(block.code[one], pa.int32()), pa.array(block.langs, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [langs.cast(pa.string()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.full(len(one), n, np.int32)), pa.array(total)],
                    names=["lang", "phrase", "n_words", "f"],
                )

    spelt = chunks_.mapInArrow(spell, "lang string, phrase string, n_words int, f long")
    return spelt.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


# --- Scores ---------------------------------------------------------------------


def _wide(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def _joined(words: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    contained_percent: int = 80,
    top: int = 2000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, k, n, score``: each language's ``top`` phrases of two to four words.

    Texts are lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and U+000A to U+000D and into words at spaces and tabs.
    ``a`` counts the phrase within pieces, overlaps included, and is ``least`` or more; ``n`` counts all words of the
    language. Cutting after ``k`` words gives the counts ``l`` and ``r`` of the parts, and the score
    ``floor(2000000 a / (l + r))`` in whole numbers; the cut with the least score counts, of equal ones the shortest first
    part. A phrase inside a longer frequent one that reaches ``contained_percent`` hundredths of its count is left out.
    Order: score and count falling, then phrase by its UTF-8 bytes.

    A null language is ``und``, as the language so named. Null and empty texts hold no words. Rows that repeat count as often
    as they stand there. A text of any length is read slice by slice; a word is held whole. Other columns, whatever
    their names, are not looked at. No rows, or no phrase frequent enough, give no rows.
    """
    plain = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    chunks_ = stored(dictionary(plain), "chunks")
    counts = stored(frequent_phrases(chunks_, least), "phrases")
    words = F.split("phrase", " ")
    long = counts.filter("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), words.alias("w"))

    inner = F.expr(
        "flatten(transform(sequence(2, n_words - 1), m -> transform(sequence(1, n_words - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    held = long.filter("n_words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("outer"))
    held = held.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    outer = long.join(held, ["lang", "phrase"], "left").filter(
        F.col("outer").isNull() | (_wide(F.col("outer")) * 100 < _wide(F.col("a")) * contained_percent)
    )

    cuts = outer.select("lang", "phrase", "a", "w", "n_words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    k = F.col("k")
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _joined(F.col("w"), F.lit(1), k).alias("left"), _joined(F.col("w"), k + 1, F.col("n_words") - k).alias("right")
    )
    for side in ("left", "right"):
        part = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0]))
        cuts = cuts.join(part, ["lang", side])
    score = F.expr("(cast(a as decimal(19,0)) * 2000000) div (cast(l as decimal(19,0)) + r)")
    cuts = cuts.withColumn("score", score.cast("long"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    best = best.select("lang", "phrase", "a", "best.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = chunks_.groupBy("lang").agg(F.sum(F.col("freq") * F.col("owned")).alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "k", "n", "score")
