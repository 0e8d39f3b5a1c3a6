"""Words of Arrow text columns as NumPy arrays: bounds, 64-bit hashes and rolling windows, without a Python loop per word.

A word is a run of bytes other than U+0020 and U+0009 to U+000D in the UTF-8 form of a text. All arithmetic is modulo
2**64 and the constants are fixed, so hashes agree between tasks, attempts and machines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are hashed at a time; tables of powers are as long.
SLICE_BYTES = 1 << 20

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_MASK = 2**64 - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the whole word."""
    h = h.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
_BYTE[list(SEPARATORS)] = 0
_BYTE_LOWER = _BYTE[_LOWER]

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, at least ``n`` of each; kept and grown up to a slice's length.

    Only a single word longer than a slice needs more, and those are not kept.
    """
    global _powers, _inverse
    if len(_powers) >= n:
        return _powers, _inverse
    tables = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        table = np.full(1 << max(16, (n - 1).bit_length()), base, np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    if len(tables[0]) <= 2 * SLICE_BYTES:
        _powers, _inverse = tables
    return tables[0], tables[1]


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the ``rows + 1`` offsets into them; a null text is empty."""
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of some texts: ``hash[i]`` of word i, and the words of text t at ``first[t]:first[t + 1]``."""

    def __init__(self, first: np.ndarray, hash_: np.ndarray):
        self.first, self.hash = first, hash_

    def __len__(self) -> int:
        return len(self.hash)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def place(self) -> np.ndarray:
        """The position of each word in its own text."""
        return np.arange(len(self.hash)) - np.repeat(self.first[:-1], self.counts)

    def left(self) -> np.ndarray:
        """How many words its text holds from each word on, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hash))


def stretches(data: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of about ``most`` bytes; each but the last ends at a separator, so no word is cut."""
    start = 0
    while start < len(data):
        end = start + most
        while end < len(data):
            gap = ~_IS_WORD[data[end : end + 4096]]
            if gap.any():
                end += int(gap.argmax())
                break
            end += 4096
        end = min(end, len(data))
        yield start, end
        start = end


def hash_words(column: pa.Array | pa.ChunkedArray, lower: bool = False, slice_bytes: int = SLICE_BYTES) -> Words:
    """The words of every row of a text column. ``lower`` folds A-Z; long columns and long texts are hashed in slices."""
    data, offsets = text_buffers(column)
    counts, hashes = [], []
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + slice_bytes, side="right")) - 1
        end = min(rows, max(end, row + 1))
        own = data[offsets[row] : offsets[end]]
        if len(own) > slice_bytes:
            parts = [_hash_slice(own[a:b], np.array([0, b - a]), lower) for a, b in stretches(own, slice_bytes)]
            counts.append(np.array([sum(len(p) for p in parts)]))
            hashes += [p.hash for p in parts]
        else:
            part = _hash_slice(own, offsets[row : end + 1] - offsets[row], lower)
            counts.append(part.counts)
            hashes.append(part.hash)
        row = end
    first = np.zeros(rows + 1, np.int64)
    if counts:
        np.cumsum(np.concatenate(counts), out=first[1:])
    return Words(first, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64))


def _hash_slice(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    n = len(data)
    inside = _IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # A text may begin with a word right after the last word of the one before.
    edges = offsets[offsets < n]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(first, np.zeros(0, np.uint64))
    powers, inverse = _power_tables(n)
    terms = (_BYTE_LOWER if lower else _BYTE)[data]
    terms *= powers[:n]
    sums = np.add.reduceat(terms, starts)
    sums *= inverse[starts]
    return Words(first, mix(sums))


def rolling(words: Words, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` words, and which starts hold a whole window of one text.

    Both arrays have an entry for every word, so windows keep the word's index; entries past a text's end are not used.
    """
    size = len(words)
    whole = words.left() >= n
    out = np.zeros(size, np.uint64)
    if size >= n:
        total = np.full(size - n + 1, seed * 0x632BE59BD9B4E019 & _MASK, np.uint64)
        for j in range(n):
            total *= _STEP
            total += words.hash[j : size - n + 1 + j]
        out[: size - n + 1] = mix(total)
    return out, whole


def row_slices(column: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold at most ``most_bytes`` together; a longer text is a range of its own."""
    _, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most_bytes, side="right")) - 1
        end = min(rows, max(end, row + 1))
        yield row, end
        row = end


def first_of_each(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first occurrence of every distinct key, in rising order, and how often each key occurs."""
    _, index, counts = np.unique(keys, return_index=True, return_counts=True)
    order = np.argsort(index)
    return index[order], counts[order]


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: whether its key occurs more than once, and whether it occurs earlier."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    twin = later.copy()
    twin[order[:-1]] |= same
    return twin, later


def gaps(rising: np.ndarray) -> bytes:
    """A rising sequence as its first value and the steps after it, two bytes each where they fit."""
    steps = np.diff(rising, prepend=0)
    small = len(steps) > 0 and int(steps.max()) < 65536
    return steps.astype(np.uint16 if small else np.uint32 if not len(steps) or steps.max() < 2**32 else np.uint64).tobytes()


def from_gaps(body: bytes, n: int) -> np.ndarray:
    kind = {2: np.uint16, 4: np.uint32, 8: np.uint64}[len(body) // n] if n else np.uint16
    return np.cumsum(np.frombuffer(body, kind).astype(np.int64))


def split_by(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices of its entries in rising order), for the buckets that have any."""
    if not len(bucket):
        return
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 65536 else np.uint32), kind="stable")
    held, start = np.unique(bucket[order], return_index=True)
    for i, (b, part) in enumerate(zip(held, np.split(order, start[1:]), strict=True)):
        yield int(held[i]), part


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket from the upper half of a hash; the lower half stays free to tell entries apart."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
