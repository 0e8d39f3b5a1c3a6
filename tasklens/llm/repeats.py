"""Exact substring deduplication by fixed-block anchors (dealt operator 4).

A repeat of 20 words holds, wherever it starts, a whole block of 10 words that begins at a multiple of 10 in its own
document. So only those non-overlapping blocks are indexed, and every rolling window of 10 words probes them:

1. Documents are dealt into chunks by a hash of their id. Each chunk sends one entry per distinct 10-word window to the
   window's bucket: a block that asks whether it occurs elsewhere, or a plain probe. Twins inside the chunk need no
   reply, so however hot a passage is, a bucket gets one entry of it per chunk.
2. Buckets answer the blocks that met a probe (*anchors*). The answer may err towards too many anchors, never too few.
3. Anchors are extended: a 20-word window all of whose own blocks are anchors is a candidate. Its full hash goes, once
   per chunk and with its place, to the bucket that knows the earliest occurrence; later ones are answered.
4. Windows that start earlier elsewhere, joined where they overlap, are the maximal exact repeats; their words go.

Entries travel packed, a few bytes per window. The three visits to the texts share one exchange of the documents.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm import words as W

WINDOW = 20
# Text that one task chunk holds, and text whose windows one bucket holds.
CHUNK_BYTES = 4 * 1024 * 1024
BUCKET_BYTES = 16 * 1024 * 1024
MIN_BUCKETS, MAX_BUCKETS = 32, 65_536

_ASK = "bucket int, chunk int, n int, keys binary, at binary"
_CLAIM = "bucket int, chunk int, n int, keys binary, docs binary, at binary"
_ANSWER = "chunk int, n int, at binary"


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    plain_spaces: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows and columns of ``docs``, with the words of repeats cut from the text, and ``n_words``, ``n_removed``.

    A word goes if a window of ``window`` words covers it whose words also start earlier: in a document with a smaller
    id, or earlier in its own. Windows are judged on the input. A text that loses words becomes its kept words joined
    by single spaces; other texts stay as they are, or are joined likewise with ``plain_spaces``.

    Null and empty texts have no words (null stays null unless ``plain_spaces`` makes it empty). Rows without an id
    come after all others; rows that repeat an id are taken in the order of their texts, as if their ids rose. An empty
    table gives an empty table. Columns of ``docs`` called ``n_words`` or ``n_removed`` are replaced.
    """
    if window < 2:
        raise ValueError("a window holds two words at least")
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, math.ceil(size / bucket_bytes)))
    # Fewer partitions than Spark's own number would make it deal the chunks out once more for the joins.
    partitions = max(chunks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rest = [c for c in docs.columns if c not in (id_col, text_col, "n_words", "n_removed")]
    # Rows without an id are spread by their text.
    spread = F.xxhash64(F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col)))
    parts = docs.select(
        F.pmod(spread, F.lit(chunks)).cast("int").alias("chunk"),
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        *[F.col(c).alias(f"rest_{i}") for i, c in enumerate(rest)],
    ).repartition(partitions, "chunk")
    block = window // 2

    def ask(table: pa.Table) -> pa.Table:
        return _ask(_ordered(table), block, buckets)

    def claim(left: pa.Table, right: pa.Table) -> pa.Table:
        return _claim(_ordered(left), right, block, window, buckets)

    schema = f"{_ddl(docs, id_col, text_col, rest)}, n_words long, n_removed long"

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        return _cut(_ordered(left), right, window, plain_spaces)

    by_chunk = parts.groupBy("chunk")
    anchors = by_chunk.applyInArrow(ask, _ASK).groupBy("bucket").applyInArrow(_anchors, _ANSWER)
    claims = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(claim, _CLAIM)
    later = claims.groupBy("bucket").applyInArrow(_later, _ANSWER)
    out = by_chunk.cogroup(later.groupBy("chunk")).applyInArrow(cut, schema)
    names = {"id": id_col, "text": text_col} | {f"rest_{i}": c for i, c in enumerate(rest)}
    kept = {c: n for n, c in names.items()}
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    types = dict(docs.dtypes)
    return out.select(*[F.col(kept[c]).cast(types[c]).alias(c) for c in columns], "n_words", "n_removed")


def _ddl(docs: DataFrame, id_col: str, text_col: str, rest: list[str]) -> str:
    types = dict(docs.dtypes)
    return ", ".join(["id long", "text string", *[f"rest_{i} {types[c]}" for i, c in enumerate(rest)]])


def _ordered(table: pa.Table) -> pa.Table:
    """A chunk in the order of its documents, the same in every pass and attempt."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def _aligned(words: W.Words, block: int) -> np.ndarray:
    return words.place() % block == 0


def _ask(table: pa.Table, block: int, buckets: int) -> pa.Table:
    words = W.hash_words(table["text"])
    hashes, whole = W.rolling(words, block)
    at = np.flatnonzero(whole)
    first, count = W.first_of_each(hashes[at])
    at = at[first]
    asks = (count == 1) & _aligned(words, block)[at]
    keys = (hashes[at].astype(np.uint32) & np.uint32(0xFFFFFFFE)) | asks
    chunk = table["chunk"][0].as_py() if table.num_rows else 0
    rows = [
        (b, chunk, len(i), keys[i].astype(np.uint32).tobytes(), W.gaps(at[i]))
        for b, i in W.split_by(W.bucket_of(hashes[at], buckets), buckets)
    ]
    return _table(rows, ("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("at", pa.binary()))


def _table(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(index of the row of each entry, its place in its chunk, entries of each row)."""
    sizes = table["n"].to_pylist()
    places = [W.from_gaps(b, n) for b, n in zip(table["at"].to_pylist(), sizes, strict=True)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.concatenate(places) if places else np.zeros(0, np.int64), sizes


def _answers(table: pa.Table, row: np.ndarray, at: np.ndarray) -> pa.Table:
    """Places as one packed row per chunk."""
    chunks = table["chunk"].to_numpy()[row]
    rows = []
    for c in np.unique(chunks):
        places = np.sort(at[chunks == c]) if len(chunks) < 4096 else None
        rows.append((int(c), places))
    if rows and rows[0][1] is None:
        order = np.lexsort((at, chunks))
        held, start = np.unique(chunks[order], return_index=True)
        rows = [(int(c), part) for c, part in zip(held, np.split(at[order], start[1:]), strict=True)]
    packed = [(c, len(places), W.gaps(places)) for c, places in rows]
    return _table(packed, ("chunk", pa.int32()), ("n", pa.int32()), ("at", pa.binary()))


def _anchors(table: pa.Table) -> pa.Table:
    row, at, _ = _unpack(table)
    keys = np.concatenate([np.frombuffer(b, np.uint32) for b in table["keys"].to_pylist()])
    twin, _ = W.repeats(keys >> np.uint32(1))
    anchored = np.flatnonzero(twin & (keys & np.uint32(1)).astype(bool))
    return _answers(table, row[anchored], at[anchored])


def _marked(answers: pa.Table, size: int) -> np.ndarray:
    marks = np.zeros(size, bool)
    for body, n in zip(answers["at"].to_pylist(), answers["n"].to_pylist(), strict=True):
        marks[W.from_gaps(body, n)] = True
    return marks


def _claim(table: pa.Table, answers: pa.Table, block: int, window: int, buckets: int) -> pa.Table:
    words = W.hash_words(table["text"])
    size = len(words)
    hashes, whole = W.rolling(words, block)
    at = np.flatnonzero(whole)
    anchored = _marked(answers, size)
    anchored[at] |= W.repeats(hashes[at])[0]
    missing = np.zeros(size + 1, np.int64)
    np.cumsum(_aligned(words, block) & whole & ~anchored, out=missing[1:])
    full, fits = W.rolling(words, window, seed=2)
    start = np.flatnonzero(fits)
    # The blocks inside a window begin at its first word or up to window - block words later.
    start = start[missing[start + window - block + 1] == missing[start]]
    first, _ = W.first_of_each(full[start])
    start = start[first]
    deal, _ = W.rolling(words, window, seed=3)
    no_id = np.iinfo(np.int64).max
    ids = table["id"].fill_null(no_id).to_numpy()
    doc = np.repeat(ids, words.counts)[start]
    chunk = table["chunk"][0].as_py() if table.num_rows else 0
    rows = []
    for b, i in W.split_by(W.bucket_of(deal[start], buckets), buckets):
        # Ids rise within a chunk; what is packed are their distances.
        rows.append((b, chunk, len(i), full[start[i]].tobytes(), _id_gaps(doc[i]), W.gaps(start[i])))
    return _table(
        rows, ("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()),
        ("keys", pa.binary()), ("docs", pa.binary()), ("at", pa.binary()),
    )


def _id_gaps(ids: np.ndarray) -> bytes:
    """Rising ids: the first one whole, then the steps, four bytes each where they fit."""
    steps = (ids[1:].astype(np.uint64) - ids[:-1].astype(np.uint64)) if len(ids) > 1 else np.zeros(0, np.uint64)
    small = not len(steps) or int(steps.max()) < 2**32
    return ids[:1].astype(np.int64).tobytes() + steps.astype(np.uint32 if small else np.uint64).tobytes()


def _from_id_gaps(body: bytes, n: int) -> np.ndarray:
    kind = np.uint64 if n > 1 and len(body) == 8 * n else np.uint32
    steps = np.frombuffer(body, kind, offset=8).astype(np.uint64)
    out = np.zeros(n, np.uint64)
    np.cumsum(steps, out=out[1:])
    out += np.frombuffer(body, np.int64, count=1).astype(np.uint64)
    return out.astype(np.int64)


def _later(table: pa.Table) -> pa.Table:
    row, at, sizes = _unpack(table)
    keys = np.concatenate([np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()])
    docs = np.concatenate([_from_id_gaps(b, n) for b, n in zip(table["docs"].to_pylist(), sizes, strict=True)])
    order = np.lexsort((at, docs, keys))
    later = np.flatnonzero(keys[order][1:] == keys[order][:-1]) + 1
    picked = order[later]
    return _answers(table, row[picked], at[picked])


def _cut(table: pa.Table, answers: pa.Table, window: int, plain_spaces: bool) -> pa.Table:
    words = W.hash_words(table["text"])
    size = len(words)
    full, fits = W.rolling(words, window, seed=2)
    repeated = _marked(answers, size)
    start = np.flatnonzero(fits)
    repeated[start] |= W.repeats(full[start])[1]
    edge = np.zeros(size + window + 1, np.int64)
    hit = np.flatnonzero(repeated)
    edge[hit] += 1
    edge[hit + window] -= 1
    gone = np.cumsum(edge[:size]) > 0
    totals = np.zeros(size + 1, np.int64)
    np.cumsum(gone, out=totals[1:])
    removed = totals[words.first[1:]] - totals[words.first[:-1]]
    kept = []
    for i, text in enumerate(table["text"].to_pylist()):
        if removed[i]:
            mask = ~gone[words.first[i] : words.first[i + 1]]
            text = b" ".join(compress(text.encode().split(), mask.tolist())).decode()
        elif plain_spaces:
            text = b" ".join((text or "").encode().split()).decode()
        kept.append(text)
    rest = [n for n in table.column_names if n.startswith("rest_")]
    return pa.table(
        [table["id"], pa.array(kept, pa.string()), *[table[n] for n in rest], pa.array(words.counts), pa.array(removed)],
        names=["id", "text", *rest, "n_words", "n_removed"],
    )
