"""Conversation structure repair by prefix-doubling path ranking (dealt operator 11).

A repair reads a conversation's rows in order and keeps, reroles or deletes each, and may insert empty turns between them.
What it has read is one of four states: nothing yet, a system turn, a user turn, an assistant turn. Rows times states are
the nodes of a graph whose arcs are edits; the cheapest path to an accepted end is wanted and, of several, the one whose
edits read least ("audit").

* A dynamic programme over costs leaves, at every node, the arcs that lie on a cheapest path.
* Nodes are ranked by the first 1, 2, 4, ... edits of their least audits: the rank by twice as many edits orders pairs of
  (rank here, rank where these edits lead), and pointers double along with it. An arc is chosen by its letter and the rank of
  the node it leads to; the least path is read off through the doubled pointers, all its places at once.

All rows of many conversations are worked on together as arrays. A conversation of any length is cut into chunks of
``CHUNK`` rows: a chunk's costs from each state to each state are a small matrix, the matrices of one conversation are
multiplied from its end (in sums and minima), and with the costs after it a chunk's paths no longer depend on the others.
Only the digest of the repaired text must see a conversation's rows in order; it reads them as a sorted stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.llm.storage import stored

CHUNK = 4096
# Rows whose paths are searched together.
LANES = 1 << 15

START, SYSTEM, USER, ASSISTANT = range(4)
# The state that the next right turn leads to, and what an insertion or a new role makes of each state.
_NEXT = np.array([USER, USER, ASSISTANT, USER])
_ROLE = {USER: "user", ASSISTANT: "assistant"}
# What is left to do at a conversation's end, by state.
_TAIL = ("", "II", "I", "")
_DELETE, _INSERT, _KEEP, _REROLE = b"DIKR"
_COST = {"rerole": 2, "delete": 3, "insert": 2, "truncated": 1}
_END_COST = np.array([_COST["insert"] * len(t) for t in _TAIL], np.int64)
_FAR = 1 << 40

BLANK, DUPLICATE, TRUNCATED, SOUND = range(4)


# --- Rows -----------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, times`` of rows that are damaged by a checksum of their conversation and turn.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes its ``. ! ?``, 3 repeats it, 4 makes it a user's.
    """
    spelt = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    what = F.crc32(F.concat(spelt[0], F.lit(":"), spelt[1]).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(what == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    times = F.when(what == 3, 2).otherwise(1)
    return rows.filter(what != 0).select("conv", "turn", role.alias("role"), text.alias("text"), times.cast("long").alias("times"))


def _digest() -> Column:
    return F.unhex(F.md5("text")).alias("digest")


def _order(*before: str) -> list[Column]:
    return [F.asc_nulls_first(c) for c in (*before, "conv", "turn", "role", "digest")]


def described(rows: DataFrame, parts: int) -> DataFrame:
    """Per distinct row ``conv, at, turn, initial, fault, copies``; ``at`` numbers the rows in order.

    Equal rows are one with a number of copies before they are shuffled, so no row is frequent. Range partitioning cuts a
    long conversation into many parts.
    """
    tail = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    kind = F.when(tail == "", BLANK).when(~tail.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    slim = rows.select("conv", "turn", "role", _digest(), kind.alias("kind"), "times")
    keys = ["conv", "turn", "role", "digest"]
    distinct = slim.groupBy(*keys).agg(F.first("kind").alias("kind"), F.sum("times").alias("copies"))
    placed = distinct.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
    # The numbers are fixed once they are written.
    placed = stored(placed.withColumn("at", F.monotonically_increasing_id()), "turns")
    said = placed.filter(F.col("kind") != BLANK).groupBy("conv", "role", "digest")
    several = said.agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1")
    several = several.select(*[F.col(c).alias(f"_{c}") for c in ("conv", "role", "digest")], "first")
    same = F.lit(True)
    for c in ("conv", "role", "digest"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    repeated = F.coalesce((F.col("kind") != BLANK) & (F.col("at") > F.col("first")), F.lit(False))
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("kind")).cast("int").alias("fault")
    return placed.join(several, same, "left").select("conv", "at", "turn", F.substring("role", 1, 1).alias("initial"), fault, "copies")


def chunked(rows: DataFrame, size: int) -> DataFrame:
    """Up to ``size`` consecutive rows of a conversation as lists of one row: ``conv, chunk, turn, initial, fault, copies``."""
    chunk = F.floor(F.col("at") / size).cast("long").alias("chunk")
    one = F.struct("at", "turn", "initial", "fault", "copies")
    grouped = rows.groupBy("conv", chunk).agg(F.array_sort(F.collect_list(one)).alias("rows"))
    return grouped.select("conv", "chunk", *[F.col(f"rows.{c}").alias(c) for c in ("turn", "initial", "fault", "copies")])


# --- Paths ----------------------------------------------------------------------


class Lanes:
    """The rows of several chunks: ``first[c]:first[c + 1]`` are those of chunk c."""

    def __init__(self, first: np.ndarray, state: np.ndarray, fault: np.ndarray, copies: np.ndarray):
        """``state`` is the state that a row's role leads to, -1 for other roles."""
        self.first, self.state, self.fault, self.copies = first, state, fault, copies
        self.length = np.diff(first)

    def arcs(self, at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs by delete, keep and rerole from each state of rows ``at``, given those ``after`` each; and the least, inserts included."""
        dead = self.fault[at] <= DUPLICATE
        extra = _COST["truncated"] * (self.fault[at] == TRUNCATED)
        # Copies of a row that is said once have to go.
        repeats = _COST["delete"] * (self.copies[at] - 1)
        state = self.state[at]
        out = np.full((3, *after.shape), _FAR, np.int64)
        out[0] = _COST["delete"] + after
        lanes = np.arange(len(at))
        kept = after[lanes, np.maximum(state, 0)] + extra
        for q in range(4):
            fits = ~dead & ((state == _NEXT[q]) | ((state == SYSTEM) & (q == START)))
            out[1, fits, q] = kept[fits]
            out[2, ~dead, q] = (after[:, _NEXT[q]] + extra + _COST["rerole"])[~dead]
        out += repeats[:, None]
        return out, _with_inserts(out.min(axis=0))

    def backwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(chunks, their rows) from the last rows to the first; a chunk joins in when its last row's turn comes."""
        for back in range(int(self.length.max(initial=0))):
            chunk = np.flatnonzero(self.length > back)
            yield chunk, self.first[chunk + 1] - 1 - back


def _with_inserts(cost: np.ndarray) -> np.ndarray:
    """The least costs where turns may be inserted first; two lead to every state that inserts reach."""
    for _ in range(2):
        cost = np.minimum(cost, _COST["insert"] + cost[..., _NEXT])
    return cost


def transfer(lanes: Lanes) -> np.ndarray:
    """``[chunk, from state, to state]``: the least cost of reading a chunk."""
    out = np.empty((len(lanes.length), 4, 4), np.int64)
    for target in range(4):
        cost = np.full((len(lanes.length), 4), _FAR, np.int64)
        cost[:, target] = 0
        for chunk, at in lanes.backwards():
            cost[chunk] = np.minimum(lanes.arcs(at, cost[chunk])[1], _FAR)
        out[:, :, target] = cost
    return out


def least_audits(lanes: Lanes, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """For each chunk and state on entry: the least cost, the state on exit, and the least audit of a cheapest path.

    ``after[c]`` has the costs of what follows chunk c, by state.
    """
    n, rows = len(lanes.length), int(lanes.first[-1])
    # Node 4 * (row + chunk) + state stands before a row; each chunk has one layer more, its exit.
    layer = np.arange(rows) + np.repeat(np.arange(n), lanes.length)
    exits = lanes.first[1:] + np.arange(n)
    nodes = 4 * (rows + n)
    order = (_DELETE, _INSERT, _KEEP, _REROLE)
    tight = np.zeros((4, nodes), bool)
    leads = np.tile(np.arange(nodes), (4, 1))
    cost = after.copy()
    states = np.arange(4)
    for chunk, at in lanes.backwards():
        own, best = lanes.arcs(at, cost[chunk])
        here = 4 * layer[at][:, None] + states
        below = here + 4
        for letter, costs in ((0, own[0]), (2, own[1]), (3, own[2]), (1, _COST["insert"] + best[:, _NEXT])):
            tight[letter, here] = (costs == best) & (costs < _FAR)
        leads[0, here] = below
        leads[1, here] = here - states + _NEXT
        state = lanes.state[at][:, None]
        leads[2, here] = below - states + np.maximum(state, 0)
        leads[3, here] = below - states + _NEXT
        cost[chunk] = best

    # Ranks by audits of 1, 2, 4, ... edits. No two arcs of a node have one letter, so the least letter leads the least audit.
    letter = np.where(tight.any(axis=0), tight.argmax(axis=0), -1)
    rank = letter + 1
    leap = np.where(letter >= 0, leads[np.maximum(letter, 0), np.arange(nodes)], np.arange(nodes))
    steps = (letter >= 0).astype(np.int64)
    leaps, reach = [leap], [steps]
    while (letter[leaps[-1]] >= 0).any():
        leap = leaps[-1]
        _, rank = np.unique(rank.astype(np.int64) * (nodes + 5) + rank[leap], return_inverse=True)
        reach.append(reach[-1] + reach[-1][leap])
        leaps.append(leap[leap])
    # Whole audits are ranked now: of a node's cheapest arcs, that of the least letter and then of the least rank.
    key = np.where(tight, np.arange(4)[:, None] * np.int64(nodes + 5) + rank[leads], np.iinfo(np.int64).max)
    chosen = np.where(letter >= 0, key.argmin(axis=0), -1)

    entry = 4 * (lanes.first[:-1] + np.arange(n))[:, None] + states
    length = reach[-1][entry]
    flat = length.ravel()
    place = np.arange(flat.sum()) - np.repeat(np.cumsum(flat) - flat, flat)
    node = np.repeat(entry.ravel(), flat)
    for level, leap in enumerate(leaps):
        far = place >> level & 1 == 1
        node[far] = leap[node[far]]
    edits = np.array(order, np.uint8)[chosen[node]]
    # Every edit but an insertion uses up a row; the copies after the first are deleted with it.
    row = node // 4 - np.searchsorted(exits, node // 4)
    times = np.where(edits == _INSERT, 1, lanes.copies[np.minimum(row, max(rows - 1, 0))]) if len(node) else flat[:0]
    spelt = np.repeat(edits, times)
    again = np.arange(len(spelt)) - np.repeat(np.cumsum(times) - times, times) > 0
    spelt[again] = _DELETE
    ends = np.cumsum(times)[np.cumsum(flat) - 1] if len(node) else flat
    ends = np.where(np.cumsum(flat) > 0, ends, 0)
    body = spelt.tobytes()
    pieces = [body[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    exit_ = leaps[-1][entry] % 4
    return cost, exit_, [pieces[4 * c : 4 * c + 4] for c in range(n)]


# --- Whole conversations --------------------------------------------------------

_LISTS = "turn array<long>, initial array<string>, fault array<int>, copies array<long>"


def _read(batch: pa.RecordBatch) -> Lanes:
    column = batch.column("initial")
    first = column.offsets.to_numpy().astype(np.int64)
    first = first - first[0]
    state = np.full(int(first[-1]), -1)
    for letter, q in (("s", SYSTEM), ("u", USER), ("a", ASSISTANT)):
        state[pc.equal(column.flatten(), letter).to_numpy(zero_copy_only=False)] = q
    fault, copies = (batch.column(c).flatten().to_numpy() for c in ("fault", "copies"))
    return Lanes(first, state, fault, copies.astype(np.int64))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``LANES`` rows (of whole chunks)."""
    for batch in batches:
        offsets = batch.column("initial").offsets.to_numpy()
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + LANES, side="right")) - 1
            end = min(batch.num_rows, max(end, row + 1))
            yield batch.slice(row, end - row)
            row = end


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        costs = transfer(_read(batch)).reshape(-1, 16)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(costs.ravel()), 16).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("chunk"), lists], names=["conv", "chunk", "costs"])


def _after(key: tuple, table: pa.Table) -> pa.Table:
    """The costs after each chunk of one conversation, out of the matrices of all of them."""
    table = table.sort_by("chunk")
    costs = np.array(table["costs"].to_pylist(), np.int64).reshape(-1, 4, 4)
    out = np.empty((len(costs), 4), np.int64)
    after = _END_COST
    for i in range(len(costs) - 1, -1, -1):
        out[i] = after
        after = np.minimum((costs[i] + after[None, :]).min(axis=1), _FAR)
    return pa.table({"conv": table["conv"], "chunk": table["chunk"], "after": pa.array(out.tolist(), pa.list_(pa.int64()))})


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk: its least audits and exits by state on entry, and what it adds to the conversation's counts."""
    for batch in _parts(batches):
        lanes = _read(batch)
        after = np.array([_END_COST if a is None else a for a in batch.column("after").to_pylist()], np.int64).reshape(-1, 4)
        cost, exits, audits = least_audits(lanes, after)
        turns, initials = batch.column("turn").to_pylist(), batch.column("initial").to_pylist()
        faults, copies = batch.column("fault").to_pylist(), batch.column("copies").to_pylist()
        rows = []
        for c in range(batch.num_rows):
            known = [t for t in turns[c] if t is not None]
            counted = [0, 0, 0]
            illegal = 0
            last = None
            for initial, fault, n in zip(initials[c], faults[c], copies[c], strict=True):
                if fault == BLANK or fault == DUPLICATE:
                    counted[fault] += n
                else:
                    counted[TRUNCATED] += fault == TRUNCATED
                    counted[DUPLICATE] += n - 1
                illegal += n - 1 + (last is not None and last + initial not in ("su", "ua", "au"))
                last = initial
            low, high = (known[0], known[-1]) if known else (None, None)
            rows.append((*counted, illegal, initials[c][0], last, low, high, len(set(known))))
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("chunk")]
            + [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]
            + [pa.array(cost.tolist(), pa.list_(pa.int64())), pa.array(exits.tolist(), pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.binary())).cast(pa.list_(pa.string()))],
            names=["conv", "chunk", *_COUNTS, "cost", "exits", "audits"],
        )


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "head", "foot", "low", "high", "distinct")
_SOLVED = (
    "chunk long, blank long, duplicate long, truncated long, illegal long, head string, foot string, low long, high long, "
    "distinct long, cost array<long>, exits array<int>, audits array<string>"
)
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_MOST = 2**63 - 1


class _Conversation:
    """What the sorted stream has read of one conversation: first its chunks in order, then its rows in order."""

    def __init__(self, conv: object):
        self.conv, self.state, self.audit = conv, START, []
        self.counts, self.cost, self.foot = [0, 0, 0, 0], 0, None
        self.low = self.high = None
        self.distinct = 0
        self.hash, self.empty = hashlib.sha256(), True
        self.edits, self.place = None, 0
        self.role = START

    def chunk(self, r: dict) -> None:
        if not self.audit:
            self.cost = r["cost"][START]
        self.audit.append(r["audits"][self.state])
        self.state = r["exits"][self.state]
        for i, name in enumerate(_COUNTS[:4]):
            self.counts[i] += r[name]
        if self.foot is not None:
            self.counts[3] += self.foot + r["head"] not in ("su", "ua", "au")
        self.foot = r["foot"]
        if r["low"] is not None:
            # A turn may go on in the next chunk.
            self.distinct += r["distinct"] - (self.high == r["low"])
            self.low = r["low"] if self.low is None else self.low
            self.high = r["high"]

    def _whole(self) -> str:
        if self.edits is None:
            self.edits = "".join(self.audit) + (_TAIL[self.state] if self.audit else "")
        return self.edits

    def _say(self, role: str, text: str, state: int) -> None:
        self.hash.update((f"{role}:{text}" if self.empty else f"\n{role}:{text}").encode())
        self.empty, self.role = False, state

    def _insert(self) -> None:
        edits = self._whole()
        while self.place < len(edits) and edits[self.place] == "I":
            state = int(_NEXT[self.role])
            self._say(_ROLE[state], "", state)
            self.place += 1

    def row(self, role: str, text: str, times: int) -> None:
        self._insert()
        edit = self._whole()[self.place]
        if edit == "K":
            self._say(role, text, SYSTEM if self.role == START and role[:1] == "s" else int(_NEXT[self.role]))
        elif edit == "R":
            state = int(_NEXT[self.role])
            self._say(_ROLE[state], text, state)
        self.place += 1
        # Its copies are deleted one by one.
        self.place += times - 1

    def result(self) -> tuple:
        self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, min(gaps, _MOST), *self.counts, self.cost, self._whole(), self.hash.hexdigest())


def repaired_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """Per conversation of ``rows``, which are damaged first (``damaged``): ``conv, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256``.

    The rows of a conversation stand by turn, nulls first, then by role and by a digest of the text. A null id is a
    conversation like others. Null turns, roles and texts are one space where they are spelt; gaps count known turns only. A
    role that does not begin with s, u or a, an empty one included, is never right as it is. Equal rows are copies of one:
    the first may be sound, the others are duplicates. A conversation without rows has zeros, an empty audit and the digest
    of nothing. Columns beside the four named ones are not looked at. No rows give none.

    An audit has a letter per edit and is one value, so a conversation holds fewer than 2**31 rows.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    kind = plain.schema["conv"].dataType.simpleString()
    said = damaged(plain)
    chunks = stored(chunked(described(said, parts), chunk), "turn-chunks")
    # Most conversations are one chunk, with nothing after it.
    long = chunks.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("_conv"))
    several = chunks.join(long, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
    costs = several.mapInArrow(matrices, f"conv {kind}, chunk long, costs array<long>")
    after = costs.groupBy("conv").applyInArrow(_after, f"conv {kind}, chunk long, after array<long>")
    after = after.select(F.col("conv").alias("_conv"), F.col("chunk").alias("_chunk"), "after")
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    solved = chunks.join(after, same, "left").drop("_conv", "_chunk").mapInArrow(solve, f"conv {kind}, {_SOLVED}")

    # Chunks, then rows, in one sorted stream; an id alone stands for a conversation that lost all its rows.
    mark = F.lit(0).alias("step")
    stream = plain.select("conv").distinct().select("conv", mark)
    stream = stream.unionByName(solved.withColumn("step", F.lit(1)), allowMissingColumns=True)
    texts = said.withColumn("digest", _digest()).withColumn("step", F.lit(2))
    stream = stream.unionByName(texts, allowMissingColumns=True)
    first = [F.asc_nulls_first("conv"), F.asc("step"), F.asc("chunk"), *_order()[1:]]
    stream = stream.repartition(parts, "conv").sortWithinPartitions(*first).drop("turn", "digest")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: _Conversation | None = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 9
            kinds = [ids, *[pa.int64()] * 6, pa.string(), pa.string()]
            names = ["conv", *[x.split()[0] for x in _RESULT.split(", ")]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        ids = None
        for batch in batches:
            ids = batch.schema.field("conv").type
            for r in batch.to_pylist():
                if r["step"] == 0:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(r["conv"])
                elif r["step"] == 1:
                    now.chunk(r)
                else:
                    now.row(r["role"], r["text"], r["times"])
            if done:
                yield out()
                done.clear()
        if now is not None:
            done.append(now.result())
            yield out()

    return stream.mapInArrow(fold, f"conv {kind}, {_RESULT}")
