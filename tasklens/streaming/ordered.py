"""Task names for events that arrive late and out of order.

A task's name depends on the order of its events, and a stream delivers them in another one. ``named_in_order`` therefore
holds every event until the watermark has passed it, and then names a task's events in their own order. What comes later
than the watermark allows is too late to be named, and Spark drops it.

Each call on the state store and each value in it costs far more than a row does, and so does a row that Python handles by itself.
So tasks are dealt over a fixed number of groups, by a hash, and state is kept per group, of rows packed by the thousand as Arrow
data: the events of a time slot stand in one of a ring of list states, so that giving out a slot reads that slot and not all that is
waiting; an event-time timer stands at the end of each slot in use; the remembered names are one packed value, read and written once
for all slots of the group that are due. Rows come and go as frames, and all tasks of a group are named at once by their columns.
More groups make these values shorter.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tasklens import constants as K
from tasklens.functions.names import present

# Lists that a group's waiting events are dealt over, by time slot.
RING = 4
# Groups that tasks are dealt over; fixed for the life of a query, as its state partitions are.
GROUPS = 512
# Rows above which slots that are due are given out by themselves.
_AT_A_TIME = 10_000
# When a slot is settled: the event time of its rows from then on.
SETTLED = "settled_at"
_AT = "_at_us"


class _NamesInOrder(StatefulProcessor):
    """Names in order, for rows one by one; ``_NamesInFrames`` takes frames.

    ``order_types`` has the types that columns are ordered by where they are held as text.
    """

    def __init__(
        self, held: StructType, order: tuple[str, ...], slot_ms: int, remember_ms: int | None, order_types: dict[str, DataType] | None = None
    ) -> None:
        self._columns, self._held = held.fieldNames(), held
        self._order, self._order_types = order, order_types or {}
        self._slot_ms, self._remember_ms = slot_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._schema = to_arrow_schema(self._held)
        self._lists = [handle.getListState(f"waiting{i}", "slot long, packed binary") for i in range(RING)]
        self._slots = handle.getValueState("slots", "slots array<long>")
        self._names = handle.getValueState("names", "packed binary")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        values = [[row[c] for c in self._columns] for row in rows]
        self._wait([pa.table([pa.array(v, f.type) for v, f in zip(zip(*values, strict=True), self._schema, strict=True)], self._schema)])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        named = Row(*self._columns, "carried_name", SETTLED)
        for rows, names, settled in self._due(timerValues, expiredTimerInfo):
            for values in zip(*[c.to_pylist() for c in rows.columns], names, settled.to_pydatetime(), strict=True):
                yield named(*values)

    def _wait(self, tables: Iterator[pa.Table]) -> None:
        """Add rows to the lists of their slots."""
        seen: set[int] = set()
        for rows in tables:
            slots = rows[_AT].to_numpy() // 1000 // self._slot_ms
            for slot in np.unique(slots).tolist():
                seen.add(slot)
                self._lists[slot % RING].appendValue((slot, _packed(rows.filter(pa.array(slots == slot)))))
        known = self._slots.get()
        before = set(known[0]) if known else set()
        if seen - before:
            self._slots.update((sorted(seen | before),))
            for slot in sorted(seen - before):
                self._handle.registerTimer((slot + 1) * self._slot_ms)

    def _due(self, timerValues, expired) -> Iterator[tuple[pa.Table, np.ndarray, pd.DatetimeIndex]]:
        """The rows of all slots that are over, each task's in order, with their names and the ends of their slots.

        The first timer of a batch gives out whatever the watermark has passed, so that names are read and written once.
        """
        now = expired.getExpiryTimeInMs()
        mark = now if timerValues is None else timerValues.getCurrentWatermarkInMs()
        known = self._slots.get()
        slots = list(known[0]) if known else []
        due = [s for s in slots if (s + 1) * self._slot_ms <= now or (s + 1) * self._slot_ms < mark]
        if not due and self._remember_ms is None:
            return
        packed = self._names.get()
        before = pickle.loads(packed[0]) if packed else {}
        names = dict(before)
        rows: list[pa.Table] = []
        for slot in due:
            rows += self._take(slot)
            if slot == due[-1] or sum(r.num_rows for r in rows) >= _AT_A_TIME:
                yield self._give(pa.concat_tables(rows), names)
                rows = []
        left = [s for s in slots if s not in due]
        if due:
            self._slots.update((left,)) if left else self._slots.clear()
            now = max(now, (due[-1] + 1) * self._slot_ms)
            if self._remember_ms is not None and names:
                # By then all names that these slots gave are over.
                self._handle.registerTimer((due[-1] + 1) * self._slot_ms + self._remember_ms)
        # Rows that wait may be older than the timer.
        over = min([now, *[s * self._slot_ms for s in left]])
        names = {task: name for task, name in names.items() if name[1] is None or name[1] > over}
        if names and names != before:
            self._names.update((pickle.dumps(names, pickle.HIGHEST_PROTOCOL),))
        elif before and not names:
            self._names.clear()

    def _take(self, slot: int) -> list[pa.Table]:
        ring = self._lists[slot % RING]
        due, other = [], []
        for of, packed in ring.get():
            if of == slot:
                due.append(pa.ipc.open_stream(packed).read_all())
            else:
                other.append((of, packed))
        if other:
            ring.put(other)
        else:
            ring.clear()
        return due

    def _give(self, rows: pa.Table, names: dict[str, tuple]) -> tuple[pa.Table, np.ndarray, pd.DatetimeIndex]:
        keys = {"task": pc.fill_null(rows["uuid"], ""), "at": rows[_AT]}
        for i, c in enumerate(self._order):
            kind = self._order_types.get(c)
            keys[f"o{i}"] = rows[c] if kind is None else rows[c].cast(to_arrow_type(kind))
        place = pc.sort_indices(pa.table(keys), sort_keys=[(k, "ascending") for k in keys], null_placement="at_start")
        rows = rows.take(place).combine_chunks()
        at = rows[_AT].to_numpy()
        ends = (at // 1000 // self._slot_ms + 1) * self._slot_ms * 1000 + 1000
        return rows, self._name(rows, keys["task"].take(place), at // 1000, ends, names), pd.DatetimeIndex(ends.view("datetime64[us]"), tz="UTC")

    def _name(self, rows: pa.Table, task: pa.ChunkedArray, at_ms: np.ndarray, slots: np.ndarray, names: dict[str, tuple]) -> np.ndarray:
        """The carried name of each row; ``names`` is what is remembered of each task, before and after these rows."""
        n = len(at_ms)
        here = np.arange(n)
        first = np.concatenate([[True], _changes(task)])
        begin = np.maximum.accumulate(np.where(first, here, 0))
        event = rows["event_id"]
        # A copy of an event in its slot is named like it and changes nothing.
        opens = first | np.concatenate([[True], slots[1:] != slots[:-1]])
        copy = np.where(opens, _flags(pc.is_null(event)), ~np.concatenate([[True], _changes(event)]))
        own = _flags(pc.not_equal(rows["name"], ""))
        ends = _flags(pc.is_in(rows["kind"], pa.array(K.TERMINAL_KINDS, pa.string()))) & ~copy
        starts = _flags(pc.equal(rows["kind"], "started")) & own & _flags(pc.not_equal(task, "")) & ~copy & ~ends
        # The last row of the same task, up to each one and before it, that gave or took the task's name.
        upto = np.maximum.accumulate(np.where(starts | ends, here, -1))
        last = np.concatenate([[-1], upto[:-1]])
        own_names = rows["name"].to_numpy()
        tasks = task.filter(pa.array(first)).to_pylist()
        known = [names.pop(t, None) for t in tasks]
        number = np.cumsum(first) - 1
        given = np.empty(n, object)
        set_here = last >= begin
        of_row = ~own & set_here & starts[last]
        of_known = ~own & ~set_here & np.array([k is not None for k in known])[number]
        if self._remember_ms is not None:
            of_row &= at_ms[last] + self._remember_ms > at_ms
            until = np.array([at_ms[0] if k is None or k[1] is None else k[1] for k in known])
            forever = np.array([k is not None and k[1] is None for k in known])
            of_known &= (until[number] > at_ms) | forever[number]
        given[own] = own_names[own]
        given[of_row] = own_names[last[of_row]]
        remembered = np.empty(len(known), object)
        remembered[:] = [k and k[0] for k in known]
        given[of_known] = remembered[number[of_known]]
        shown = np.maximum.accumulate(np.where(copy, -1, here))
        of_copy = shown >= np.maximum.accumulate(np.where(opens, here, 0))
        given = np.where(copy, np.where(of_copy, given[shown], None), given)
        for t, k, at_end, start in zip(tasks, known, np.concatenate([np.flatnonzero(first)[1:], [n]]) - 1, np.flatnonzero(first), strict=True):
            source = upto[at_end]
            if source < start:
                if k is not None:
                    names[t] = k
            elif starts[source]:
                names[t] = (own_names[source], None if self._remember_ms is None else int(at_ms[source]) + self._remember_ms)
        return given

    def close(self) -> None: ...


class _NamesInFrames(_NamesInOrder):
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._wait(self._table(frame) for frame in rows)
        return iter(())

    def _table(self, frame: pd.DataFrame) -> pa.Table:
        # By place, as the names of columns may be lost on the way: the held ones come first.
        columns = [pa.array(frame.iloc[:, i], f.type, from_pandas=True) for i, f in enumerate(self._schema)]
        return pa.table(columns, self._schema)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for rows, names, settled in self._due(timerValues, expiredTimerInfo):
            frame = {c: rows[c].to_pandas() for c in self._columns}
            yield pd.DataFrame({**frame, "carried_name": names, SETTLED: settled})


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def _flags(values: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(values, False).to_numpy().astype(bool)


def _changes(values: pa.ChunkedArray) -> np.ndarray:
    """Where a value, from the second on, is another than the one before it; two nulls are alike."""
    codes = pc.dictionary_encode(values, null_encoding="encode").combine_chunks()
    codes = codes.indices if isinstance(codes, pa.DictionaryArray) else pa.concat_arrays([c.indices for c in codes.chunks])
    codes = codes.to_numpy()
    return codes[1:] != codes[:-1]


# Microseconds, as JSON would otherwise cut times to milliseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# Frames hold times in nanoseconds.
_FRAME_TIMES = ("1678-01-01 00:00:00 UTC", "2262-01-01 00:00:00 UTC")


def _as_text(value: Column, kind: DataType) -> Column:
    """A value as text (binary as it is), for frames, which lose whole numbers and times beside nulls; ``_from_text`` undoes it."""
    if isinstance(kind, StringType | BinaryType):
        return value
    if isinstance(kind, ArrayType | MapType | StructType):
        return F.to_json(value, {**_JSON, "ignoreNullFields": "false"})
    return (F.unix_micros(value) if isinstance(kind, TimestampType) else value).cast("string")


def _from_text(text: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType | BinaryType):
        return text
    if isinstance(kind, ArrayType | MapType | StructType):
        return F.from_json(text, kind, _JSON)
    return F.timestamp_micros(text.cast("long")) if isinstance(kind, TimestampType) else text.cast(kind)


def _milliseconds(spark, interval: str) -> int:
    return int(spark.range(1).select(F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00 UTC' + interval {interval})")).first()[0]) // 1000


def named_in_order(
    events: DataFrame,
    delay: str = "1 day",
    slot: str = "1 hour",
    remember: str | None = "30 days",
    order: tuple[str, ...] = ("event_id",),
    groups: int = GROUPS,
) -> DataFrame:
    """``carry_task_name`` for a stream in any order: adds ``carried_name``, and ``settled_at`` as the new event time.

    ``events`` has ``event_id, event_ts (an instant), uuid, kind, name`` and any other columns. Events of a task are named by
    (``event_ts``, ``order``) once the watermark, ``delay`` behind the newest event, has passed their ``slot``; ``settled_at`` is
    its end, for operators that follow. A name is forgotten ``remember`` after its start, if no end came. Copies of an
    event are named like it. An event without a task id neither gives nor takes a name. Rows of the kind ``K.CLOCK`` move the
    watermark and are not given out. For the watermark, times before 1678 and after 2261 count as the ends of these years. A row without a time cannot be placed and is left out. Tasks are dealt over ``groups``; a
    slot of one group (or as many as have 10,000 rows), and the names it remembers, are in memory when the slot is given out.
    """
    spark = events.sparkSession
    first, last = (F.lit(t).cast("timestamp") for t in _FRAME_TIMES)
    apart = F.concat(F.lit("\x00"), F.col("event_id").cast("string"))
    group = F.pmod(F.xxhash64(F.coalesce(present(F.col("uuid")), apart)), F.lit(groups))
    kinds = {f.name: f.dataType for f in events.schema if f.name != "event_ts"}
    texts = [_as_text(F.col(name), kind).alias(name) for name, kind in kinds.items()]
    timed = events.filter(F.col("event_ts").isNotNull()).select(
        *texts, F.unix_micros("event_ts").alias(_AT), F.greatest(F.least("event_ts", last), first).alias("event_ts"), group.alias("_group")
    )
    held = StructType([StructField(name, kind if isinstance(kind, BinaryType) else StringType()) for name, kind in kinds.items()]).add(_AT, "long")
    out = StructType([*held]).add("carried_name", "string").add(SETTLED, "timestamp")
    texts_of = {c: LongType() if isinstance(kinds[c], TimestampType) else kinds[c] for c in order if not isinstance(kinds[c], StringType | BinaryType)}
    remember_ms = None if remember is None else _milliseconds(spark, remember)
    named = timed.withWatermark("event_ts", delay).groupBy("_group").transformWithStateInPandas(
        _NamesInFrames(held, order, _milliseconds(spark, slot), remember_ms, texts_of),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName=SETTLED,
    )
    clock = F.col("kind") == K.CLOCK
    values = [_from_text(F.col(name), kind).alias(name) for name, kind in kinds.items()]
    return named.filter(~clock).select(*values, "carried_name", SETTLED, F.timestamp_micros(_AT).alias("event_ts"))
