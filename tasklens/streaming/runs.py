"""Structured Streaming forms of the operators.

Every run has its own checkpoint under the shared folder, and sinks that can be written twice without harm: file
sinks, or one folder per batch that a repeated batch replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from tasklens import constants as K
from tasklens.functions.names import present
from tasklens.operators.canonical import broker_events
from tasklens.operators.envelope import explode_envelopes, intact_envelopes, mappable, route_event_types
from tasklens.operators.naming import with_task_name
from tasklens.operators.registry import registry_diff
from tasklens.schemas import TABLES
from tasklens.session import new_folder
from tasklens.sources.views import VIEWS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as a query starts; a query keeps the ones it started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stateful(spark: SparkSession) -> dict[str, str]:
    """Settings for a query with state: RocksDB, and a state partition per core, as a query keeps its partitions for life.

    A batch stores what it changed, not the whole state. Rows of state are not counted, which would look each one up before
    it is written, and a join keeps both sides of a partition in one store, not in four.
    """
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.streaming.join.stateFormatVersion": "3",
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
    }


def stream_table(spark: SparkSession, folder: str, name: str, **options: object) -> DataFrame:
    """A table of ``folder`` as a stream of its files."""
    reader = spark.readStream.schema(TABLES[name]).option("pathGlobFilter", f"{name}.parquet")
    return reader.options(**{k: str(v) for k, v in options.items()}).parquet(folder)


def stream_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over ``events`` as a stream."""
    return spark.sql(VIEWS[name], events=stream_table(spark, folder, "events"))


def append_all(stream: DataFrame, purpose: str) -> DataFrame:
    """Everything available of ``stream``, appended to a folder of Parquet files and read back."""
    spark = stream.sparkSession
    folder = new_folder(spark, purpose)
    run = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/data")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")


def append_events(stream: DataFrame, path: str, checkpoint: str):
    """Start a query that appends canonical events to ``path`` by date and kind, the layout of ``write_events``."""
    dated = stream.withColumn("event_date", F.to_date("event_ts"))
    return (
        dated.writeStream.format("parquet")
        .partitionBy("event_date", "kind")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def each_batch(
    stream: DataFrame, purpose: str, shape: Callable[[DataFrame], DataFrame], mode: str = "append"
) -> DataFrame:
    """Everything available of ``stream``, each batch shaped and written to its own folder, read back as one table.

    A batch that runs again replaces its folder. The table has a ``batch_id``.
    """
    spark = stream.sparkSession
    folder = new_folder(spark, purpose)

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{folder}/data/batch_id={batch_id}")

    run = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/data")


# --- Stateless ------------------------------------------------------------------


def normalised(envelopes: DataFrame) -> DataFrame:
    """Envelopes (``message_id, event_ts, body``) to canonical events, as they arrive; nothing is kept between them."""
    rows = route_event_types(explode_envelopes(envelopes, intact=True).drop("poison"))
    rows = rows.filter(mappable())
    rows = rows.withColumns(
        {"event_id": F.concat_ws(".", "message_id", "pos"), "carried_name": present(F.col("name"))}
    )
    return broker_events(with_task_name(rows))


# --- Stateful -------------------------------------------------------------------


class _RememberName(StatefulProcessor):
    """Per task: the name its last named start gave it, until the task ends."""

    def __init__(self, ttl_ms: int | None, columns: list[str]) -> None:
        self._ttl_ms, self._columns = ttl_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._name = handle.getValueState("name", "name string", self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self._name.get()
        before = memory = known[0] if known else None
        renewed = False
        # A task has few events in a batch, too few to gain from a frame per task.
        for row in sorted(rows, key=lambda r: (r.event_ts, r.event_id)):
            yield Row(**{c: row[c] for c in self._columns}, carried_name=row.name or memory)
            if row.kind in K.TERMINAL_KINDS:
                memory = None
            elif row.kind == "started" and row.name and row.uuid:
                memory, renewed = row.name, True
        # A start that repeats the name renews how long it is remembered.
        if memory and renewed:
            self._name.update((memory,))
        elif before and not memory:
            self._name.clear()

    def close(self) -> None: ...


def carry_names(events: DataFrame, ttl_hours: float | None = 24 * 7) -> DataFrame:
    """``carry_task_name`` for a stream: the remembered names are state, and expire instead of being evicted.

    A group is one task's rows of one batch, so its size is bounded by the source's batch limits
    (``maxFilesPerTrigger``, ``maxBytesPerTrigger``). A row without a task id remembers nothing and is a group by itself.
    """
    apart = F.concat(F.lit("\x00"), F.col("event_id").cast("string"))
    keyed = events.withColumn("_key", F.coalesce(present(F.col("uuid")), apart))
    out = StructType.fromJson(events.schema.jsonValue()).add("carried_name", "string")
    return keyed.groupBy("_key").transformWithState(
        _RememberName(None if ttl_hours is None else int(ttl_hours * 3_600_000), events.columns),
        outputStructType=out,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_hours is not None else "None",
    )


def carried(events: DataFrame, ttl_hours: float | None = 24 * 7) -> DataFrame:
    values = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # Expiring state asks for a next batch for ever, which a run that is to end must not grant.
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    with settings(events.sparkSession, values):
        return append_all(carry_names(events, ttl_hours), "carried")


def deduped(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per event id among events that arrive within ``delay`` of each other."""
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(events: DataFrame, by: tuple[str, ...], size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events per tumbling (or sliding) window and ``by``; partial counts are combined before the shuffle."""
    window = F.window("event_ts", size, slide) if slide else F.window("event_ts", size)
    counts = events.withWatermark("event_ts", delay).groupBy(window, *by).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), *by, "n")


def session_counts(events: DataFrame, by: tuple[str, ...], gap: str, delay: str = "1 hour") -> DataFrame:
    """Events per session: a run of events of one ``by`` with no pause of ``gap``."""
    session = F.session_window("event_ts", gap)
    counts = events.withWatermark("event_ts", delay).groupBy(session, *by).agg(F.count("*").alias("n"))
    return counts.select(
        F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *by, "n"
    )


def latest_of(updates: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The newest row per key of a table written by ``each_batch``."""
    kept = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*kept), "batch_id").alias("_row")
    return updates.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def sessions(events: DataFrame, by: tuple[str, ...], gap: str, delay: str = "1 hour") -> DataFrame:
    """Closed sessions. Rows of one session are merged before the shuffle, so a busy key sends few rows."""
    merge = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    with settings(events.sparkSession, merge):
        return append_all(session_counts(events, by, gap, delay), "sessions")


def window_totals(events: DataFrame, by: tuple[str, ...], size: str, slide: str | None = None) -> DataFrame:
    """Window counts so far, open windows included: every batch appends the counts it changed."""
    counts = windowed_counts(events, by, size, slide)
    updates = each_batch(counts, "windows", lambda batch: batch, mode="update")
    return latest_of(updates, ("window_start", *by))


# --- Kept tables ----------------------------------------------------------------


def _partial_state(events: DataFrame) -> DataFrame:
    place = F.struct("event_ts", "event_id")
    return events.groupBy("task_id").agg(
        F.max(F.struct(place.alias("place"), "kind")).alias("latest"),
        F.min("event_ts").alias("first_ts"),
        F.count("*").alias("n_events"),
    )


def merged_states(partials: DataFrame) -> DataFrame:
    """The latest state per task out of partial states, in any number and order."""
    return partials.groupBy("task_id").agg(
        F.max("latest").alias("latest"), F.min("first_ts").alias("first_ts"), F.sum("n_events").alias("n_events")
    )


def latest_state(events: DataFrame) -> DataFrame:
    """The latest kind per task, kept up to date by a stream.

    Each batch is folded to one partial state per task it touches and appended. Partial states merge in any order,
    so there is no state store to grow, late events need no watermark, and a reader folds the table once more.
    ``merged_states`` also compacts it.
    """
    table = each_batch(events, "states", _partial_state)
    return merged_states(table.drop("batch_id")).select(
        "task_id", "latest.kind", "first_ts", F.col("latest.place.event_ts").alias("last_ts"), "n_events"
    )


class LossListener(StreamingQueryListener):
    """Gathers the figures that a query observes under one name, batch by batch, from its progress."""

    def __init__(self, name: str) -> None:
        self.name, self.rows, self.ended = name, {}, Event()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        figures = event.progress.observedMetrics.get(self.name)
        if figures is not None:
            # A batch that runs again reports again.
            self.rows[event.progress.batchId] = figures.asDict()

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


LOSSES = ("envelopes", "poisoned", "lost", "unrouted")


def loss_metrics(envelopes: DataFrame, path: str) -> DataFrame:
    """Store the routed events of a stream of envelopes under ``path``; one row per batch of what was lost on the way.

    ``poisoned`` counts envelopes with an element that is no event, ``lost`` the elements that go with it, and ``unrouted`` the
    events of other types. The figures are observed where the rows pass and come with the query's progress, so counting
    them takes no pass of its own. Nothing poisoned is stored.
    """
    spark = envelopes.sparkSession
    name = f"loss_{uuid.uuid4().hex}"
    opened = intact_envelopes(envelopes)
    unrouted = F.size(F.filter("elements", lambda e: ~F.coalesce(e["type"].isin(*K.BROKER_KINDS), F.lit(False))))
    watched = opened.observe(
        name,
        F.count("*").alias("envelopes"),
        F.count_if(F.col("n_lost") > 0).alias("poisoned"),
        F.coalesce(F.sum("n_lost"), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(unrouted), F.lit(0)).alias("unrouted"),
    )
    rows = watched.select("*", F.posexplode("elements").alias("pos", "event")).drop("elements", "n_lost").select("*", "event.*").drop("event")
    listener = LossListener(name)
    spark.streams.addListener(listener)
    try:
        run = (
            route_event_types(rows).writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", new_folder(spark, "loss"))
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
        # Progress is told by another thread.
        listener.ended.wait(60)
    finally:
        spark.streams.removeListener(listener)
    rows = [(batch, *[int(figures[c]) for c in LOSSES]) for batch, figures in sorted(listener.rows.items())]
    return spark.createDataFrame(rows, "batch_id long, " + ", ".join(f"{c} long" for c in LOSSES))


MANIFEST = "snapshot_id bigint, path string, previous_path string"


def registry_changes(manifests: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """A change feed out of a stream of registry snapshots.

    The stream carries one ``MANIFEST`` row per snapshot, not the snapshot: a batch holds a few paths, and each
    snapshot is read and compared with the one before it in parallel.
    """
    spark = manifests.sparkSession
    folder = new_folder(spark, "registry")
    columns = "name string, " + ", ".join(f"{f} string" for f in fields)

    def compare(batch: DataFrame, _batch_id: int) -> None:
        for row in batch.orderBy("snapshot_id").toLocalIterator():
            new = spark.read.schema(columns).parquet(row.path)
            old = spark.read.schema(columns).parquet(row.previous_path) if row.previous_path else new.limit(0)
            changes = registry_diff(old, new, fields)
            changes.write.mode("overwrite").parquet(f"{folder}/changes/snapshot_id={row.snapshot_id}")

    run = (
        manifests.writeStream.foreachBatch(compare)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/changes")
