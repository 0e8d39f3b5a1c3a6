"""From arriving envelopes to stored canonical events, as one streaming query.

Envelopes are opened and cut before their first poisoned element inside the row. Names are given in the order of the events
(first stateful operator), copies that were delivered again are dropped (second one, on the first one's event time), metadata
joins by name, and the canonical events go to a folder by date and kind. The file sink writes a batch once, however
often it is tried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tasklens import constants as K
from tasklens.functions.control import lookup
from tasklens.operators.canonical import broker_events
from tasklens.operators.envelope import explode_envelopes, local_host, mappable
from tasklens.operators.naming import join_task_meta, with_task_name
from tasklens.schemas import TIMED_EVENT
from tasklens.streaming.ordered import SETTLED, named_in_order
from tasklens.streaming.runs import ROCKSDB, append_events, settings


def arriving_events(envelopes: DataFrame, host: str | None = None) -> DataFrame:
    """The routed, mappable events of ``envelopes`` (``message_id, ingest_ts, body``), as instants, with the clock rows.

    An event's time is its producer's ``timestamp``; one without is placed where it arrived. Its id is its envelope and place.
    """
    rows = explode_envelopes(envelopes, intact=True, fields=TIMED_EVENT).drop("poison")
    at = F.timestamp_micros(F.round(F.col("timestamp") * 1_000_000).cast("long"))
    rows = rows.withColumns({"event_ts": F.coalesce(at, F.col("ingest_ts").cast("timestamp")), "event_id": F.concat_ws(".", "message_id", "pos")})
    # One filter for events and clock rows, as two would read the stream twice.
    clock = F.col("type") == K.CLOCK_TYPE
    rows = rows.withColumn("kind", F.when(clock, K.CLOCK).otherwise(lookup(F.col("type"), K.BROKER_KINDS)))
    wanted = F.col("kind").isNotNull() & mappable()
    own = local_host(host)
    if own is not None:
        wanted = wanted & (clock | (F.col("hostname") == own))
    return rows.filter(wanted).drop("timestamp")


def lifecycle(
    envelopes: DataFrame,
    meta: DataFrame | None = None,
    delay: str = "1 day",
    slot: str = "1 hour",
    remember: str | None = "30 days",
    host: str | None = None,
) -> DataFrame:
    """Canonical events of a stream of envelopes: each once, named in order, with metadata where ``meta`` is given."""
    named = named_in_order(arriving_events(envelopes, host), delay, slot, remember, order=("message_id", "pos"))
    once = named.dropDuplicatesWithinWatermark(["event_id"]).drop(SETTLED)
    rows = with_task_name(once.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")))
    return broker_events(rows if meta is None else join_task_meta(rows, meta))


def start_lifecycle(envelopes: DataFrame, path: str, checkpoint: str, meta: DataFrame | None = None, **options: str | None) -> StreamingQuery:
    """Start the query that appends canonical events under ``path``; it ends when all input at hand is read."""
    with settings(envelopes.sparkSession, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
        return append_events(lifecycle(envelopes, meta, **options), path, checkpoint)
