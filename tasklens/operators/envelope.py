"""From envelopes and raw rows to the lifecycle events worth mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tasklens import constants as K
from tasklens.functions.control import lookup
from tasklens.functions.names import present
from tasklens.functions.payload import number, runtime_ms
from tasklens.schemas import ENVELOPE_EVENT


def _elements(df: DataFrame, body: str) -> DataFrame:
    """Add ``_all``: a body's elements, NULL for those that are no object. A body is one event or a list of events.

    A body that cannot be read to its end is one element that is no object. So is an empty or missing one.
    """
    # One parse; the type of an element tells an object from a text that looks like one.
    whole = F.col("_whole")
    listed = F.try_variant_get(whole, "$", "array<variant>")
    return (
        df.withColumn("_whole", F.try_parse_json(F.col(body)))
        .withColumn("_listed", F.coalesce(listed, F.array(whole)))
        .withColumn("_all", F.transform("_listed", lambda e: F.when(_is_object(e), e)))
        .drop("_whole", "_listed")
    )


def _is_object(element: Column) -> Column:
    return F.coalesce(F.to_json(element).startswith("{"), F.lit(False))


def _intact(df: DataFrame, body: str) -> DataFrame:
    """Add ``_elements`` cut before the first that is no event, and ``_total``, how many there were."""
    first_bad = F.array_position(F.transform("_all", lambda e: e.isNull()), True)
    cut = F.slice("_all", F.lit(1), (F.col("_bad") - 1).cast("int"))
    return (
        _elements(df, body)
        .withColumn("_bad", first_bad)
        .withColumns({"_elements": F.when(F.col("_bad") > 0, cut).otherwise(F.col("_all")), "_total": F.size("_all")})
        .drop("_all", "_bad")
    )


def _event(element: Column, fields: str) -> Column:
    """An element's fields, each by itself: one of another type than it should have is NULL."""
    return F.struct(
        *[F.try_variant_get(element, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in StructType.fromDDL(fields)]
    )


def explode_envelopes(df: DataFrame, body: str = "body", intact: bool = False, fields: str = ENVELOPE_EVENT) -> DataFrame:
    """One row per envelope element: its ``pos``, its ``fields``, and ``poison`` where it is not an object.

    Parsing happens inside the row, so nothing is shuffled. ``intact`` cuts each envelope before its first poisoned
    element: the stateless form of ``quarantine_poison`` for envelopes that are still whole, fit for streams.
    """
    rows = _intact(df, body).drop("_total") if intact else _elements(df, body).withColumnRenamed("_all", "_elements")
    kept = [c for c in df.columns if c != body]
    # The outer form, as Spark would guard the inner one with a size filter that parses every body once more.
    rows = rows.select(*kept, F.posexplode_outer("_elements").alias("pos", "_element")).filter("pos is not null")
    element = F.col("_element")
    parsed = rows.withColumns({"_event": _event(element, fields), "poison": element.isNull()})
    return parsed.select("*", "_event.*").drop("_event", "_element")


def intact_envelopes(df: DataFrame, body: str = "body", fields: str = ENVELOPE_EVENT) -> DataFrame:
    """Envelopes with their ``elements`` before the first that is no event, and ``n_lost``, how many go with it."""
    cut = _intact(df, body)
    elements = F.transform("_elements", lambda e: _event(e, fields))
    lost = F.col("_total") - F.size("_elements")
    return cut.withColumns({"elements": elements, "n_lost": lost}).drop(body, "_elements", "_total")


def envelope_loss(df: DataFrame, body: str = "body") -> DataFrame:
    """Per envelope, how many elements are kept and how many are lost to poison."""
    cut = _intact(df, body).withColumn("n_kept", F.size("_elements"))
    return cut.withColumn("n_lost", F.col("_total") - F.col("n_kept")).drop(body, "_elements", "_total")


def quarantine_poison(df: DataFrame, poison: str = "poison") -> DataFrame:
    """Drop, per ``message_id``, the first poisoned element and everything after it.

    The cut points are aggregated from the poisoned rows alone (combined map-side), so the events meet a small
    table that AQE broadcasts, or a skew-split join where it is not small; no message is gathered in one task.
    """
    cuts = poison_cuts(df, poison).select(F.col("message_id").alias("_message"), "first_bad")
    cut_off = (F.col("message_id") == F.col("_message")) & (F.col("pos") >= F.col("first_bad"))
    return df.join(cuts, cut_off, "left_anti")


def poison_cuts(df: DataFrame, poison: str = "poison") -> DataFrame:
    """One row per poisoned message; its count is the poison counter."""
    return df.filter(F.col(poison)).groupBy("message_id").agg(F.min("pos").alias("first_bad"))


def route_event_types(df: DataFrame) -> DataFrame:
    """Keep the event types the broker path owns and name their ``kind``."""
    return df.filter(F.col("type").isin(*K.BROKER_KINDS)).withColumn("kind", lookup(F.col("type"), K.BROKER_KINDS))


def local_host(*candidates: str | None) -> str | None:
    """The first candidate that is not blank, trimmed."""
    return next((c.strip() for c in candidates if c and c.strip()), None)


def filter_hostname(df: DataFrame, override: str | None = None, fallback: str | None = None) -> DataFrame:
    """Keep the events of one host; without a host, all events."""
    host = local_host(override, fallback)
    # Equality is never true for a missing hostname, and a host is never blank.
    return df if host is None else df.filter(F.col("hostname") == host)


def mappable() -> Column:
    """False for the rows that cannot be mapped: a succeeded event whose runtime cannot be read."""
    return (F.col("kind") != "succeeded") | F.col("runtime").isNull() | runtime_ms(F.col("runtime")).isNotNull()


def rejection() -> Column:
    """Why an event cannot be mapped; NULL for good events."""
    reason = F.when(number(F.col("runtime")).isNull(), "runtime is not a finite number").otherwise(
        "runtime is out of range"
    )
    return F.when(~mappable(), reason)


def absorb_bad_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split events into those that can be mapped and those that cannot, with a ``rejected`` reason."""
    return df.filter(mappable()), df.filter(~mappable()).withColumn("rejected", rejection())


def gate_signals(df: DataFrame) -> DataFrame:
    """Drop signals that report nothing: received without request, postrun without success, failure without exception."""
    gate = (
        F.when(F.col("signal") == "received", F.col("request").isNotNull())
        .when(F.col("signal") == "postrun", F.col("state").eqNullSafe("SUCCESS"))
        .when(F.col("signal") == "failure", F.col("exception_type").isNotNull())
        .otherwise(F.col("signal").isin(*K.SIGNAL_KINDS))
    )
    return df.filter(gate)


def signal_task_id() -> Column:
    """The task id of a signal row; an attribute that is present wins even when it is empty, except for retries."""
    of_request = F.coalesce("request.id", "request.task_id", F.lit(""))
    own = F.coalesce("task_id", F.lit(""))
    return (
        F.when(F.col("signal").isin("received", "revoked"), of_request)
        .when(
            F.col("signal") == "retry",
            F.coalesce(present(of_request), "kwargs_task_id", F.lit("")),
        )
        .otherwise(own)
    )


def request_queue() -> Column:
    return F.try_element_at("request.delivery_info", F.lit("routing_key"))


def retain_latest_n(
    df: DataFrame, n: int = K.EVENT_BUFFER_ROWS, time: str = "event_ts", order: tuple[str, ...] = ("event_ts", "event_id")
) -> DataFrame:
    """The last ``n`` rows in ``order``, what a drop-oldest buffer of that size would hold.

    An hourly histogram (one column, combined map-side) gives an hour before which no kept row can lie. The scan
    skips everything older, so the final top-n meets few rows per task however many tasks there are.
    """
    start = _hour_holding(df, n, time)
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(start).cast(df.schema[time].dataType))
    return df.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(n)


def _hour_holding(df: DataFrame, n: int, time: str) -> str | None:
    """The start of the hour in which the n-th newest row lies; None if there are fewer rows with a time."""
    hours = df.groupBy(F.to_date(time).alias("day"), F.hour(time).alias("hour")).agg(F.count("*").alias("rows"))
    # Every hour holds a row, so n hours are always enough.
    newest = hours.filter("day is not null").orderBy(F.desc("day"), F.desc("hour")).limit(n)
    seen = 0
    for day, hour, rows in newest.toLocalIterator():
        seen += rows
        if seen >= n:
            return f"{day} {hour:02d}:00:00"
    return None


def dropped_count(df: DataFrame, n: int = K.EVENT_BUFFER_ROWS) -> DataFrame:
    """How many rows ``retain_latest_n`` leaves out; saturates at 2^53 - 1."""
    lost = F.greatest(F.count("*") - n, F.lit(0))
    return df.agg(F.least(lost, F.lit(2**53 - 1)).alias("dropped"), F.least(F.count("*"), F.lit(n)).alias("kept"))
