"""Broker, pool, priority and command-parameter rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.names import present


def lookup(key: Column, table: dict) -> Column:
    """The value of a fixed table at ``key``; NULL for a key it does not hold."""
    return F.try_element_at(F.expr(f"map({', '.join(repr(x) for item in table.items() for x in item)})"), key)


def transport_kind(driver: Column) -> Column:
    """``redis`` or ``amqp`` for the drivers known as such, else the driver's own name."""
    name = present(F.lower(F.trim(driver)))
    return (
        F.when(name.contains("redis"), "redis").when(name.isin(*K.AMQP_DRIVERS), "amqp").otherwise(name)
    )


def priority_of_label(label: Column, transport: Column) -> Column:
    """The number a transport uses for a named priority; transports other than redis rank as amqp does."""
    key = F.lower(F.trim(label))
    return F.when(transport.eqNullSafe("redis"), lookup(key, K.REDIS_PRIORITIES)).otherwise(
        lookup(key, K.AMQP_PRIORITIES)
    )


def priority_of_number(value: Column) -> Column:
    return F.when(value.between(0, 255), value).cast("int")


def coerce_priority(raw: Column, transport: Column) -> Column:
    """The number of a priority that is written as a whole number (0 to 255) or as a label; NULL for anything else."""
    text = F.trim(raw.cast("string"))
    digits = F.when(text.rlike("^[0-9]{1,9}$"), text).cast("int")
    return F.coalesce(priority_of_number(digits), priority_of_label(text, transport))


def priority_is_guess(label: Column, transport: Column) -> Column:
    """A label on a transport whose ordering is not known."""
    return label.isNotNull() & ~F.coalesce(transport.isin("amqp", "redis"), F.lit(False))


def broker_type(url: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    return (
        F.when(low.contains("redis"), "redis")
        .when(low.contains("amqp") | low.contains("rabbit"), "amqp")
        .when(low.contains("sqs"), "sqs")
        .otherwise("unknown")
    )


def pool_type(pool: Column) -> Column:
    low = F.lower(pool)
    return F.when(low.isNull(), K.DEFAULT_POOL).when(low.contains("solo"), "solo").otherwise(low)


def eta_problem(eta: Column, at: Column, now: Column) -> Column:
    """Why an ETA is refused; NULL if it is absent or inside the window.

    ``at`` is ``number(eta)``: the ETA in epoch seconds, best taken from a column of its own as it is used often.
    """
    return (
        F.when(eta.isNull(), F.lit(None).cast("string"))
        .when(at.isNull() | (at < K.ETA_MIN_EPOCH) | (at > K.ETA_MAX_EPOCH), "invalid")
        .when(at - now < -K.ETA_MAX_PAST_SECONDS, "too far past")
        .when(at - now > K.ETA_MAX_FUTURE_SECONDS, "too far future")
    )


def rate_problem(task_name: Column, rate: Column) -> Column:
    """Why a rate limit is refused; NULL if it is well formed. A trailing line break is tolerated."""
    text = F.regexp_replace(F.coalesce(rate, F.lit("")), r"\n\z", "")
    return F.when(F.coalesce(task_name, F.lit("")) == "", "task name required").when(
        ~text.rlike("(?U)" + K.RATE_PATTERN.replace("$", r"\z")), "invalid rate"
    )


def clears_rate(rate: Column) -> Column:
    return rate == "0"


def canonical_state(state: Column) -> Column:
    return F.coalesce(lookup(state, K.CANONICAL_STATES), F.lit(K.UNKNOWN_STATE))
