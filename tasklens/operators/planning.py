"""What a retry, purge or rate-limit command would do, as tables for an operator's tool to carry out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.control import coerce_priority, eta_problem
from tasklens.functions.names import authoritative, present
from tasklens.functions.payload import number
from tasklens.operators.ordered import Running, running


def _cap(limit: Column) -> Column:
    return F.least(F.coalesce(limit, F.lit(K.BULK_RETRY_DEFAULT)), F.lit(K.BULK_RETRY_HARD_CAP))


def retry_candidates(ids: DataFrame) -> DataFrame:
    """The ids each command may retry: its first ones in order, up to its cap.

    ``ids(command_id, position, task_id, max_ids)``; ``max_ids`` is the command's own limit. The hard cap stands as a constant
    next to the rank, so Spark cuts every command to that many ids before the shuffle, however many one asks for (with the
    ``windowGroupLimitThreshold`` of ``build_session``; Spark's own stops at 1,000).
    """
    first = W.partitionBy("command_id").orderBy("position")
    ranked = ids.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= K.BULK_RETRY_HARD_CAP)
    return ranked.filter(F.col("rank") <= _cap(F.col("max_ids"))).withColumn("rank", F.col("rank").cast("long"))


def retry_requests(commands: DataFrame, ids: DataFrame) -> DataFrame:
    """Per command: how many ids it asks for, whether the cap cut them, and whether it is refused for having none."""
    totals = ids.groupBy(F.col("command_id").alias("_command")).agg(F.count("*").alias("_total"))
    cap, total = _cap(F.col("max_ids")), F.coalesce("_total", F.lit(0))
    return commands.join(totals, F.col("command_id") == F.col("_command"), "left").select(
        "command_id",
        F.when(total == 0, "refused").otherwise("accepted").alias("status"),
        F.least(total, cap).alias("requested"),
        (total > cap).alias("capped"),
    )


def retry_name(supplied: Column, stored: Column, info_name: Column, info_task: Column) -> Column:
    """The supplied name unless it is a placeholder, else the stored one; NULL if neither can be trusted."""
    info = F.coalesce(present(info_name), info_task)
    return F.coalesce(authoritative(supplied), authoritative(F.coalesce(present(stored), info)))


def retry_plan(
    requests: DataFrame, backend: DataFrame, now: Column, transport: Column | None = None
) -> DataFrame:
    """Per request: whether it can be retried, with what, and if not the first check it fails.

    ``requests(task_id, supplied_name, override_args, override_kwargs, eta, priority_label)`` meets ``backend``
    (one row per ``task_id``) in one join. A priority is a label or a whole number; a bad one refuses
    nothing, it is left out.
    """
    fields = ("name", "args", "kwargs", "info_name", "info_task")
    stored = backend.select(
        F.col("task_id").alias("_task"),
        *[
            (F.col(c) if c in backend.columns else F.lit(None).cast("string")).alias(f"_{c}")
            for c in fields
        ],
    )
    name = retry_name(F.col("supplied_name"), F.col("_name"), F.col("_info_name"), F.col("_info_task"))
    args = F.coalesce("override_args", "_args")
    kwargs = F.coalesce("override_kwargs", "_kwargs")
    reason = F.coalesce(
        F.concat(F.lit("eta "), eta_problem(F.col("eta"), F.col("_at"), now)),
        F.when(F.col("_resolved").isNull(), "name unresolved").when(
            args.isNull() | kwargs.isNull(), "inputs unresolved"
        ),
    )
    priority = coerce_priority(F.col("priority_label"), transport if transport is not None else F.lit("amqp"))
    joined = requests.join(stored, F.col("task_id") == F.col("_task"), "left")
    decided = joined.withColumns({"_resolved": name, "_at": number(F.col("eta"))}).withColumn("_reason", reason)
    accepted = F.col("_reason").isNull()
    return decided.select(
        *[c for c in ("command_id", "position") if c in requests.columns],
        "task_id",
        F.when(accepted, "accepted").otherwise("refused").alias("status"),
        F.col("_reason").alias("reason"),
        F.when(accepted, F.col("_resolved")).alias("name"),
        F.when(accepted, args).alias("args"),
        F.when(accepted, kwargs).alias("kwargs"),
        F.when(accepted, F.col("eta")).alias("eta"),
        F.when(accepted, priority).alias("priority"),
    )


def _breaker_levels() -> list[list[Running]]:
    """The breaker's streak is the running count of doubts less its value at the last success."""
    doubtful, success = F.col("outcome") == "indeterminate", F.col("outcome") == "success"
    streak = F.col("_doubts") - F.coalesce("_at_success", F.lit(0))
    trips = doubtful & (streak >= K.CIRCUIT_BREAK_AFTER)
    return [
        [Running("_doubts", F.when(doubtful, 1).otherwise(0), "sum")],
        [Running("_at_success", F.when(success, F.col("_doubts")), "last")],
        [
            Running("_trips", F.when(trips, 1).otherwise(0), "sum"),
            Running("_tripped", F.when(trips, 1).otherwise(0), "sum", inclusive=False),
        ],
    ]


def circuit_break(
    log: DataFrame, order: tuple[str, ...] = ("event_ts", "event_id"), key_row_budget: int | None = None
) -> DataFrame:
    """Add ``final_outcome``: the outcome of each command of a batch, ``skipped`` once the breaker has opened.

    The breaker opens at the third indeterminate outcome without a success in between; a plain failure neither
    counts nor resets. All running values have the same keys, so they share one shuffle.
    """
    out = running(log, ["batch_id"], order, _breaker_levels(), key_row_budget)
    final = F.when(F.col("_tripped") > 0, "skipped").otherwise(F.col("outcome"))
    return out.withColumn("final_outcome", final).drop("_doubts", "_at_success", "_trips", "_tripped")


def retry_summary(
    log: DataFrame,
    cap: int = K.BULK_RETRY_DEFAULT,
    order: tuple[str, ...] = ("event_ts", "event_id"),
    key_row_budget: int | None = None,
) -> DataFrame:
    """Per batch: requested, succeeded, failed, skipped, and whether it was capped or its breaker opened.

    Whether the breaker is open depends on earlier rows only, so it is worked out before the cap is applied. An id
    that appears twice in a batch counts once among the succeeded and once among the failed.
    """
    limit = min(cap, K.BULK_RETRY_HARD_CAP)
    levels = _breaker_levels()
    levels[0].append(Running("_rank", F.lit(1), "sum"))
    rows = running(log, ["batch_id"], order, levels, key_row_budget)
    taken, tried = F.col("_rank") <= limit, F.col("_tripped") == 0
    per_id = rows.groupBy("batch_id", "task_id").agg(
        F.count_if(taken).alias("_requested"),
        F.count_if(~taken).alias("_cut"),
        F.count_if(taken & ~tried).alias("_skipped"),
        F.max((taken & tried & (F.col("outcome") == "success")).cast("int")).alias("_ok"),
        F.max((taken & tried & (F.col("outcome") != "success")).cast("int")).alias("_bad"),
        F.max(taken & (F.col("_trips") > 0)).alias("_broken"),
    )
    return per_id.groupBy("batch_id").agg(
        F.sum("_requested").alias("requested"),
        F.sum("_ok").alias("succeeded"),
        F.sum("_bad").alias("failed"),
        F.sum("_skipped").alias("skipped"),
        F.max("_broken").alias("circuit_broken"),
        (F.sum("_cut") > 0).alias("capped"),
    )


def purge_decision(requests: DataFrame, depths: DataFrame, threshold: int = K.PURGE_THRESHOLD) -> DataFrame:
    """Whether each purge request may proceed, and the first guard that stops it.

    ``requests(request_id, queue, force, confirm_token, expected_token)``, ``depths(queue, depth)``.
    """
    known = depths.select(F.col("queue").alias("_queue"), F.col("depth").alias("depth_before"))
    depth, limit = F.col("depth_before"), max(1, threshold)
    reason = (
        F.when(F.coalesce("force", F.lit(False)), F.lit(None).cast("string"))
        .when(F.col("confirm_token").isNull(), "no confirm token")
        .when(depth.isNull(), "depth unknown")
        .when(depth > limit, "depth over threshold")
        .when(~F.col("confirm_token").eqNullSafe(F.col("expected_token")), "confirm token mismatch")
    )
    return requests.join(known, F.col("queue") == F.col("_queue"), "left").select(
        "request_id",
        "queue",
        "depth_before",
        reason.isNull().alias("allowed"),
        reason.alias("reason"),
        (reason.isNull() & F.coalesce("force", F.lit(False))).alias("audit"),
    )


def _purged_queues(decisions: DataFrame) -> DataFrame:
    return decisions.filter("allowed").select(F.col("queue").alias("_purged")).distinct()


def purge_effect(pending: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per queue that is purged: the messages that go. Counts are taken per queue before anything is joined."""
    counts = pending.groupBy(F.col("queue").alias("_queue")).agg(F.count("*").alias("_count"))
    allowed = decisions.filter("allowed").groupBy("queue").agg(F.max("depth_before").alias("depth_before"))
    return allowed.join(counts, F.col("queue") == F.col("_queue"), "left").select(
        "queue", "depth_before", F.coalesce("_count", F.lit(0)).alias("purged")
    )


def surviving_messages(pending: DataFrame, decisions: DataFrame) -> DataFrame:
    """The messages that stay: those of every queue that is not purged."""
    return pending.join(_purged_queues(decisions), F.col("queue") == F.col("_purged"), "left_anti")


def outcome_class(status: Column, indeterminate: Column) -> Column:
    """A command's result; a timed-out call may have taken effect, so it is neither a success nor a failure."""
    return F.when(F.coalesce(indeterminate, F.lit(False)), "indeterminate").otherwise(status)


def command_outcomes(log: DataFrame) -> DataFrame:
    """Commands per action and outcome, from ``log(action, status, indeterminate)``."""
    outcome = outcome_class(F.col("status"), F.col("indeterminate"))
    return log.groupBy("action", outcome.alias("outcome")).agg(F.count("*").alias("n"))
