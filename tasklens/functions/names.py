"""Task names and their placeholders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasklens import constants as K


def present(text: Column) -> Column:
    """``text``, or NULL where it is empty."""
    return F.nullif(text, F.lit(""))


def placeholder_name(
    name: Column, task_id: Column, queue: Column | None = None, hint: Column | None = None
) -> Column:
    """The name, else the trimmed hint, else a tag made of what is known of the task."""
    short = present(F.substring(task_id, 1, K.SHORT_ID_CHARS))
    known = present(queue) if queue is not None else F.lit(None).cast("string")
    # concat is NULL if any part is, so the first complete tag wins.
    tags = [
        F.concat(F.lit("<unknown:"), known, F.lit(":"), short, F.lit(">")),
        F.concat(F.lit("<unknown:"), known, F.lit(">")),
        F.concat(F.lit("<unknown:"), short, F.lit(">")),
        F.lit("<unknown>"),
    ]
    hints = [present(F.trim(hint))] if hint is not None else []
    return F.coalesce(present(name), *hints, *tags)


def is_placeholder(name: Column) -> Column:
    """True for names that say nothing: missing, empty, ``unknown`` or a placeholder tag."""
    return F.coalesce(name.isin("", "unknown") | name.startswith("<unknown"), F.lit(True))


def authoritative(name: Column) -> Column:
    """``name``, or NULL where it is a placeholder."""
    return F.when(~is_placeholder(name), name)
