"""Text columns: exception texts, tracebacks, signatures, redaction."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasklens import constants as K

Rule = tuple[str, str, str]


def scrub_text(text: Column, rules: Sequence[Rule] = K.TEXT_RULES) -> Column:
    """``text`` with every rule's matches replaced."""
    for name, pattern, replacement in rules:
        replaced = F.regexp_replace(text, pattern, replacement)
        hints = [F.lower(text).contains(stem) for stem in K.TEXT_STEMS.get(name, ())]
        text = F.when(reduce(or_, hints), replaced).otherwise(text) if hints else replaced
    return text


def tail(text: Column, limit: int) -> Column:
    """The last ``limit`` characters behind a marker where ``text`` is longer, else ``text``."""
    return F.when(
        F.length(text) > limit, F.concat(F.lit(K.TRACEBACK_MARKER), F.right(text, F.lit(limit)))
    ).otherwise(text)


def first_traceback(*candidates: Column) -> Column:
    """The first available candidate, most specific first."""
    return F.coalesce(*candidates)


def exception_message(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(K.DEFAULT_EXCEPTION_MESSAGE))


def exception_class(message: Column) -> Column:
    """The last segment of the dotted name that ``message`` opens with, if a call follows it."""
    # (?U) gives \w its Unicode meaning, as names may hold any letter.
    dotted = F.regexp_extract(
        F.substring(message, 1, K.EXCEPTION_SCAN_CHARS), "(?U)" + K.EXCEPTION_PATTERN, 1
    )
    return F.when(dotted == "", F.lit(K.DEFAULT_EXCEPTION)).otherwise(F.substring_index(dotted, ".", -1))


def short_signature(signature: Column) -> Column:
    keep = K.SIGNATURE_CHARS - 3
    return F.when(
        F.length(signature) > K.SIGNATURE_CHARS, F.concat(F.left(signature, F.lit(keep)), F.lit("..."))
    ).otherwise(signature)


def retry_reason(reason: Column, details: Column) -> Column:
    return F.coalesce(reason, details)
