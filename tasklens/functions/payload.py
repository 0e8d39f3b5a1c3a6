"""Arguments, keyword arguments, results and numbers of an event."""

from __future__ import annotations

import ast
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from tasklens import constants as K
from tasklens.functions.nested import scrub_nested
from tasklens.functions.text import Rule, scrub_text


def _literal(text: str):
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, TypeError, RecursionError):
        return None


def _json(value) -> str:
    def plain(v):
        if isinstance(v, dict):
            return {k if isinstance(k, str) else str(k): plain(x) for k, x in v.items()}
        if isinstance(v, (list, tuple)):
            return [plain(x) for x in v]
        return v

    return json.dumps(plain(value), default=repr, ensure_ascii=False)


def _map_distinct(texts: pd.Series, fn) -> pd.Series:
    """``fn`` once per distinct text of a batch; payloads repeat a lot."""
    codes, distinct = pd.factorize(texts)
    results = [fn(t) for t in distinct] + [None]
    return pd.Series([results[c] for c in codes], index=texts.index, dtype=object)


@F.pandas_udf(StringType())
def _parse_list(texts: pd.Series) -> pd.Series:
    def parse(text: str) -> str | None:
        value = _literal(text)
        return _json(list(value)) if isinstance(value, (list, tuple)) else None

    return _map_distinct(texts, parse)


@F.pandas_udf(MapType(StringType(), StringType()))
def _parse_map(texts: pd.Series) -> pd.Series:
    def parse(text: str) -> dict | None:
        value = _literal(text)
        if not isinstance(value, dict):
            return None
        return {
            str(k): v if v is None or isinstance(v, str) else _json(v) for k, v in value.items()
        }

    return _map_distinct(texts, parse)


def coerce_args(text: Column) -> Column:
    """Positional arguments written as a literal list or tuple, as JSON text; NULL for anything else.

    Only texts that need a literal parser travel to Python; absent and empty payloads stay in the JVM.
    """
    empty = text.isin("()", "[]")
    parsed = _parse_list(F.when(~empty & (text != ""), text))
    return F.when(empty, F.lit("[]")).otherwise(parsed)


def coerce_kwargs(text: Column) -> Column:
    """Keyword arguments written as a literal dict; NULL for anything else, and ``{}`` stays ``{}``.

    Values that are not text are kept as JSON text.
    """
    empty = text == "{}"
    parsed = _parse_map(F.when(~empty & (text != ""), text))
    return F.when(empty, F.create_map().cast("map<string,string>")).otherwise(parsed)


def scrub_kwargs(
    kwargs: Column,
    redact: Column | None = None,
    keep: Column | None = None,
    sensitive: Sequence[str] = K.SENSITIVE_KEYS,
    rules: Sequence[Rule] = K.TEXT_RULES,
) -> Column:
    """Keep-list, then the task's own redactions, then the default rules. A NULL keep-list keeps all keys.

    Values that are maps or lists, as JSON text, are searched for sensitive keys themselves.
    """
    if keep is not None:
        kwargs = F.map_filter(kwargs, lambda k, _v: keep.isNull() | F.array_contains(keep, k))

    def value(k: Column, v: Column) -> Column:
        listed = F.lower(k).isin(*sensitive)
        if redact is not None:
            listed = listed | F.coalesce(F.array_contains(redact, k), F.lit(False))
        return F.when(listed, F.lit(K.REDACTED)).otherwise(scrub_nested(v, sensitive, rules))

    return F.transform_values(kwargs, value)


def scrub_args(args: Column, keep: Column | None = None, rules: Sequence[Rule] = K.TEXT_RULES) -> Column:
    """Positional arguments have no names, so any keep-list hides them all."""
    scrubbed = scrub_text(args, rules)
    if keep is None:
        return scrubbed
    return F.when(args.isNotNull() & keep.isNotNull(), F.lit(K.REDACTED)).otherwise(scrubbed)


def scrub_result(
    result: Column, redact: Column | None = None, rules: Sequence[Rule] = K.TEXT_RULES
) -> Column:
    scrubbed = scrub_text(result, rules)
    if redact is None:
        return scrubbed
    return F.when(F.coalesce(redact, F.lit(False)), F.lit(K.REDACTED)).otherwise(scrubbed)


def number(text: Column) -> Column:
    """``text`` as a double, NULL where it is not written as a number. Refers to ``text`` once, so it stays cheap to nest."""
    return F.regexp_extract(text, K.NUMBER_PATTERN, 0).try_cast("double")


def runtime_ms(runtime: Column) -> Column:
    """Seconds as text to whole milliseconds, cut towards zero; NULL if they are no number or out of range."""
    return (number(runtime) * 1000).try_cast("bigint")


def flag(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))
