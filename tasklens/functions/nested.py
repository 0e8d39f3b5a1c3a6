"""Redaction of nested payloads: a walk over their tree by key, not a pattern over their text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.text import Rule, scrub_text

# Levels that are walked. What lies deeper is hidden as a whole, as its keys are not looked at.
DEPTH = 6


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _walked(node: Column, sensitive: Sequence[str], rules: Sequence[Rule], depth: int) -> Column:
    """The JSON text of a variant, its sensitive values hidden whatever they are."""
    hidden = F.lit(f'"{K.REDACTED}"')
    text = F.try_variant_get(node, "$", "string")
    leaf = F.when(F.schema_of_variant(node) == "STRING", _quoted(scrub_text(text, rules))).otherwise(F.to_json(node))
    pairs, items = F.try_variant_get(node, "$", "map<string,variant>"), F.try_variant_get(node, "$", "array<variant>")
    if depth == 0:
        return F.when(pairs.isNotNull() | items.isNotNull(), hidden).otherwise(leaf)
    # Lists are walked like maps without keys, so that the expression grows by the level and does not double.
    unnamed = F.transform(items, lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("value")))
    members = F.coalesce(F.map_entries(pairs), unnamed)

    def shown(e: Column) -> Column:
        listed = F.coalesce(F.lower(e["key"]).isin(*sensitive), F.lit(False))
        below = F.when(listed, hidden).otherwise(_walked(e["value"], sensitive, rules, depth - 1))
        name = F.when(e["key"].isNotNull(), F.concat(_quoted(e["key"]), F.lit(":"))).otherwise("")
        return F.concat(name, F.coalesce(below, F.lit("null")))

    inner = F.array_join(F.transform(members, shown), ",")
    is_map = pairs.isNotNull()
    walked = F.concat(F.when(is_map, "{").otherwise("["), inner, F.when(is_map, "}").otherwise("]"))
    return F.coalesce(walked, leaf)


def scrub_nested(
    text: Column, sensitive: Sequence[str] = K.SENSITIVE_KEYS, rules: Sequence[Rule] = K.TEXT_RULES, depth: int = DEPTH
) -> Column:
    """``text`` with its secrets hidden: JSON maps and lists by their keys at any of ``depth`` levels, other texts by the rules.

    The value of a sensitive key is hidden whole, be it a text with blanks and commas, a number, a list or a map; texts inside are
    scrubbed by the rules as well. Maps come out with their keys in order. NULL stays NULL.
    """
    container = F.ltrim(text).startswith("{") | F.ltrim(text).startswith("[")
    node = F.try_parse_json(F.when(container, text))
    return F.when(node.isNotNull(), _walked(node, sensitive, rules, depth)).otherwise(scrub_text(text, rules))
