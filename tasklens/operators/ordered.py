"""Running values per key in a total order, also where one key holds a large share of all rows.

A window partitioned by a key puts every row of that key into one task. That is right for ordinary keys and
fatal for a hot one. ``running`` therefore counts the keys first, at any size of input: an aggregate that reads the key
columns alone and is combined map-side. Keys within the row budget use one window and so one shuffle. Rows of keys above it
are range-partitioned and sorted on ``(key, order)``; every so many rows of a partition are a chunk, which cuts a hot key
into consecutive pieces within the budget. Each computes its own running value, and a carry-in per (key, chunk) joins the
pieces. There are as many partitions as the rows need, however small the budget is. Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasklens.session import stored

# Rows of one key that one task may hold.
KEY_ROW_BUDGET = 5_000_000
# Rows that a task sorts, where keys are cut up.
SORTED_ROWS = 1_000_000
# Broadcast key lists only up to this many rows.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Running:
    """One running value: ``how`` is ``sum`` or ``last`` (last non-null value)."""

    name: str
    value: Column
    how: str
    inclusive: bool = True

    def over(self, window: W) -> Column:
        framed = window.rowsBetween(W.unboundedPreceding, 0 if self.inclusive else -1)
        if self.how == "sum":
            return F.coalesce(F.sum(self.value).over(framed), F.lit(0))
        return F.last(self.value, ignorenulls=True).over(framed)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    levels: Sequence[Sequence[Running]],
    key_row_budget: int | None = None,
) -> DataFrame:
    """Add the running values of ``levels``; a later level may refer to columns of an earlier one.

    ``order`` must be a total order within a key. ``key_row_budget`` is how many rows of a key one task may hold.
    """
    budget = key_row_budget or KEY_ROW_BUDGET
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = stored(counts.filter(F.col("_rows") > budget), "hot-keys")
    n_keys, n_rows = hot.agg(F.count("*"), F.sum("_rows")).first()
    if not n_keys:
        return _by_window(df, keys, order, levels)
    hot = hot.select(*[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)])
    if n_keys <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    is_hot = _same([F.col(k) for k in keys], [F.col(f"_hot{i}") for i in range(len(keys))])
    cold_part = _by_window(df.join(hot, is_hot, "left_anti"), keys, order, levels)
    hot_part = _by_chunks(df.join(hot, is_hot, "left_semi"), keys, order, levels, budget, n_rows)
    return cold_part.unionByName(hot_part)


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & a.eqNullSafe(b)
    return out


def _by_window(df, keys, order, levels) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    for level in levels:
        df = df.withColumns({r.name: r.over(window) for r in level})
    return df


def _by_chunks(df, keys, order, levels, budget: int, n_rows: int) -> DataFrame:
    # Tasks for the rows, not for the chunks: a small budget makes many chunks in a partition, not many partitions.
    least = math.ceil(n_rows / min(SORTED_ROWS, budget))
    spread = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows / SORTED_ROWS))
    rows = df.repartitionByRange(min(least, spread), *keys, *order).sortWithinPartitions(*keys, *order)
    # The number of a row is its partition's in the upper bits and its place in the lower 33: both in order.
    number, place_bits = F.col("_number"), 33
    in_place = F.floor(number.bitwiseAND((1 << place_bits) - 1) / budget)
    chunk = F.shiftleft(F.shiftright(number, place_bits), place_bits) + in_place
    rows = rows.withColumn("_number", F.monotonically_increasing_id()).withColumn("_chunk", chunk).drop("_number")
    # The chunk of a row must not change when a task is run again, so the rows are fixed first.
    rows = stored(rows, "chunks")
    in_chunk = W.partitionBy(*keys, "_chunk").orderBy(*order)
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    place = F.struct(*order)
    for level in levels:
        totals, carried, combined = [], {}, {}
        for r in level:
            part = f"_part_{r.name}"
            if r.how == "sum":
                totals.append(F.sum(r.value).alias(part))
                carried[f"_in_{r.name}"] = F.coalesce(F.sum(part).over(before), F.lit(0))
                combined[r.name] = r.over(in_chunk) + F.col(f"_in_{r.name}")
            else:
                totals.append(F.max_by(r.value, F.when(r.value.isNotNull(), place)).alias(part))
                carried[f"_in_{r.name}"] = F.last(part, ignorenulls=True).over(before)
                combined[r.name] = F.coalesce(r.over(in_chunk), F.col(f"_in_{r.name}"))
        # One row per (hot key, chunk): at most hot keys + chunks rows.
        carry = rows.groupBy(*keys, "_chunk").agg(*totals).withColumns(carried)
        carry = carry.select(
            *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
            F.col("_chunk").alias("_key_chunk"),
            *carried,
        )
        match = _same(
            [F.col(k) for k in keys] + [F.col("_chunk")],
            [F.col(f"_key{i}") for i in range(len(keys))] + [F.col("_key_chunk")],
        )
        rows = rows.join(carry, match, "left").withColumns(combined)
        rows = rows.drop(*[f"_key{i}" for i in range(len(keys))], "_key_chunk", *carried)
    return rows.drop("_chunk")
