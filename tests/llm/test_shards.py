"""Sharding: how many texts are cut, against what is possible and against all ways to pack small tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from tasklens.llm import shards

DOCS = "doc_id long, text string"


def placed(spark, rows, n):
    """(the texts that lie in several shards, the sizes of all shards, the rows by text)"""
    out = shards.balanced_shards(spark.createDataFrame(rows, DOCS).repartition(3), n).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    where, sizes, text = defaultdict(Counter), Counter(dict.fromkeys(range(n), 0)), dict(rows)
    for r in out:
        where[text[r.doc_id]][r.shard] += 1
        sizes[r.shard] += 1
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    return {t for t, w in where.items() if t is not None and len(w) > 1}, sizes, where


@pytest.mark.parametrize("copies", [2, 3])
def test_no_group_is_cut_where_all_rows_are_linked(spark, copies):
    cut, _, _ = placed(spark, [(i, f"text {i // copies}") for i in range(1200)], 8)
    assert not cut


def test_a_text_larger_than_a_shard_fills_as_few_as_hold_it(spark):
    rows = [(i, "everywhere" if i < 400 else f"pair {i // 2}" if i < 800 else f"alone {i}") for i in range(1200)]
    cut, _, where = placed(spark, rows, 8)
    assert cut == {"everywhere"}
    assert sorted(where["everywhere"].values()) == [100, 150, 150]


def fewest_cut(groups, room):
    """The least number of groups that cannot lie in one shard each, over all ways to put them there."""
    best = len(groups)
    for goals in product(range(-1, len(room)), repeat=len(groups)):
        left = list(room)
        for g, goal in zip(groups, goals, strict=True):
            if goal >= 0:
                left[goal] -= g
        if min(left) >= 0:
            best = min(best, goals.count(-1))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_small_tables_against_all_ways(spark, seed):
    rng = random.Random(seed)
    groups = [rng.randint(2, 6) for _ in range(rng.randint(3, 6))]
    total = sum(groups) + rng.randint(0, 8)
    rows = [f"t{g}" for g, n in enumerate(groups) for _ in range(n)]
    rows = list(enumerate(rows + [f"alone {i}" for i in range(total - len(rows))]))
    least, more = divmod(total, 3)
    cut, _, _ = placed(spark, rows, 3)
    assert len(cut) <= fewest_cut(groups, [least + (s < more) for s in range(3)]) + 1


def test_clashing_columns_nulls_and_repeated_ids(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (3, None), (None, "a"), (4, ""), (5, "")]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("mine") for c in ("shard", "slot", "size", "text_id", "piece", "n", "row_id")})
    out = shards.balanced_shards(df, 2).collect()
    assert sorted(r.size for r in out) == [1, 1, 1, 1, 2, 2, 2]
    assert sorted(Counter(r.shard for r in out).values()) == [3, 4]
    assert shards.balanced_shards(df.limit(0), 2).collect() == []
