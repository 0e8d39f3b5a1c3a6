"""Fingerprints against plain counting, links against comparing all fingerprints."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tasklens.llm import simhash
from tasklens.llm.near import components

DOCS = "doc_id long, text string"


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reached(fps):
    """The least index that each fingerprint reaches."""
    a, label = np.array(fps, np.uint64), list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 3):
            x, y = root(i), root(int(j))
            label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(fps))]


@pytest.fixture(scope="module")
def fps():
    rng = random.Random(3)
    out = {rng.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1, 2**63}
    for x in list(out)[:120]:
        for _ in range(4):
            out.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    # Many within few bits of each other.
    return sorted(out | {(i << 3) ^ 0xABCDEF0123456789 for i in range(150)})


@pytest.mark.parametrize("limit", [simhash.GROUP_LIMIT, 64])
def test_links(spark, fps, limit):
    nodes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    tied = {r.id: r.component for r in components(simhash.hamming_links(nodes, 3, limit)).collect()}
    got, want = {}, {}
    for x, label in zip(fps, reached(fps), strict=True):
        signed = x - 2**64 if x >= 2**63 else x
        got.setdefault(tied.get(signed, signed), set()).add(x)
        want.setdefault(label, set()).add(x)
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values()}


def test_groups_split_until_they_are_small(spark):
    """Fingerprints that share every band but the lowest are dealt again, until the bits left bound a group."""
    nodes = spark.range(300).select(F.col("id").alias("fp"))
    sizes = simhash._groups(nodes, 1, 16).groupBy("key").count()
    assert sizes.agg(F.max("count")).first()[0] <= 8 * 16


def test_index(fps):
    """The shared bits of every node are those of all fingerprints below it, and a search finds exactly the near ones."""
    fp = np.array(sorted(fps, key=simhash_rank), np.uint64)
    index = simhash.GrayIndex(np.zeros(len(fp), np.int64), fp)
    for level in index.levels:
        start = 0
        for mask, pattern, end in zip(level["mask"], level["pattern"], level["end"], strict=True):
            held = fp[start:end]
            shared = ~(np.bitwise_and.reduce(held) ^ np.bitwise_or.reduce(held))
            assert mask == shared and pattern == held[0] & mask
            start = end
    assert len(index.levels[-1]["mask"]) == 1
    a, b = index.pairs(np.arange(len(fp)), fp, 3)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {
        (i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if int(fp[i] ^ fp[j]).bit_count() <= 3
    }


def simhash_rank(x):
    for step in (1, 2, 4, 8, 16, 32):
        x ^= x >> step
    return x


def test_gray_rank(spark, fps):
    nodes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    order = [r.fp % 2**64 for r in nodes.orderBy(simhash.gray_rank(F.col("fp"))).collect()]
    assert order == sorted(fps, key=simhash_rank)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 400)}" for _ in range(300)]
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one  TWO"), (5, "a"), (6, "\x0bword\x0cword\r\nword É")]
    for i in range(10, 25):
        copy = list(base)
        copy[rng.randrange(300)] = "other"
        out.append((i, " ".join(copy)))
    out += [(i, " ".join(f"w{rng.randint(0, 400)}" for _ in range(40))) for i in range(30, 60)]
    out += [(70, "again " * 90), (71, "again\n" * 70), (72, " ".join(base) * 40), (None, " ".join(base)), (None, "only this without an id")]
    return out + [(12, out[10][1]), (3, "other words under an old id")]


def test_components(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    fps_ = [plain_fingerprint(t) for _, t in rows]
    labels = reached(fps_)
    least = {}
    for (i, _), label in zip(rows, labels, strict=True):
        if i is not None:
            least[label] = min(i, least.get(label, i))
    want = sorted(((i, f, least.get(x)) for (i, _), f, x in zip(rows, fps_, labels, strict=True)), key=repr)
    got = sorted(((r.id, r.fp % 2**64, r.component_id) for r in simhash.simhash_components(docs).collect()), key=repr)
    assert got == want
    assert len({x for _, _, x in got}) < len(got)


def test_long_texts_are_read_in_slices(rows):
    for _, text in rows:
        body = memoryview((text or "").encode())
        assert simhash.fingerprint(body, 3, 7) == plain_fingerprint(text)


def test_clashing_columns_and_no_rows(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    more = docs.withColumns({c: F.lit("mine") for c in ("id", "fp", "key", "path", "band", "component", "least", "root")})
    plain = sorted(simhash.simhash_components(docs).collect(), key=repr)
    assert sorted(simhash.simhash_components(more).collect(), key=repr) == plain
    assert simhash.simhash_components(docs.limit(0)).collect() == []
