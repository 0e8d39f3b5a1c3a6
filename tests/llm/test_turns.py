"""Conversation repair against a search over whole audits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tasklens.llm import turns
from tasklens.llm.queries import QUERIES

ROWS = "conv_id long, turn long, role string, text string"


def damage(rows, conv):
    def spelt(x):
        return " " if x is None else x

    out = []
    for c, turn, role, text in rows:
        if c != conv:
            continue
        what = zlib.crc32(f"{spelt(c)}:{spelt(turn)}".encode()) % 20
        role, text = spelt(role), spelt(text)
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))


def faults_of(got):
    seen, out = set(), []
    for _, role, text in got:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(got, faults):
    """The least (cost, audit) and its turns, by a search that always follows the least audit of the least cost."""
    then, full = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, q, said = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(got) and q in ("", "a"):
            return cost, audit, said
        new = full[then[q]]
        heapq.heappush(heap, (cost + 2, audit + "I", i, then[q], (*said, (new, ""))))
        if i == len(got):
            continue
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, said))
        if faults[i] in ("", "t"):
            _, role, text = got[i]
            more = int(faults[i] == "t")
            heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, then[q], (*said, (new, text))))
            if role[:1] == then[q] or (role[:1] == "s" and q == ""):
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*said, (role, text))))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        got = damage(rows, conv)
        faults = faults_of(got)
        known = [r[0] for r in got if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:], strict=False))
        cost, audit, said = cheapest(got, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
    return out


@pytest.fixture(scope="module")
def rows():
    """Nulls everywhere, empty and blank texts, odd roles, equal turns, repeated rows and a longer conversation."""
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "", "bot", "Ünknown", None]
    out = []
    for conv in [*range(50), None]:
        for turn in range(rng.choice([1, 2, 3, 5, 9, 40])):
            text = rng.choice([f"x{rng.randint(0, 6)}.", f"x{rng.randint(0, 6)}", f"y{rng.randint(0, 99)}!", "", None, "ok? \n", " \t", "é" * 3000 + "."])
            out.append((conv, rng.choice([turn, turn, turn, None, turn + 3, turn // 2]), rng.choice(roles), text))
    return out + out[:40]


# Small chunks cut every conversation in several.
@pytest.mark.parametrize("chunk", [turns.CHUNK, 5, 1])
def test_repairs(spark, rows, chunk):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in turns.repaired_conversations(df, chunk=chunk).collect()}
    assert got == brute(rows)


def test_hot_row(spark):
    """One row a thousand times, in a conversation of a few others."""
    rows = [(1, 2, "user", "Again.")] * 1000 + [(1, t, "assistant", f"Reply {t}.") for t in (1, 3, 4)]
    df = spark.createDataFrame(rows, ROWS)
    assert {r[0]: tuple(r)[1:] for r in turns.repaired_conversations(df, chunk=2).collect()} == brute(rows)


def test_clashing_columns_and_no_rows(spark, rows):
    df = spark.createDataFrame(rows[:60], ROWS)
    more = df.withColumns({c: F.lit("mine") for c in ("conv", "at", "chunk", "fault", "copies", "digest", "step", "times", "cost")})
    assert sorted(turns.repaired_conversations(more).collect(), key=repr) == sorted(turns.repaired_conversations(df).collect(), key=repr)
    assert turns.repaired_conversations(df.limit(0)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, folder)
    assert got.columns[0] == "conv_id"
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute(rows)
