"""Collocations against counting every phrase of every piece."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tasklens.llm import phrases

DOCS = "doc_id long, text string, lang string"


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", text)]


def brute(rows, least, percent, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in counts.items():
        often = {p: f for p, f in count.items() if f >= least}
        held = set()
        for p, f in often.items():
            for m in range(2, len(p)):
                held |= {p[i : i + m] for i in range(len(p) - m + 1) if 100 * f >= percent * often[p[i : i + m]]}
        scored = []
        for p, a in often.items():
            if len(p) > 1 and p not in held:
                score, k = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    names = "of the a New york city É state rain".split()
    passage = " ".join(rng.choice(names) for _ in range(60))
    out = [(1, None, "en"), (2, "", None), (3, " \t\n.", "en"), (4, "one", ""), (5, "Same same SAME same", None)]
    for i in range(10, 90):
        ends = [" ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "\xa0"]
        text = "".join(rng.choice(names) + rng.choice(ends) for _ in range(rng.randint(1, 80)))
        out.append((i, text + rng.choice(["", passage, "new york city " * 9]), rng.choice(["en", "en", "fr", None, "und"])))
    return out + out[20:30]


def found(docs, **more):
    return sorted(tuple(r) for r in phrases.collocations(docs, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,percent,top", [(5, 80, 2000), (12, 60, 7)])
def test_collocations(spark, rows, least, percent, top):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    expected = brute(rows, least, percent, top)
    assert expected and found(docs, least=least, contained_percent=percent, top=top) == expected


def test_long_texts_are_read_in_slices(spark, rows, monkeypatch):
    """Slices of a few bytes, chunks of a few words: every phrase still counts once."""
    monkeypatch.setattr(phrases, "SLICE_BYTES", 40)
    monkeypatch.setattr(phrases, "LONGEST", 5)
    for _, text, _ in rows:
        raw = (text or "").encode()
        counted, want = Counter(), Counter()
        for chunk, owned in phrases.parse([raw]):
            words = chunk.split(b" ")
            for m in range(1, 5):
                counted.update(tuple(words[i : i + m]) for i in range(owned) if i + m <= len(words))
        for words in pieces(text):
            for m in range(1, 5):
                want.update(tuple(w.encode() for w in words[i : i + m]) for i in range(len(words) - m + 1))
        assert counted == want


def test_equal_passages_share_chunks():
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randint(0, 500)}" for _ in range(3000))
    texts = [f"{' '.join(f'x{rng.randint(0, 500)}' for _ in range(n))} {passage}".encode() for n in (3, 50, 171)]
    found_ = Counter(c for t in texts for c in phrases.parse([t]))
    assert sum(1 for f in found_.values() if f == 3) > 0.8 * sum(1 for c in found_ if b"w" in c[0])


def test_clashing_columns_and_no_rows(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    more = docs.withColumns({c: F.lit("mine") for c in ("chunk", "owned", "freq", "phrase", "a", "l", "r", "k", "n", "score", "rank")})
    assert found(more, least=9) == found(docs, least=9)
    assert found(docs.limit(0)) == []
    assert found(docs, least=10**9) == []
