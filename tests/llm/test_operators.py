"""The dealt operators against brute force, round trips and known answers, on small tables with awkward rows."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tasklens.llm import bpe, kneser, language, leaks, near, nearest, quality, repeats, shards, warc
from tasklens.llm.queries import vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def prose(rng: random.Random, n: int) -> str:
    names = "the of and rain wind stone river light dark seven Éa x1 -".split()
    return " ".join(rng.choice(names) + str(rng.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and blank texts, odd spaces, copies, near copies, a long text, and shared passages."""
    rng = random.Random(4)
    base, passage = prose(rng, 80).split(" "), prose(rng, 30)
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "a b"), (6, "\x0bword\x0cword\r\nword")]
    for i in range(10, 22):
        copy = list(base)
        copy[i * 3] = f"changed{i}"
        out.append((i, " ".join(copy)))
    out += [(i, " ".join(base)) for i in (30, 31, 32)]
    out += [(i, f"{prose(rng, 25)}  {passage}\n{prose(rng, 15)}") for i in (40, 41, 42)]
    out += [(50, "again " * 50), (51, prose(rng, 4000)), (-7, prose(rng, 30))]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def awkward(docs):
    """The rows with extra columns that bear the operators' own names, and a null id."""
    extra = docs.withColumns({c: F.lit("mine") for c in ("id", "chunk", "score", "n", "ids", "rest_0", "_0", "bucket", "shard")})
    return extra.unionByName(extra.limit(1).withColumn("doc_id", F.lit(None).cast("long")))


# --- 1: LM scoring -------------------------------------------------------------


def test_kneser_ney_against_the_formulas(docs, rows):
    model = kneser.learn(docs)
    got = {r["doc_id"]: r for r in kneser.score(docs, model).collect()}
    texts = [[*words(t, True), None] for _, t in rows]
    pairs = Counter((a, b) for t in texts for a, b in zip(["<s>", *t], t, strict=False))
    single = Counter(w for t in texts for w in t)
    total, distinct = sum(single.values()), len(single)
    lefts, after = Counter(b for _, b in pairs), Counter()
    kinds: dict = {}
    for (a, _), c in pairs.items():
        after[a] += c
        kinds.setdefault(a, Counter())[min(c, 3)] += 1
    d2 = kneser.discounts(*[sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    d1 = kneser.discounts(*[sum(c == k for c in lefts.values()) for k in (1, 2, 3, 4)])
    spare = sum(d1[min(c, 3) - 1] for c in lefts.values()) / len(pairs)

    def p(a, b):
        lower = max(lefts[b] - d1[min(lefts[b], 3) - 1], 0) / len(pairs) + spare / (distinct + 1)
        kept = sum(d2[k - 1] * n for k, n in kinds[a].items()) / after[a]
        return max(pairs[a, b] - d2[min(pairs[a, b], 3) - 1], 0) / after[a] + kept * lower

    # All that may follow a word adds up to one, with what is kept for unknown words.
    assert math.isclose(sum(p("<s>", w) for w in single), 1 - sum(d2[k - 1] * n for k, n in kinds["<s>"].items()) / after["<s>"] * spare / (distinct + 1), rel_tol=1e-6)
    for (i, _), t in zip(rows, texts, strict=True):
        row = got[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(t), len(t), total)
        assert math.isclose(row["base_score"], sum(math.log10((single[w] + 1) / (total + distinct + 1)) for w in t), rel_tol=1e-9)
        expected = sum(math.log10(p(a, b)) for a, b in zip(["<s>", *t], t, strict=False))
        assert math.isclose(row["score"], expected, rel_tol=1e-6, abs_tol=1e-9)


def test_unseen_words_and_empty_models_have_finite_scores(spark, docs, nothing):
    model = kneser.learn(nothing)
    assert all(math.isfinite(r["score"]) for r in kneser.score(awkward(docs), model).collect())
    unseen = spark.createDataFrame([(1, "never seen words")], "doc_id long, text string")
    row = kneser.score(unseen, kneser.learn(docs)).first()
    assert row["n_known"] == 1 and math.isfinite(row["score"])
    assert kneser.score(nothing, model).count() == 0


# --- 2: sharding ---------------------------------------------------------------


@pytest.mark.parametrize("count", [3, 8, 100])
def test_shards_are_even_and_keep_copies_together(docs, rows, count):
    got = shards.balanced_shards(docs, count).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes[s] for s in range(count)) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    text = dict(rows)
    for r in got:
        body = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
    if count < 10:
        assert len({r["shard"] for r in got if r["doc_id"] in (30, 31, 32)}) == 1


def test_a_group_larger_than_a_shard_is_cut(spark, nothing):
    same = spark.range(100).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 90, "x").otherwise(F.col("id").cast("string")).alias("text"))
    got = shards.balanced_shards(same, 4).collect()
    assert sorted(Counter(r["shard"] for r in got).values()) == [25, 25, 25, 25]
    assert shards.balanced_shards(nothing, 4).count() == 0
    repeated = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, "a")], "doc_id long, text string")
    assert shards.balanced_shards(repeated, 2).count() == 4


# --- 3: quality ----------------------------------------------------------------


def test_quality_learns_what_its_labels_mark(spark, nothing):
    rng = random.Random(1)
    good = [(i, prose(rng, 60), 1) for i in range(0, 300, 2)]
    bad = [(i, " ".join(w.upper() + "!!" for w in prose(rng, 60).split()), 0) for i in range(1, 300, 2)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    labels = table.filter("doc_id < 200").select("doc_id", "quality")
    weights = quality.train_quality(table.drop("quality"), labels)
    scored = quality.score_quality(table.filter("doc_id >= 200"), weights).collect()
    assert all(r["predicted"] == r["quality"] and 0 <= r["score"] <= 1 for r in scored)
    none = quality.train_quality(nothing, labels)
    assert not none.any()
    odd = spark.createDataFrame([(1, None, "mine"), (1, "", "mine"), (None, "x " * 9000, "mine")], "doc_id long, text string, score string")
    assert [c for c in quality.score_quality(odd, weights).columns].count("score") == 1
    assert all(0 <= r["score"] <= 1 for r in quality.score_quality(odd, weights).collect())


# --- 4: substring dedup ---------------------------------------------------------


@pytest.mark.parametrize(("window", "chunk"), [(20, 1 << 22), (20, 300), (5, 300), (2, 1000)])
def test_repeats_against_all_windows(docs, rows, window, chunk):
    got = {r["doc_id"]: r for r in repeats.remove_repeats(docs, window=window, plain_spaces=True, chunk_bytes=chunk).collect()}
    seen: set = set()
    for i, text in sorted(rows):
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["text"]) == (len(own), sum(gone), kept)


def test_repeats_keep_rows_and_columns(docs, nothing):
    odd = awkward(docs)
    got = repeats.remove_repeats(odd, window=5)
    assert got.count() == odd.count() and got.columns == [*odd.columns, "n_words", "n_removed"]
    assert repeats.remove_repeats(nothing).count() == 0


# --- 5: WARC -------------------------------------------------------------------


def test_archives_come_back_whole(spark, tmp_path):
    html = [(1, "u", None), (2, "u\r\nX: y", ""), (3, None, "<p>é</p>"), (5, "u", "<p>é</p>"), (4, "u", "<p>é</p>"), (6, "u", "\r\n\r\n" * 9000)]
    pages = spark.createDataFrame(html, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc.read_archives(warc.write_archives(pages, str(tmp_path / "w"))).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    for i, _, text in html:
        body = (text or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    kinds = {i: (r["record_type"], r["refers_to"]) for i, r in got.items()}
    assert kinds == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 5), 4: ("revisit", 5), 5: ("response", None), 6: ("response", None)
    }
    assert bytes(got[6]["payload"]).decode() == "\r\n\r\n" * 9000
    empty = pages.limit(0)
    assert warc.read_archives(warc.write_archives(empty, str(tmp_path / "e"))).count() == 0


def test_damage_is_found():
    good = warc._member(warc.record_bytes("response", "urn:page:1", "u", b"hello"))
    assert [r.payload for r in warc.read_records(io.BytesIO(good * 3))] == [b"hello"] * 3
    changed = warc._member(warc.record_bytes("response", "urn:page:1", "u", b"hello").replace(b"hello", b"jello"))
    short = warc._member(warc.record_bytes("response", "urn:page:1", "u", b"hello")[:-6])
    for bad in (good[:-12], changed, short, b"no gzip"):
        with pytest.raises(warc.BadRecord):
            list(warc.read_records(io.BytesIO(good + bad)))


# --- 6: Jaccard join -------------------------------------------------------------


def brute_components(rows, size, percent):
    sets = {}
    for i, text in rows:
        own = words(text, True)
        sets[i] = {tuple(own[k : k + size]) for k in range(max(1, len(own) - size + 1))} if own else set()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("size", "percent", "block"), [(3, 90, 1500), (5, 80, 1500), (3, 90, 3), (1, 60, 1500)])
def test_components_against_all_pairs(docs, rows, size, percent, block):
    got = near.near_components(docs, shingle=size, percent=percent, block=block).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, size, percent)


def near_pairs(rng, pairs, length=40):
    """Pairs of texts with one other word, ids 2k and 2k + 1."""
    out = []
    for k in range(pairs):
        own = [f"p{k}w{j}x{rng.randint(0, 9)}" for j in range(length)]
        out += [(2 * k, " ".join(own)), (2 * k + 1, " ".join([*own[:-1], "other"]))]
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_components_of_a_table_unioned_with_itself(spark, docs, rows, size, percent):
    pairs = [(i + 1000, t) for i, t in near_pairs(random.Random(8), 30)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(pairs, "doc_id long, text string"))
    expected = brute_components([*rows, *pairs], size, percent)
    assert sum(c != i for i, (_, c) in expected.items()) >= 30
    got = near.near_components(table.union(table), shingle=size, percent=percent).collect()
    assert len(got) == 2 * len(expected)
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert {(r["id"], r["component_id"]) for r in got} == {(i, c) for i, (_, c) in expected.items()}


def test_an_id_of_several_texts_is_one_document(spark):
    texts = [(5, "a b c"), (5, "q r s"), (1, "a b c"), (9, "q r s"), (9, "q r s")]
    got = near.near_components(spark.createDataFrame(texts, "doc_id long, text string"), shingle=3).collect()
    assert len(got) == 5 and {r["component_id"] for r in got} == {1}


def test_a_bit_for_every_member(spark, nothing):
    ids = spark.createDataFrame([(i,) for i in [3, -4, 3, 2**62, 0]], "id long")
    bits = near.member_bits(ids)
    at = np.array([r.slot - 1 for r in ids.select(near._slot()).collect()])
    assert len(bits) * 8 == near.MEMBER_BITS
    assert (bits[at >> 3] >> (at & 7) & 1).all()
    assert int(np.unpackbits(bits).sum()) == len(set(at.tolist()))
    assert not near.member_bits(nothing.selectExpr("doc_id AS id")).any()


def test_packed_sets_keep_their_low_bits():
    values = np.array([0, 1, 2**48 - 1, 2**64 - 1, 5], np.uint64)
    packed = near._packed(values, np.array([0, 2, 2, 5]))
    assert [len(b) for b in packed.to_pylist()] == [12, 0, 18]
    assert near._unpacked(packed.to_pylist()).tolist() == [int(v) % 2**48 for v in values]


def test_light_sets_against_all_pairs(spark, nothing):
    rng = random.Random(2)
    base = [f"w{k}" for k in range(14)]
    rows = []
    for i in range(60):
        own = [w for w in base if rng.random() > 0.05] + ([f"x{i}"] if rng.random() < 0.3 else [])
        rows.append((i, " ".join(own)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = near.near_components(table, shingle=1, percent=90).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 1, 90)
    assert near.near_components(nothing).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (2, "a b c"), (2, "q r s"), (9, "q r s")], "doc_id long, text string")
    assert sorted(near.near_components(odd, shingle=3).collect(), key=str) == sorted([(None, 1, None), (2, 1, 2), (2, 1, 2), (9, 1, 2)], key=str)


# --- 7: decontamination -----------------------------------------------------------


def test_leaks_with_other_words_inside(spark, nothing):
    rng = random.Random(3)
    items = [(i, prose(rng, 20 + i)) for i in range(8)] + [(20, "tiny item here"), (21, None), (22, "")]
    rows, expected = [], set()
    for i in range(8):
        own = words(items[i][1])
        for k in (5, 14):
            own[k] = "otherwise"
        rows.append((i, f"{prose(rng, 30)} {' '.join(own).upper()} {prose(rng, 5)}"))
        expected.add((i, i))
    rows += [(100 + i, prose(rng, 60)) for i in range(20)] + [(200, None), (201, ""), (202, "a tiny item here too")]
    expected.add((202, 20))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = leaks.find_leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected
    assert all(r["first_word"] == 30 for r in got if r["doc_id"] < 8)
    assert leaks.find_leaks(nothing, benchmark).count() == 0
    assert leaks.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert leaks.find_leaks(awkward(docs.limit(1)), benchmark).count() == 2


@pytest.mark.parametrize(("window", "share"), [(12, 0.8), (12, 0.9), (15, 0.8)])
def test_every_leaking_window_leaves_a_mask_whole(window, share):
    skipped = [{j for j, bit in enumerate(m) if bit == "0"} for m in leaks.masks(leaks.allowed(window, share))]
    for size in range(leaks.SPAN, window + 1):
        for others in combinations(range(size), size - math.ceil(share * size - 1e-9)):
            spans = [{o - at for o in others if 0 <= o - at < leaks.SPAN} for at in range(size - leaks.SPAN + 1)]
            assert any(inside <= skip for inside in spans for skip in skipped), others


@pytest.mark.parametrize("size", [10, 12])
def test_leaks_with_any_two_other_words(spark, size):
    rng = random.Random(9)
    own = words(prose(rng, size))
    rows = []
    for i, pair in enumerate(combinations(range(size), 2)):
        rows.append((i, " ".join(["before", *("otherwise" if k in pair else w for k, w in enumerate(own)), "after"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = leaks.find_leaks(docs, spark.createDataFrame([(1, " ".join(own))], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["first_word"], r["n_words"], r["n_equal"]) for r in got) == [(i, 1, size, size - 2) for i, _ in rows]


# --- 8: language --------------------------------------------------------------------


def test_language_profiles(spark, nothing):
    rng = random.Random(6)
    parts = {"aa": "ka lo mi na tu".split(), "bb": "sch ein ung ver heit".split(), "ру": "при вет мир дом".split()}
    table = [(i, " ".join(rng.choice(p) + rng.choice(p) for _ in range(40)), lang) for i, (lang, p) in enumerate(list(parts.items()) * 30)]
    docs = spark.createDataFrame([*table, (900, None, "aa"), (901, "123 !?", "bb"), (902, "x", None)], "doc_id long, text string, lang string")
    profiles = language.learn_profiles(docs.filter("doc_id < 60"))
    got = {r["doc_id"]: r for r in language.predict_language(docs, profiles).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in table) and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"
    assert language.predict_language(docs, profiles.limit(0)).filter("lang_pred <> 'und'").count() == 0
    assert language.learn_profiles(nothing).count() == 0


def test_profiles_against_plain_counts(spark):
    docs = spark.createDataFrame([("Ab a-b É", "x"), ("b" * 5, "x"), ("字" * 3 + "".join(map(chr, range(0x4E00, 0x4F00))), "y")], "text string, lang string")
    for lang in ("x", "y"):
        counts: Counter = Counter()
        for text, own in docs.collect():
            if own == lang:
                for word in re.findall(r"[^\W\d_]+", text.lower()):
                    padded = f" {word} "
                    counts.update(word)
                    counts.update(padded[k : k + n] for n in (2, 3) for k in range(len(padded) - n + 1))
        expected = sorted(counts, key=lambda g: (-counts[g], [*map(ord, g)]))[:100]
        rows = language.learn_profiles(docs, size=100).filter(F.col("lang") == lang).orderBy("rank").collect()
        texts = ["".join(chr(p) for p in (r["gram"] >> 42, r["gram"] >> 21 & 0x1FFFFF, r["gram"] & 0x1FFFFF) if p) for r in rows]
        assert texts == expected


# --- 9: BPE ---------------------------------------------------------------------------


def test_bpe_is_that_of_the_public_library():
    path, pattern = vocabulary()
    own = bpe.Codec(path, pattern)
    public = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(8)
    parts = ["a", "b", "e", "th", "A", "  ", " ", "\n", "é", "ß", "1", "'s", "=", "-", "ing", "the", "\U0001f600", "漢", "‍", "\x1c", "　", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(3000)] + ["=" * 5000, " " * 3001 + "x", "ab" * 4000]
    small = bpe.Transducer(own.ranks, max_states=5)
    for text in texts:
        ids = own.encode(text)
        assert list(ids) == public.encode_ordinary(text)
        assert own.decode(ids) == text
    for piece in ("unbelievably", "=" * 70, "ééé", "thethethe"):
        assert small.encode(piece.encode()) == public.encode_ordinary(piece)


def test_utf8_machine_is_that_of_the_codec():
    rng = random.Random(9)
    for _ in range(5000):
        data = bytes(rng.choice([rng.randrange(256), 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0xED, 0xA0, 65]) for _ in range(rng.randint(0, 12)))
        machine, at = bpe.Utf8Machine(), rng.randint(0, len(data))
        assert machine.feed(data[:at]) + machine.feed(data[at:]) + machine.end() == data.decode("utf-8", "replace")


def test_bpe_tables(docs, rows, nothing):
    path, pattern = vocabulary()
    odd = awkward(docs)
    got = bpe.decode(bpe.encode(odd, path, pattern), path, pattern)
    assert got.filter("decoded <> coalesce(text, '')").count() == 0 and got.count() == odd.count()
    assert got.filter("length(ids) <> 4 * n_tokens").count() == 0
    assert bpe.encode(nothing, path, pattern).count() == 0
    assert public_tokenizers.PATTERN == pattern


# --- 10: nearest neighbours ---------------------------------------------------------


def test_nearest_against_all_distances(spark):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((12, 24))
    points = (centre[rng.integers(0, 12, 3000)] + 0.4 * rng.standard_normal((3000, 24))).astype(np.float32)
    points[100:400] = points[7]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    odd = [(5000, None), (5001, [0.0] * 24), (5002, [float("nan")] * 24), (5003, [1.0, None] * 12), (5004, [1.0]), (None, points[0].tolist())]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    queries = table.filter("vec_id % 100 = 0 or vec_id > 4999")
    got = nearest.nearest(table, queries, list_rows=100, probes=12, part_rows=64).collect()
    hit = 0
    for q in range(0, 3000, 100):
        exact = np.sqrt(((points.astype(float) - points[q].astype(float)) ** 2).sum(1))
        order = [int(j) for j in np.lexsort((np.arange(3000), exact)) if j != q][:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        assert all(math.isclose(s, exact[i], rel_tol=1e-12, abs_tol=1e-12) for _, i, s in own)
        hit += len({i for _, i, _ in own} & set(order))
        if 100 <= q < 400:
            assert [i for _, i, _ in own] == order
    assert hit >= 0.95 * 300 and {r["query_id"] for r in got} == set(range(0, 3000, 100))


def test_probes_follow_vectors_without_clusters(spark):
    points = np.random.default_rng(12).standard_normal((6000, 64))
    points /= np.sqrt((points * points).sum(1))[:, None]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(points.tolist())], "vec_id long, embedding array<double>")
    got = nearest.nearest(table, table.filter("vec_id % 100 = 0"), list_rows=20).collect()
    hit = 0
    for q in range(0, 6000, 100):
        d = ((points - points[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len({r["vec_id"] for r in got if r["query_id"] == q} & set(np.argsort(d)[:10].tolist()))
    assert hit >= 0.95 * 600


def test_few_candidates_and_none(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = nearest.nearest(table, table.filter("vec_id = 1")).collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 2), (2, 2)]
    assert nearest.nearest(table.limit(0), table).count() == 0
