"""The registered queries of the dealt operators: each applies its operator to whole tables and digests the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens.llm import bpe, kneser, language, leaks, near, nearest, phrases, quality, shards, simhash, turns, warc
from tasklens.llm.repeats import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(divisor: int, remainder: int, id_col: str = "doc_id") -> Column:
    """True for the rows that a model may not learn from: those whose crc32 of the id as text leaves the remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor == remainder, F.lit(False))


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", held_out(7, 2).alias("held_out"))
    scored = kneser.score(docs, kneser.learn(docs.filter(~F.col("held_out"))))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op2_sharding")
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.balanced_shards(read(spark, folder, "documents"), 8)
    law = F.lit("rows").alias("law")
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", held_out(5, 0).alias("held_out"))
    labels = read(spark, folder, "labels").filter(~held_out(5, 0))
    weights = quality.train_quality(docs, labels)
    return quality.score_quality(docs, weights).select("doc_id", "held_out", "score", "predicted")


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    kept = remove_repeats(docs, plain_spaces=True)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_warc")
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(read(spark, folder, "pages")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_ngram_jaccard")
def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = near.near_components(read(spark, folder, "documents"), shingle=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks.find_leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "first_word", "n_words", "n_equal")


@query("op8_language_id")
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang", held_out(5, 0).alias("held_out"))
    profiles = language.learn_profiles(docs.filter(~F.col("held_out")))
    found = language.predict_language(docs.drop("lang"), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def vocabulary() -> tuple[str, str]:
    """The rank file and the pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = vocabulary()
    decoded = bpe.round_trip(read(spark, folder, "documents").select("doc_id", "text"), path, pattern, keep_text=False)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return nearest.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = turns.repaired_conversations(read(spark, folder, "conversations"))
    return repaired.withColumnRenamed("conv", "conv_id")


@query(
    "op12_collocations",
    r"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) v(m)),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(w))::bigint AS n FROM words GROUP BY lang),
held AS (SELECT DISTINCT s.lang, s.phrase FROM counts s JOIN counts b ON s.lang = b.lang AND s.m > 1 AND b.m > s.m AND 100 * b.f >= 80 * s.f
  AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
cuts AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, m, unnest(range(1, m)) AS k FROM counts WHERE m > 1),
scored AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, ((2000000::hugeint * a) // (x.f + y.f))::bigint AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.m], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored) q WHERE place = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best ANTI JOIN held USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = phrases.collocations(read(spark, folder, "documents"), least=30, contained_percent=80, top=2000)
    return found.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


@query("op13_simhash")
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(read(spark, folder, "documents"), shingle=3, radius=3)
    bits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select(F.col("id").alias("doc_id"), bits, "component_id")
