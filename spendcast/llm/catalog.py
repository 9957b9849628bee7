"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm import (
    byte_bpe, exact_dedup, importance, language, lm_score, neighbours, ngram_join, packing, quality, suffix_dedup, token_count, toxicity, whitening,
)
from spendcast.llm.common import LOWER, UPPER, fold, held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _classified(spark: SparkSession, sf_dir: str, operator, threshold: float) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = operator.score(docs, operator.fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select(
        "doc_id", held_out("doc_id", operator.FOLDS, operator.ASIDE).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity, 0.7)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality, 0.5)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.count_tokens(docs, vocabulary("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_tokens", "token_score")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coder = (vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = byte_bpe.encode(docs, *coder).select("doc_id", "ids")
    return byte_bpe.decode(ids, *coder).select(
        "doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packing.pieces(packed)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return scored.select("doc_id", held_out("doc_id", language.FOLDS, 0).alias("held_out"), "lang_pred", "score")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    router = neighbours.fit(vectors, "embedding", "vec_id")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), router)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.project(vectors, whitening.fit(vectors))


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm_score.score(docs, fold("doc_id", 7) != 2)
    return scored.select(
        "doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    named = [op1_toxicity, op2_quality, op3_ngram_join, op4_token_counts, op5_byte_bpe, op6_packing, op7_exact_dedup, op8_language_id, op9_nearest_neighbours, op10_suffix_dedup, op11_whitening, op12_lm_score, op13_importance]
    return {q.__name__: q for q in named}


OP7 = f"""
WITH rows AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM rows WINDOW same AS (PARTITION BY text_sha256)"""


OP3 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)"""


#: crc32 of each distinct word from its bytes (as pairs of hexadecimal digits) by a table of 256 numbers.
OP13 = f"""
WITH RECURSIVE crc(value, step, entry) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT value, step + 1, CASE WHEN entry % 2 = 1 THEN xor(entry // 2, 3988292384) ELSE entry // 2 END FROM crc WHERE step < 8),
entries AS (SELECT list(entry ORDER BY value) AS entry FROM crc WHERE step = 8),
texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents
  UNION ALL SELECT 't', 0, NULL, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') FROM benchmark),
words AS (
  SELECT kind, row, unnest(list_filter(string_split_regex(text, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS word FROM texts),
buckets AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, len(hex(encode(word))) // 2),
      lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c // 256, entry[1 + xor(c % 256, b)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), entries),
found AS (SELECT kind, row, bucket FROM words JOIN buckets USING (word)),
counts AS (SELECT bucket, count(*) FILTER (kind = 't') AS t, count(*) FILTER (kind = 'd') AS s FROM found GROUP BY bucket),
totals AS (SELECT sum(t)::DOUBLE AS t_all, sum(s)::DOUBLE AS s_all FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS gain FROM counts, totals),
weights AS (
  SELECT row, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row),
scores AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    ((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row) WHERE kind = 'd'),
placed AS (
  SELECT *, n_features >= 20 AS open, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN open AND place <= 10 * n // 100 THEN place END AS rank FROM placed"""


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_join": OP3, "op7_exact_dedup": OP7, "op13_importance": OP13}
