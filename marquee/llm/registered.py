"""One query per operator, over whole tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import ann, bpe, fim, jaccard_join, licences, lm, mixing, oracles, quality, sentencepiece, sharding, toxicity, url_filter, whitening
from marquee.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
#: Sources by the square root of their tokens, the rest as named.
MARGINS = [
    mixing.Margin("source", {}, temper=0.5),
    mixing.Margin("lang", {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15}),
    mixing.Margin("topic", {"prose": 0.8, "tabular": 0.03}),
]
MIX_RATE, MIX_CYCLES, MIX_SEED = 0.4, 6, "mix"
FIM_SEED = 42
#: Score from which a text counts as toxic.
TOXIC_FROM = 0.3
#: What to do, host, path.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_topic_and_tokens(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", "n_tokens")
    # Read again to draw from: texts are searched and cut into words once.
    mixed = mixing.mix(stored(docs, "mix-docs"), MARGINS, MIX_RATE, MIX_CYCLES, MIX_SEED)
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("chance", 6).alias("chance"), "sampled")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.shard(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.judged(table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, F.col("vec_id") % 100 == 0, k=10)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.train(docs.where(~F.coalesce(lm.held_out(F.col("doc_id")), F.lit(False))))
    return lm.score(docs, model).withColumn("held_out", lm.held_out(F.col("doc_id")))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_licence_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "sentence_ids", "licence", "licences")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.fit(url_filter.LABELLED_URLS), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    tokens = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *vocabulary, decoded=True)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.rearrange(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=FIM_SEED)
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    parts = F.arrays_zip("whitened", "explained")
    each = rows.select("vec_id", "n", "deviation", "identity_error", F.posexplode(parts).alias("place", "part"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"),
        "identity_error",
    )


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    tokens = sentencepiece.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, packed="words")
    return sentencepiece.decode(tokens.select("doc_id", "ids", "words"), path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("words", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_mixing_sources": op1_mixing_sources,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_licence_scans": op7_licence_scans,
    "op8_url_filters": op8_url_filters,
    "op9_quality_rules": op9_quality_rules,
    "op10_byte_level_bpe": op10_byte_level_bpe,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLES: dict[str, str] = {
    "op1_mixing_sources": oracles.mixing_sql(MARGINS, MIX_RATE, MIX_CYCLES, MIX_SEED),
    "op7_licence_scans": oracles.licences_sql(),
    "op9_quality_rules": oracles.quality_sql(),
    "op11_fill_in_middle": oracles.fill_in_middle_sql(FIM_SEED, fim.FIM_RATE, fim.SPM_RATE),
}
