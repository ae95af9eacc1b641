"""The corpus pipeline: five operators, each on all that the one before has kept.

Rows are documents (doc_id, text, lang, source, n_chars); columns beyond these
are carried along. Rows that a stage does not name as rejected go on unchanged.
NULL and empty texts have no toxic clauses, fail the quality rules and so do not
reach the later stages. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, jaccard_join, mixing, quality, toxicity
from marquee.llm.common import stored, table
from marquee.llm.registered import MARGINS, MIX_CYCLES, MIX_RATE, MIX_SEED, TOXIC_FROM

VOCABULARY = "byte_bpe_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the bound; labels of these documents are learned from."""
    model = toxicity.learn(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_FROM).select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.passed(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; repeated rows once.

    Documents without an id stay only if no document of their group has one, one of each group.
    """
    return jaccard_join.one_per_group(docs)


def sample_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics come near their target shares."""
    mixed = mixing.mix(mixing.with_topic_and_tokens(docs), MARGINS, MIX_RATE, MIX_CYCLES, MIX_SEED)
    return mixed.where("sampled").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text's bytes again."""
    vocabulary = (public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    decoded = bpe.encode(docs.select("doc_id", "text"), *vocabulary, decoded=True)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("decodes_to_text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources", sample_mix),
    ("byte-level BPE", tokens),
]

#: SQL cannot express the learned and the iterative stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; what each other stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
