"""A training-corpus pipeline over ``documents``: identify languages, keep one of each group of near
copies, take out personal data, mix the sources to weights and encode the texts.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import langid, mixing, ngram_join, pieces, pii
from courtside.llm.common import table, written

LEAST_CONFIDENCE = 0.5
MIX_WEIGHTS = (3, 1, 2)
MIX_RATE = 1.5
MIX_COPIES = 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: ``lang`` becomes the language found; documents without letters or without a clear
    language go."""
    found = langid.identify(docs, declared=F.col("lang"), host=F.col("source"))
    found = found.filter((F.col("detected") != "und") & (F.col("confidence") >= LEAST_CONFIDENCE))
    return found.select(*[F.col("detected").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (five words, 0.8): of each component one row stays, that with the least id. Where an id
    repeats, its texts are told apart by their sets; a null id comes after all others; rows without words stay."""
    return ngram_join.keep_firsts(docs, shingle=5, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span is replaced by its kind in brackets."""
    return pii.redact_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        .select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document as often as its source's target takes it."""
    return mixing.mix_documents(docs, MIX_WEIGHTS, MIX_RATE, MIX_COPIES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: the piece ids of every text."""
    coded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), pieces.load())
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", redact),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

# Trained models, hashes and tokenizers: not SQL. Tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
