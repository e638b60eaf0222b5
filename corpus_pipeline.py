"""The corpus pipeline: stages that each read the documents the one before them left."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.llm.common import ensure_checkpoint_dir
from quartermill.llm.decontam import decontaminate
from quartermill.llm.langid import identify, learn
from quartermill.llm.linededup import drop_repeated_lines
from quartermill.llm.neardup import keep_one
from quartermill.llm.pieces import encode

#: A public SentencePiece model; any other path does as well.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Documents whose n-grams are farther from every profile are in no known language.
LEAST_SCORE = 0.1


def with_text(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """``changed`` with the columns of ``docs``, its new text and the length of it."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return changed.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach. Null, letterless and unlike texts go.

    Without a labelled document there is nothing to tell languages by, and all would go:
    that is an error, save for an empty table.
    """
    profiles = learn(docs, "text", "lang")
    if not profiles and not docs.isEmpty():
        raise ValueError("no document has both a text and a language, so no language can be learned")
    found = identify(docs, profiles)
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them share, save in the last one."""
    return with_text(docs, drop_repeated_lines(docs), "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_text(docs, decontaminate(docs, items), "clean_text")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, and the text they decode to."""
    coded = encode(docs.drop("n_chars"), MODEL, out="decoded")
    return coded.select("doc_id", "lang", "source", F.col("decoded").alias("text"), "n_tokens", "ids")


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Models and signatures are not for SQL; the tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return out
