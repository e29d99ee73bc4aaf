"""The corpus pipeline: documents without toxic ones, without unknown languages, one of each near-duplicate group, packed.

Counted as part of ``gridweave.llm``.  Every stage takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread for the next.
All but the last return the columns of ``documents``, extra ones included.

Edge cases: a null or empty text is not toxic, has no language and goes at the
second stage, as do texts without a letter and, if there is a language to learn
from, those of which no profile knows an n-gram.  Rows of a null id are judged by
their text, are never a copy of another and are packed.  Repeated rows of one id
share their fate: their group keeps the id and with it all of its rows.  Without
labels nothing is toxic.  Very long texts are read whole; memory follows the
longest.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm import langid, neardup, packing, toxicity
from gridweave.llm.common import table, written
from gridweave.llm.queries import tokenizer

#: Similarity in per cent from which documents are near-duplicates; the query of the operator alone has its own.
NEAR = 80


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier chain takes for toxic; it learns from the documents given and their labels."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts, texts without a letter and, if there is a language to learn from the documents given, those without an n-gram of any."""
    return langid.predict(docs, langid.learn(docs.where(langid.training(F.col("doc_id")))), keep=True, told=True)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each group of near-duplicates, linked at a similarity of ``NEAR`` per cent."""
    return neardup.kept_rows(docs, link=NEAR)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("toxicity", clean), ("language", spoken), ("near-duplicates", distinct), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Models, minimum hashes and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
