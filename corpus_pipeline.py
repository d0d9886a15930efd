"""Corpus pipeline: toxicity, near-duplicates, secrets, mixing, packing, in this order.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns
a DataFrame that the caller writes and rereads; all but the last keep the columns of ``docs``,
whatever they are named.  ``run`` writes each stage once to the shared folder.  The classifier
and the tokeniser have no SQL form, so there is no ORACLE_SQL.

Defined results of every stage: a null text counts as empty and is never a reason to drop a
row; rows with a null id are judged like any other, but are no near-duplicate of a row and so
stay there; exact repeats of a row are one document to the near-duplicate stage and rows each
to the others; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abundara.llm.common import cut, table
from abundara.llm.mixing import mix
from abundara.llm.packing import pack_documents
from abundara.llm.registry import tokenizer_path
from abundara.llm.secrets import redact
from abundara.llm.similar import keep_first_joined
from abundara.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scoring as toxic go."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of the smallest id stays: SimHash links, and similarity 0.8 and more on five-word shingles, which SimHash misses."""
    return keep_first_joined(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings are replaced by marks in the text; every row stays."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of rare sources are repeated, up to twice, by their share of the mix; every row stays."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed sequences, written in small batches: the last stage meets executors whose heap is full."""
    return cut(pack_documents(docs, tokenizer_path()), batch_rows=1000)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))  # written once: no later stage runs an earlier one again
    return STAGES[-1][1](spark, docs, sf_dir)
