"""The registered opN queries: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abundara.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.lines import clean_lines

    return clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.mixing import draws

    return draws(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.toxicity import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.chat import digests, format_turns

    said = "</s>[INST] ok [/INST]"
    probe = spark.sql(f"SELECT -1L AS conv_id, posexplode(array('user', 'assistant')) AS (turn, role), '{said}' AS text")
    return digests(format_turns(table(spark, sf_dir, "conversations").unionByName(probe, allowMissingColumns=True)))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.vectors import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.secrets import secret_spans

    return secret_spans(table(spark, sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abundara.llm.substrings import repeated_windows

    return repeated_windows(table(spark, sf_dir, "documents")).drop("removed")


def queries() -> dict:
    return {"op1_packing": op1_packing, "op2_line_cleaning": op2_line_cleaning, "op3_licenses": op3_licenses, "op4_mixing": op4_mixing, "op5_simhash": op5_simhash, "op6_toxicity": op6_toxicity, "op7_chat": op7_chat, "op8_neighbours": op8_neighbours, "op9_secrets": op9_secrets, "op10_substrings": op10_substrings}


def oracle_sql() -> dict[str, str]:
    from abundara.llm import lines, mixing, secrets

    return {"op2_line_cleaning": lines.ORACLE, "op4_mixing": mixing.ORACLE, "op9_secrets": secrets.ORACLE}
