"""From raw documents to token ids: language ID, line dedup, near-duplicate removal, decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. A missing table is an error.

Defined results: null and blank texts don't get past language ID, which rejects them; nulls in other columns stay; rows
with null ids go through all stages, each for itself, and no near-duplicate or leak removes them; of rows that repeat a
doc_id the one with the longest text stays if texts differ or are copies; ties are settled as the operators' docstrings
say; very long texts are worked on whole; columns of any other name, the operators' own included, are carried to the last
stage, which returns ids and tokens only; empty documents or an empty benchmark give an empty result or remove nothing.
The tables between stages stay in the shared folder (spark.checkpoint.dir) for the rows that are read from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bpe, decontaminate, language, line_dedup, near_dup
from quillspark.llm.common import work_table

#: Language ID, BPE and the signatures can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.accepted(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that very many share; n_chars follows."""
    out = line_dedup.deduplicate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.deduplicate(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, exact)."""
    return bpe.encode(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", remove_leaks),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
