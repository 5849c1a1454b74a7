"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import audio, bpe, decontaminate, language, licenses, line_dedup, near_dup, suffix_dedup, token_counts, token_files
from quillspark.llm.common import work_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.redacted_counts(_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(_table(spark, sf_dir, "documents")).select("doc_id", "ids")
    return token_files.write(ids, work_path(spark, "tokens"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.groups(_table(spark, sf_dir, "documents"))


def op7_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no recordings: the bytes of each turn serve as 8-bit samples."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.encode("text", "UTF-8").alias("clip"))
    return audio.store(turns, ["conv_id", "turn"], "clip", work_path(spark, "audio"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = (op1_suffix_dedup, op2_token_counts, op3_token_files, op4_line_dedup, op5_decontamination, op6_minhash, op7_audio, op8_licenses, op9_bpe, op10_language_id)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": line_dedup.oracle()}
