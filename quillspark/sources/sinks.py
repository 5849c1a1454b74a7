"""Sinks: JSON lines with an optional offset index, titles, features, mappings."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import ids as I  # noqa: E741


#: Columns that hold trees as JSON text, and unknown keys of a document as a JSON object.
TREES, EXTRA = ("hierarchy", "related_work"), "extra"


def as_json(df: DataFrame) -> DataFrame:
    """One column `value`: each row as compact JSON. Null fields are kept, trees are objects, extra keys come last."""
    plain = [F.col(f"`{c}`") for c in df.columns if c not in (*TREES, EXTRA)]
    value = F.to_json(F.struct(*plain), {"ignoreNullFields": "false"})
    for c in df.columns:
        if c in TREES:
            value = F.concat(_open(value), F.lit(f',"{c}":'), F.coalesce(F.col(c), F.lit("null")), F.lit("}"))
    if EXTRA in df.columns:
        more = F.trim(F.col(EXTRA))
        value = F.when(F.coalesce(F.length(more), F.lit(0)) > 2, F.concat(_open(value), F.lit(","), F.substring(more, 2, 1 << 30))).otherwise(value)
    return df.select(value.alias("value"))


def _open(value: Column) -> Column:
    """A JSON object without its last brace."""
    return F.regexp_replace(value, r"\}$", "")


def from_json(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    return df.select(F.from_json(column, schema).alias("__r")).select("__r.*")


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines that any reader of the format understands: see as_json."""
    as_json(df).write.mode(mode).text(path)


def write_indexed(rows: Iterable[tuple[int, dict]], path: str) -> None:
    """One file of JSON lines and `path`.index, a TSV of key and byte offset: for programs that read single rows.

    A compatibility sink: rows come from toLocalIterator(), one partition at a time."""
    with open(path, "wb") as f, open(f"{path}.index", "w") as index:
        index.write("key\tfile_line_offset\n")
        for key, row in rows:
            index.write(f"{key}\t{f.tell()}\n")
            f.write(json.dumps(row, ensure_ascii=False, separators=(",", ":")).encode() + b"\n")


def read_index(spark, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="key bigint, file_line_offset bigint")


def write_references(docs: DataFrame, wanted: DataFrame, order: str, cut: bool = False) -> DataFrame:
    """The documents that are wanted, in source order; with cut, their citations cut to wanted ones."""
    own = I.keep_ids(docs, wanted)
    return (I.filter_citations(own, wanted) if cut else own).orderBy(order)


def titles(papers: DataFrame) -> DataFrame:
    """(id, norm_title): a table to be written partitioned or bucketed by what searches need."""
    return papers.select("id", T.normalize_string(F.col("title")).alias("norm_title"))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).csv(path)


def merge_parts(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mapping_lines(mapping: DataFrame) -> DataFrame:
    """Lines of a mapping (row_pos, value), in order; -1 for none."""
    return mapping.orderBy("row_pos").select(F.coalesce("value", F.lit(-1)).cast("string").alias("value"))


def read_mapping(lines: DataFrame) -> DataFrame:
    """(row_pos, value) of lines with row_pos; -1 and None are null."""
    v = F.col("value").try_cast("bigint")
    return lines.select("row_pos", F.when(v >= 0, v).alias("value"))

