"""Language ID by compression: the language whose zstandard raw-content dictionary makes a text smallest.

A text is cut into blocks of `BLOCK` bytes, all of which are compressed, each for itself, with each language's
dictionary; the sizes are summed, so a long text is judged like a short one. It is rejected if the best language isn't
smaller than the second by `MARGIN` of the uncompressed size, or not smaller by `GAIN` than the text compressed without
any dictionary. Dictionaries are cut from a bounded sample of labelled rows: `SAMPLE` texts of each language, those
with the smallest hashes of doc_id; each gives `PIECES` pieces of `PIECE` characters at most, taken from anywhere in it by
a hash, and a dictionary is of `DICTIONARY` bytes at most. Case is ignored.

Defined results: null or blank texts are rejected with a null language; with no labelled row every text is rejected, so
an empty table gives an empty result; ties go to the language first in alphabetical order (and are rejected, as their
margin is 0); every row gives one row, repeated ones too; ids are of any type, null ones are kept; other columns, whatever
their names, are ignored by `identify` and kept by `accepted`; very long texts are judged whole, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import small_batches, text_slices, type_of, work_table

SAMPLE, DICTIONARY, PIECE, PIECES, BLOCK, LEVEL, MARGIN, GAIN = 200, 64 * 1024, 256, 5, 2048, 6, 0.003, 0.003


def dictionaries(docs: DataFrame, sample: int = SAMPLE, size: int = DICTIONARY) -> dict[str, bytes]:
    """language -> dictionary content, from labelled rows (lang not null, text not empty)."""
    small_batches(docs.sparkSession)
    own = docs.where("lang is not null and text is not null and text <> ''").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", F.lit("dictionary")).alias("__key"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("__key"))
    ids = work_table(own.select("lang", "__key").distinct().withColumn("__rank", rank).where(F.col("__rank") <= sample).select("lang", "__key"), "sample")
    at = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))
    piece = F.transform(at, lambda i: F.struct(F.xxhash64("__key", i).alias("h"), i.alias("i")))
    some = F.transform(F.slice(F.array_sort(piece), 1, PIECES), lambda x: F.struct(x["h"].alias("h"), F.expr("text").substr(x["i"] * PIECE + 1, F.lit(PIECE)).alias("s")))
    rows = own.join(ids, ["lang", "__key"], "left_semi").select("lang", F.explode(some).alias("p")).distinct()
    parts: dict[str, list[tuple[int, bytes]]] = {}
    for r in rows.select("lang", "p.h", "p.s").collect():  # SAMPLE x PIECES pieces of each language at most
        parts.setdefault(r.lang, []).append((r.h, r.s.lower().encode()))
    out = {}
    for lang, found in parts.items():
        size_now, keep = 0, []
        for _, p in sorted(found):
            if size_now + len(p) < size:
                keep.append(p)
                size_now += len(p) + 1
        out[lang] = b"\n".join(keep)
    return {k: v for k, v in sorted(out.items()) if len(v) >= 8}


class Compressors:
    def __init__(self, dicts: dict[str, bytes], level: int = LEVEL):
        frame = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        params = zstandard.ZstdCompressionParameters.from_level(level, **frame)
        self.plain = zstandard.ZstdCompressor(compression_params=params)
        self.langs, self.each = list(dicts), []
        for d in dicts.values():
            z = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            z.precompute_compress(level=level)
            self.each.append(zstandard.ZstdCompressor(level=level, dict_data=z, **frame))

    def judge(self, text: str | None, margin: float, gain: float) -> tuple[str | None, float | None, bool]:
        """(best language, margin over the second as a share of the bytes, accepted)."""
        if text is None or not text.strip() or not self.each:
            return None, None, False
        data = text.lower().encode()
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(z.compress(b)) for b in blocks) for z in self.each]
        plain = sum(len(self.plain.compress(b)) for b in blocks)
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        second = sizes[order[1]] if len(order) > 1 else plain
        lead = (second - best) / len(data)
        return self.langs[order[0]], lead, lead >= margin and (plain - best) / len(data) >= gain


def _classify(dicts: dict[str, bytes], margin: float, gain: float, column: str = "__text"):
    """Judges the texts of a column; of the name __text, it isn't returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = Compressors(dicts)
        for b in (part.slice(lo, hi - lo) for part in batches for lo, hi in text_slices(part, column, 4 << 20)):
            got = [z.judge(t.as_py(), margin, gain) for t in b.column(column)]
            lang, lead, ok = zip(*got, strict=True) if got else ((), (), ())
            names = [n for n in b.schema.names if n != "__text"]
            cols = [b.column(n) for n in names]
            yield pa.record_batch([*cols, pa.array(lang, pa.string()), pa.array(lead, pa.float64()), pa.array(ok, pa.bool_())], names=[*names, "language", "margin", "accepted"])

    return run


def identify(docs: DataFrame, dicts: dict[str, bytes] | None = None, margin: float = MARGIN, gain: float = GAIN) -> DataFrame:
    """(doc_id, language, margin, accepted), a row for each row."""
    dicts = dictionaries(docs) if dicts is None else dicts
    own = docs.select("doc_id", F.col("text").cast("string").alias("__text"))
    return own.mapInArrow(_classify(dicts, margin, gain), f"doc_id {type_of(own)}, language string, margin double, accepted boolean")


def accepted(docs: DataFrame, dicts: dict[str, bytes] | None = None, margin: float = MARGIN, gain: float = GAIN) -> DataFrame:
    """docs without the rows that are rejected, all in one pass."""
    from pyspark.sql import types as T

    dicts = dictionaries(docs) if dicts is None else dicts
    place = [f"c{i}" for i in range(len(docs.columns))]
    at = place[[c.lower() for c in docs.columns].index("text")]
    packed = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(docs.columns, place, strict=True)])
    if not isinstance(packed.schema[at].dataType, T.StringType):
        packed, at = packed.withColumn("__text", F.col(at).cast("string")), "__text"
    kept = [f for f in packed.schema.fields if f.name != "__text"]
    schema = T.StructType([*kept, T.StructField("language", T.StringType()), T.StructField("margin", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    return packed.mapInArrow(_classify(dicts, margin, gain, at), schema).where("accepted").select(*[F.col(p).alias(c) for c, p in zip(docs.columns, place, strict=True)])
