"""Benchmark decontamination by spaced seeds.

Words of documents and of benchmark items are hashed. Each fixed mask takes some of the next words and ignores the
others, so a substitution between them doesn't hide a hit. Document seeds are tested in the worker against a bit filter
of the items' seeds (its size follows the benchmark, up to 64 MB; a fuller filter costs time, not correctness); those
that pass are joined with the items' seeds in Spark, and around each hit the item is laid over the document: the window
with the most equal words, of those in which at least half of the words are equal, decides.

An item leaks into a document if that window has at least min(13, 0.8 x words of the item) equal words. In items of up to
26 words that is so wherever the equal words lie; in longer ones equal words far from each other don't add up. Items of
under 8 words are too short for the masks: they leak where all their words stand in the document, one after the other
(their seed is the whole item).
Defined results: null ids or texts and texts without words never match; repeated rows give one result; of equally good
overlaps the shortest counts, then the first; an empty table gives an empty result; a word is as in `common`; ids are of
any type; a text of any length is hashed whole, and only the words around hits leave the worker; other columns, whatever
their names, are ignored by `leaks` and kept by `clean`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import U64, Words, fresh, ids_only, mix, runs, text_slices, type_of, work_table

MASKS = ((0, 1, 3, 4, 6, 7), (0, 1, 3, 5, 6, 8), (0, 1, 2, 4, 8, 9), (0, 2, 4, 5, 8, 9))
SHORT, MIN_WORDS, SHARE = 8, 13, 0.8
_SEED = "array<struct<h: bigint, at: int>>"


def seeds(w: Words, short: Sequence[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each mask, and for runs of each number of words in short, the first words of its seeds, and their hashes."""
    end = np.repeat(w.off[1:], w.n)
    for k, mask in enumerate((*MASKS, *(range(n) for n in short))):
        at = np.flatnonzero(np.arange(len(w.h)) + mask[-1] < end)
        h = np.full(len(at), k + 1 if k < len(MASKS) else 1000 + len(mask), U64)
        for o in mask:
            h = h * U64(0x9E3779B97F4A7C15) + (w.h[at + o] ^ (w.h[at + o] >> U64(32)))
        yield at, mix(h)


def needed(n: int) -> int:
    """Equal words that an item of n words must have in a document that it leaks into."""
    return n if n < SHORT else min(MIN_WORDS, int(np.ceil(SHARE * n)))


def _items(of: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in text_slices(b):
                w = Words(b.column("text").slice(lo, hi - lo))
                own: list[list] = [[] for _ in range(hi - lo)]
                for k, (at, h) in enumerate(seeds(w, range(1, SHORT))):
                    of_item = np.searchsorted(w.off, at, "right") - 1
                    whole = w.n[of_item] == k - len(MASKS) + 1
                    pick = w.n[of_item] >= SHORT if k < len(MASKS) else whole
                    for r, a, x in zip(of_item[pick].tolist(), at[pick].tolist(), h[pick].astype(np.int64).tolist(), strict=True):
                        own[r].append({"h": x, "at": a - int(w.off[r])})
                words = [w.h[a:e].tobytes() for a, e in zip(w.off[:-1], w.off[1:], strict=True)]
                yield pa.record_batch({of: b.column("doc_id").slice(lo, hi - lo), "item": pa.array(words, pa.binary()), "seeds": pa.array(own, pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())])))})

    return run


def _bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = np.zeros(1 << bits, bool)
        for b in batches:
            h = b.column("h").to_numpy().astype(U64)
            f[h >> U64(64 - bits)] = True
            f[h & U64((1 << bits) - 1)] = True
        yield pa.record_batch({"f": pa.array([np.packbits(f, bitorder="little").tobytes()], pa.binary())})

    return run


def _hits(bits: int, packed, reach: int, short: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = np.frombuffer(packed.value, np.uint8)

        def has(i: np.ndarray) -> np.ndarray:
            return (f[i >> U64(3)] >> (i & U64(7)).astype(np.uint8)) & np.uint8(1) == 1

        for b in batches:
            rows: dict[str, list] = {"doc_id": [], "first": [], "words": [], "seeds": []}
            for lo, hi in text_slices(b):
                w = Words(b.column("text").slice(lo, hi - lo))
                found = []
                for at, h in seeds(w, short):
                    i = np.flatnonzero(has(h >> U64(64 - bits)))
                    i = i[has(h[i] & U64((1 << bits) - 1))]
                    found.append((at[i], h[i]))
                at, h = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                doc = np.searchsorted(w.off, at, "right") - 1
                apart = np.cumsum(np.concatenate([[0], (at[1:] - at[:-1] > 2 * reach) | (doc[1:] != doc[:-1])]) if len(at) else [])
                for s, e in zip(*runs(apart), strict=True):
                    d = doc[s]
                    start, end = max(w.off[d], at[s] - reach), min(w.off[d + 1], at[e - 1] + reach)
                    rows["doc_id"].append(lo + int(d))
                    rows["first"].append(int(start - w.off[d]))
                    rows["words"].append(w.h[start:end].tobytes())
                    rows["seeds"].append([{"h": int(x), "at": int(a)} for x, a in zip(h[s:e].astype(np.int64), at[s:e] - start, strict=True)])
            ids = b.column("doc_id").take(pa.array(rows.pop("doc_id"), pa.int64()))
            types = (pa.int32(), pa.binary(), pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())])))
            yield pa.record_batch([ids, *(pa.array(x, t) for x, t in zip(rows.values(), types, strict=True))], names=["doc_id", *rows])

    return run


def overlap(doc: np.ndarray, item: np.ndarray, at: int) -> tuple[int, int, int]:
    """Best window of item laid over doc with its first word at `at`: first word in doc, words, equal words.

    Of the windows with at least as many equal words as others, that with the most equal words, then the shortest."""
    lo, hi = max(0, -at), min(len(item), len(doc) - at)
    same = doc[at + lo : at + hi] == item[lo:hi]
    where = np.flatnonzero(same)
    if not len(where):
        return at + lo, 0, 0
    balance = np.concatenate([[0], np.cumsum(np.where(same, 1, -1))])
    count = np.concatenate([[0], np.cumsum(same)])
    e = where + 1  # a best window ends with an equal word; its start is the first from which the balance doesn't fall
    s = where[count[np.searchsorted(-np.minimum.accumulate(balance), -balance[e], "left")]]
    k = np.lexsort((s, e - s, count[s] - count[e]))[0]
    return at + lo + int(s[k]), int(e[k] - s[k]), int(count[e[k]] - count[s[k]])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep, out = [], []
        for k, (first, words, item, at) in enumerate(zip(*(b.column(c).to_pylist() for c in ("first", "words", "item", "at")), strict=True)):
            x, y = np.frombuffer(words, U64), np.frombuffer(item, U64)
            start, n, equal = overlap(x, y, at)
            if equal >= needed(len(y)):
                keep.append(k)
                out.append((first + start, n, equal))
        at = pa.array(keep, pa.int64())
        cols = list(zip(*out, strict=True)) or [[]] * 3
        yield pa.record_batch([b.column("doc_id").take(at), b.column("item_id").take(at), *(pa.array(c, pa.int32()) for c in cols)], names=["doc_id", "item_id", "first_word", "n_words", "n_equal"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, n_equal): the best overlap of each pair that leaks."""
    spark, ids = docs.sparkSession, ids_only(docs)
    whole = "doc_id is not null and text is not null"
    named = benchmark.select(F.col("item_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    doc, item = f"doc_id {type_of(ids)}", f"item_id {type_of(named)}"
    items = named.where(whole).mapInArrow(_items("item_id"), f"{item}, item binary, seeds {_SEED}").where("size(seeds) > 0")
    items = work_table(items.withColumn("key", F.xxhash64("item_id", "item")).dropDuplicates(["key"]), "items")
    marks = items.select("key", F.explode("seeds").alias("s")).select("key", "s.h", F.col("s.at").alias("item_at"))
    sizes = [r.n for r in items.select((F.length("item") / 8).cast("int").alias("n")).where(F.col("n") < SHORT).distinct().collect()]
    n, reach = marks.count(), (items.agg(F.max(F.length("item"))).first()[0] or 0) // 8
    bits = int(np.clip(np.ceil(np.log2(64 * max(n, 1))), 16, 29))
    packed = np.zeros((1 << bits) // 8, np.uint8)
    for r in marks.select("h").mapInArrow(_bits(bits), "f binary").toLocalIterator():
        packed |= np.frombuffer(r.f, np.uint8)
    found = ids.where(whole).mapInArrow(_hits(bits, spark.sparkContext.broadcast(packed.tobytes()), reach, sorted(sizes)), f"{doc}, first int, words binary, seeds {_SEED}")
    found = work_table(found.withColumn("place", F.xxhash64("doc_id", "first", "words")).dropDuplicates(["place"]), "hits")
    at = found.select("place", F.explode("seeds").alias("s")).select("place", "s.h", "s.at")
    laid = at.join(marks, "h").select("place", "key", (F.col("at") - F.col("item_at")).alias("at")).distinct()
    pairs = laid.join(found.drop("seeds"), "place").join(items.drop("seeds"), "key").select("doc_id", "item_id", "first", "words", "item", "at")
    best = pairs.mapInArrow(_verify, f"{doc}, {item}, first_word int, n_words int, n_equal int")
    top = F.max_by(F.struct("first_word", "n_words", "n_equal"), F.struct("n_equal", -F.col("n_words"), -F.col("first_word"))).alias("t")
    return best.groupBy("doc_id", "item_id").agg(top).select("doc_id", "item_id", "t.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that some item leaks into."""
    key = fresh(docs, "leak")
    bad = work_table(leaks(docs, benchmark).select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return docs.join(bad, F.col("doc_id") == F.col(key), "left_anti")
