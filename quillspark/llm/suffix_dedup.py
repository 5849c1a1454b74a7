"""Suffix-array dedup: passages of at least `MIN` words that occur in two documents or more.

The suffix array is sparse. Of the K-word grams that begin in the first W words of a passage of MIN words, the one with
the least hash is its minimiser; only suffixes at minimisers are retained, and equal passages retain the same one.
Suffixes are first told apart by a hash of their first MIN - W + 1 words, which any passage has in common from its
minimiser on; those whose words begin no other document's suffix are dropped by an aggregate that combines before its
shuffle. Where all around the suffixes of a key (every passage they stand for) is equal, they need no further look. The
others fetch their words and are sorted by them, as in a suffix array. Neighbours are compared: right by the words they
have in common (at most MIN), left by those before. For each offset of the minimiser in a passage the runs of neighbours
with enough words in common to the right are sorted by what is on the left; equal neighbours there are equal passages.
Overlapping matches are joined to maximal spans. The result is exactly that of comparing every passage of MIN words with
every other one.

A key that more than `LIMIT` suffixes share is never held by one task: there each suffix gives a hash of each passage it
stands for, and aggregates over those hashes find the repeats.

`kind` is `repeat` for what also occurs in another document, `copy` for what isn't the first occurrence (by doc_id, then
position). Defined results: null ids or texts and texts of fewer words give nothing; ids are of any type that can be
ordered; rows that repeat a doc_id are one document, so repeat nothing; a passage within one document only is no repeat;
a text of any length is cut into suffixes whole; other columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import U64, Words, codes, ids_only, mix, runs, text_slices, type_of, whole_groups, work_table

MIN, W, K = 50, 32, 8
LIMIT = 20_000
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BACK = U64(pow(int(_BASE), -1, 1 << 64))
_PLACE = U64((1 << 28) - 1)


class _Rolling:
    """Hashes of word ranges by prefix sums."""

    def __init__(self, h: np.ndarray):
        power = np.full(len(h) + 1, _BASE, U64)
        power[0] = 1
        back = np.full(len(h) + 1, _BACK, U64)
        back[0] = 1
        self.back = np.cumprod(back)
        self.total = np.concatenate([np.zeros(1, U64), np.cumsum(h * np.cumprod(power)[:-1])])

    def range(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[first]) * self.back[first] + (end - first).astype(U64))


def suffixes(w: Words, least: int = MIN) -> dict[str, np.ndarray]:
    """The retained suffixes: text, word `at`, first passage and number of passages it stands for, and hashes."""
    n, reach = len(w.h), least - W + 1
    begin, end = np.repeat(w.off[:-1], w.n), np.repeat(w.off[1:], w.n)
    t = np.flatnonzero(np.arange(n) + least <= end)
    roll = _Rolling(w.h)
    least_gram = (roll.range(np.arange(max(0, n - K + 1)), np.arange(K, max(K, n + 1))) & ~_PLACE) | np.arange(max(0, n - K + 1), dtype=U64)
    step = 1
    while step < W:
        least_gram = np.minimum(least_gram[:-step], least_gram[step:]) if len(least_gram) > step else least_gram[:0]
        step *= 2
    p = (least_gram[t] & _PLACE).astype(np.int64) if len(t) else t
    s, e = runs(p)
    p, first, last = p[s], t[s], t[e - 1]
    lo, hi = np.maximum(begin[p], p - W + 1), np.minimum(end[p], p + least)
    shape = ((p - lo) << 36 | (hi - p) << 24 | (p - first) << 12 | (last - first)).astype(U64)
    around = mix(roll.range(lo, p) * _BASE + roll.range(p, hi) + mix(shape))
    return {"text": np.searchsorted(w.off, p, "right") - 1, "at": p, "first": first, "last": last, "key": roll.range(p, p + reach), "around": around}


def _retain(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in text_slices(b):
                w = Words(b.column("text").slice(lo, hi - lo))
                s = suffixes(w, least)
                k, off = s["text"], w.off[s["text"]]
                start, stop = w.chars(w.start[s["first"]], k), w.chars(w.end[s["last"] + least - 1], k)
                ints = [x.astype(np.int32) for x in (s["at"] - off, s["first"] - off, s["last"] - s["first"] + 1, start, stop)]
                cols = [s["key"].astype(np.int64), s["around"].astype(np.int64), b.column("doc_id").slice(lo, hi - lo).take(pa.array(k)), *ints]
                yield pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x) for x in cols], names=["key", "around", "doc_id", "at", "first", "n", "start", "stop"])

    return run


def _fetch(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc_id", "at", "many", "hot", "words", "first", "starts", "stops"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for b in batches:
            for lo, hi in text_slices(b):
                w = Words(b.column("text").slice(lo, hi - lo))
                s = suffixes(w, least)
                of: list[dict[int, int]] = [{} for _ in range(hi - lo)]
                for i, (k, p) in enumerate(zip(s["text"].tolist(), (s["at"] - w.off[s["text"]]).tolist(), strict=True)):
                    of[k][p] = i
                rows: list[list] = [[] for _ in names]
                begin = w.chars(w.start, np.repeat(np.arange(hi - lo), w.n))
                end = w.chars(w.end, np.repeat(np.arange(hi - lo), w.n))
                for k, wanted in enumerate(b.column("wanted")[lo:hi].to_pylist()):
                    a, z = int(w.off[k]), int(w.off[k + 1])
                    for x in wanted:
                        i = of[k].get(x["at"])
                        if i is None or s["key"][i].astype(np.int64) != x["key"]:
                            continue  # another text with the same doc_id
                        p, f, g = a + x["at"], int(s["first"][i]), int(s["last"][i]) + 1
                        words = np.zeros(W - 1 + least, np.uint32)
                        lo2, hi2 = max(a, p - W + 1), min(z, p + least)
                        words[lo2 - p + W - 1 : hi2 - p + W - 1] = (w.h[lo2:hi2] >> U64(32)).astype(np.uint32)
                        for r, v in zip(rows, (x["key"], lo + k, x["at"], x["many"], x["hot"], words.tobytes(), f - a, begin[f:g], end[f + least - 1 : g + least - 1]), strict=True):
                            r.append(v)
                cols = [pa.array(r, t) for r, t in zip(rows, types, strict=True)]
                cols[1] = b.column("doc_id").take(cols[1])
                yield pa.record_batch(cols, names=names)

    return run


def _common(words: np.ndarray) -> np.ndarray:
    """How many leading words each row has in common with the row before (0 for the first)."""
    if len(words) < 2:
        return np.zeros(len(words), np.int64)
    differs = words[1:] != words[:-1]
    n = np.where(differs.any(axis=1), differs.argmax(axis=1), words.shape[1])
    return np.concatenate([[0], n])


def _extend(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = W - 1 + least
        for b in whole_groups(batches, "key"):
            words = np.frombuffer(b"".join(b.column("words").to_pylist()), np.uint32).reshape(-1, width)
            # the suffix array of each key: rows in the order of the words from the minimiser on
            key = b.column("key").to_numpy()
            big = np.ascontiguousarray(words[:, W - 1 :].astype(">u4")).view(f"S{4 * least}").ravel()
            order = np.lexsort((big, key))
            b, words, key = b.take(pa.array(order)), words[order], key[order]
            doc, at, first = codes(b.column("doc_id")), b.column("at").to_numpy(), b.column("first").to_numpy()
            many = b.column("many").to_numpy(zero_copy_only=False)
            n = b.column("starts").value_lengths().to_numpy()
            right = _common(words[:, W - 1 :])
            right[np.concatenate([[True], key[1:] != key[:-1]])] = 0
            before = words[:, W - 2 :: -1]  # the words on the left, nearest first
            hit, copy = np.zeros((2, len(key), W + 1), bool)
            for left in range(W):
                c = at - left - first  # the passage that begins `left` words before the minimiser is the c-th it stands for
                run_ = np.cumsum(right < least - left)  # neighbours that have the rest of the passage in common
                i = np.flatnonzero((c >= 0) & (c < n))
                if len(i) < 2:
                    continue
                alone = np.bincount(run_[i], minlength=run_[-1] + 1)[run_[i]] < 2
                if left:
                    side = np.ascontiguousarray(before[i, :left]).view(f"S{4 * left}").ravel()
                    side = np.unique(side[~alone], return_inverse=True)[1] if not alone.all() else np.zeros(0, np.int64)
                    own = np.full(len(i), -1, np.int64)
                    own[~alone] = side
                else:
                    own = np.zeros(len(i), np.int64)
                o = np.lexsort((at[i], doc[i], own, run_[i]))
                i, own = i[o], own[o]
                s = np.flatnonzero(np.concatenate([[True], (run_[i][1:] != run_[i][:-1]) | (own[1:] != own[:-1])]))
                size = np.diff(np.append(s, len(i)))
                repeats = (doc[i[s]] != doc[i[s + size - 1]]) | (np.maximum.reduceat(many[i].astype(np.int8), s) == 1)
                lead, on = np.repeat(i[s], size), np.repeat(repeats, size)
                hit[i[on], c[i[on]]] = True
                later = on & ((doc[i] != doc[lead]) | (at[i] != at[lead]))
                copy[i[later], c[i[later]]] = True
            starts, stops = b.column("starts"), b.column("stops")
            so = np.concatenate([[0], np.cumsum(n)])
            starts, stops = starts.flatten().to_numpy(), stops.flatten().to_numpy()
            out = []
            for flag, what in ((hit, False), (copy, True)):
                edge = np.diff(np.pad(flag, ((0, 0), (1, 0))).astype(np.int8), axis=1)
                r, f = np.nonzero(edge == 1)
                _, g = np.nonzero(edge == -1)
                out.append((r, first[r] + f, first[r] + g - 1 + least, starts[so[r] + f], stops[so[r] + g - 1], np.full(len(r), what)))
            row, *cols = [np.concatenate(x) for x in zip(*out, strict=True)]
            cols = [pa.array(c.astype(t)) for c, t in zip(cols, (np.int32, np.int32, np.int32, np.int32, bool), strict=True)]
            yield pa.record_batch([b.column("doc_id").take(pa.array(row, pa.int64())), *cols], names=["doc_id", "first", "end", "start", "stop", "copy"])

    return run


def _passages(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = W - 1 + least
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                key, at, first = (part.column(c).to_numpy() for c in ("key", "at", "first"))
                words = np.frombuffer(b"".join(part.column("words").to_pylist()), np.uint32).reshape(-1, width).astype(U64)
                total = np.zeros((len(key), width + 1), U64)
                np.cumsum(words * np.cumprod(np.full(width, _BASE, U64)), axis=1, out=total[:, 1:])
                n = part.column("starts").value_lengths().to_numpy()
                row = np.repeat(np.arange(len(key)), n)
                c = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                left = (at - first)[row] - c
                begin = W - 1 - left
                h = mix((total[row, begin + least] - total[row, begin]) ^ mix(key[row].astype(U64) + left.astype(U64)))
                pick = part.take(pa.array(row))
                start, stop = part.column("starts").flatten(), part.column("stops").flatten()
                cols = [pa.array(h.astype(np.int64)), pick.column("doc_id"), pick.column("at"), pick.column("many"), pa.array((first[row] + c).astype(np.int32)), start, stop]
                yield pa.record_batch(cols, names=["passage", "doc_id", "at", "many", "first", "start", "stop"])

    return run


def _hot(fetched: DataFrame, least: int, kind: str) -> DataFrame:
    """What _extend gives, for keys of any number of suffixes: aggregates over the passages' hashes."""
    each = fetched.mapInArrow(_passages(least), f"passage bigint, doc_id {kind}, at int, many boolean, first int, start int, stop int")
    each = work_table(each, "passages")
    least_ = F.min(F.struct("doc_id", "at"))
    seen = each.groupBy("passage").agg(least_.alias("lead"), F.max("doc_id").alias("last"), F.bool_or("many").alias("many"))
    seen = seen.where(F.col("many") | (F.col("lead.doc_id") != F.col("last"))).select("passage", "lead")
    met = each.drop("many").join(seen, "passage")
    copy = (F.col("doc_id") != F.col("lead.doc_id")) | (F.col("at") != F.col("lead.at"))
    return met.select("doc_id", "first", (F.col("first") + least).alias("end"), "start", "stop", copy.alias("copy"))


def repeats(docs: DataFrame, least: int = MIN, limit: int = LIMIT) -> DataFrame:
    """(doc_id, kind, start, stop, first_word, n_words): maximal spans; start and stop are code points."""
    if least < W + K:
        raise ValueError(f"a passage must have at least {W + K} words")
    ids = ids_only(docs).where("doc_id is not null and text is not null")
    kind = type_of(ids)
    every = work_table(ids.mapInArrow(_retain(least), f"key bigint, around bigint, doc_id {kind}, at int, first int, n int, start int, stop int"), "suffixes")
    # what of each key, and of each surrounding under it, is needed: combined before it is shuffled
    spread = every.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), (F.min("around") != F.max("around")).alias("mixed"), F.count("*").alias("size"))
    spread = work_table(spread.where("a <> z").select("key", "mixed", (F.col("size") > limit).alias("hot")), "keys")
    met = work_table(every.join(spread, "key"), "met")
    whole = met.groupBy("key", "around").agg(F.min(F.struct("doc_id", "at")).alias("lead"), F.max("doc_id").alias("z"))
    whole = whole.select("key", "around", "lead", (F.col("lead.doc_id") != F.col("z")).alias("many")).where("many")
    lead = F.col("lead.doc_id").isNotNull() & (F.col("doc_id") == F.col("lead.doc_id")) & (F.col("at") == F.col("lead.at"))
    met = met.join(whole, ["key", "around"], "left").withColumn("many", F.coalesce("many", F.lit(False))).withColumn("lead", F.coalesce(lead, F.lit(False)))
    met = work_table(met.where(F.col("many") | F.col("mixed")).drop("around"), "decided")
    # of those with equal surroundings, the first speaks for all
    wanted = met.where(F.col("mixed") & (F.col("lead") | ~F.col("many"))).groupBy("doc_id").agg(F.collect_set(F.struct("key", "at", "many", "hot")).alias("wanted"))
    fetched = ids.join(wanted, "doc_id").mapInArrow(_fetch(least), f"key bigint, doc_id {kind}, at int, many boolean, hot boolean, words binary, first int, starts array<int>, stops array<int>")
    fetched = work_table(fetched, "open")
    span = f"doc_id {kind}, first int, end int, start int, stop int, copy boolean"
    found = fetched.where("not hot").repartition("key").sortWithinPartitions("key").mapInArrow(_extend(least), span)
    if not spread.where("hot").isEmpty():
        found = found.unionByName(_hot(fetched.where("hot"), least, kind))
    sure = met.where("many").select("doc_id", "first", (F.col("first") + F.col("n") - 1 + least).alias("end"), "start", "stop", (~F.col("lead")).alias("copy"))
    kinds = F.explode(F.when(F.col("copy"), F.array(F.lit("repeat"), F.lit("copy"))).otherwise(F.array(F.lit("repeat"))))
    each = sure.unionByName(found).select("doc_id", kinds.alias("kind"), "first", "end", "start", "stop")
    by = Window.partitionBy("doc_id", "kind").orderBy("first", "end")
    island = F.sum(F.col("new").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    reached = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    joined = each.withColumn("new", F.coalesce(F.col("first") > reached, F.lit(True))).withColumn("island", island)
    return joined.groupBy("doc_id", "kind", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("first").alias("first_word"), (F.max("end") - F.min("first")).alias("n_words")).drop("island")
