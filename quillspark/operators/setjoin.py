"""The set-similarity join in blocks: memory is that of two blocks, and only sets and matches are shuffled, never candidates.

Sets are packed into blocks by size; every two blocks whose sizes can match are one row, joined in a worker. Words are told
apart by 64-bit hashes: that any two of a million collide has a probability of 3 in 100 million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import reliable

#: Words of a block, at least and at most, where a set counts as LEAST words; entries that are expanded at once.
SMALL, LARGE, LEAST, AT_ONCE = 100_000, 800_000, 20, 2_000_000


def scores(i: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """similarity() of sets of a and b words that share i; 0 where they share none."""
    i = i.astype(np.float64)
    with np.errstate(invalid="ignore"):
        jac, cont = i / (a + b - i), i / np.minimum(a, b)
        return np.where(i > 0, 2 * jac * cont / (jac + cont), 0.0)


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for n[0] numbers, then the same for the others."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def _cuts(cost: np.ndarray, most: int) -> list[int]:
    """Where to part items of these costs so that parts cost no more than `most`, or are one item."""
    cuts, done = [0], 0
    total = np.cumsum(cost)
    while cuts[-1] < len(cost):
        k = max(cuts[-1] + 1, int(np.searchsorted(total, done + most, "right")))
        done = int(total[k - 1])
        cuts.append(k)
    return cuts


def _signatures(of: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """256 bits for each of n sets."""
    bits = np.unique(of * 256 + (words & 255))
    at, first = np.unique(bits >> 6, return_index=True)
    out = np.zeros(n * 4, np.uint64)
    if len(bits):
        out[at] = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (bits & 63).astype(np.uint64)), first)
    return out.reshape(n, 4)


def joined(lw: np.ndarray, ln: np.ndarray, rw: np.ndarray, rn: np.ndarray, t: float, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in left and right, and scores, of all pairs of sets that score t or more. Sets lie one behind the other in lw
    and rw, with ln and rn words each. same: left is right; each pair comes once, the lower place first.

    Words are ordered by how many right sets have them, those that none has first. A pair must share one of the first words
    that the overlap it needs leaves over; where those aren't rarer than all words by far, all are counted instead."""
    nl, nr = len(ln), len(rn)
    vocab, inv, freq = np.unique(rw, return_inverse=True, return_counts=True)
    if not nl or not len(vocab):
        return
    rank = np.empty(len(vocab), np.int64)
    rank[np.lexsort((vocab, freq))] = np.arange(1, len(vocab) + 1)
    width = len(vocab) + 1
    at = np.minimum(np.searchsorted(vocab, lw), len(vocab) - 1)
    l_of, r_of = np.repeat(np.arange(nl), ln), np.repeat(np.arange(nr), rn)
    lcode, rcode = np.sort(l_of * width + np.where(vocab[at] == lw, rank[at], 0)), np.sort(r_of * width + rank[inv])
    lrank, rrank = lcode % width, rcode % width
    l0, r0 = np.cumsum(ln) - ln, np.cumsum(rn) - rn
    first = lambda n: n - np.ceil(t * n / (2 - t) - 1e-9).astype(np.int64) + 1
    l_first, r_first = (np.arange(len(lw)) - l0[l_of] < first(ln)[l_of]) & (lrank > 0), np.arange(len(rw)) - r0[r_of] < first(rn)[r_of]

    def posted(keep: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of, ranks = r_of[keep], rrank[keep]
        n = np.bincount(ranks, minlength=width)
        return of[np.argsort(ranks, kind="stable")], np.cumsum(n) - n, n

    few, every = posted(r_first), posted(slice(None))
    dense = every[2][lrank].sum() <= 8 * few[2][lrank[l_first]].sum()
    if dense:
        for lo in range(0, nl, step := max(1, AT_ONCE // nr)):
            hi = min(nl, lo + step)
            own = slice(l0[lo], l0[hi - 1] + ln[hi - 1])
            counts = np.zeros((hi - lo) * nr, np.int64)
            n = every[2][lrank[own]]
            cuts = _cuts(n, AT_ONCE)
            for x, y in zip(cuts, cuts[1:], strict=False):
                m = n[x:y]
                to = every[0][_ranges(every[1][lrank[own][x:y]], m)]
                counts += np.bincount(np.repeat(l_of[own][x:y] - lo, m) * nr + to, minlength=len(counts))
            hit = np.flatnonzero(counts)
            li, ri = hit // nr + lo, hit % nr
            if same:
                hit, li, ri = (x[up] for up in [li < ri] for x in (hit, li, ri))
            s = scores(counts[hit], ln[li], rn[ri])
            ok = s >= t - 1e-9  # 3 of 5 words is 0.75, whatever rounding says
            yield li[ok], ri[ok], s[ok]
        return
    ls, rs = _signatures(l_of, lw, nl), _signatures(r_of, rw, nr)
    e_of, e_rank = l_of[l_first], lrank[l_first]
    n = few[2][e_rank]
    cuts = _cuts(np.bincount(e_of, n, nl).astype(np.int64), AT_ONCE)
    ends = np.searchsorted(e_of, cuts)
    for x, y in zip(ends, ends[1:], strict=False):
        m = n[x:y]
        pair = np.unique(np.repeat(e_of[x:y], m) * nr + few[0][_ranges(few[1][e_rank[x:y]], m)])
        li, ri = pair // nr, pair % nr
        if same:
            li, ri = (z[up] for up in [li < ri] for z in (li, ri))
        apart = np.bitwise_count(ls[li] ^ rs[ri]).sum(1, dtype=np.int64)  # words that only one has are so many at least
        most = np.minimum((ln[li] + rn[ri] - apart) // 2, np.minimum(ln[li], rn[ri]))
        li, ri = (z[ok] for ok in [(most > 0) & (scores(np.maximum(most, 0), ln[li], rn[ri]) >= t - 1e-9)] for z in (li, ri))
        parts = _cuts(ln[li], AT_ONCE)
        for u, v in zip(parts, parts[1:], strict=False):
            a, b = li[u:v], ri[u:v]
            ranks = lrank[_ranges(l0[a], ln[a])]
            code = np.repeat(b, ln[a]) * width + ranks
            found = (rcode[np.minimum(np.searchsorted(rcode, code), len(rcode) - 1)] == code) & (ranks > 0)
            s = scores(np.bincount(np.repeat(np.arange(len(a)), ln[a]), found, len(a)), ln[a], rn[b])
            ok = s >= t - 1e-9
            yield a[ok], b[ok], s[ok]


def _packed(sets: DataFrame, p: str) -> DataFrame:
    """Blocks ({p}b, {p}lo, {p}hi, p) of sets (id, w): number, sizes of the smallest and the largest set, and the sets."""
    own = reliable(sets.select("id", "w", F.size("w").alias("n")).where("n > 0"))
    sizes = sorted((r["n"], r["count"] * max(LEAST, r["n"])) for r in own.groupBy("n").count().collect())
    block = min(LARGE, max(SMALL, sum(w for _, w in sizes) // 16))
    rows, done = [], 0
    for n, w in sizes:
        rows.append((n, float(done), float(w)))
        done += w
    at = own.sparkSession.createDataFrame(rows, "n int, done double, w0 double")
    number = F.floor((F.col("done") + F.col("w0") * F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003) / block).cast("int")
    placed = own.join(F.broadcast(at), "n").select(number.alias(f"{p}b"), "n", F.struct("id", "w").alias("s"))
    return placed.repartition(min(400, int(done // block) + 1), f"{p}b").groupBy(f"{p}b").agg(F.min("n").alias(f"{p}lo"), F.max("n").alias(f"{p}hi"), F.collect_list("s").alias(p))


def matches(left: DataFrame, right: DataFrame | None, t: float) -> DataFrame:
    """(l, r, score) of the ids of all sets (id, w) of both sides that score t or more; w: arrays of distinct hashes, ids
    BIGINT. Without right, of all pairs of left, each once, l < r."""
    same = right is None
    a = _packed(left, "a")
    b = a.toDF("bb", "blo", "bhi", "b") if same else _packed(right, "b")
    near = (F.col("blo") <= F.col("ahi") * ((2 - t) / t) + 1e-6) & (F.col("bhi") >= F.col("alo") * (t / (2 - t)) - 1e-6)
    met = a.join(b.hint("shuffle_replicate_nl"), near & (F.col("ab") <= F.col("bb")) if same else near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(x: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows = x.values
            w = rows.field("w")
            return rows.field("id").to_numpy(zero_copy_only=False), w.flatten().to_numpy(zero_copy_only=False), np.diff(w.offsets.to_numpy()).astype(np.int64)

        for batch in batches:
            for k in range(batch.num_rows):
                (ai, aw, an), (bi, bw, bn) = side(batch.column("a")[k]), side(batch.column("b")[k])
                for x, y, s in joined(aw, an, bw, bn, t, same and batch.column("ab")[k] == batch.column("bb")[k]):
                    u, v = ai[x], bi[y]
                    if same:
                        u, v = np.minimum(u, v), np.maximum(u, v)
                    yield pa.record_batch({"l": pa.array(u), "r": pa.array(v), "score": pa.array(s)})

    return met.select("ab", "bb", "a", "b").mapInArrow(run, "l bigint, r bigint, score double")
