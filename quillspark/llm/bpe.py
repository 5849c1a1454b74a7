"""BPE encoding and decoding over a memory-mapped lexicon.

Texts are split into pre-tokens by the usual byte-level pattern (contractions; letters, digits or others, each with one
blank before; white space), for whole batches with NumPy. The most frequent pre-tokens of the corpus, counted over all
documents, are compiled into a minimal acyclic transducer: equal suffixes share states, and the numbers on the arcs of
a path add up to the word's rank, which leads to its token ids. The automaton is laid out as a double array in one file
in the shared folder; Spark hands it to every executor, which maps it into memory. All words of a slice walk through it
together, a byte at a time. Words it lacks are merged exactly, by rank, in the worker.

Defined results: null text -> null ids, null count and null `exact`; empty text -> no ids; ids decode to the same bytes
(`exact`); one row for each row, null or repeated ids included; an empty table gives an empty result. The result is
that of the vocabulary's own library, whatever words the lexicon holds.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import raw, small_batches, span_hashes, text_slices, work_path, work_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEXICON_WORDS = 100_000
LONGEST_WORD = 48
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OTHER, LETTER, DIGIT, SPACE = range(4)
NO_PAIR = np.int64(1) << 40


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4")
    every, out = points.tobytes().decode("utf-32-le"), np.zeros(0x110000, np.uint8)
    for cls, pat in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pat, every):
            out[points[m.start() : m.end()]] = cls
    return out


def pretokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each pre-token of the texts in data, cut at off; the first pre-token of each text (n + 1)."""
    cp = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    n, c = len(cp), classes()[cp]
    doc = np.searchsorted(byte, off)
    edge = np.zeros(n + 1, bool)
    edge[doc] = True
    cut = np.zeros(n + 3, bool)
    cut[:n] = edge[:n]
    cut[1:n] |= c[1:] != c[:-1]
    last = np.flatnonzero((c == SPACE) & ~edge[1:] & np.append(c[1:] != SPACE, True)) if n else np.zeros(0, int)
    cut[last] = True  # the last of a run of white space goes with what follows, or stays alone
    joined = last[cp[last] == 32]
    cut[joined + 1] = False
    tick = np.flatnonzero((cp == 39) & cut[:n] & ~edge[1:])
    tick = tick[c[tick + 1] == LETTER] if len(tick) else tick
    if len(tick):
        pad = np.append(cp, [0, 0, 0])
        a, b, inside = pad[tick + 1], pad[tick + 2], ~edge[np.minimum(tick + 2, n)]
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = np.zeros(len(tick), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y)) & inside
        cut[tick[one | two] + 1] = False
        cut[tick[one] + 2] = True
        cut[tick[two] + 3] = True
    cut = cut[: n + 1] | edge
    at = np.flatnonzero(cut[:n])
    start = byte[at]
    return start, np.append(start[1:], len(data)), np.searchsorted(at, doc)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (1 + max(int(r) for _, r in pairs))
    for t, r in pairs:
        out[int(r)] = base64.b64decode(t)
    return out


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact byte-pair merging: always the pair of least rank, the leftmost of equal ones."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks) + 1 << 20
    pair = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pair:
        low = min(pair)
        if low == none:
            break
        i = pair.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap, for words of any length."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n + [False]
    while heap:
        r, i, e = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or end[j] != e or ranks.get(word[i:e]) != r:
            continue
        alive[j], end[i], after[i] = False, e, after[j]
        if after[i] < n:
            before[after[i]] = i
            k = end[after[i]]
            if (r := ranks.get(word[i:k])) is not None:
                heapq.heappush(heap, (r, i, k))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:e])) is not None:
            heapq.heappush(heap, (r, p, e))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def minimal_automaton(words: Iterable[bytes]) -> tuple[list[dict[int, int]], list[bool], int]:
    """States (arcs by byte), which of them are final, and the start: the smallest automaton of words, sorted and distinct."""
    arcs: list[dict[int, int]] = [{}]
    final, known, path, prev = [False], {}, [0], b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            s = path.pop()
            key = (final[s], *arcs[s].items())
            same = known.setdefault(key, s)
            if same != s:
                arcs[path[-1]][prev[len(path) - 1]] = same
                free.append(s)

    free: list[int] = []
    for w in words:
        k = 0
        m = min(len(w), len(prev))
        while k < m and w[k] == prev[k]:
            k += 1
        close(k)
        for b in w[k:]:
            if free:
                s = free.pop()
                arcs[s], final[s] = {}, False
            else:
                s = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[path[-1]][b] = s
            path.append(s)
        final[path[-1]] = True
        prev = w
    close(0)
    return arcs, final, 0


def _double_array(arcs: list[dict[int, int]], final: list[bool], start: int) -> np.ndarray:
    """Rows (check, target, output, final): state s goes over byte b to row s + b if that row's check is s."""
    order, seen = [], {start}
    todo = [start]
    while todo:
        s = todo.pop()
        order.append(s)
        for t in arcs[s].values():
            if t not in seen:
                seen.add(t)
                todo.append(t)
    count: dict[int, int] = {}

    def reach(s: int) -> int:
        if s not in count:
            stack = [s]
            while stack:
                x = stack[-1]
                wait = [t for t in arcs[x].values() if t not in count]
                if wait:
                    stack += wait
                else:
                    stack.pop()
                    count[x] = final[x] + sum(count[t] for t in arcs[x].values())
        return count[s]

    reach(start)
    base, used, taken = {start: 1}, bytearray(4096), {1}
    for b in arcs[start]:
        used[1 + b] = 1
    low = 2
    for s in sorted((s for s in order if s != start), key=lambda s: -len(arcs[s])):
        labels = list(arcs[s])
        x, tries = low, 0
        while x in taken or any(used[x + b] for b in labels):
            x += 1
            tries += 1
            if x + 256 >= len(used):
                used.extend(bytes(len(used)))
        if tries > 400:
            low += tries // 4
        while x + 512 >= len(used):
            used.extend(bytes(len(used)))
        base[s] = x
        taken.add(x)
        for b in labels:
            used[x + b] = 1
    table = np.zeros((max(base.values()) + 257, 4), np.int32)
    for s in order:
        passed = int(final[s])
        for b in sorted(arcs[s]):
            t = arcs[s][b]
            table[base[s] + b] = (base[s], base[t], passed, final[t])
            passed += count[t]
    return table


def compile_lexicon(words: Iterable[bytes], tokens: list[bytes]) -> bytes:
    """The file: lengths of its parts, the transducer, the ids of each word by rank, the vocabulary."""
    ranks = {t: i for i, t in enumerate(tokens) if t}
    words = sorted({w for w in words if w})
    ids = [merge(w, ranks) for w in words]
    parts = [
        _double_array(*minimal_automaton(words)).ravel(),
        np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32),
        np.array([x for i in ids for x in i], np.int32),
        np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32),
    ]
    last = b"".join(tokens)
    head = np.array([*(len(p) for p in parts), len(last)], np.int64)
    return head.tobytes() + b"".join(p.astype(np.int32).tobytes() for p in parts) + last


class Coder:
    """Encodes and decodes with a mapped lexicon file."""

    def __init__(self, path: str):
        mapped = np.memmap(path, np.uint8, "r")
        head = mapped[:40].view(np.int64)
        at, parts = 40, []
        for n in head[:4]:
            parts.append(np.asarray(mapped[at : at + 4 * n]).view(np.int32))
            at += 4 * int(n)
        self.table, self.word_off, self.word_ids, off = parts
        self.table = self.table.reshape(-1, 4)
        self.token_off, self.token_bytes = off.astype(np.int64), np.asarray(mapped[at : at + int(head[4])])
        joined = self.token_bytes.tobytes()
        self.ranks = {joined[a:b]: i for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)) if b > a}
        self.bytes_ = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {(self.ranks[t[:i]] << 32) | self.ranks[t[i:]]: r for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks}
        self.pair_bits = max(8, len(pairs).bit_length() + 2)
        self.pair_key, self.pair_rank = np.full(1 << self.pair_bits, -1, np.int64), np.zeros(1 << self.pair_bits, np.int64)
        key, rank = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
        at = self._slot(key)
        while len(key):  # open addressing: of those that want a slot, one gets it if it's free, the others go on
            free = self.pair_key[at] < 0
            self.pair_key[at[free]], self.pair_rank[at[free]] = key[free], rank[free]
            on = self.pair_key[at] != key
            self.pair_rank[at[~on]] = rank[~on]
            key, rank, at = key[on], rank[on], (at[on] + 1) & ((1 << self.pair_bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.pair_bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's union, or NO_PAIR."""
        key = (left << 32) | right
        at, out, live = self._slot(key), np.full(len(key), NO_PAIR), np.arange(len(key))
        while len(live):
            found = self.pair_key[at]
            hit = found == key
            out[live[hit]] = self.pair_rank[at[hit]]
            on = ~hit & (found >= 0)
            live, key, at = live[on], key[on], (at[on] + 1) & ((1 << self.pair_bits) - 1)
        return out

    def merge_many(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """merge() for many words of one byte or more that are no tokens themselves, in step: (ids of each, all ids)."""
        size = end - start
        word = np.repeat(np.arange(len(start)), size)
        sym = self.bytes_[data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]]
        done_word, done_sym = [], []
        rank = np.full(len(sym), NO_PAIR)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.pair_ranks(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, first)
            n = np.diff(np.append(first, len(sym)))
            on = np.repeat(low < NO_PAIR, n)
            if not on.all():
                done_word.append(word[~on])
                done_sym.append(sym[~on])
                word, sym, rank, low, n = word[on], sym[on], rank[on], low[low < NO_PAIR], n[low < NO_PAIR]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, n))
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])]
            sym[hit] = low
            gone = np.ones(len(sym), bool)
            gone[hit + 1] = False
            at = hit - np.arange(len(hit))
            word, sym, rank = word[gone], sym[gone], rank[gone]
            at = np.concatenate([at, at - 1])
            at = at[at >= 0]
            last = at + 1 >= len(word)
            rank[at[last]] = NO_PAIR
            at = at[~last]
            inside = word[at] == word[at + 1]
            rank[at[~inside]] = NO_PAIR
            rank[at[inside]] = self.pair_ranks(sym[at[inside]], sym[at[inside] + 1])
        if not done_word:
            return np.zeros(len(start), np.int64), np.zeros(0, np.int32)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        return np.bincount(word, minlength=len(start)), sym[np.argsort(word, kind="stable")].astype(np.int32)

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rank of each byte span in the lexicon, or -1."""
        out = np.full(len(start), -1, np.int64)
        live = np.flatnonzero(end > start)
        at, stop = start[live], end[live]
        state, total = np.ones(len(live), np.int64), np.zeros(len(live), np.int64)
        while len(live):
            row = self.table[state + data[at]]
            at = at + 1
            total = total + row[:, 2]
            known, over = row[:, 0] == state, at == stop
            hit = known & over & (row[:, 3] == 1)
            out[live[hit]] = total[hit]
            go = np.flatnonzero(known & ~over)
            live, at, stop, total, state = live[go], at[go], stop[go], total[go], row[go, 1].astype(np.int64)
        return out

    def pieces(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start of each pre-token, first pre-token of each text, number of ids of each pre-token, all ids."""
        start, end, first = pretokens(data, off)
        count, ids = self._ids(data, start, end)
        return start, first, count, ids

    def counts(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Number of ids of each pre-token, all of data being cut at start."""
        return self._ids(data, start, np.append(start[1:], len(data)))[0]

    def _ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        rank = self.lookup(data, start, end)
        new = np.flatnonzero(rank < 0)
        whole, ranks = data.tobytes(), self.ranks
        own = [whole[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
        one = np.array([ranks.get(w, -1) for w in own], np.int64)
        step = np.flatnonzero((one < 0) & (end[new] - start[new] <= LONGEST_WORD))
        long = {int(i): merge(own[i], ranks) for i in np.flatnonzero((one < 0) & (end[new] - start[new] > LONGEST_WORD))}
        n_step, ids_step = self.merge_many(data, start[new][step], end[new][step])
        lens = np.ones(len(new), np.int64)
        lens[step] = n_step
        for i, x in long.items():
            lens[i] = len(x)
        into = np.cumsum(lens) - lens
        new_ids = np.zeros(int(lens.sum()), np.int32)
        new_ids[into[one >= 0]] = one[one >= 0]
        new_ids[np.repeat(into[step] - (np.cumsum(n_step) - n_step), n_step) + np.arange(len(ids_step))] = ids_step
        for i, x in long.items():
            new_ids[into[i] : into[i] + len(x)] = x
        begin, count = self.word_off[rank].astype(np.int64), (self.word_off[np.minimum(rank + 1, len(self.word_off) - 1)] - self.word_off[rank]).astype(np.int64)
        begin[new], count[new] = len(self.word_ids) + into, lens
        pool = np.concatenate([self.word_ids, new_ids])
        into = np.cumsum(count) - count
        ids = pool[np.repeat(begin - into, count) + np.arange(int(count.sum()))]
        return count, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the first id of each text (n + 1), and whether each text comes back from them."""
        data, off = raw(texts)
        start, first, count, ids = self.pieces(data, off)
        upto = np.concatenate([[0], np.cumsum(count)])[first]
        back, back_off = self.decode(ids, upto)
        if np.array_equal(back, data):
            return ids, upto, np.ones(len(texts), bool)
        return ids, upto, np.array([np.array_equal(back[a:b], data[c:d]) for a, b, c, d in zip(back_off[:-1], back_off[1:], off[:-1], off[1:], strict=True)], bool)

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ids, and where each text, whose first id is in off, begins (n + 1)."""
        begin = self.token_off[ids]
        n = self.token_off[ids + 1] - begin
        into = np.concatenate([[0], np.cumsum(n)])
        return self.token_bytes[np.repeat(begin - into[:-1], n) + np.arange(into[-1])], into[off]


_coders: dict[str, Coder] = {}


def coder(name: str) -> Coder:
    """In a worker: the coder of a file that was added to the session."""
    if name not in _coders:
        _coders.clear()  # a worker serves one lexicon after the other
        _coders[name] = Coder(SparkFiles.get(name))
    return _coders[name]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in text_slices(b, most=16 << 20):
            keep, marks = [], []
            for lo2, hi2 in text_slices(b.slice(lo, hi - lo)):
                data, off = raw(b.column("text").slice(lo + lo2, hi2 - lo2))
                start, end, _ = pretokens(data, off)
                h, i, n = np.unique(span_hashes(data, start, end), return_index=True, return_counts=True)
                s, e = start[i], end[i]
                size = e - s
                packed = data[np.repeat(s - (np.cumsum(size) - size), size) + np.arange(size.sum())]
                keep.append((packed, size))
                marks.append((h, n))
            h, n = (np.concatenate(x) for x in zip(*marks, strict=True))
            size, data = np.concatenate([k[1] for k in keep]), np.concatenate([k[0] for k in keep])
            _, i, inv = np.unique(h, return_index=True, return_inverse=True)
            total, s = np.bincount(inv, weights=n).astype(np.int64), np.cumsum(size) - size
            pick = size[i] <= LONGEST_WORD  # longer words are never compiled, so needn't be counted
            i, total = i[pick], total[pick]
            at = np.concatenate([[0], np.cumsum(size[i])])
            packed = data[np.repeat(s[i] - at[:-1], size[i]) + np.arange(at[-1])]
            words = pa.BinaryArray.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
            yield pa.record_batch({"word": words, "n": pa.array(total)})


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the pre-tokens of at most LONGEST_WORD bytes of all texts."""
    small_batches(docs.sparkSession)
    own = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    return own.mapInArrow(_count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def add_lexicon(spark: SparkSession, content: bytes) -> str:
    """Writes a lexicon to the shared folder and hands it to all executors; its name there."""
    uri = work_path(spark, "lexicon")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    for i in range(0, len(content), 1 << 22):
        out.write(bytearray(content[i : i + (1 << 22)]))
    out.close()
    spark.sparkContext.addFile(uri)
    return uri.rsplit("/", 1)[1]


def build_lexicon(docs: DataFrame, vocabulary: str = VOCABULARY, words: int = LEXICON_WORDS) -> str:
    """Compiles the most frequent words of docs, `words` at most, equally frequent ones all or none; the name of the file."""
    counts = work_table(word_counts(docs).where("n > 1"), "words")  # a sort would send `words` rows of each partition to the driver
    least, total = 2, 0
    for r in counts.groupBy("n").count().orderBy(F.col("n").desc()).toLocalIterator():
        total += r["count"]
        if total > words:
            least = r.n + 1
            break
    top = counts.where(F.col("n") >= least).select("word")
    return add_lexicon(docs.sparkSession, compile_lexicon((bytes(r.word) for r in top.collect()), read_ranks(vocabulary)))


def _encode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = coder(name)
        for b in batches:
            for lo, hi in text_slices(b):
                text = b.column("text").slice(lo, hi - lo)
                ids, off, same = z.encode(text)
                null = text.is_null().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids), mask=pa.array(null))
                yield pa.record_batch({"doc_id": b.column("doc_id").slice(lo, hi - lo), "ids": lists, "n_tokens": pa.array(np.diff(off), pa.int64(), mask=null), "exact": pa.array(same, mask=null)})

    return run


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, words: int = LEXICON_WORDS, lexicon: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, exact), a row for each row."""
    small_batches(docs.sparkSession)
    name = lexicon or build_lexicon(docs, vocabulary, words)
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_encode(name), f"doc_id {own.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_tokens bigint, exact boolean")


def _decode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = coder(name)
        for b in batches:
            lists = b.column("ids")
            n = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            data, off = z.decode(ids, np.concatenate([[0], np.cumsum(n)]))
            whole = data.tobytes()
            texts = [whole[a:e].decode(errors="replace") if ok else None for a, e, ok in zip(off[:-1], off[1:], lists.is_valid().to_pylist(), strict=True)]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "text": pa.array(texts, pa.string())})

    return run


def decode(encoded: DataFrame, lexicon: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(lexicon), f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")
