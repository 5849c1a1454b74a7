"""Edit-aware token counts.

For each document a segment tree is kept over leaves of `LEAF` pre-tokens; every node has the bytes and the tokens below
it (two arrays in heap order, node 1 is the root). An edit re-splits and re-encodes only the leaves it touches, from the
leaf with the last two characters before it up to the first old leaf boundary after it that is also a boundary of the
new split (from there on the split can't differ), with one leaf of context beyond; then the sums on the paths from those
leaves to the root are set anew. If the text under some leaves outgrows four times their size, the leaves are dealt
anew, without encoding anything else. The text itself is a stack of pieces, edits being applied from its end, so none
copies more than the bytes around it.

Edits are (start, stop, replacement) in code points of the original text, in any order. Defined results: edits are
clipped to the text; those with a null part, with start > stop, or that overlap one that starts earlier are skipped
(of equal starts the first of the list counts); a null text has a null tree and null counts; an empty text has 0 tokens;
rows with repeated or null ids, of any type, are counted each for itself; other columns are ignored; long texts and long
words take time in proportion to their length; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.bpe import LEXICON_WORDS, VOCABULARY, Coder, build_lexicon, coder, pretokens
from quillspark.llm.common import raw, text_slices, type_of

LEAF, CONTEXT, NEAR = 32, 8, 256
EDIT = "array<struct<start: int, stop: int, replacement: string>>"
_EDIT = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("replacement", pa.string())]))
#: E-mail addresses; numbers of nine digits or more; keys with a common prefix. An address begins where no character of its
#: kind stands before, and its parts give nothing back, so that no text takes quadratic time.
SECRETS = regex.compile(r"(?<mail>(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)+)|(?<number>\d{9,})|(?<key>(?:sk|pk|ghp|AKIA)[-_]?[A-Za-z0-9]{16,})")


class CountTree:
    """Bytes and tokens of a text's leaves, with the sums above them."""

    def __init__(self, size: np.ndarray, tokens: np.ndarray):
        self.size, self.tokens = size, tokens

    @classmethod
    def of_leaves(cls, size: np.ndarray, tokens: np.ndarray) -> CountTree:
        cap = 1 << max(0, int(len(size) - 1).bit_length())
        trees = []
        for x in (size, tokens):
            t = np.zeros(2 * cap, np.int32)
            t[cap : cap + len(x)] = x
            lo = cap
            while lo > 1:
                t[lo // 2 : lo] = t[lo : 2 * lo].reshape(-1, 2).sum(axis=1)
                lo //= 2
            trees.append(t)
        return cls(*trees)

    @property
    def cap(self) -> int:
        return len(self.size) // 2

    def leaf_at(self, byte: int) -> tuple[int, int]:
        """The leaf that holds a byte (the last one that isn't empty, beyond the end), and its first byte."""
        byte, node, first = min(max(byte, 0), max(int(self.size[1]) - 1, 0)), 1, 0
        while node < self.cap:
            node *= 2
            if byte - first >= self.size[node]:
                first += int(self.size[node])
                node += 1
        return node - self.cap, first

    def set(self, leaf: int, size: int, tokens: int) -> None:
        node = leaf + self.cap
        by_size, by_tokens = size - int(self.size[node]), tokens - int(self.tokens[node])
        while node:
            self.size[node] += by_size
            self.tokens[node] += by_tokens
            node //= 2

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return self.size[self.cap :], self.tokens[self.cap :]


def _dealt(start: np.ndarray, stop: int, count: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of leaves of `per` pre-tokens."""
    first = np.arange(0, len(start), per)
    edge = np.append(start[first], stop)
    return np.diff(edge), np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)


def build_tree(start: np.ndarray, stop: int, count: np.ndarray) -> CountTree:
    return CountTree.of_leaves(*_dealt(start, stop, count, LEAF))


class Pieces:
    """A text whose end is edited first: original[:cut], then the pieces of a stack, the last of them first."""

    def __init__(self, original: bytes):
        self.original, self.cut, self.stack = memoryview(original), len(original), []

    def tail(self, size: int) -> bytes:
        """The first bytes behind the cut."""
        out = []
        for p in reversed(self.stack):
            if size <= 0:
                break
            out.append(p[:size])
            size -= len(p)
        return b"".join(out)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """original[start:stop], before the cut, gives way to new; the cut moves to start."""
        self.stack += [p for p in (self.original[stop : self.cut], memoryview(new)) if len(p)]
        self.cut = start

    def whole(self) -> bytes:
        return b"".join([self.original[: self.cut], *reversed(self.stack)])


def edit(tree: CountTree, text: Pieces, start: int, stop: int, new: bytes, z: Coder) -> tuple[CountTree, int]:
    """The tree with text[start:stop] (bytes, before the cut) replaced, as in text, and how many bytes were encoded again."""
    total, shift = int(tree.size[1]), len(new) - (stop - start)
    text.replace(start, stop, new)
    if not total:
        data = np.frombuffer(new, np.uint8)
        begin, _, count, _ = z.pieces(data, np.array([0, len(data)]))
        return build_tree(begin, len(data), count), len(new)
    i, first = tree.leaf_at(start - CONTEXT)
    j, at = tree.leaf_at(stop)
    sizes, _ = tree.leaves()
    end, step = at + int(sizes[j]), 1
    while True:
        ahead, k = end, j
        while ahead < total and ahead < end + CONTEXT:
            k += 1
            ahead += int(sizes[k])
        data = np.frombuffer(bytes(text.original[first:start]) + text.tail(ahead + shift - start), np.uint8)
        begin, _, _ = pretokens(data, np.array([0, len(data)]))
        if end == total or np.any(begin == end + shift - first):
            break
        more = min(j + step, len(sizes) - 1)
        end, j, step = end + int(sizes[j + 1 : more + 1].sum()), more, 2 * step
    begin = begin[begin < end + shift - first]
    data = data[: end + shift - first]
    count = z.counts(data, begin)
    n = j - i + 1
    per = max(1, -(-len(begin) // n))
    size, tokens = _dealt(begin, len(data), count, per)
    if per > 4 * LEAF:
        size, tokens = _dealt(begin, len(data), count, LEAF)
        old_size, old_tokens = tree.leaves()
        tree = CountTree.of_leaves(*(np.concatenate([o[:i], x, o[j + 1 :]]) for o, x in ((old_size, size), (old_tokens, tokens))))
    else:
        for k in range(n):
            tree.set(i + k, int(size[k]) if k < len(size) else 0, int(tokens[k]) if k < len(size) else 0)
    return tree, len(data)


def apply_all(tree: CountTree, text: str, edits: Sequence[tuple], z: Coder) -> tuple[CountTree, str, int, int]:
    """Tree, text, edits applied, bytes encoded again."""
    todo, free = [], 0
    for s, e, r in sorted((x for x in edits if None not in x), key=lambda x: x[0]):
        s, e = min(max(s, 0), len(text)), min(max(e, 0), len(text))
        if s <= e and s >= free:
            todo.append((s, e, r))
            free = max(e, s)
    pieces, again = Pieces(text.encode()), 0
    marks = sorted({p for s, e, _ in todo for p in (s, e)})
    byte, at, done = {}, 0, 0
    for p in marks:
        done += len(text[at:p].encode())
        byte[p], at = done, p
    near: list[tuple[int, int, list]] = []  # edits less than NEAR bytes apart share leaves; they are one edit
    for s, e, r in todo:
        s, e, r = byte[s], byte[e], r.encode()
        if near and s - near[-1][1] < NEAR:
            a, b, q = near[-1]
            q += [pieces.original[b:s], r]
            near[-1] = (a, e, q)
        else:
            near.append((s, e, [r]))
    for s, e, r in reversed(near):  # from the end, so that the offsets before an edit still hold
        tree, n = edit(tree, pieces, s, e, b"".join(r), z)
        again += n
    return tree, pieces.whole().decode(), len(todo), again


def secrets(text: str) -> list[tuple[int, int, str]]:
    """Edits that take out addresses, long numbers and keys."""
    return [(m.start(), m.end(), f"<{m.lastgroup}>") for m in SECRETS.finditer(text)]


def _build(name: str, edits_of: Callable | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = coder(name)
        for b in batches:
            for lo, hi in text_slices(b):
                text = b.column("text").slice(lo, hi - lo)
                data, off = raw(text)
                start, first, count, _ = z.pieces(data, off)
                size, tokens, edits = [], [], []
                for k, t in enumerate(text.to_pylist()):
                    if t is None:
                        size.append(None), tokens.append(None), edits.append(None)
                        continue
                    x = slice(first[k], first[k + 1])
                    tree = build_tree(start[x] - off[k], off[k + 1] - off[k], count[x])
                    size.append(tree.size), tokens.append(tree.tokens)
                    edits.append([dict(zip(("start", "stop", "replacement"), e, strict=True)) for e in edits_of(t)] if edits_of else [])
                cols = [b.column("doc_id").slice(lo, hi - lo), text, pa.array(size, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())), pa.array(edits, _EDIT)]
                yield pa.record_batch(cols, names=["doc_id", "text", "tree_bytes", "tree_tokens", "edits"])

    return run


def _apply(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = coder(name)
        for b in batches:
            for lo, hi in text_slices(b):
                part = b.slice(lo, hi - lo)
                rows: list[list] = [[] for _ in range(6)]
                for t, s, n, edits in zip(part.column("text").to_pylist(), *(part.column(c) for c in ("tree_bytes", "tree_tokens", "edits")), strict=True):
                    if t is None:
                        got = (None,) * 6
                    else:
                        tree = CountTree(*(np.array(x.values.to_numpy(zero_copy_only=False)) for x in (s, n)))
                        todo = [tuple(e.values()) for e in edits.as_py() or [] if e is not None]
                        tree, t, k, again = apply_all(tree, t, todo, z) if todo else (tree, t, 0, 0)
                        got = (t, tree.size, tree.tokens, int(tree.tokens[1]), k, again)
                    for x, y in zip(rows, got, strict=True):
                        x.append(y)
                types = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int64())
                yield pa.record_batch([part.column("doc_id"), *(pa.array(x, t) for x, t in zip(rows, types, strict=True))], names=["doc_id", "text", "tree_bytes", "tree_tokens", "n_tokens", "n_edits", "bytes_reencoded"])

    return run


def trees(docs: DataFrame, lexicon: str, edits_of: Callable[[str], list[tuple]] | None = None) -> DataFrame:
    """(doc_id, text, tree_bytes, tree_tokens, edits): tree_tokens[1] (0-based) is the document's count; edits are what edits_of finds."""
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_build(lexicon, edits_of), f"doc_id {type_of(own)}, text string, tree_bytes array<int>, tree_tokens array<int>, edits {EDIT}")


def apply_edits(trees: DataFrame, lexicon: str) -> DataFrame:
    """Rows of trees() with edits applied: (doc_id, text, tree_bytes, tree_tokens, n_tokens, n_edits, bytes_reencoded)."""
    own = trees.select("doc_id", "text", "tree_bytes", "tree_tokens", "edits")
    return own.mapInArrow(_apply(lexicon), f"doc_id {type_of(own)}, text string, tree_bytes array<int>, tree_tokens array<int>, n_tokens bigint, n_edits int, bytes_reencoded bigint")


def redacted_counts(docs: DataFrame, vocabulary: str = VOCABULARY, words: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, n_tokens, n_edits, bytes_reencoded) after secrets() are taken out of every text."""
    name = build_lexicon(docs, vocabulary, words)
    return apply_edits(trees(docs, name, secrets), name).select("doc_id", "n_tokens", "n_edits", "bytes_reencoded")
