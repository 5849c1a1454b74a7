"""What the operators share: scratch tables, batch slices, word hashes.

A *word* is a maximal run of ASCII letters, digits, underscores and non-ASCII characters of the lower-cased text.
Word hashes are computed for whole Arrow batches with NumPy; no Python loop runs over words.
"""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 18
U64 = np.uint64
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95]] = True
_WORD[128:] = True
_LOW = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=U64)
_own_dir: list[str] = []
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it names none, one of our own, on a local master
    only: the executors of a cluster wouldn't share it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="quill"))
        atexit.register(shutil.rmtree, _own_dir[0], True)
    return "file://" + _own_dir[0]


def work_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/quill-{tag}-{uuid.uuid4().hex}"


def work_table(df: DataFrame, tag: str) -> DataFrame:
    """Runs df once and cuts its lineage: written as Parquet to the shared folder, so it outlives any executor."""
    path = work_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with at most so many bytes of text, one row at least."""
    a = batch.column(column)
    size = np.cumsum(pc.fill_null(pc.binary_length(a), 0).to_numpy(zero_copy_only=False))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + most, "right")))
        yield lo, min(hi, n)
        lo = hi
    release()


def release() -> None:
    """Gives memory that a batch no longer needs back to the system: workers live on, side by side with the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def raw(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets; null counts as empty."""
    a = pc.fill_null(a.cast(pa.large_string()), "")
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64 bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes at a time."""
    length = end - start
    h = mix(length.astype(U64) + U64(0x9E3779B97F4A7C15))
    if not len(start):
        return h
    at = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
    live = np.flatnonzero(length > 0)
    done = 0
    while len(live):
        chunk = at[start[live] + done] & _LOW[np.minimum(length[live] - done, 8)]
        h[live] = mix((h[live] ^ chunk) * U64(0xD6E8FEB86659FD93))
        done += 8
        live = live[length[live] > done]
    return h


class Words:
    """Words of a slice of texts: hashes h, first and end byte, and off, the first word of each text (n + 1)."""

    def __init__(self, texts: pa.Array):
        self.data, self.text_off = data, off = raw(pc.utf8_lower(texts.cast(pa.large_string())))
        m = _WORD[data]
        s, e = m.copy(), m.copy()
        s[1:] &= ~m[:-1]
        e[:-1] &= ~m[1:]
        if len(data):
            first, last = off[:-1][off[:-1] < off[1:]], off[1:][off[:-1] < off[1:]] - 1
            s[first] = m[first]
            e[last] = m[last]
        self.start, self.end = np.flatnonzero(s), np.flatnonzero(e) + 1
        self.off = np.searchsorted(self.start, off)
        self.h = span_hashes(data, self.start, self.end)
        self.n = np.diff(self.off)

    def chars(self, at: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Code-point offsets, within their texts, of byte positions."""
        count = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return count[at] - count[self.text_off[text]]


def words_of(text: str) -> list[str]:
    """The words of one text; the slow counterpart of Words, for tests and explanations."""
    low = pc.utf8_lower(pa.scalar(text)).as_py()
    return re.findall(r"[0-9A-Za-z_\u0080-\U0010ffff]+", low)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and end of each run of equal neighbours."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return first, np.append(first[1:], len(keys)) if len(first) else first


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of a partition sorted by key, cut so that no group is split between two of them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key)
        if held and held[-1].column(key)[-1] == k[0] and k[-1] == k[0]:
            held.append(b)
            continue
        differs = pc.not_equal(k, k[-1]).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if held and (cut or held[-1].column(key)[-1] != k[0]):
            whole = pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks()
            yield from whole.to_batches()
            held = []
        elif cut:
            yield b.slice(0, cut)
        held.append(b.slice(cut))
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in whatever case."""
    return name + "_" * (1 + max((len(c) for c in df.columns), default=0))


def free(df: DataFrame, name: str) -> str:
    """name, or where df has such a column, in whatever case, a name with underscores behind it that df doesn't have."""
    return fresh(df, name) if name.lower() in (c.lower() for c in df.columns) else name


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of texts of 4 MB at most, unless the session has its own limit: texts differ too much in length for
    a limit of rows, and a batch is held by the executor, by the worker and once more as its result."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "67108864b") == "67108864b":
        spark.conf.set(key, "4m")


def ids_only(docs: DataFrame) -> DataFrame:
    """doc_id, of whatever type that can be ordered, and text, whatever other columns there are."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))


def type_of(df: DataFrame, column: str = "doc_id") -> str:
    """The type of a column, for the schema of a worker's result."""
    return df.schema[column].dataType.simpleString()


def codes(a: pa.Array) -> np.ndarray:
    """Integers in the order of a's values: themselves, or ranks within the batch."""
    if pa.types.is_integer(a.type):
        return a.to_numpy(zero_copy_only=False)
    return np.unique(a.to_numpy(zero_copy_only=False), return_inverse=True)[1].astype(np.int64)
