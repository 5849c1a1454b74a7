"""Token ids as binary shards: independent zstandard frames, a trailing seek table, a checksum for each frame.

A shard is a file in Zstandard's public seekable format. Each document is a frame of its own, its ids as little-endian
16-bit (32-bit for larger vocabularies) integers; the seek table, a skippable frame at the end, has each frame's
compressed and decompressed size and the low 32 bits of the XXH64 of its content. A reader fetches the table and the
frames asked for, nothing else. A task writes under a name of its own attempt and renames at its end, so a task that
runs again after a loss leaves the same shard; the index of all documents is a Parquet table beside the shards.

Defined results: null ids -> an index row with null frame and count; no ids -> an empty frame; repeated and null doc_ids,
of any type, have a frame for each row; other columns are ignored; a document of any length is one frame of its own;
an empty table -> no shard and an empty index; an id that is negative or not below vocabulary_size -> ValueError.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quillspark.llm.common import type_of

LEVEL = 1
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "shard int, frame int, n_tokens bigint, n_bytes int, checksum bigint"


class ShardWriter:
    def __init__(self, out, level: int = LEVEL):
        self.out, self.entries = out, []
        self.z = zstandard.ZstdCompressor(level=level, write_checksum=False)

    def add(self, content: bytes) -> tuple[int, int, int]:
        """Frame number, compressed size and checksum of content, now written."""
        frame, mark = self.z.compress(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.out.write(frame)
        self.entries.append((len(frame), len(content), mark))
        return len(self.entries) - 1, len(frame), mark

    def finish(self) -> None:
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        foot = struct.pack("<IBI", len(self.entries), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(foot)) + table + foot)


class ShardReader:
    """Frames of a shard, each read and decompressed by itself."""

    def __init__(self, file):
        self.file, self.z = file, zstandard.ZstdDecompressor()
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError("no seek table with checksums")
        table = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(-1, 3)
        self.size, self.mark = table[:, 1], table[:, 2]
        self.at = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])

    def frame(self, i: int) -> bytes:
        content = self.z.decompress(self.file.read_at(int(self.at[i + 1] - self.at[i]), int(self.at[i])), max_output_size=int(self.size[i]) or 1)
        if len(content) != self.size[i] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.mark[i]:
            raise ValueError(f"frame {i} is damaged")
        return content


def _name(shard: int) -> str:
    return f"shard-{shard:06d}.zst"


def _width(vocabulary_size: int) -> int:
    return 2 if vocabulary_size <= 1 << 16 else 4


def _write(uri: str, vocabulary_size: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, kind = TaskContext.get().partitionId(), np.dtype(f"<u{_width(vocabulary_size)}")
        fs, root = pafs.FileSystem.from_uri(uri)
        own, out = f"{root}/.{uuid.uuid4().hex}", None
        for b in batches:
            if out is None:
                out = fs.open_output_stream(own, buffer_size=1 << 20)
                w = ShardWriter(out, level)
            lists = b.column("ids")
            flat, null = lists.flatten().to_numpy(zero_copy_only=False), lists.is_null().to_numpy(zero_copy_only=False)
            if len(flat) and not 0 <= flat.min() <= flat.max() < vocabulary_size:
                raise ValueError(f"token ids must be in [0, {vocabulary_size})")
            flat = flat.astype(kind)
            n = np.where(null, 0, np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            end = np.cumsum(n)
            rows = [(None,) * 5 if x else (shard, *((f := w.add(flat[e - k : e].tobytes()))[:1]), int(k), f[1], f[2]) for x, k, e in zip(null, n, end, strict=True)]
            cols = zip(*rows, strict=True) if rows else [[]] * 5
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.record_batch([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["doc_id", "shard", "frame", "n_tokens", "n_bytes", "checksum"])
        if out is not None:
            w.finish()
            out.close()
            fs.move(own, f"{root}/{_name(shard)}")

    return run


def write(tokens: DataFrame, uri: str, vocabulary_size: int = 1 << 16, level: int = LEVEL) -> DataFrame:
    """Writes (doc_id, ids) below uri, which all executors share, and returns the index: a row for each document."""
    spark = tokens.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{uri}/shards")
    path.getFileSystem(spark._jsparkSession.sparkContext().hadoopConfiguration()).mkdirs(path)
    own = tokens.select("doc_id", "ids")
    schema = f"doc_id {type_of(own)}, {INDEX}"
    own.mapInArrow(_write(f"{uri}/shards", vocabulary_size, level), schema).write.parquet(f"{uri}/index")
    return spark.read.schema(schema).parquet(f"{uri}/index")


def _read(uri: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        open_: dict[int, ShardReader] = {}
        for b in batches:
            ids = []
            for s, f in zip(b.column("shard").to_pylist(), b.column("frame").to_pylist(), strict=True):
                if f is not None and s not in open_:
                    open_.clear()
                    open_[s] = ShardReader(fs.open_input_file(f"{root}/{_name(s)}"))
                ids.append(None if f is None else np.frombuffer(open_[s].frame(f), f"<u{width}").astype(np.int32))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return run


def read(wanted: DataFrame, uri: str, vocabulary_size: int = 1 << 16) -> DataFrame:
    """(doc_id, ids) for rows of the index; only their frames are decompressed."""
    own = wanted.select("doc_id", "shard", "frame").repartition("shard").sortWithinPartitions("shard", "frame")
    return own.mapInArrow(_read(f"{uri}/shards", _width(vocabulary_size)), f"doc_id {type_of(own)}, ids array<int>")
