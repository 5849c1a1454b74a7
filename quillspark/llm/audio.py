"""Audio columns: polyphase resampling, overlapped log-mel filterbanks, hysteresis energy segmentation.

A clip is bytes: a RIFF/WAVE file with 16-bit PCM (channels are averaged), or else raw 8-bit mu-law samples at
`RAW_RATE`. It is resampled to `RATE` by a windowed-sinc polyphase filter, cut into frames of 25 ms every 10 ms (the last
or only one padded with zeros, so the frames reach the clip's end), and turned into the logarithms of `MELS` mel bands.
The frames are stored in tensors of fixed shape (`FRAMES`, `MELS`), the last one padded with zeros, each with its time
span, which ends with the clip at the latest. `store` writes them from the workers to Parquet files whose column has
Arrow's fixed-shape tensor type; Spark, which has no such type, reads it as an array of FRAMES x MELS floats. A segment of
sound begins where a frame's energy reaches `HIGH` dB below the clip's loudest frame and lasts as long as it stays above
`LOW` dB below it. Samples are decoded and resampled block by block, for the frames at hand, so a clip needs little more
memory than its bytes and its features.

Defined results: null clips and clips without samples give no row, as do WAVE files cut off before their format is
told (under `HEADER` bytes); other damaged WAVE headers are read as raw samples; silence gives one segment over the whole
clip; an empty table gives an empty result; rows are independent, whatever ids repeat, tie or are null; columns that are
no keys are ignored; where a key is called like a column of the result, that column gets underscores behind its name.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import small_batches, text_slices

RAW_RATE, RATE, WINDOW, HOP, FFT, MELS, FRAMES = 8000, 16000, 400, 160, 512, 40, 16
HIGH, LOW, TAPS, HEADER, BLOCK = 12.0, 24.0, 16, 36, 2048
TENSOR = pa.fixed_shape_tensor(pa.float32(), (FRAMES, MELS), dim_names=("frame", "mel"))


@cache
def _mulaw() -> np.ndarray:
    x = ~np.arange(256).astype(np.uint8)
    size = ((x & 15).astype(int) * 2 + 33 << ((x >> 4) & 7)) - 33
    return np.where(x & 128, -size, size) / 8159.0


def decode(clip: bytes) -> tuple[Callable[[int, int], np.ndarray], int, int]:
    """What gives the samples [a, b) of a clip, in [-1, 1]; how many there are; their rate."""
    if clip[:4] == b"RIFF" and clip[8:12] == b"WAVE":
        at, form = 12, None
        while at + 8 <= len(clip):
            kind, n = clip[at : at + 4], struct.unpack_from("<I", clip, at + 4)[0]
            if kind == b"fmt " and at + 24 <= len(clip):
                form = struct.unpack_from("<HHIIHH", clip, at + 8)
            if kind == b"data" and form and form[0] == 1 and form[5] == 16 and form[1] and form[2]:
                size = min(n, len(clip) - at - 8) // (2 * form[1]) * form[1]
                x = np.frombuffer(clip, "<i2", size, at + 8).reshape(-1, form[1])
                return lambda a, b: x[a:b].mean(axis=1) / 32768.0, len(x), form[2]
            at += 8 + n + n % 2
        if len(clip) < HEADER:
            return lambda a, b: np.zeros(0), 0, RAW_RATE
    raw_ = np.frombuffer(clip, np.uint8)
    return lambda a, b: _mulaw()[raw_[a:b]], len(raw_), RAW_RATE


@cache
def _filter(up: int, down: int) -> np.ndarray:
    """Low-pass for rates times up/down, TAPS input samples wide on each side, of gain `up`."""
    half = TAPS * max(up, down)
    t = np.arange(-half, half + 1) / max(up, down)
    h = np.sinc(t) * np.hanning(len(t) + 2)[1:-1]
    return h * up / h.sum()


def resampled(get: Callable[[int, int], np.ndarray], size: int, rate: int, first: int, end: int, to: int = RATE) -> np.ndarray:
    """Samples [first, end) at the rate `to`. Polyphase: output m is the filter's branch (m * down) % up over the input
    around (m * down) // up."""
    up, down = to // gcd(rate, to), rate // gcd(rate, to)
    if up == down:
        return get(first, end)
    h = _filter(up, down)
    half = len(h) // 2
    at = np.arange(first, end) * down + half  # output m is sum over j of h[at - j * up] x[j]
    if not len(at):
        return np.zeros(0)
    lo, hi = int(at[0]) // up - len(h) // up - 1, int(at[-1]) // up + 1
    x = np.zeros(hi - lo)
    a, b = max(lo, 0), min(hi, size)
    x[a - lo : b - lo] = get(a, b)
    out = np.empty(len(at))
    for phase in range(up):
        m = np.flatnonzero(at % up == phase)
        if len(m):
            out[m] = np.convolve(x, h[phase::up])[at[m] // up - lo]
    return out


def resample(x: np.ndarray, rate: int, to: int = RATE) -> np.ndarray:
    return resampled(lambda a, b: x[a:b], len(x), rate, 0, length(len(x), rate, to), to)


def length(size: int, rate: int, to: int = RATE) -> int:
    """How many samples a clip has after resampling."""
    return -(-size * (to // gcd(rate, to)) // (rate // gcd(rate, to)))


@cache
def mel_bank() -> np.ndarray:
    top = 2595 * np.log10(1 + RATE / 2 / 700)
    edge = 700 * (10 ** (np.linspace(0, top, MELS + 2) / 2595) - 1)
    f = np.arange(FFT // 2 + 1) * RATE / FFT
    lo, mid, hi = edge[:-2, None], edge[1:-1, None], edge[2:, None]
    return np.maximum(0, np.minimum((f - lo) / (mid - lo), (hi - f) / (hi - mid))).T


def log_mel(get: Callable[[int, int], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel rows and energies in dB of frames up to the end; the energy of the last one is that of its samples."""
    if not size:
        return np.zeros((0, MELS), np.float32), np.zeros(0)
    n = 1 + -(-max(0, size - WINDOW) // HOP)
    mel, db = np.empty((n, MELS), np.float32), np.empty(n)
    for i in range(0, n, BLOCK):  # in blocks, so a long clip needs no more memory than a short one
        j = min(n, i + BLOCK)
        x = get(i * HOP, min(size, (j - 1) * HOP + WINDOW))
        x = np.pad(x, (0, (j - 1 - i) * HOP + WINDOW - len(x)))
        part = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[::HOP]
        power = np.abs(np.fft.rfft(part * np.hanning(WINDOW), FFT)) ** 2
        mel[i:j] = np.log(np.maximum(power @ mel_bank(), 1e-10))
        held = np.minimum(WINDOW, size - np.arange(i, j) * HOP)
        db[i:j] = 10 * np.log10(np.maximum((part**2).sum(axis=1) / held, 1e-10))
    return mel, db


def segments(db: np.ndarray, high: float = HIGH, low: float = LOW) -> list[tuple[int, int]]:
    """Half-open runs of frames: begun at max - high, held above max - low."""
    if not len(db):
        return []
    above, loud = db >= db.max() - low, db >= db.max() - high
    edge = np.flatnonzero(np.diff(np.concatenate([[False], above, [False]]).astype(int)))
    out = []
    for s, e in edge.reshape(-1, 2):
        first = np.flatnonzero(loud[s:e])
        if len(first):
            out.append((int(s + first[0]), int(e)))
    return out


def features(clip: bytes) -> Iterator[tuple[int, float, float, int, np.ndarray, list[dict]]]:
    """For each tensor: number, time span, frames in use, tensor, the clip's segments that begin in it."""
    get, size, rate = decode(clip)
    mel, db = log_mel(lambda a, b: resampled(get, size, rate, a, b), length(size, rate))
    found = segments(db)
    span = lambda s, e: (s * HOP / RATE, min(((e - 1) * HOP + WINDOW) / RATE, size / rate))
    for k in range(0, len(mel), FRAMES):
        part = mel[k : k + FRAMES]
        tensor = np.zeros((FRAMES, MELS), np.float32)
        tensor[: len(part)] = part
        own = [dict(zip(("start_s", "end_s"), span(s, e), strict=True)) for s, e in found if k <= s < k + FRAMES]
        yield k // FRAMES, *span(k, k + len(part)), len(part), tensor, own


_SEGMENTS = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
_COLUMNS = (("tensor", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("n_frames", pa.int32()), ("features", pa.list_(pa.float32())), ("segments", _SEGMENTS))


def _names(keys: list[str]) -> list[str]:
    """Keys, then the result's own columns."""
    return [*keys, *(n + "_" * (1 + max(map(len, keys))) if n in {k.lower() for k in keys} else n for n, _ in _COLUMNS)]


def _rows(part: pa.RecordBatch, keys: list[str]) -> pa.RecordBatch:
    row, out = [], []
    for i, clip in enumerate(part.column("__clip")):
        if clip.is_valid:
            for f in features(clip.as_py()):
                row.append(i)
                out.append(f)
    cols = list(zip(*out, strict=True)) if out else [[]] * 6
    tensors = np.stack(cols[4]) if out else np.zeros((0, FRAMES, MELS), np.float32)
    cols[4] = pa.FixedShapeTensorArray.from_numpy_ndarray(tensors).storage if out else pa.array([], TENSOR.storage_type)
    own = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(cols, _COLUMNS, strict=True)]
    return pa.record_batch([*(part.column(f"__k{k}").take(pa.array(row, pa.int64())) for k in range(len(keys))), *own], names=_names(keys))


def _extract(keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in text_slices(b, "__clip"):
                rows = _rows(b.slice(lo, hi - lo), keys)
                at = len(keys) + 4
                yield rows.set_column(at, rows.schema.names[at], rows.column(at).cast(pa.list_(pa.float32())))

    return run


def _store(keys: list[str], uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, out = TaskContext.get().partitionId(), 0, None
        fs, root = pafs.FileSystem.from_uri(uri)
        own = f"{root}/.{uuid.uuid4().hex}"  # a task that runs again after a loss writes and renames anew
        for b in batches:
            for lo, hi in text_slices(b, "__clip"):
                rows = tensor_table(pa.Table.from_batches([_rows(b.slice(lo, hi - lo), keys)]), len(keys) + 4)
                if out is None:
                    sink = fs.open_output_stream(own)
                    out = pq.ParquetWriter(sink, rows.schema)
                out.write_table(rows)
                n += len(rows)
        if out is not None:
            out.close()
            sink.close()
            fs.move(own, f"{root}/part-{part:06d}.parquet")
            yield pa.record_batch({"part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int64())})

    return run


def _clips(clips: DataFrame, keys: list[str], column: str) -> tuple[DataFrame, str]:
    small_batches(clips.sparkSession)
    own = clips.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(column).cast("binary").alias("__clip"))
    kinds = [f.dataType.simpleString() for f in own.schema.fields[:-1]] + ["int", "double", "double", "int", "array<float>", "array<struct<start_s: double, end_s: double>>"]
    return own, ", ".join(f"`{n}` {t}" for n, t in zip(_names(keys), kinds, strict=True))


def extract(clips: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, tensor, start_s, end_s, n_frames, features (FRAMES x MELS floats, row by row), segments."""
    own, schema = _clips(clips, keys, column)
    return own.mapInArrow(_extract(keys), schema)


def store(clips: DataFrame, keys: list[str], column: str, uri: str) -> DataFrame:
    """The same rows, written below uri, which all executors share, with features as fixed-shape tensors, and read again."""
    spark = clips.sparkSession
    own, schema = _clips(clips, keys, column)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{uri}/tensors")
    path.getFileSystem(spark._jsparkSession.sparkContext().hadoopConfiguration()).mkdirs(path)
    own.mapInArrow(_store(keys, f"{uri}/tensors"), "part int, n bigint").write.parquet(f"{uri}/parts")
    return spark.read.schema(schema).parquet(f"{uri}/tensors")


def tensor_table(rows: pa.Table, at: int | None = None) -> pa.Table:
    """rows with their features (column `at`) as fixed-shape tensors; Arrow and Parquet files keep the type."""
    at = rows.schema.get_field_index("features") if at is None else at
    flat = rows.column(at).combine_chunks().flatten().cast(pa.float32())
    stored = pa.FixedSizeListArray.from_arrays(flat, FRAMES * MELS)
    return rows.set_column(at, pa.field(rows.schema.names[at], TENSOR), pa.ExtensionArray.from_storage(TENSOR, stored))
