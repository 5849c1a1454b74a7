"""Spark sessions."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parent.parent)


def attach(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it. On a cluster whose nodes don't share that
    path, ship the package with --py-files instead."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *paths])
    return spark


def local(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("quillspark")
    own = {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory, "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    return attach(b.config(map=own | conf).getOrCreate())


_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is named, one of our own, on a local master
    only: executors of a cluster wouldn't share it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="quill"))
        atexit.register(shutil.rmtree, _own_dir[0], True)
    return "file://" + _own_dir[0]


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/quill-{tag}-{uuid.uuid4().hex}"


def reliable(df: DataFrame) -> DataFrame:
    """df computed once and checkpointed in the shared folder, so that it outlives executors."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


#: Documents of a batch that are Python objects at the same time.
SLICE = 50


def sliced(f: Callable, kind: str, arrow: pa.DataType) -> Callable:
    """An Arrow UDF of `kind` (and `arrow`, which is the same) from f on plain values; of a batch only SLICE rows are Python objects."""

    @F.arrow_udf(kind)
    def run(first: pa.Array, second: pa.Array) -> pa.Array:
        parts = [pa.array([f(x, y) for x, y in zip(first.slice(lo, SLICE).to_pylist(), second.slice(lo, SLICE).to_pylist(), strict=True)], arrow) for lo in range(0, len(first), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return run
