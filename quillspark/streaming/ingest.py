"""Growing collections: JSON lines that arrive in a folder, as a stream; each id is taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.schema import PAPER


def papers(spark: SparkSession, folder: str, schema: str = PAPER, files: int = 100) -> DataFrame:
    """New records of a folder, with the time of arrival."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder).withColumn("arrived", F.current_timestamp())


def once(stream: DataFrame, late: str = "7 days") -> DataFrame:
    """Each id once within the watermark, so the state doesn't grow for ever."""
    return stream.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["id"])


def append(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends to a Parquet table with exactly-once file commits; stops when what is there has been read."""
    return stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
