"""The batch transforms on streams of files: normalised rows, deduplicated by record hash, and windowed counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(folder)


def first_within(df: DataFrame, key: str = "record_hash", at: str = "collected_at", late: str = "1 day") -> DataFrame:
    """The first row of each key as far as the watermark remembers it."""
    return df.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def counts(df: DataFrame, by: str, at: str, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """(window start, value, n) of event-time windows."""
    return df.withWatermark(at, late).groupBy(F.window(at, window), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), by, "n")


def run(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Micro-batches through a batch sink until the input is read; the checkpoint makes restarts exact."""
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
