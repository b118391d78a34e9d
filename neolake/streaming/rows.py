"""Operators that look at one row only, on streams.

Filters and tiers need no state; their thresholds are fixed when the stream
starts (for tiers that includes the clonal fraction). Ranks and reports need
the whole table: run them on what the stream has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def epitope_stream(spark: SparkSession, path: str, schema: StructType, files_at_once: int = 100) -> DataFrame:
    """Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def start(rows: DataFrame, steps: list[Callable[[DataFrame], DataFrame]], out: str, checkpoint: str) -> StreamingQuery:
    """Apply the steps to each row that arrives and append it to a Parquet folder, exactly once."""
    for step in steps:
        rows = step(rows)
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
