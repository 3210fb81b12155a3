"""Streams of change events into sinks: files of events in, one sink call for each micro-batch.

Progress moves only after the sink has returned, so a failure repeats the batch; the replica's ledger then leaves out
what an earlier attempt has committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def run(spark: SparkSession, path: str, schema, sink: Callable[[DataFrame, int], None], checkpoint: str, files: int = 1000) -> StreamingQuery:
    """Applies all event files under path that the checkpoint hasn't seen, then stops."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
