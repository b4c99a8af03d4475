"""Routing a stream of queries with Structured Streaming.

Classification and dispatch are narrow, stateless projections, so the batch router runs
unchanged on a streaming DataFrame; the call log becomes an append-only file sink with a
checkpoint (exactly-once file output, restartable after failure).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.router.registry import Router, call_log, default_router

QUERY_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("query", T.StringType()),
])


def routed_stream(spark: SparkSession, source_dir: str, router: Router | None = None,
                  schema: T.StructType = QUERY_SCHEMA,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming call log ``(query_id, query, detected, module_used, confidence)`` over
    parquet files arriving in ``source_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return call_log((router or default_router()).route(reader.parquet(source_dir)))


def start_router_log(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                     router: Router | None = None, available_now: bool = True) -> StreamingQuery:
    """Append the call log of every arriving query to parquet files in ``sink_dir``."""
    writer = (routed_stream(spark, source_dir, router).writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
