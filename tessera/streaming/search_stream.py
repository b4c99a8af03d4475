"""Searching a stream of queries against a persisted index.

Top-k per query needs a ranking window, which a streaming plan cannot hold, so each
micro-batch of queries is searched as a batch job against the static index
(``foreachBatch``).  Every batch writes into its own ``epoch=<id>`` folder with overwrite,
so a batch replayed after a failure replaces its earlier output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.functions import constants as K
from tessera.operators.segments import Version
from tessera.plans.ingest import current_version, search_index

QUERY_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
])


def start_search_stream(spark: SparkSession, source_dir: str, index: Version | str, sink_dir: str,
                        checkpoint_dir: str, top_k: int = K.SEARCH_TOP_K,
                        level: str | None = None, schema: T.StructType = QUERY_SCHEMA,
                        available_now: bool = True) -> StreamingQuery:
    """Top-k hits of every query file arriving in ``source_dir``, as parquet under
    ``sink_dir/epoch=<batch id>``.  ``index`` is a version, or the folder of an index, of which
    every batch takes the version that is current when it starts."""
    def search_batch(batch, epoch_id: int) -> None:
        version = current_version(batch.sparkSession, index) if isinstance(index, str) else index
        hits = search_index(version, batch, top_k=top_k, level=level)
        hits.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    writer = (spark.readStream.schema(schema).parquet(source_dir).writeStream
              .foreachBatch(search_batch).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
